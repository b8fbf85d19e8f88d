"""Main text of web pages by tag-path ratios.

A page is cut into blocks: runs of text between block-level tags, each with its
root-to-leaf tag path.  Per path the text length, punctuation and link text are
summed and divided by the number of its blocks, which gives three ratios per
path.  The ratios of the blocks in page order are smoothed with a short
Gaussian, averaged again per path and fused into one score, weighted by what
the path's own names say (``article`` and ``main`` count more; menus, adverts,
forms and the like count nothing).  Paths above a share of the best score are
content.  Content inside an ``article`` or ``main`` takes with it every block of
that element (the outermost one) that is not named as boilerplate.  Content below
another common container takes what lies between its first and last block, and
content directly under ``body`` what lies there and is not mostly links, so
headings and short paragraphs stay with their article.

Hidden elements and boilerplate tags drop all that is in them.  Class, id and role
words only mark an element that holds neither the article or main element with the
most unlinked text nor more than half of the page's unlinked text.  Elements named as
reader comments are left out of these sums and never spared for their size, unless all
text of the page stands in them, or the page's only article or main element does.

Defined cases: null, empty or text-free pages give an empty text.  Tags that
are never closed, stray end tags, unclosed comments and quotes are accepted.
Pages are independent of each other; equal rows give equal rows; other columns
are ignored.  Nothing is capped: the whole page is read and kept.  Paths are numbered,
so pages nested thousands of blocks deep take memory in proportion to their length.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint, content_path string"

# fixed values: HTML elements by role
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea select svg math iframe object title".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s "
             "samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
               "h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
               "th": {"tr", "table"}, "option": set()}
BOILER_TAGS = set("nav footer aside form button dialog header menu head".split())
BOILER_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "notice notices gdpr popup modal overlay newsletter subscribe signup sidebar widget widgets related recommended "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager share sharing social comment comments disqus "
    "replies respond footer header masthead toolbar login search skip hidden copyright alert contentinfo complementary "
    "form".split())
COMMENT_WORDS = set("comment comments disqus replies respond".split())
# words that tell of a page's state: "no-comments", "comments-open"
STATE_WORDS = set("no has with without open opened closed enabled disabled".split())
PAGE_ONLY = {"header", "banner"}     # no boilerplate inside an article: its own heading
MAIN_TAGS = {"article", "main"}
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
UNSEEN = re.compile(r"(?<![\w-])(?:display\s*:\s*none|visibility\s*:\s*hidden)(?![\w-])", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
THRESHOLD = 0.25
MAIN_WEIGHT = 4.0


class Block:
    """Text of one block with the number of its tag path.

    ``main`` is (place, path) of its outermost article or main element; ``marks`` are the places of
    the elements around it that are marked by their words.
    """

    __slots__ = ("path", "boiler", "marks", "main", "text", "linked")

    def __init__(self, path, boiler, marks, main):
        self.path, self.boiler, self.marks, self.main, self.text, self.linked = path, boiler, marks, main, [], 0

    def unlinked(self) -> int:
        return max(0, len(" ".join("".join(self.text).split())) - self.linked)


def _hidden(attrs: str) -> bool:
    low = attrs.lower()
    if "hidden" not in low and "none" not in low:
        return False
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" \
                or name == "style" and UNSEEN.search(value):
            return True
    return False


def _boiler_names(attrs: str, inside_main: bool) -> tuple[bool, bool]:
    """(marked as boilerplate, marked as reader comments) by class, id and role."""
    marked = False
    for m in NAMES.finditer(attrs):
        for name in m[1].strip("\"'").split():
            words = {w.lower() for w in WORDS.findall(name)}
            if words & COMMENT_WORDS and words & STATE_WORDS:
                continue
            if words & COMMENT_WORDS:
                return True, True
            words &= BOILER_WORDS
            marked = marked or bool(words - PAGE_ONLY or words and not inside_main)
    return marked, False


class Paths:
    """Numbered tag paths: each is its parent's number and a tag; 0 is the root, parents come first."""

    def __init__(self):
        self.parent, self.tag, self.depth, self.known = [0], [""], [0], {}

    def child(self, path: int, tag: str) -> int:
        number = self.known.setdefault((path, tag), len(self.parent))
        if number == len(self.parent):
            self.parent.append(path)
            self.tag.append(tag)
            self.depth.append(self.depth[path] + 1)
        return number

    def common(self, paths: set[int]) -> int:
        """The container of all paths: a single path's own parent, else the deepest path above all."""
        paths = set(paths)
        if len(paths) == 1:
            path = paths.pop()
            return self.parent[path] if self.depth[path] > 1 else path
        while len(paths) > 1:
            deepest = max(self.depth[p] for p in paths)
            paths = {self.parent[p] if self.depth[p] == deepest else p for p in paths}
        return paths.pop()

    def below(self, top: int) -> np.ndarray:
        """For each path, whether it is ``top`` or lies in it."""
        inside = np.zeros(len(self.parent), bool)
        for p, parent in enumerate(self.parent):
            inside[p] = p == top or p > 0 and inside[parent]
        return inside

    def text(self, path: int) -> str:
        tags = []
        while path:
            tags.append(self.tag[path])
            path = self.parent[path]
        return "".join(f"/{t}" for t in reversed(tags))


def blocks_of(page: str) -> tuple[list[Block], Paths]:
    """Blocks with text, in page order, and the paths that they number."""
    out: list[Block] = []
    paths, comments = Paths(), set()
    # (tag, path, boilerplate, places of the elements marked by their words, outermost article or main)
    stack: list[tuple[str, int, bool, tuple, tuple | None]] = []
    current, links, at = None, 0, 0

    def add(piece: str) -> None:
        nonlocal current
        if not piece:
            return
        if current is None:
            if piece.isspace():
                return
            current = Block(*(stack[-1] if stack else ("", 0, False, (), None))[1:])
            out.append(current)
        piece = _html.unescape(piece) if "&" in piece else piece
        current.text.append(piece)
        if links:
            current.linked += len(piece)

    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        add(page[at:m.start()])
        at = m.end()
        close, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not close:
            if not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if close else links + 1
            continue
        current = None
        if tag in VOID:
            continue
        if close:
            if any(s[0] == tag for s in reversed(stack)):
                while stack.pop()[0] != tag:
                    pass
                links = 0
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] in CLOSES_P and stack[k][0] != "p":
                    break
        if tag in CLOSES_SAME:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in CLOSES_SAME[tag]:
                    break
        _, path, boiler, marks, main = stack[-1] if stack else ("", 0, False, (), None)
        if tag not in ("html", "body"):
            boiler = boiler or _hidden(attrs) or tag in BOILER_TAGS and not (tag == "header" and main)
            marked, comment = _boiler_names(attrs, main is not None)
            if marked:
                marks = (*marks, m.start())
            if comment:
                comments.add(m.start())
        path = paths.child(path, tag)
        stack.append((tag, path, boiler, marks, main or ((m.start(), path) if tag in MAIN_TAGS else None)))
    add(page[at:])
    out = [b for b in out if any(not t.isspace() for t in b.text)]
    _judge_marks(out, comments)
    return out, paths


def _judge_marks(blocks: list[Block], comments: set[int]) -> None:
    """Blocks in a marked element are boilerplate, unless the page's article or most of its text is in it."""
    if not any(b.marks for b in blocks):
        return
    seen = [b for b in blocks if not b.boiler]
    plain = [b for b in seen if comments.isdisjoint(b.marks)]
    if not any(b.main for b in plain) and len({b.main for b in seen if b.main}) == 1 or not plain:
        plain = seen
    marked, mains, total = {}, {}, 0
    for b in plain:
        size = b.unlinked()
        total += size
        for k in b.marks:
            marked[k] = marked.get(k, 0) + size
        if b.main:
            mains[b.main] = mains.get(b.main, 0) + size
    largest = max(mains, key=mains.get, default=None)
    spared = {k for k, size in marked.items() if 2 * size > total and (k not in comments or size == total)}
    for b in plain:
        if b.main and b.main == largest:
            spared.update(k for k in b.marks if k <= largest[0])
    for b in blocks:
        b.boiler = b.boiler or not spared.issuperset(b.marks)


def _smooth(x: np.ndarray) -> np.ndarray:
    weight = np.convolve(np.ones(len(x)), KERNEL, "same")[:len(x)] if len(x) >= 5 else None
    if weight is None:
        padded = np.concatenate((x, np.zeros(5 - len(x))))
        ones = np.concatenate((np.ones(len(x)), np.zeros(5 - len(x))))
        return (np.convolve(padded, KERNEL, "same") / np.maximum(np.convolve(ones, KERNEL, "same"), 1e-9))[:len(x)]
    return np.convolve(x, KERNEL, "same") / weight


def content_blocks(blocks: list[Block], paths: Paths) -> tuple[list[str], str]:
    """(texts of the content blocks, the path of their container)."""
    blocks = [b for b in blocks if not b.boiler]
    if not blocks:
        return [], ""
    texts = [" ".join("".join(b.text).split()) for b in blocks]
    names, path = np.unique([b.path for b in blocks], return_inverse=True)
    n = np.bincount(path)
    per_path = lambda v: (np.bincount(path, v) / n)[path]
    length = np.array([len(t) for t in texts], float)
    marks = np.array([len(PUNCTUATION.findall(t)) for t in texts], float)
    free = 1 - np.minimum(1, np.array([b.linked for b in blocks]) / np.maximum(1, length))
    ratio = _smooth(per_path(length * free))
    punctuation = _smooth(per_path(marks))
    weight = np.where([b.main is not None for b in blocks], MAIN_WEIGHT, 1.0)
    score = per_path(ratio * np.sqrt(1 + punctuation) * per_path(free) * weight)
    chosen = score >= THRESHOLD * score.max()
    roots = {b.path for b, c in zip(blocks, chosen) if c}
    mains = {b.main for b, c in zip(blocks, chosen) if c and b.main}
    if mains:
        tops = {path for _, path in mains}
        root = tops.pop() if len(tops) == 1 else paths.common(tops)
        chosen = [b.main in mains for b in blocks]
    else:
        root = paths.common(roots)
        places = np.flatnonzero(chosen)     # other elements may have the same path: only what lies between
        if paths.tag[root] in ("", "html", "body"):
            chosen = [c or places[0] <= k <= places[-1] and free[k] > 0.5 for k, c in enumerate(chosen)]
        else:
            inside = paths.below(root)
            chosen = [places[0] <= k <= places[-1] and inside[b.path] for k, b in enumerate(blocks)]
    return [t for t, c in zip(texts, chosen) if c and t], paths.text(root)


def main_text(page: str | None) -> tuple[str, int, str]:
    """(text, number of blocks, content path) of one page."""
    texts, root = content_blocks(*blocks_of(page or ""))
    return " ".join(texts), len(texts), root


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, content_path) for every row of ``pages``."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [main_text(p) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([f[0] for f in found], pa.string()),
                     pa.array([len(f[0]) for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                     pa.array([f[2] for f in found], pa.string())],
                    names=["page_id", "url", "text", "n_chars", "n_blocks", "content_path"])

    return pages.selectExpr(f"cast(`{key}` as bigint) page_id", f"`{url}` url", f"`{html}` html").mapInArrow(run, SCHEMA)
