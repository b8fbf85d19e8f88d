"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from stratum.llm import quality as Q

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def quality_rules() -> str:
    """The same counts by listing every window as text and numbering equal ones."""
    grams, covers, tops, cols = [], [], [], []
    for n in sorted({3, *Q.TOP_PCT, *Q.DUP_PCT}):
        words = " || ' ' || ".join(["w", *[f"lead(w, {k}) OVER d" for k in range(1, n)]])
        grams.append(f"{words} AS g{n}")
        if n in Q.TOP_PCT:
            tops.append(f"""top{n} AS (SELECT doc_id, max(c) AS top{n}_chars FROM (
                SELECT doc_id, count(*) * (length(g{n}) - {n - 1}) AS c FROM grams
                WHERE g{n} IS NOT NULL GROUP BY doc_id, g{n} HAVING count(*) >= {Q.TOP_LEAST}) GROUP BY doc_id)""")
        if n == 3:
            covers.append("max(CASE WHEN g3 IS NOT NULL AND count3 > 1 THEN 1 ELSE 0 END) OVER "
                          "(PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rep3")
        if n in Q.DUP_PCT:
            covers.append(f"max(CASE WHEN g{n} IS NOT NULL AND nth{n} > 1 THEN 1 ELSE 0 END) OVER "
                          f"(PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS cov{n}")
            cols.append(f"sum(length(w) * cov{n}) AS dup{n}_chars")
    nths = ["count(*) OVER (PARTITION BY doc_id, g3) AS count3",
            *[f"row_number() OVER (PARTITION BY doc_id, g{n} ORDER BY pos) AS nth{n}" for n in Q.DUP_PCT]]
    counts = ", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in Q.COUNTS)
    bad = [f"100 * n_symbols > {Q.SYMBOLS_PER_100_WORDS} * n_words",
           f"100 * n_dup_lines > {Q.DUP_LINES_PCT} * n_lines",
           f"100 * dup_line_chars > {Q.DUP_LINE_CHARS_PCT} * word_chars",
           *[f"100 * top{n}_chars > {p} * word_chars" for n, p in Q.TOP_PCT.items()],
           *[f"100 * dup{n}_chars > {p} * word_chars" for n, p in Q.DUP_PCT.items()]]
    top_names = [f"top{n}" for n in Q.TOP_PCT]
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos
          FROM (SELECT doc_id, {WORDS} AS ws FROM d)),
grams AS (SELECT doc_id, pos, w, {', '.join(grams)} FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
nths AS (SELECT *, {', '.join(nths)} FROM grams),
cover AS (SELECT doc_id, w, {', '.join(covers)} FROM nths),
perword AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, sum(rep3) AS n_repeat_words,
            {', '.join(cols)} FROM cover GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d),
wordlines AS (SELECT doc_id, l, count(*) AS n,
              length(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars
              FROM lines WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, l),
perline AS (SELECT doc_id, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines, sum((n - 1) * chars) AS dup_line_chars
            FROM wordlines GROUP BY doc_id),
{', '.join(tops)},
counted AS (SELECT d.doc_id, length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
            * EXCLUDE (doc_id, text) FROM d LEFT JOIN perword USING (doc_id) LEFT JOIN perline USING (doc_id)
            {' '.join(f'LEFT JOIN {t} USING (doc_id)' for t in top_names)}),
final AS (SELECT doc_id, {counts} FROM counted),
judged AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_WORDS_PCT} * n_words
           AS base_failed FROM final)
SELECT *, NOT base_failed AND NOT ({' OR '.join(bad)}) AS kept FROM judged"""


def url_filter(rules: list) -> str:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in rules)
    return f"""
WITH rules(rh, rp, action) AS (VALUES {values}),
parsed AS (SELECT page_id,
  coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
hosts AS (SELECT DISTINCT host, path FROM parsed),
best AS (SELECT host, path, first(rh || rp ORDER BY length(rh || rp) DESC, length(rh) DESC) AS rule,
         first(action ORDER BY length(rh || rp) DESC, length(rh) DESC) AS action
         FROM hosts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
         GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parsed LEFT JOIN best USING (host, path)"""


def html_text() -> str:
    """The article element without tags; these pages hold no other markup inside it."""
    return r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS article FROM pages),
t AS (SELECT page_id, url, article, trim(regexp_replace(
        replace(replace(replace(replace(regexp_replace(article, '<[^>]*>', ' ', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars,
       len(list_filter(regexp_split_to_array(article, '<(?:p|h1|br|/p|/h1|/br)>'),
           lambda x: regexp_matches(regexp_replace(x, '<[^>]*>', '', 'g'), '\S')))::BIGINT AS n_blocks,
       '/html/body/article' AS content_path
FROM t"""


LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def jaccard_join(width: int = 5, percent: int = 80) -> str:
    """All pairs of sets that share a shingle, counted; then reachability."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[]
         WHEN len(ws) < {width} THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - {width} + 2),
                             lambda i: array_to_string(ws[i:i + {width} - 1], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
         GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
          WHERE 100 * c >= {percent} * (nx.n + ny.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
       least(doc_id, (SELECT min(y) FROM reach WHERE x = doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id)"""


def decontamination(window: int = 10) -> str:
    """Windows as text, joined with every stretch of document words of the same length."""
    words = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH i AS (SELECT item_id, {words} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), {window}) AS size, unnest(list_transform(
          range(1, greatest(len(ws) - {window}, 0) + 2), lambda k: array_to_string(ws[k:k + {window} - 1], ' '))) AS t
        FROM i WHERE len(ws) > 0),
d AS (SELECT doc_id, {words} AS ws FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
p AS (SELECT doc_id, size, ws, unnest(range(1, len(ws) - size + 2)) AS pos FROM d, sizes WHERE len(ws) >= size),
hits AS (SELECT p.doc_id, p.pos, p.size, win.item_id FROM p JOIN win
         ON win.size = p.size AND win.t = array_to_string(p.ws[p.pos:p.pos + p.size - 1], ' ')),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id),
covered AS (SELECT doc_id, count(*) AS n_hit FROM (
            SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (doc_id) LEFT JOIN covered USING (doc_id)"""


def prefix_trie(every: int = 20, shares: int = 4) -> str:
    """Every prefix of every rebuilt conversation as a list; subtrees by listing each node under its prefixes.

    crc32 is computed from its polynomial, byte by byte.
    """
    steps = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    words = r"len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))"
    return f"""
WITH RECURSIVE tab(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, k + 1, {steps} FROM tab WHERE k < 8),
crc(conv_id, s, k, v) AS (
  SELECT conv_id, conv_id::VARCHAR, 0, 4294967295::BIGINT FROM (SELECT DISTINCT conv_id FROM conversations)
  WHERE conv_id IS NOT NULL
  UNION ALL SELECT conv_id, s, crc.k + 1, xor(crc.v >> 8, tab.v) FROM crc JOIN tab
  ON tab.k = 8 AND tab.i = xor(crc.v & 255, ascii(s[crc.k + 1])) WHERE crc.k < length(s)),
h AS (SELECT conv_id, xor(v, 4294967295) % {shares} AS h FROM crc WHERE k = length(s)),
own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS s
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (SELECT own.conv_id, coalesce(base.s[1:h], []) || own.s[h + 1:] AS s FROM own JOIN h USING (conv_id)
            LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % {every}),
member AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM rebuilt),
node AS (SELECT s[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = depth), '') AS ends
         FROM member GROUP BY ALL),
valued AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * (SELECT {words.replace("x,", "path[-1].x,")}) END AS value
           FROM node),
above AS (SELECT path AS below, value, depth AS below_depth, unnest(range(0, depth + 1)) AS depth FROM valued),
childless AS (SELECT path FROM node WHERE path NOT IN (SELECT path[1:depth - 1] FROM node WHERE depth > 0)),
subtree AS (SELECT below[1:depth] AS path, depth, sum(value) AS saved,
            count(*) FILTER (below IN (SELECT path FROM childless)) AS leaves,
            count(*) FILTER (below_depth = depth + 1) AS children FROM above GROUP BY ALL)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id,
       n.n_convs::BIGINT AS n_convs, children::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n JOIN subtree t ON t.depth = n.depth AND t.path = n.path
LEFT JOIN node p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]"""


def fill_in_middle(percent: int = 90, spm_percent: int = 20) -> str:
    draws = ", ".join(f"('0x' || substr(d, {1 + 8 * k}, 8))::BIGINT AS h{k + 1}" for k in range(4))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
           sha256('1:' || doc_id::VARCHAR) AS d FROM documents),
h AS (SELECT *, {draws} FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
      CASE WHEN n = 0 OR h3 % 100 >= {percent} OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           THEN 'plain' WHEN h4 % 100 < {spm_percent} THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(text, 1, a) AS pre, substr(text, a + 1, b - a) AS mid, substr(text, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""
