"""Row-wise expressions.  All return JVM-side Columns (no Python UDFs).

Semantics kept from the reference dialect where Spark differs:
* integer division truncates there; ``floor_div`` is exact floor division;
* a remainder follows the dividend in both engines; ``pmod`` is used for a
  canonical residue;
* splitting '' yields no element there and [''] in Spark: ``nonempty_split``
  drops empty pieces;
* ``2^n`` is done with shifts on BIGINT, never through DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(x, m) -> Column:
    """Exact floor(x / m) for integers, also for negative x (m > 0)."""
    x, m = _c(x), (m if isinstance(m, Column) else F.lit(m))
    return int_div(x - F.pmod(x, m), m)


def int_div(a, b) -> Column:
    """Integral division (SQL ``div``, truncating); never goes through DOUBLE."""
    b = b if isinstance(b, Column) else F.lit(b)
    return F.call_function("div", _c(a).cast("bigint"), b.cast("bigint"))


def bit(i) -> Column:
    """BIGINT with only bit ``i`` set."""
    if isinstance(i, int):
        return F.shiftleft(F.lit(1).cast("bigint"), i)
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), _c(i).cast("int"))


def cents(value) -> Column:
    """Round a DOUBLE amount to integer cents (HALF_UP, as both engines do)."""
    return F.round(_c(value) * 100).cast("bigint")


def nonempty_split(s, pattern: str) -> Column:
    """``split`` that yields no empty pieces (and nothing for '' or NULL)."""
    return F.filter(F.split(F.coalesce(_c(s), F.lit("")), pattern), lambda t: t != "")


def is_block_repeat(x) -> Column:
    """True when the decimal text of ``x`` is one block repeated >= 2 times."""
    return _c(x).cast("string").rlike(r"^([0-9]+)\1+$")
