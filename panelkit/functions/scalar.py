"""Scalar column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def colref(name: str) -> Column:
    """A column by its literal name, even with dots, spaces or backticks in it
    (``F.col("a.b")`` would mean field b of struct a)."""
    return F.col("`" + name.replace("`", "``") + "`")


# Every double of magnitude >= 2^53 is an integer: floor() is the identity there.
_INTEGRAL = float(2 ** 53)


def round_half_up(c, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` as a double.

    The same arithmetic gives bit-identical results in Spark and DuckDB,
    which ``round()`` does not at half points. Spark's ``floor`` returns a
    BIGINT (an ANSI overflow error past 9.2e18), so it is applied only below
    2^53, where it is needed; above, the value already is an integer."""
    scale = float(10 ** digits)
    y = col(c) * F.lit(scale) + F.lit(0.5)
    floored = F.when(F.abs(y) < F.lit(_INTEGRAL), F.floor(y).cast("double")).otherwise(y)
    return floored / F.lit(scale)


def row_mean(cols: Sequence[str]) -> Column:
    """Mean of several columns of one row; NULL if any of them is NULL."""
    total = reduce(lambda a, b: a + b, [col(c) for c in cols])
    return total / F.lit(float(len(cols)))


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    d = col(den)
    return F.when(d != F.lit(0), col(num) / d)


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation over rows where both sides are non-NULL, NULL for
    a constant column (Spark's ``corr`` raises DIVIDE_BY_ZERO under ANSI)."""
    both = col(x).isNotNull() & col(y).isNotNull()
    xx = F.when(both, col(x))
    yy = F.when(both, col(y))
    return safe_div(F.covar_samp(xx, yy), F.stddev_samp(xx) * F.stddev_samp(yy))


def fixed_text(c, digits: int) -> Column:
    """Python ``f"{x:.Nf}"``: half-even on the binary value, no separators."""
    return F.regexp_replace(F.format_number(col(c), digits), ",", "")


def thousands_text(c) -> Column:
    """Python ``f"{n:,}"`` for integers."""
    return F.format_number(col(c), 0)


def decoded_path(path_col) -> Column:
    """``_metadata.file_path``/``file_name`` are URI-encoded (a space is %20;
    '+' is left as is, so it is protected from form decoding)."""
    return F.url_decode(F.regexp_replace(col(path_col), r"\+", "%2B"))


def file_stem(path_col) -> Column:
    """File name without its last extension (``raw_<stem>`` naming)."""
    return F.regexp_extract(col(path_col), r"([^/]+?)(\.[^./]*)?$", 1)


def bytes_to_mb(c, digits: int = 2) -> Column:
    return round_half_up(col(c) / F.lit(1024.0 * 1024.0), digits)


def let(x: Column, f) -> Column:
    """``f(x)`` with ``x`` evaluated once, however often ``f`` uses it (also where the
    optimiser would copy ``x`` into every use, as when a filter passes a projection)."""
    return F.transform(F.array(x), f)[0]


def timestamp_text(c) -> Column:
    """A time as the reports write it: ``yyyy-MM-dd HH:mm:ss`` in the session's time zone."""
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")


def position_in(c, values: Sequence) -> Column:
    """0-based place of a value in a list, NULL if it is not in it."""
    at = F.array_position(F.array(*[F.lit(v) for v in values]), col(c))
    return F.when(at > 0, at - 1)
