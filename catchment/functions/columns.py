"""Column helpers: small ``Column -> Column`` functions built from Spark's own
expressions, so that they stay inside whole-stage code generation.

Every helper returns a Column; none calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number written as text: optional sign, digits with an optional fraction, an
# optional exponent. Grouping marks are removed before this is matched.
_NUMBER_RE = r"[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def prefix(col: Column | str, width: int) -> Column:
    """First ``width`` characters (area id from block id)."""
    return F.substring(_c(col), 1, width)


def lenient_number(col: Column | str, grouping_mark: str = ",") -> Column:
    """Text to double the lenient way: grouping marks are dropped, the first
    number in the text is taken, text without a number becomes NULL.

    ``'1,234'`` -> 1234.0, ``'$12.5%'`` -> 12.5, ``'x'`` -> NULL, ``''`` -> NULL.
    The cast only ever sees text that matched the number pattern, so it cannot
    raise under ANSI mode.
    """
    cleaned = F.regexp_replace(_c(col).cast("string"), F.lit(grouping_mark), F.lit(""))
    found = F.regexp_extract(cleaned, _NUMBER_RE, 0)
    return F.when(found != F.lit(""), found.cast("double"))


def safe_div(num: Column | str, den: Column | str) -> Column:
    """Division where a zero denominator gives NULL instead of Inf/NaN/error."""
    return F.try_divide(_c(num), _c(den))


def round_half_even(col: Column | str, digits: int = 0) -> Column:
    """Round half to even; ``digits=0`` uses ``rint`` (exact on doubles)."""
    return F.rint(_c(col)) if digits == 0 else F.bround(_c(col), digits)


def zero_to_null(col: Column | str) -> Column:
    """0 -> NULL, everything else unchanged."""
    return F.nullif(_c(col), F.lit(0))


def null_to_zero(col: Column | str) -> Column:
    """NULL -> 0."""
    return F.coalesce(_c(col), F.lit(0))


def nonfinite_to_null(col: Column | str) -> Column:
    """NaN and +-Inf -> NULL (for doubles that come from outside)."""
    c = _c(col)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def if_else(cond: Column, yes: Column, no: Column) -> Column:
    """Conditional where a NULL condition gives NULL, not the ``no`` branch."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def replace_first(col: Column | str, old: str, new: str) -> Column:
    """Replace the first occurrence of the literal ``old`` by ``new``."""
    import re

    pattern = "^(.*?)" + re.escape(old)
    return F.regexp_replace(_c(col), F.lit(pattern), F.lit("$1" + new.replace("$", "\\$")))


def num_text(col: Column | str, digits: int = 2) -> Column:
    """Shortest text of a number already rounded to ``digits`` places:
    trailing zeros and a bare point are dropped, and a negative zero prints
    ``0`` (2.0 -> '2', 0.370 -> '0.37', -0.0 -> '0')."""
    fixed = F.format_string(f"%.{digits}f", _c(col))
    trimmed = F.regexp_replace(F.regexp_replace(fixed, r"0+$", ""), r"\.$", "")
    trimmed = F.regexp_replace(trimmed, r"^-0$", "0")
    return F.when(_c(col).isNotNull(), trimmed)


def range_text(mid: Column | str, low: Column | str, high: Column | str, digits: int = 2) -> Column:
    """``'mid (low-high)'``, e.g. ``'0.37 (-0.46-2)'``; NULL if a part is NULL."""
    return F.concat(
        num_text(mid, digits), F.lit(" ("), num_text(low, digits), F.lit("-"),
        num_text(high, digits), F.lit(")"),
    )


# Coefficients of the double-precision normal CDF approximation
# of Hart (1968) as published by West (2005), "Better approximations to
# cumulative normal functions". Numerator, then denominator, highest power first.
_HART_NUM = [
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
_HART_DEN = [
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]
_HART_SPLIT = 7.07106781186547
_SQRT_2PI = 2.506628274631


def _horner(coefs: list[float], x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def normal_cdf(z: Column | str) -> Column:
    """Standard normal CDF as column arithmetic (neither Spark nor DuckDB has
    ``erf``); relative error below 1e-12 in the body, continued fraction in the
    tail. NULL in, NULL out."""
    zc = _c(z)
    a = F.abs(zc)
    expo = F.exp(-(a * a) / F.lit(2.0))
    body = expo * _horner(_HART_NUM, a) / _horner(_HART_DEN, a)
    frac = a + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        frac = a + F.lit(k) / frac
    tail = expo / frac / F.lit(_SQRT_2PI)
    lower = F.when(a > F.lit(37.0), F.lit(0.0)).when(a < F.lit(_HART_SPLIT), body).otherwise(tail)
    return F.when(zc.isNull(), F.lit(None)).when(zc > 0, F.lit(1.0) - lower).otherwise(lower)
