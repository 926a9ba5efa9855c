"""Column expressions shared by the ETL, feature and read plans.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it stays inside
whole-stage codegen; nothing is a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "NUMERIC_TEXT", "safe_float", "safe_int", "safe_long", "text_true", "safe_div", "season_label", "season_start",
    "ymd", "truthy", "coalesce0", "count_at_least", "double_double",
    "triple_double", "quad_double", "dfs_score", "DK_WEIGHTS", "FD_WEIGHTS", "BOX_SCORE_DEFAULTS",
    "weights_for", "array_slope", "array_mean", "array_std_pop", "any_of",
]

# Text that Python's float() accepts and that we accept too: optional sign, digits with an optional
# fraction, optional exponent, or nan/inf spellings. Spark's own cast also accepts '12d'/'12f' and
# rejects '1_000'; the guard keeps both engines to the decimal forms above.
NUMERIC_TEXT = r"^\s*[+-]?((\d+(\.\d*)?)|(\.\d+))([eE][+-]?\d+)?\s*$"


def safe_float(c: Column | str) -> Column:
    """Text or number to double; NULL for NULL, '' , bad text or NaN (the collector's safe_float)."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.trim(c.cast("string"))
    d = F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))
    return F.when(~F.isnan(d), d)


def safe_long(c: Column | str) -> Column:
    """Text or number to long; integer text is read digit by digit (ids keep every digit), other numeric text is
    truncated toward zero; NULL for bad text or values outside 64 bits."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.trim(c.cast("string"))
    d = safe_float(c)
    return F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("long")).otherwise(F.when(F.abs(d) < F.lit(2.0 ** 63), d.cast("long")))


def safe_int(c: Column | str) -> Column:
    """A stat as int, truncating toward zero like ``int(float(x))``: '12.9' -> 12, '-0.5' -> 0. For ids use
    ``safe_long``: a value outside 32 bits is NULL here."""
    n = safe_long(c)
    return F.when(n.between(-(2 ** 31), 2 ** 31 - 1), n.cast("int"))


def text_true(c: Column | str) -> Column:
    """``lower(x) == 'true'`` with a missing value counting as False."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.coalesce(c.cast("string"), F.lit(""))) == F.lit("true")


def safe_div(a: Column, b: Column, default: float = 0.0) -> Column:
    """a / b, or ``default`` when b is 0 (or either side NULL makes a NULL quotient -> default)."""
    return F.coalesce(F.try_divide(a, b), F.lit(default))


def season_label(d: Column | str) -> Column:
    """'YYYY-YY' season of a date; a season starts in October: 2021-10-19 -> '2021-22', 2000-01-02 -> '1999-00'."""
    d = F.col(d) if isinstance(d, str) else d
    y = F.when(F.month(d) >= 10, F.year(d)).otherwise(F.year(d) - 1)
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def season_start(d: Column | str) -> Column:
    """October 1st of the season that contains ``d``."""
    d = F.col(d) if isinstance(d, str) else d
    return F.make_date(F.when(F.month(d) >= 10, F.year(d)).otherwise(F.year(d) - 1), F.lit(10), F.lit(1))


def ymd(c: Column | str) -> Column:
    """Parse 'yyyyMMdd' text to a date (NULL when malformed)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(c.cast("string"), "yyyyMMdd") if hasattr(F, "try_to_date") else F.to_date(c, "yyyyMMdd")


def truthy(c: Column) -> Column:
    """Python truthiness of a number: non-NULL and non-zero."""
    return c.isNotNull() & (c != 0)


def coalesce0(c: Column | str) -> Column:
    """``x or 0``: NULL becomes 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0))


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds)


# Categories that count toward double / triple / quad doubles.
DOUBLE_CATEGORIES = ("points", "rebounds_total", "assists", "steals", "blocks")


def count_at_least(cols=DOUBLE_CATEGORIES, threshold: int = 10) -> Column:
    """Number of categories (NULL as 0) that reach ``threshold``: a per-row sum, no shuffle."""
    return reduce(lambda a, b: a + b, [F.when(coalesce0(c) >= threshold, 1).otherwise(0) for c in cols])


def double_double() -> Column:
    return count_at_least() >= 2


def triple_double() -> Column:
    return count_at_least() >= 3


def quad_double() -> Column:
    return count_at_least() >= 4


# The two platforms' scoring rules (points per unit of each stat and bonuses).
DK_WEIGHTS = {"points": 1.0, "rebounds_total": 1.25, "assists": 1.5, "steals": 3.0, "blocks": 3.0,
              "turnovers": -1.0, "double_double": 1.5, "triple_double": 3.0}
FD_WEIGHTS = {"points": 1.0, "rebounds_total": 1.2, "assists": 1.5, "steals": 3.0, "blocks": 3.0,
              "turnovers": -1.0}
# Defaults of the parametric box-score scoring (per stat, minutes, bonuses).
BOX_SCORE_DEFAULTS = {"points": 1.0, "rebounds_total": 1.25, "assists": 1.5, "steals": 3.0, "blocks": 3.0,
                      "turnovers": -1.0, "minutes": 0.0, "double_double": 0.0, "triple_double": 0.0,
                      "quad_double": 0.0}

_STAT_ORDER = ("points", "rebounds_total", "assists", "steals", "blocks", "turnovers", "minutes")


def weights_for(platform: str) -> dict:
    if platform == "DraftKings":
        return DK_WEIGHTS
    if platform == "FanDuel":
        return FD_WEIGHTS
    raise ValueError(f"Unknown platform: {platform}")


def dfs_score(weights: Mapping[str, float]) -> Column:
    """Fantasy score of a log row: weighted stats (NULL as 0) plus stacking bonuses, rounded to 2.

    The additions run in a fixed order starting from 0.0 so that the double result is the same
    as a sequential sum.
    """
    total = F.lit(0.0)
    for stat in _STAT_ORDER:
        if stat in weights:
            total = total + coalesce0(stat).cast("double") * F.lit(float(weights[stat]))
    bonus = {"double_double": double_double, "triple_double": triple_double, "quad_double": quad_double}
    for name, flag in bonus.items():
        if name in weights:
            total = total + F.when(flag(), F.lit(float(weights[name]))).otherwise(F.lit(0.0))
    return F.round(total, 2)


# ---- small-array statistics (arrays are bounded frames, at most 50 elements) -------------------

def array_mean(arr: Column) -> Column:
    """Mean of a numeric array; NULL when empty."""
    n = F.size(arr)
    s = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(n > 0, s / n)


def array_std_pop(arr: Column) -> Column:
    """Population standard deviation (numpy default) of a numeric array; NULL when empty."""
    n = F.size(arr)
    s = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    mean = s / n
    ss = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + (x.cast("double") - mean) * (x.cast("double") - mean))
    return F.when(n > 0, F.sqrt(ss / n))


def array_slope(arr: Column) -> Column:
    """Least-squares slope of the values against their positions 0..n-1 (``np.polyfit(x, y, 1)[0]``).

    NULL for fewer than two values (a single point has no slope).
    """
    n = F.size(arr).cast("double")
    sx = n * (n - 1) / 2
    sxx = (n - 1) * n * (2 * n - 1) / 6
    sy = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    idx = F.transform(arr, lambda x, i: F.struct(i.cast("double").alias("i"), x.cast("double").alias("v")))
    sxy = F.aggregate(idx, F.lit(0.0), lambda acc, e: acc + e["i"] * e["v"])
    mx = sx / n
    my = sy / n
    # centred form is numerically steadier than n*sxy - sx*sy
    num = sxy - n * mx * my
    den = sxx - n * mx * mx
    return F.when(n >= 2, num / den)
