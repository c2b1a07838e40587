"""Column helpers.  All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, StringType

# Amounts: up to 10**19, to a billionth.  Sums have ten more digits in front, so neither
# large totals overflow nor small amounts vanish.
MONEY = "decimal(28,9)"
WEIGHT = "decimal(18,4)"  # attribution weights are published with four places
EXACT_WEIGHT = "decimal(20,18)"  # unrounded weights, which are at most 1


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_n(value: Column | str, digits: int) -> Column:
    """Round a double half away from zero, on its binary value.

    Spark's ``round`` works on the shortest decimal text of a double (1.005
    becomes 1.01); most other engines scale, round and scale back (1.0).  This
    is the second kind.  A value so large that it has no fraction at this scale is
    returned as it is.
    """
    value = col(value).cast("double")
    scale = F.lit(float(10**digits))
    rounded = F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)) / scale
    return F.when(F.abs(value) * scale < F.lit(2.0**52), rounded).otherwise(value)


def safe_ratio(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom`` as a double; NULL where the bottom is 0 or NULL."""
    bottom = col(bottom).cast("double")
    return col(top).cast("double") / F.when(bottom != 0, bottom)


def exact_sum(value: Column | str, decimal_type: str = MONEY) -> Column:
    """A sum of doubles that does not depend on the order rows arrive in."""
    return F.sum(col(value).cast(decimal_type)).cast("double")


def count_where(condition: Column) -> Column:
    """Rows that satisfy the condition; NULL counts as no."""
    return F.sum(F.when(condition, 1).otherwise(0))


def whole_number(df: DataFrame, column: str) -> Column:
    """64-bit cast that rounds: text half away from zero, fractions half to even.

    (Spark's own cast cuts fractions off and rejects text such as ``12.7``.)
    """
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, StringType):
        value = round_n(value, 0)
    elif isinstance(kind, FractionalType):
        value = F.rint(value.cast("double"))
    return value.cast("long")


def hill(spend: Column | str, half_saturation: Column | float) -> Column:
    """Saturation response in [0, 1): S^2 / (K^2 + S^2)."""
    s = col(spend)
    k = half_saturation if isinstance(half_saturation, Column) else F.lit(float(half_saturation))
    return s * s / (k * k + s * s)


def decay(days: Column, per_day: float) -> Column:
    """Exponential weight of a touch that happened ``days`` ago (never above 1)."""
    return F.exp(F.lit(-per_day) * F.greatest(F.lit(0), days))


def channel_label(channel: Column | str) -> Column:
    """``paid_search`` -> ``paid search``; only the first underscore is replaced."""
    c = col(channel)
    at = F.instr(c, "_")
    return F.when(at > 0, F.overlay(c, F.lit(" "), at, F.lit(1))).otherwise(c)


def week_label(week: Column | str) -> Column:
    """The part of a week's text before the first space."""
    return F.split_part(col(week).cast("string"), F.lit(" "), F.lit(1))


def signed_percent(value: Column | str) -> Column:
    """``+608.3%`` / ``-2.5%``: a plus sign only in front of positive values."""
    v = col(value)
    return F.concat(F.when(v > 0, "+").otherwise(""), v.cast("string"), F.lit("%"))


def dollars(value: Column | str) -> Column:
    """``$1234.50``: two decimals, no grouping."""
    return F.concat(F.lit("$"), F.format_string("%.2f", round_n(value, 2)))
