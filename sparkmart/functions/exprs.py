"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MONEY_SCALE = 4
_LOW_BITS = 20


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- cleaning -----------------------------------------------------------------


def no_nan(c: Column | str) -> Column:
    """NaN counts as missing."""
    return F.nanvl(col(c), F.lit(None).cast("double"))


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]; NULL stays NULL (greatest/least alone would return the bound)."""
    c = col(c)
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def number(c: Column | str, decimal_comma: bool = False) -> Column:
    """Text to double; anything that is not a plain or scientific number becomes NULL, not an error.

    A cast alone also takes "5d", "NaN", "Infinity" and hex floats. A number ends in a digit or
    a point and holds no x, which is checked without a regular expression per value.
    """
    text = F.trim(col(c).cast("string"))
    if decimal_comma:
        text = F.replace(text, F.lit(","), F.lit("."))
    ends_well = F.substring(text, -1, 1).between(".", "9")
    hexadecimal = text.contains("x") | text.contains("X")
    value = F.when(ends_well & ~hexadecimal, text.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)  # "1e400" is no number either


def title_case(c: Column | str) -> Column:
    return F.initcap(F.trim(col(c)))


def is_blank(c: Column | str) -> Column:
    return F.trim(col(c).cast("string")) == ""


# --- exact sums ---------------------------------------------------------------
# Money arrives as double. Summing doubles gives results that depend on the order of the
# rows; summing wide decimals is several times slower because they are boxed. So values are
# turned into whole units of 10^-scale and summed as two bigints (high and low bits), which
# neither rounds nor overflows for up to 2^43 rows, and combines before the shuffle. What a value
# has beyond those units goes to a third part, a sum of doubles: the decimals below the scale
# (0 for money, where only rounding of the double is left), and the whole of a value too large for units. Infinity and NaN go
# there too and make the sum what they make of any sum of doubles.

_MAX_UNITS = float(1 << 53)  # larger whole numbers are not exact as double
_NOISE = 1e-14  # a product of decimals is off by a few units in the last place of the double


def _split(c: Column | str, scale: int) -> tuple[Column, Column]:
    """(whole units as bigint, the rest as double)."""
    value, unit = col(c).cast("double"), F.lit(float(10**scale))
    fits = F.abs(value) * unit < _MAX_UNITS  # false for Infinity, and for NaN, which sorts above all
    units = F.when(fits, F.rint(value * unit)).when(value.isNotNull(), 0.0)
    below = value - units / unit
    noise = F.abs(below) <= F.abs(value) * F.lit(_NOISE)
    return units.cast("bigint"), F.when(fits, F.when(noise, 0.0).otherwise(below)).otherwise(value)


def sum_parts(c: Column | str, name: str, scale: int = MONEY_SCALE) -> list[Column]:
    """First-level partial sum of a double column as ``<name>_hi``, ``<name>_lo`` and ``<name>_rest``."""
    units, rest = _split(c, scale)
    return [
        F.sum(F.shiftright(units, _LOW_BITS)).alias(f"{name}_hi"),
        F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("bigint"))).alias(f"{name}_lo"),
        F.sum(rest).alias(f"{name}_rest"),
    ]


def merge_parts(name: str) -> list[Column]:
    """Partial sums added up again, still in parts."""
    return [F.sum(f"{name}_{p}").alias(f"{name}_{p}") for p in ("hi", "lo", "rest")]


def parts_decimal(hi: Column, lo: Column) -> Column:
    """The exact number of units as decimal(38,0)."""
    return (hi.cast("decimal(38,0)") * F.lit(1 << _LOW_BITS) + lo).cast("decimal(38,0)")


def _total(hi: Column, lo: Column, rest: Column, scale: int) -> Column:
    return parts_decimal(hi, lo).cast("double") / F.lit(float(10**scale)) + rest


def parts_value(name: str, scale: int = MONEY_SCALE) -> Column:
    """Parts of one row (or one aggregate) as double."""
    return _total(F.col(f"{name}_hi"), F.col(f"{name}_lo"), F.col(f"{name}_rest"), scale)


def sum_of_parts(name: str, scale: int = MONEY_SCALE) -> Column:
    """Aggregate: the total of already reduced parts as double."""
    return _total(F.sum(f"{name}_hi"), F.sum(f"{name}_lo"), F.sum(f"{name}_rest"), scale)


def exact_sum(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Aggregate: sum of a double column, independent of the rows' order in all decimals of the scale."""
    return _total(*sum_parts(c, "s", scale), scale)


def exact_avg(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Aggregate: mean of the non-null values, from the exact sum."""
    return F.try_divide(exact_sum(c, scale), F.count(col(c)).cast("double"))


# --- ratios and buckets --------------------------------------------------------


def round_even(c: Column, digits: int) -> Column:
    """Round the binary value half to even, as numpy does. ``round`` would go through the decimal
    text of the double and rounds half up."""
    scale = F.lit(float(10**digits))
    return F.rint(c * scale) / scale


def share_pct(part: Column, total: Column, digits: int = 2) -> Column:
    """Percentage of a total; NULL when the total is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), total), digits)


def case_when(*branches: tuple[Column, str], otherwise: str) -> Column:
    """Ordered CASE of labels."""
    first, *rest = branches
    start = F.when(first[0], F.lit(first[1]))
    return reduce(lambda acc, b: acc.when(b[0], F.lit(b[1])), rest, start).otherwise(F.lit(otherwise))


def month_key(df: DataFrame, name: str) -> Column:
    """What to group by for calendar months: the first day of the month, which is cheaper per row
    than formatted text. Text dates give YYYY-MM as it stands, so an odd date cannot fail the query."""
    if isinstance(df.schema[name].dataType, StringType):
        return F.substring(name, 1, 7)
    return F.trunc(F.col(name).cast("date"), "month")


def month_label(df: DataFrame, key: str) -> Column:
    """YYYY-MM of a month key."""
    if isinstance(df.schema[key].dataType, StringType):
        return F.col(key)
    return F.date_format(key, "yyyy-MM")


def month_number(df: DataFrame, name: str) -> Column:
    """Month of the year, 1 to 12; NULL when text holds none."""
    if isinstance(df.schema[name].dataType, StringType):
        return F.substring(name, 6, 2).try_cast("int")
    return F.month(name)


def money_text(c: Column | str, digits: int = 0) -> Column:
    """Thousands separators, e.g. 12,345."""
    return F.format_number(col(c), digits)


def percent_text(c: Column | str, digits: int = 1) -> Column:
    """A fraction as percent text, e.g. 97.3%."""
    return F.concat(F.format_number(col(c) * 100, digits), F.lit("%"))


def p_text(c: Column | str) -> Column:
    """A probability with four decimals, or with three significant digits where those would be zeros."""
    return F.when(col(c) < 1e-4, F.format_string("%.2e", c)).otherwise(F.format_string("%.4f", c))
