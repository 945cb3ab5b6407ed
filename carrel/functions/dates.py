"""Partial dates: intervals, windows around a diagnosis, comparisons of coded dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.functions.scalars import digits, text, unknown

WINDOW_MONTHS = 6
#: other spellings that are tried, in this order, when a value isn't year-month-day digits
OTHER_FORMATS = ["MM/dd/yyyy", "M/d/yyyy", "dd-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMMM yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss"]
# The shape of a partial date.
_PARTS = r"^([0-9]{4})(?:[-/]?([0-9]{1,2}))?(?:[-/]?([0-9]{1,2}))?$"


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def interval(value: Column) -> Column:
    """struct(lo, hi) of all days a partial date may mean; null if it means none.

    A year is the whole year, a month the whole month. A value of that shape with an impossible
    month or day is null; other shapes are read by OTHER_FORMATS.
    """
    s = text(value)
    return _span(s, _parts(s), _first_day(s, _parts(s)))


def _parts(s: Column) -> Column:
    """Year, month and day digits of a stripped value; null if it has another shape."""
    found = F.regexp_replace(s, _PARTS, "$1,$2,$3")
    return F.when(s.rlike(_PARTS), F.split(found, ","))


def _first_day(s: Column, parts: Column) -> Column:
    year, month, day = (parts[k] for k in range(3))
    exact = F.coalesce(*(F.try_to_timestamp(s, F.lit(f)).cast("date") for f in OTHER_FORMATS))
    filled = lambda x: F.when(x == "", "01").otherwise(x)
    return F.when(parts.isNotNull(), _day(year, filled(month), filled(day))).when(~F.lower(s).isin("", "nan", "none", "null", "unknown"), exact)


def _span(s: Column, parts: Column, lo: Column) -> Column:
    hi = F.when(parts[1] == "", F.date_sub(F.add_months(lo, 12), 1)).when(parts[2] == "", F.last_day(lo)).otherwise(lo)
    return F.when(lo.isNotNull(), F.struct(lo.alias("lo"), hi.alias("hi")))


def with_interval(df: DataFrame, value: str, name: str) -> DataFrame:
    """interval() of a column as a new one; each part is taken once, in a projection of its own."""
    at = f"{name}_"
    stripped = df.withColumn(f"{at}text", text(F.col(value)))
    parted = stripped.withColumn(f"{at}parts", _parts(F.col(f"{at}text")))
    first = parted.withColumn(f"{at}lo", _first_day(F.col(f"{at}text"), F.col(f"{at}parts")))
    return first.withColumn(name, _span(F.col(f"{at}text"), F.col(f"{at}parts"), F.col(f"{at}lo"))).drop(f"{at}text", f"{at}parts", f"{at}lo")


def with_window(df: DataFrame, value: str, name: str, months: int = WINDOW_MONTHS) -> DataFrame:
    return with_interval(df, value, name).withColumn(name, widened(F.col(name), months))


def day_interval(day: Column) -> Column:
    """The interval of a column that is a date or a timestamp already."""
    return F.when(day.isNotNull(), F.struct(day.cast("date").alias("lo"), day.cast("date").alias("hi")))


def widened(span: Column, months: int = WINDOW_MONTHS) -> Column:
    """An interval widened by whole months, clamped at month ends."""
    return F.when(span.isNotNull(), F.struct(F.add_months(span["lo"], -months).alias("lo"), F.add_months(span["hi"], months).alias("hi")))


def window(value: Column, months: int = WINDOW_MONTHS) -> Column:
    """struct(lo, hi): the interval of a partial date, widened."""
    return widened(interval(value), months)


def predicted_date(value: Column) -> Column:
    """From the digits of a value: day, else month, else year."""
    s = digits(value)
    return F.coalesce(*(F.when(F.length(s) >= n, F.try_to_date(F.substring(s, 1, n), f)) for n, f in ((8, "yyyyMMdd"), (6, "yyyyMM"), (4, "yyyy"))))


def registry_date(value: Column) -> Column:
    return F.try_to_date(text(value), "dd-MMM-yyyy")


def coded_number(x: Column) -> Column:
    """The first eight digits of a stripped coded date, zeros filling a partial one."""
    return F.substring(F.rpad(x, 8, "0"), 1, 8).try_cast("int")


def coded_difference(a: Column, b: Column) -> Column:
    """Difference of two coded dates as eight-digit numbers (zeros fill partial ones); null if either is unknown."""
    return F.when(~unknown(a) & ~unknown(b), coded_number(text(a)) - coded_number(text(b)))
