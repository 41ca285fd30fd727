"""Native column expressions; nothing here leaves the JVM."""

from pyspark.sql import Column, functions as F

from tidegauge.schemas import ANNUAL_PERIOD, MISSING_VALUE, SOURCE

# Fixed formats.
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def surrogate_id(raw_series_id: Column, source: str = SOURCE) -> Column:
    """Key of a series, the same on every run: a hash of its natural key."""
    return F.md5(F.concat(F.lit(f"{source}|"), raw_series_id))


def number(text: Column) -> Column:
    """Double of a decimal text, NULL for anything else (never NaN)."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def integer(text: Column) -> Column:
    return text.try_cast("int")


def point_year(year: Column) -> Column:
    """Year of a point; a point without one gets 0."""
    return integer(F.coalesce(year, F.lit("0")))


def point_value(value: Column) -> Column:
    """Value of a point; the missing-value mark and an absent value are NULL."""
    return number(F.nullif(value, F.lit(MISSING_VALUE)))


def is_unparsable_value(value: Column) -> Column:
    """True where a value is given, is not the missing mark and is no number."""
    return F.coalesce((value != MISSING_VALUE) & number(value).isNull(), F.lit(False))


def is_annual(period: Column) -> Column:
    return F.coalesce(period == ANNUAL_PERIOD, F.lit(False))


def period_month(period: Column) -> Column:
    """Month number of ``M<digits>``, NULL for other periods or months beyond 1..12."""
    month = integer(F.nullif(F.regexp_extract(period, r"M(\d+)", 1), F.lit("")))
    return F.when(month.between(1, 12), month)


def period_date(year: Column, period: Column) -> Column:
    """First day of the period's month, NULL where year or month are unusable."""
    month = period_month(period)
    usable = year.between(1, 9999) & month.isNotNull()
    return F.when(usable, F.make_date(year, month, F.lit(1)))


def month_index(date: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return F.year(date) * 12 + F.month(date)


def year_month(date: Column) -> Column:
    """The month as the number YYYYMM."""
    return F.year(date) * 100 + F.month(date)


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def year_start(date: Column) -> Column:
    return F.trunc(date, "year")


def change(value: Column, base: Column) -> Column:
    """Relative change against ``base``; NULL where the base is missing or zero."""
    return value / F.nullif(base, F.lit(0.0)) - 1


def percent(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0)) * 100
