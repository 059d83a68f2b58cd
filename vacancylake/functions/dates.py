"""Dates written as "day month", ISO stamps and whole-day ages.

All columns are ``timestamp_ntz``; "now" is always the ``as_of`` argument.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed
from vacancylake.functions.text import WHITESPACE, strip

# Which month names each source prints.
MONTH_NAMES = {
    "jobs_ge": [fixed.GEORGIAN_MONTHS, fixed.ENGLISH_MONTHS],
    "cv_ge": [fixed.GEORGIAN_SHORT_MONTHS, fixed.GEORGIAN_MONTHS, fixed.ENGLISH_MONTHS],
    "ss_ge": [fixed.GEORGIAN_MONTHS],
}
ALL_MONTH_NAMES = [fixed.GEORGIAN_SHORT_MONTHS, fixed.GEORGIAN_MONTHS, fixed.ENGLISH_MONTHS]
_BLANKS = "[" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "]+"


def moment(value: str | dt.datetime | Column) -> Column:
    """``as_of`` as a zone-less timestamp column."""
    if isinstance(value, Column):
        return value
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def month_map(names: list[list[str]] = ALL_MONTH_NAMES) -> Column:
    """Month name -> number, as one literal the optimizer folds."""
    return F.create_map(*[F.lit(x) for group in names for i, n in enumerate(group, 1) for x in (n, i)])


def day_month(
    text: Column, as_of: str | dt.datetime | Column, months: Column | None = None, roll_year: bool = False
) -> Column:
    """``25 ივნისი`` -> timestamp in the year of ``as_of``; anything else -> NULL.

    ``roll_year`` picks the neighbouring year when that date is nearer to
    ``as_of`` (a December posting read in January).
    """
    now = moment(as_of)
    parts = F.split(strip(text), _BLANKS)
    day = F.get(parts, F.lit(0)).try_cast("int")
    month = F.try_element_at(month_map() if months is None else months, F.get(parts, F.lit(1)))

    def in_year(year: Column) -> Column:
        zero = F.lit(0)
        return F.try_make_timestamp_ntz(year, month, day, zero, zero, F.lit(0).cast("decimal(16,6)"))

    year = F.year(now)
    if not roll_year:
        return in_year(year)
    here = in_year(year)
    half_year = F.expr("INTERVAL '183' DAY")
    return (
        F.when(here > now + half_year, in_year(year - 1))
        .when(here < now - half_year, in_year(year + 1))
        .otherwise(here)
    )


def split_range(text: Column, normalise_dashes: bool = False) -> tuple[Column, Column]:
    """Start and end text of ``a - b``; the end is NULL when there is no dash."""
    text = strip(text)
    if normalise_dashes:
        text = F.regexp_replace(text, r"\s*[-–—]\s*", " - ")
    parts = F.split(text, " - ", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def iso_stamp(text: Column) -> Column:
    """ISO date or timestamp, ``Z`` or an offset accepted; bad text -> NULL."""
    shape = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
    zoned = r"(Z|[+-]\d{2}:\d{2})$"
    local = F.regexp_replace(text, zoned, "").try_cast("timestamp_ntz")
    hours = F.when(text.rlike(r"[+-]\d{2}:\d{2}$"), F.substring(text, -6, 3).try_cast("int")).otherwise(F.lit(0))
    minutes = F.when(text.rlike(r"[+-]\d{2}:\d{2}$"), F.right(text, F.lit(2)).try_cast("int")).otherwise(F.lit(0))
    sign = F.when(text.rlike(r"-\d{2}:\d{2}$") & text.rlike(r":\d{2}.*-\d{2}:\d{2}$"), -1).otherwise(1)
    offset = F.make_dt_interval(F.lit(0), hours, sign * minutes)
    return F.when(text.rlike(shape), F.when(text.rlike(r":.*" + zoned), local - offset).otherwise(local))


def iso_text(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")


def whole_days_since(stamp: Column, as_of: str | dt.datetime | Column) -> Column:
    """Whole days, cut toward zero; negative when ``stamp`` is in the future."""
    return F.extract(F.lit("DAY"), moment(as_of) - stamp).cast("bigint")


def days_before(as_of: str | dt.datetime | Column, days: int) -> Column:
    return moment(as_of) - F.make_dt_interval(F.lit(days))


def hours_before(as_of: str | dt.datetime | Column, hours: int) -> Column:
    return moment(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))


_EPOCH = "1970-01-01 00:00:00"


def as_instant(stamp: Column) -> Column:
    """A zone-less timestamp read as UTC, whatever the session zone; watermarks need an instant."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", moment(_EPOCH), stamp))


def from_instant(instant: Column) -> Column:
    """The UTC reading of an instant, without a zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), moment(_EPOCH))
