"""Date and time expressions. Timestamps carry no zone and mean UTC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
# A time of day followed by a zone or offset.
ZONED = r"(?i):\d\d(\.\d+)?\s*(z|[+-]\d\d(:?\d\d)?|[a-z]{2,5}|[a-z]+(/[a-z_+-]+)+\d*)$"
# A zone right after the minutes, and ISO's basic and week forms of a date.
NO_SECONDS = r"(?i)^(\d{4}-\d\d-\d\d[T ]\d\d:\d\d)(\s*(?:z|[+-]\d\d(?::?\d\d)?|[a-z]{2,5}|[a-z]+(?:/[a-z_]+)+))$"
BASIC = r"^(\d{4})(\d\d)(\d\d)(?:T(\d\d):?(\d\d):?(\d\d)?)?$"
WEEK = r"^(\d{4})-?W(\d\d)(?:-?([1-7]))?$"
#: Epoch milliseconds of the years 1 to 9999.
MILLIS = (-62135596800000, 253402300799999)


def from_instant(moment: Column) -> Column:
    """A point in time as its UTC date and time, whatever zone the session has."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), F.expr(EPOCH))


def to_instant(utc: Column) -> Column:
    """The point in time of a UTC date and time."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc).cast("timestamp")


def parse_timestamp(text: Column, formats: Sequence[str] = ()) -> Column:
    """Lenient parse: ISO forms first, then ``formats`` in order; anything else is null.

    Text with a zone or zone name becomes UTC (an unknown zone makes it null), text without one is taken as it stands.
    """
    filled = F.regexp_replace(text, NO_SECONDS, "$1:00$2")
    others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    # The rarer forms come last, so that their patterns run only on texts that the plain casts refuse.
    return F.coalesce(_iso(text), _iso(filled), *others, basic_or_week_date(text))


def _iso(text: Column) -> Column:
    has_zone = (F.length(text) > len("2024-01-01T00:00")) & text.rlike(ZONED)
    return F.when(has_zone, from_instant(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))


def basic_or_week_date(text: Column) -> Column:
    """``20240131``, ``20240131T101500``, ``2024-W05`` or ``2024-W05-3``; anything else is null."""
    basic = F.regexp_replace(text, BASIC, "$1-$2-$3 $4:$5:$6")
    basic = F.regexp_replace(F.regexp_replace(basic, " ::$", ""), ":$", ":00").try_cast("timestamp_ntz")
    year, week, day = (F.try_to_number(F.nullif(F.regexp_extract(text, WEEK, i), F.lit("")), F.lit("9999")).cast("int") for i in (1, 2, 3))
    first = F.make_date(year, F.lit(1), F.lit(4))
    first = F.date_sub(first, F.weekday(first))
    date = F.date_add(first, (week - 1) * 7 + F.coalesce(day, F.lit(1)) - 1)
    last = F.date_add(F.make_date(year, F.lit(12), F.lit(28)), 0)
    week_date = F.when(week.between(1, F.weekofyear(last)), date).cast("timestamp_ntz")
    return F.when(text.rlike(BASIC), basic).when(text.rlike(WEEK), week_date)


def timestamp_column(df: DataFrame, name: str, formats: Sequence[str] = ()) -> Column:
    """A date column of any type as a timestamp: text is parsed, dates and times are converted."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return parse_timestamp(F.col(name), formats)
    return from_instant(F.col(name)) if isinstance(dtype, T.TimestampType) else F.col(name).cast("timestamp_ntz")


def parse_timestamp_strict(text: Column) -> Column:
    """Parse that fails the job on bad text; null stays null."""
    parsed = parse_timestamp(text.cast("string"))
    bad = F.concat(F.lit("not a date: "), text.cast("string"))
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(bad)).otherwise(parsed)


def from_epoch_millis(millis: Column) -> Column:
    """Milliseconds since 1970; null outside the years 1 to 9999."""
    known = F.when(millis.between(*MILLIS), millis.cast("long"))
    return F.timestamp_add("MILLISECOND", known, F.expr(EPOCH))


def parse_variant_timestamp(value: Column) -> Column:
    """A JSON value that is either epoch milliseconds or ISO text; zero, empty and others are null."""
    kind = F.schema_of_variant(value)
    millis = F.try_variant_get(value, "$", "long")
    return F.when((kind == "BIGINT") & (millis != 0), from_epoch_millis(millis)).when(
        kind == "STRING", parse_timestamp(F.try_variant_get(value, "$", "string"))
    )


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days from start to end; null when the end lies before the start."""
    return F.when(end >= start, F.extract(F.lit("DAY"), end - start).cast("long"))


def days_until_midnight_of(as_of: Column, moment: Column) -> Column:
    """Whole days (rounded down) from a moment to the start of the day of ``as_of``."""
    day_start = moment.cast("date").cast("timestamp_ntz")
    return F.date_diff(as_of.cast("date"), moment.cast("date")) - F.when(moment > day_start, 1).otherwise(0)


def instant(as_of: dt.datetime | str | None) -> Column:
    """The clock: a given moment, or now. Every function that reads the clock goes through here."""
    if as_of is None:
        return from_instant(F.current_timestamp())
    return F.lit(str(as_of)).cast("timestamp_ntz")
