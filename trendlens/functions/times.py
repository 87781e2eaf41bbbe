"""Parsing, formatting and splitting of timestamps.

Times are wall-clock values without zone (``timestamp_ntz``), so no result depends
on the session time zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlens.schema import ISO_REGEX, TEXT_FORMAT, WEEKDAYS

# Tried in order after the ISO forms, which Spark's own cast understands.
MIXED_PATTERNS = (
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
)


def is_iso(c: Column) -> Column:
    return c.rlike(ISO_REGEX)


def parse_iso(c: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` to wall-clock time, anything else to NULL.

    The regex fixes the form, so the cast (much cheaper than a formatter per row)
    only has to read digits. The length rules out the line break ``$`` lets through.
    """
    return F.when(is_iso(c) & (F.length(c) == 20), c.try_cast("timestamp_ntz"))


def parse_default(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def parse_mixed(c: Column, patterns=MIXED_PATTERNS) -> Column:
    """Several formats in one column, to UTC wall-clock time; bad text gives NULL."""
    instant = c.try_cast("timestamp")
    has_offset = c.rlike(r"\d{2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)\s*$")
    in_utc = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz")
    )
    others = [F.try_to_timestamp(c, F.lit(p)).cast("timestamp_ntz") for p in patterns]
    return F.coalesce(
        F.when(has_offset, in_utc).otherwise(c.try_cast("timestamp_ntz")), *others
    )


def format_time(c: Column, pattern: str = TEXT_FORMAT) -> Column:
    return F.date_format(c, pattern)


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970 of a wall-clock time."""
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def weekday_index(c: Column) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(c)


def weekday_name(c: Column) -> Column:
    return weekday_label(weekday_index(c))


def weekday_label(index: Column) -> Column:
    """Name of a weekday index; reports group by the index and name it last."""
    return F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), index)


def weekday_position(name: Column) -> Column:
    """1..7 for Mon..Sun, 0 for any other text: the sort key of weekday reports."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), name)


def weekday_number(c: Column) -> Column:
    """Sunday = 1 .. Saturday = 7, as the model uses it."""
    return F.dayofweek(c)


def days_between(end: Column, start: Column) -> Column:
    """Calendar days, not 24 hour blocks."""
    return F.datediff(end, start)
