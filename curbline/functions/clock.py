"""Wall-clock and UTC conversions that never read the session time zone.

A wall-clock reading is TIMESTAMP_NTZ; an instant is TIMESTAMP.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbline.schema import DAY_PARTS, OTHER_DAY_PART, PEAK_HOURS, SOURCE_ZONE, WEEKEND_DAYS

_SLASH_DATE_TIME = (
    r"^=(\d{1,2})/(\d{1,2})/((?!0000)\d{4})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})$"
)
_WITHOUT_OFFSET = r"^\s*\d{4,6}(-\d{1,2}){0,2}([ T][0-9:.]*)?\s*$"
_STARTS_WITH_YEAR = r"^\s*\d{4,6}(-|\s*$)"


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def parse_slash_date_time(text: Column) -> Column:
    """``month/day/year hour:minute:second`` to a wall-clock reading, else null."""
    # A match drops the leading mark; with it, text of any other form cannot be cast.
    marked = F.concat(F.lit("="), text)
    dashed = F.regexp_replace(marked, _SLASH_DATE_TIME, "$3-$1-$2 $4:$5:$6")
    return dashed.try_cast("timestamp_ntz")


def _as_if_utc(wall_clock: Column) -> Column:
    """The instant at which a clock in UTC shows this reading.

    By arithmetic: a cast, or ``timestamp_diff``, would go through the session zone.
    """
    hours = F.unix_date(F.to_date(wall_clock)).cast("bigint") * 24 + F.hour(wall_clock)
    micros = (F.extract(F.lit("SECOND"), wall_clock) * 1_000_000).cast("bigint")
    return F.timestamp_micros((hours * 60 + F.minute(wall_clock)) * 60_000_000 + micros)


def _reading_in_utc(instant: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def local_to_instant(local: Column, zone: str = SOURCE_ZONE) -> Column:
    """A reading that a clock change skips is taken with the offset before the change; of a
    repeated one the first is meant.

    ``to_utc_timestamp`` shifts by a constant zone; ``convert_timezone`` gives the same but
    looks the zone up for every row, which costs five times as much.
    """
    return F.to_utc_timestamp(_as_if_utc(local), zone)


def instant_to_local(instant: Column, zone: str = SOURCE_ZONE) -> Column:
    return _reading_in_utc(F.from_utc_timestamp(instant, zone))


def iso_utc(instant: Column) -> Column:
    """ISO-8601 text to the second with an explicit zero offset."""
    # date_format would show the session zone; text of a wall-clock reading does not.
    plain = _reading_in_utc(instant).cast("string")
    return F.concat(F.substring(plain, 1, 10), F.lit("T"), F.substring(plain, 12, 8), F.lit("+00:00"))


def parse_instant(text: Column, zone: str = SOURCE_ZONE) -> Column:
    """ISO-8601 text to an instant, else null; text without an offset is in ``zone``."""
    # The two common endings are told first; they spare the longer pattern.
    ends_in_offset = text.endswith("Z") | (F.substring(text, -6, 1) == "+")
    naive = local_to_instant(text.try_cast("timestamp_ntz"), zone)
    return F.when(~ends_in_offset & text.rlike(_WITHOUT_OFFSET), naive).when(
        text.rlike(_STARTS_WITH_YEAR), text.try_cast("timestamp")
    )


def iso_weekday(day: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return (F.weekday(day) + 1).cast("int")


def day_name(day: Column) -> Column:
    """Mon to Sun."""
    return F.dayname(day)


def is_weekend(day: Column) -> Column:
    return iso_weekday(day).isin(*WEEKEND_DAYS)


def time_of_day(hour: Column) -> Column:
    parts = [F.when(hour.between(first, last), part) for part, first, last in DAY_PARTS]
    return F.coalesce(*parts, F.lit(OTHER_DAY_PART))


def is_peak_hour(hour: Column) -> Column:
    return reduce(lambda a, b: a | b, [hour.between(*hours) for hours in PEAK_HOURS])
