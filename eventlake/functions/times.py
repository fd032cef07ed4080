"""Column functions over dates, times and durations. Sessions run with spark.sql.session.timeZone=UTC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import first_group, non_empty

ISO = "yyyy-MM-dd'T'HH:mm:ss"
_OFFSET = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"


def to_zone(col: Column, zone: str = "+05:30", assume_zone: str = "+00:00") -> Column:
    """ISO text re-rendered in a zone; naive text is read in assume_zone; unparseable text stays as it is."""
    whole = F.when(col.rlike("T.*" + _OFFSET) | col.rlike(":[0-9]{2}.*" + _OFFSET), col).when(col.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.concat(col, F.lit("T00:00:00" + assume_zone))).otherwise(F.concat(col, F.lit(assume_zone)))
    return F.coalesce(F.concat(F.date_format(F.from_utc_timestamp(F.try_to_timestamp(whole), zone), ISO), F.lit(zone)), col)


def attach_zone(col: Column, zone: str = "+05:30") -> Column:
    """The instant of a local wall time in a zone: nothing is shifted but the zone is set."""
    return F.to_utc_timestamp(col, zone)


def default_end(start: Column, end: Column, hours: int = 2) -> Column:
    """The end, or start plus hours where it is absent or equals the start."""
    return F.when(end.isNull() | (end == start), start + F.expr(f"INTERVAL '{hours}' HOUR")).otherwise(end)


def fix_offset_suffix(col: Column, bad_suffix: str, zone: str = "+05:30") -> Column:
    """Values with a malformed offset keep their first 19 characters and are converted; others stay."""
    return F.when(col.endswith(bad_suffix), to_zone(F.substring(col, 1, 19), zone)).otherwise(col)


def pad_date_parts(col: Column) -> Column:
    """2026-8-3T.. as 2026-08-03T..; an offset of +5.5:00 becomes +05:30."""
    x = F.replace(col, F.lit("+5.5:00"), F.lit("+05:30"))
    x = F.regexp_replace(x, r"^([0-9]{4})-([0-9])-", "$1-0$2-")
    return F.regexp_replace(x, r"^([0-9]{4}-[0-9]{2})-([0-9])(T|$)", "$1-0$2$3")


def parse_loose_date(col: Column, formats: Sequence[str]) -> Column:
    """The first format that fits the text without dots and commas, sept read as sep; null if none fits."""
    x = F.regexp_replace(F.lower(F.trim(F.regexp_replace(col, "[.,]", ""))), r"\bsept\b", "sep")
    x = F.initcap(F.regexp_replace(x, r"\s+", " "))
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in formats])


def _clock(hour: Column, minute: Column, half: Column) -> Column:
    """Minutes since midnight of a 12-hour clock time."""
    return (hour.cast("int") % 12 + F.when(F.upper(half) == "PM", 12).otherwise(0)) * 60 + F.coalesce(minute.cast("int"), F.lit(0))


_RANGE = r"(?i)([0-9]{1,2})(?:[:.]([0-9]{2}))?\s*([ap]m)?\s*(?:-|to|–)\s*([0-9]{1,2})(?:[:.]([0-9]{2}))?\s*([ap]m)?"


def parse_time_range(col: Column, base: Column) -> Column:
    """struct(start, end) of "3 - 6 PM" and the like on a base date; a missing half of the day comes from the other side.

    Null if there is no range or neither side names a half.
    """
    parts = F.split(F.regexp_replace(F.regexp_extract(col, _RANGE, 0), _RANGE, "$1|$2|$3|$4|$5|$6"), "[|]")  # the text is searched once
    g = [non_empty(F.get(parts, F.lit(i))) for i in range(6)]
    halves = F.coalesce(g[2], g[5]), F.coalesce(g[5], g[2])
    day = F.to_timestamp(F.to_date(base))
    at = lambda m: F.timestamp_seconds(F.unix_timestamp(day) + m * 60)
    good = g[0].isNotNull() & halves[0].isNotNull()
    start, end = _clock(g[0], g[1], halves[0]), _clock(g[3], g[4], halves[1])
    return F.when(good, F.struct(at(start).alias("start"), at(end).alias("end")))


def parse_hour_range(col: Column) -> Column:
    """struct(start_hour, end_hour) of the first "h AM - h PM"; a start after its end is taken 12 hours earlier.

    A single hour lasts two hours; null without any.
    """
    two = r"(?i)([0-9]{1,2})\s*([ap]m)?\s*-\s*([0-9]{1,2})\s*([ap]m)"
    one = r"(?i)([0-9]{1,2})\s*([ap]m)"
    hour = lambda h, half: h.cast("int") % 12 + F.when(F.upper(half) == "PM", 12).otherwise(0)
    a, ah, b, bh = (first_group(col, two, i) for i in range(1, 5))
    start, end = hour(a, F.coalesce(ah, bh)), hour(b, bh)
    single = hour(first_group(col, one, 1), first_group(col, one, 2))
    both = F.struct(F.when(start > end, start - 12).otherwise(start).alias("start_hour"), end.alias("end_hour"))
    return F.when(a.isNotNull(), both).when(single.isNotNull(), F.struct(single.alias("start_hour"), ((single + 2) % 24).alias("end_hour")))


def to_24h(col: Column, compat: bool = False) -> Column:
    """hh:mm AM/PM as HH:mm:ss; with compat 12 hours are added to every PM, so that 12 PM is 24."""
    h, m, half = (first_group(F.trim(col), r"(?i)^([0-9]{1,2}):([0-9]{2})\s*([ap]m)$", i) for i in (1, 2, 3))
    hour = h.cast("int") if compat else h.cast("int") % 12
    hour = hour + F.when(F.upper(half) == "PM", 12).otherwise(0)
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), m, F.lit(":00"))


def parse_duration(col: Column) -> Column:
    """Seconds of "N Hours", "N Minutes" and "N Days" summed; null if there are none."""
    total, any_ = F.lit(0).cast("bigint"), F.lit(False)
    for unit, seconds in (("day", 86_400), ("hour", 3_600), ("minute", 60)):
        found = F.regexp_extract_all(col, F.lit(rf"(?i)([0-9]+)\s*{unit}s?"), F.lit(1))
        total = total + F.aggregate(found, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint")) * seconds
        any_ = any_ | (F.size(found) > 0)
    return F.when(any_, total)


def duration_hours(col: Column) -> Column:
    """Upper bound in hours of "3 to 4 hrs"; 0 if unknown, null with a slash (several days)."""
    last = F.regexp_extract(col, r"(?i)(?:[0-9.]+\s*(?:-|to)\s*)?([0-9]+(?:\.[0-9]+)?)\s*h(?:ou)?rs?", 1)
    return F.when(~col.contains("/"), F.coalesce(F.nullif(last, F.lit("")).cast("double"), F.lit(0.0)))


def parse_date_range(col: Column, fmt: str = "MMMM d, yyyy") -> Column:
    """struct(start, end) of "January 15, 2026 to February 26, 2026"; a single date is both; bad text is null."""
    parts = F.split(col, r"\s+to\s+")
    start = F.try_to_timestamp(F.get(parts, F.lit(0)), F.lit(fmt)).cast("date")
    end = F.when(F.size(parts) > 1, F.try_to_timestamp(F.get(parts, F.lit(1)), F.lit(fmt)).cast("date")).otherwise(start)
    return F.when(start.isNotNull() & end.isNotNull(), F.struct(start.alias("start"), end.alias("end")))


def spans_days(start: Column, end: Column, compat: bool = False) -> Column:
    """Whether two ISO texts lie on different days; with compat only their first nine characters are compared."""
    n = 9 if compat else 10
    return F.substring(start, 1, n) != F.substring(end, 1, n)


def future_only(df: DataFrame, col: str, as_of: Column, inclusive: bool = True) -> DataFrame:
    return df.filter(F.col(col) >= as_of if inclusive else F.col(col) > as_of)


def within_horizon(df: DataFrame, col: str, as_of: Column, days: int = 30) -> DataFrame:
    """Rows 0 to days days ahead of as_of."""
    return df.filter(F.col(col).between(as_of, as_of + F.expr(f"INTERVAL '{days}' DAY")))


def drop_long(df: DataFrame, start: str, end: str, days: int = 3) -> DataFrame:
    """Rows that span at most days days; an absent end counts as no span."""
    return df.filter(F.coalesce(F.datediff(F.col(end), F.col(start)), F.lit(0)) <= days)


def fix_datetime_text(col: Column, offset: str = "+05:30") -> Column:
    """yyyy-MM-dd HH:mm... as yyyy-MM-ddTHH:mm:00 with an offset."""
    return F.concat(F.substring(F.replace(col, F.lit(" "), F.lit("T")), 1, 16), F.lit(":00" + offset))
