"""Instants as epoch milliseconds, ISO text and calendar days.

All functions are independent of the session time zone unless they say otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output and input formats, home zone of the day strings, bucket sizes in seconds.
BASIC_OFFSET_FORMAT = "yyyyMMdd'T'HHmmss.SSSZ"
BASIC_ZULU_FORMAT = "yyyyMMdd'T'HHmmss.SSSX"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
HOME_ZONE = "Asia/Shanghai"
HOUR_SECONDS = 3600
DAY_SECONDS = 86400

_DAY_MILLIS = DAY_SECONDS * 1000


def _two(value: Column, width: int = 2) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def iso_utc(millis: Column) -> Column:
    """ISO-8601 text with milliseconds and a ``Z``, e.g. ``2016-09-19T16:00:00.002Z``."""
    millis = millis.cast("long")
    rest = F.pmod(millis, F.lit(_DAY_MILLIS))
    day = ((millis - rest) / F.lit(_DAY_MILLIS)).cast("int")
    return F.concat(
        F.date_from_unix_date(day).cast("string"),
        F.lit("T"),
        _two(F.floor(rest / 3600000)),
        F.lit(":"),
        _two(F.floor(F.pmod(rest, F.lit(3600000)) / 60000)),
        F.lit(":"),
        _two(F.floor(F.pmod(rest, F.lit(60000)) / 1000)),
        F.lit("."),
        _two(F.pmod(rest, F.lit(1000)), 3),
        F.lit("Z"),
    )


def instant_from_iso(text: Column) -> Column:
    """Instant of an ISO text with milliseconds and ``Z`` or an offset such as ``+08:00``."""
    return F.to_timestamp(text, ISO_FORMAT)


def millis_from_iso(text: Column) -> Column:
    """Epoch milliseconds of an ISO text such as :func:`iso_utc` writes."""
    return F.unix_millis(instant_from_iso(text))


def instant_from_basic(text: Column) -> Column:
    """Instant of a basic-format text: ``20160919T160000.002+0000`` or ``…002Z``."""
    return F.when(F.endswith(text, F.lit("Z")), F.to_timestamp(text, BASIC_ZULU_FORMAT)).otherwise(
        F.to_timestamp(text, BASIC_OFFSET_FORMAT)
    )


def wall_clock(millis: Column, zone: str = "UTC") -> Column:
    """The clock reading (timestamp without zone) of an instant in ``zone``."""
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=millis.cast("decimal(18,3)") / F.lit(1000)
    )
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def day_text(millis: Column, zone: str = HOME_ZONE) -> Column:
    """Calendar day (``yyyy-MM-dd``) of an instant in ``zone``."""
    return wall_clock(millis, zone).cast("date").cast("string")


def day_start_millis(day: Column, zone: str = HOME_ZONE) -> Column:
    """Epoch milliseconds at which a day given as text starts in ``zone``."""
    midnight = day.cast("date").cast("timestamp_ntz")
    utc = midnight if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight)
    seconds = F.unix_date(utc.cast("date")).cast("long") * DAY_SECONDS + (
        F.hour(utc) * 3600 + F.minute(utc) * 60 + F.second(utc)
    )
    return seconds * 1000


def duration_bucket(seconds: Column) -> Column:
    """Upper edge, in seconds, of the hour or day bucket a duration falls in.

    Durations of a day and more round up to whole days, shorter ones to whole hours, always past
    the current one (exactly one hour is in the two-hour bucket); negative ones count as zero.
    """
    seconds = F.greatest(seconds.cast("long"), F.lit(0).cast("long"))
    unit = F.when(seconds >= DAY_SECONDS, F.lit(DAY_SECONDS)).otherwise(F.lit(HOUR_SECONDS))
    return ((F.floor(seconds / unit) + 1) * unit).cast("int")
