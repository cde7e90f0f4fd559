"""Time helpers on zone-less local timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone the fleet operates in; hour bands of the delay report (end excluded).
FLEET_ZONE = "America/Sao_Paulo"
PERIODS = {"morning": (7, 9), "afternoon": (17, 19), "evening": (20, 21)}


def local_time(moment: datetime) -> Column:
    """A zone-less literal; as text, because a datetime literal is shifted to the session's zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_local(text: Column) -> Column:
    """ISO text as a zone-less timestamp; a zone mark is dropped, bad text gives NULL."""
    return text.try_cast("timestamp_ntz")


def parse_utc(text: Column) -> Column:
    """ISO text as a zone-less UTC time; an offset is taken into account, bad text gives NULL.

    Text without a zone mark is UTC already.
    """
    marked = text.rlike(r"(Z|UTC|GMT|[+-]\d{2}:?\d{2})\s*$") & text.contains(":")
    seconds = F.unix_micros(text.try_cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000)
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )
    return F.when(marked, moment).otherwise(text.try_cast("timestamp_ntz"))


def gps_to_local(utc: Column, zone: str = FLEET_ZONE) -> Column:
    """A zone-less UTC time as local time of the fleet, comparable with collection times."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def minutes_between(start: Column, end: Column) -> Column:
    """Signed minutes from ``start`` to ``end``, with fractions.

    Taken from the interval between zone-less times, so no clock change counts.
    """
    gap = end - start
    whole = (
        F.extract(F.lit("DAY"), gap) * 1440
        + F.extract(F.lit("HOUR"), gap) * 60
        + F.extract(F.lit("MINUTE"), gap)
    )
    return whole + F.extract(F.lit("SECOND"), gap).cast("double") / 60.0


def seconds_of_day(time: Column) -> Column:
    """Seconds since midnight, with fractions."""
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.extract(F.lit("SECOND"), time)


def day_period(time: Column) -> Column:
    """Name of the delay-report band the hour lies in, else NULL."""
    hour = F.hour(time)
    period = F.lit(None).cast("string")
    for name, (start, end) in PERIODS.items():
        period = F.when((hour >= start) & (hour < end), F.lit(name)).otherwise(period)
    return period
