"""Epoch <-> text conversions with an explicit zone, independent of the session zone.

Wall-clock values travel as TIMESTAMP_NTZ, so only the ``tz`` argument counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TZ = "+08:00"
FULL = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"
# Fixed value: the timestamp standing for "no time given".
DEFAULT_TIME = "1970-07-01 00:00:00"

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_of_ntz(ts: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock value read as UTC."""
    return F.unix_timestamp(ts)


def local_ntz(epoch: Column, tz: str = DEFAULT_TZ) -> Column:
    """Wall clock in ``tz`` at ``epoch`` seconds."""
    utc = F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), epoch.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def render(epoch: Column, pattern: str = FULL, tz: str = DEFAULT_TZ) -> Column:
    return F.date_format(local_ntz(epoch, tz), pattern)


def render_ms(epoch_ms: Column, pattern: str = FULL, tz: str = DEFAULT_TZ) -> Column:
    return render(F.floor(epoch_ms / 1000).cast("bigint"), pattern, tz)


def parse(text: Column, pattern: str = FULL, tz: str = DEFAULT_TZ) -> Column:
    """Epoch seconds of ``text`` read in ``tz``; NULL when it does not parse."""
    wall = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    return F.unix_timestamp(F.convert_timezone(F.lit(tz), F.lit("UTC"), wall))


def parse_zoned(text: Column, pattern: str) -> Column:
    """Epoch seconds of a text that carries its own offset."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(pattern)))


def day(epoch: Column, tz: str = DEFAULT_TZ) -> Column:
    return render(epoch, DAY, tz)


def hour(epoch: Column, tz: str = DEFAULT_TZ) -> Column:
    return render(epoch, "HH", tz)


def minute(epoch: Column, tz: str = DEFAULT_TZ) -> Column:
    return render(epoch, "mm", tz)


def day_key(epoch: Column, tz: str = DEFAULT_TZ) -> Column:
    """yyyyMMdd as INT."""
    return render(epoch, "yyyyMMdd", tz).cast("int")


def time_or_default(text: Column, pattern: str = FULL) -> Column:
    """TIMESTAMP_NTZ of a text, the fixed default when blank."""
    parsed = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    blank = F.coalesce(text, F.lit("")) == ""
    return F.when(blank, F.lit(DEFAULT_TIME).cast("timestamp_ntz")).otherwise(parsed)


def text_to_time(text: Column) -> Column:
    """Long texts carry a time of day, short ones only a date."""
    full = F.try_to_timestamp(text, F.lit(FULL)).cast("timestamp_ntz")
    date = F.try_to_timestamp(text, F.lit(DAY)).cast("timestamp_ntz")
    return F.when(F.length(text) > 13, full).otherwise(date)
