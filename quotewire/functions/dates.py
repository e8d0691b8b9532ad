"""Dates and times; all days are UTC days."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotewire.functions.text import clean_text

# Tried in order, without the weekday. Zoned formats name their own offset.
ZONED_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "d MMM yyyy HH:mm:ss XX",
    "MMMM d, yyyy 'at' h:mm a O",
)
LOCAL_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "MMMM d, yyyy 'at' h:mm a",
    "MMMM d, yyyy",
    "d MMMM yyyy",
)
# Fixed value: the zone of dates that name none.
DEFAULT_ZONE = "Asia/Singapore"


def date_bucket(epoch_seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch_seconds), "yyyy-MM-dd")


def news_date(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def parse_publish_date(
    text: Column,
    zone: str = DEFAULT_ZONE,
    zoned: Sequence[str] = ZONED_FORMATS,
    local: Sequence[str] = LOCAL_FORMATS,
) -> Column:
    """Instant of a written date, or NULL; dates without a zone are in ``zone``."""
    value = F.regexp_replace(clean_text(text), "^[A-Z][a-z]+, ", "")
    with_zone = F.concat_ws(" ", value, F.lit(zone))
    return F.coalesce(
        *[F.try_to_timestamp(value, F.lit(f)) for f in zoned],
        *[F.try_to_timestamp(with_zone, F.lit(f + " VV")) for f in local],
    )


def to_timestamp_coerce(value: Column) -> Column:
    """Timestamp, or NULL where the text is none."""
    return value.try_cast("timestamp")


def time_period(time: Column) -> Column:
    hour = F.hour(time)
    return (
        F.when(hour.between(9, 15), "TRADING_HOUR")
        .when(hour.between(16, 23), "AFTER_MARKET")
        .otherwise("PRE_MARKET")
    )


def now_utc() -> Column:
    return F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    )
