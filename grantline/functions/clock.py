"""Time arithmetic on epoch milliseconds; stored times have second precision (UTC session)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantline.settings import DAY_MS, HOUR_MS

# Last second of the year 9999, the end of the timestamp range.
_LAST_MS = 253_402_300_799_000


def seconds_timestamp(ms: Column) -> Column:
    """Timestamp of an epoch value, cut to the second."""
    return F.date_trunc("second", F.timestamp_millis(ms))


def timestamp_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def as_of(as_of_ms: int) -> Column:
    """The pass's clock as a stored timestamp."""
    return seconds_timestamp(F.lit(as_of_ms).cast("bigint"))


def as_of_exact(as_of_ms: int) -> Column:
    """The pass's clock with milliseconds, for comparisons."""
    return F.timestamp_millis(F.lit(as_of_ms).cast("bigint"))


def has_expiry_date(as_of_ms: int, days: Column) -> Column:
    """No days, or as many as lead to a date; others can be neither kept nor revoked in time."""
    reach = (_LAST_MS - as_of_ms) // DAY_MS
    return F.coalesce(days.between(-reach, reach), F.lit(True))


def expiry_ms(as_of_ms: int, days: Column) -> Column:
    """``as_of + days``. No days or zero days mean no expiry; a negative value lies in the past.

    Days without a date give null, too: :func:`has_expiry_date` tells them apart, and a
    request with such days is never provisioned.
    """
    dated = (days != 0) & has_expiry_date(as_of_ms, days)
    return F.when(dated, F.lit(as_of_ms).cast("bigint") + days.cast("bigint") * F.lit(DAY_MS))


def pending_hours(as_of_ms: int, created_ms: Column) -> Column:
    return (F.lit(float(as_of_ms)) - created_ms.cast("double")) / F.lit(float(HOUR_MS))


def whole_hours(hours: Column) -> Column:
    """Hours as printed in mail: rounded half to even."""
    return F.bround(hours, 0).cast("bigint")
