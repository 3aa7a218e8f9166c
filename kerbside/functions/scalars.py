"""Small column expressions whose NULL, zone or overflow rules differ from Spark's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.fixed_values import FEED_TIMESTAMP_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _all_present(cols: list[Column]) -> Column:
    present = cols[0].isNotNull()
    for c in cols[1:]:
        present = present & c.isNotNull()
    return present


def least_strict(*cols: Column | str) -> Column:
    """Smallest argument; NULL when any argument is NULL (Spark's own skips NULLs)."""
    args = [_col(c) for c in cols]
    return F.when(_all_present(args), F.least(*args))


def greatest_strict(*cols: Column | str) -> Column:
    """Largest argument; NULL when any argument is NULL."""
    args = [_col(c) for c in cols]
    return F.when(_all_present(args), F.greatest(*args))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, NULL for a zero denominator."""
    return F.try_divide(_col(numerator), _col(denominator))


def non_empty(c: Column | str) -> Column:
    """Text, with the empty string turned into NULL."""
    return F.nullif(_col(c), F.lit(""))


def fingerprint(c: Column | str) -> Column:
    """Deterministic, non-negative 60-bit id of a text, computed row by row."""
    return F.conv(F.substring(F.md5(_col(c)), 1, 15), 16, 10).cast("bigint")


def utc_suffix(c: Column | str) -> Column:
    """Write a trailing +00:00 offset as Z."""
    return F.regexp_replace(_col(c), r"\+00:00$", "Z")


def hour_bucket(c: Column | str, tz: str | None = None) -> Column:
    """Start of the civil hour as an instant.

    Zones whose offset is a whole number of hours need no ``tz``: their hours start when
    UTC hours do. With ``tz`` the minutes elapsed on the local clock are subtracted, which
    also holds for offsets like +05:30 and across clock changes.
    """
    ts = _col(c)
    if tz is None:
        return F.date_trunc("hour", ts)
    into_hour = F.pmod(F.unix_micros(civil_time(ts, tz).cast("timestamp")), F.lit(3_600_000_000))
    return F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) - into_hour)


def civil_time(c: Column | str, tz: str) -> Column:
    """Wall-clock time in ``tz`` of a UTC instant (the session zone must be UTC)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(c).cast("timestamp_ntz"))


def parse_feed_timestamp(c: Column | str, tz: str = "UTC") -> Column:
    """Timestamp of the disruption feed; NULL when unparsable. ``tz`` is the feed's own zone."""
    parsed = F.try_to_timestamp(_col(c), F.lit(FEED_TIMESTAMP_FORMAT))
    if tz == "UTC":
        return parsed
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), parsed.cast("timestamp_ntz")).cast("timestamp")


def minutes_between(earlier: Column | str, later: Column | str) -> Column:
    """Whole minutes from ``earlier`` to ``later``."""
    return F.timestamp_diff("MINUTE", _col(earlier), _col(later))
