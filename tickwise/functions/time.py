"""Epoch-millisecond time helpers.

Every label is computed from the epoch number itself, never through the
session time zone, so the same query gives the same text on any cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The display offset of every label is UTC+8.
UTC8_OFFSET_MS = 8 * 3600 * 1000
LABEL_FORMAT = "yyyyMMdd-HH:mm"  # bar open time label
ALERT_FORMAT = "yyyyMMdd-HH:mm.ss"  # alert "current time" label
PERIOD_FORMAT = "yyyyMMdd-HHmm"  # archive file period
ARCHIVE_PREFIX = "kline_"
ARCHIVE_SUFFIX = ".zst"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_clock(ms, offset_ms: int = UTC8_OFFSET_MS) -> Column:
    """TIMESTAMP_NTZ holding the wall clock at ``offset_ms`` from UTC."""
    return F.timestamp_add("MILLISECOND", _col(ms) + F.lit(offset_ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_ms(ts_ntz) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ read as UTC."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(ts_ntz))


def label_utc8(ms) -> Column:
    """Epoch ms -> ``yyyyMMdd-HH:mm`` in UTC+8."""
    return F.date_format(wall_clock(ms), LABEL_FORMAT)


def alert_time(ms) -> Column:
    """Epoch ms -> ``yyyyMMdd-HH:mm.ss`` in UTC+8."""
    return F.date_format(wall_clock(ms), ALERT_FORMAT)


def archive_period_start_s(ms, rotation_s: int) -> Column:
    """Start (epoch seconds) of the rotation bucket holding ``ms``."""
    secs = F.floor(_col(ms) / 1000)
    return F.floor(secs / rotation_s) * rotation_s


def archive_period(ms, rotation_s: int) -> Column:
    """The bucket's UTC+8 ``yyyyMMdd-HHmm`` label."""
    return F.date_format(wall_clock(archive_period_start_s(ms, rotation_s) * 1000), PERIOD_FORMAT)


def archive_file_name(ms, rotation_s: int) -> Column:
    return F.concat(F.lit(ARCHIVE_PREFIX), archive_period(ms, rotation_s), F.lit(ARCHIVE_SUFFIX))


# DuckDB equivalents for the oracle SQL.
def sql_label_utc8(ms: str) -> str:
    return f"strftime(make_timestamp(({ms} + {UTC8_OFFSET_MS}) * 1000), '%Y%m%d-%H:%M')"


def sql_alert_time(ms: str) -> str:
    return f"strftime(make_timestamp(({ms} + {UTC8_OFFSET_MS}) * 1000), '%Y%m%d-%H:%M.%S')"


def sql_archive_period(ms: str, rotation_s: int) -> str:
    start = f"(floor(floor({ms} / 1000) / {rotation_s}) * {rotation_s})"
    return f"strftime(make_timestamp((CAST({start} AS BIGINT) * 1000 + {UTC8_OFFSET_MS}) * 1000), '%Y%m%d-%H%M')"
