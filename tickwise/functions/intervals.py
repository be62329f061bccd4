"""Interval names and minutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The interval vocabulary of the exchange feed.
INTERVALS = ["1m", "5m", "15m", "30m", "1h", "4h", "1d"]
# Minutes per unit letter of an interval name such as 15m, 1h, 4h, 1d.
UNIT_MINUTES = {"m": 1, "h": 60, "d": 1440}

INTERVAL_PATTERN = r"^([0-9]+)([mhd])\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def interval_minutes(name) -> Column:
    """interval name -> minutes (``1h`` and ``60m`` both give 60); null if unknown."""
    n = _col(name)
    count = F.regexp_extract(n, INTERVAL_PATTERN, 1)
    unit = F.regexp_extract(n, INTERVAL_PATTERN, 2)
    factor = F.when(unit == "m", UNIT_MINUTES["m"]).when(unit == "h", UNIT_MINUTES["h"]).when(unit == "d", UNIT_MINUTES["d"])
    # The text comes off the wire: a number beyond a long is an unknown name.
    return F.when(n.rlike(INTERVAL_PATTERN), F.try_multiply(count.try_cast("bigint"), factor.cast("bigint")))


def canonical_interval(name) -> Column:
    """Minutes form of an interval (``1h`` -> ``60m``, ``4h`` -> ``240m``); unknown names stay as they are."""
    n = _col(name)
    m = interval_minutes(n)
    return F.when(m.isNotNull(), F.concat(m.cast("string"), F.lit("m"))).otherwise(n)


def interval_name(minutes) -> Column:
    """Vocabulary name for a number of minutes (60 -> ``1h``), else ``<n>m``."""
    m = _col(minutes)
    return (
        F.when((m % 1440 == 0) & (m >= 1440), F.concat((m / 1440).cast("bigint").cast("string"), F.lit("d")))
        .when((m % 60 == 0) & (m >= 60), F.concat((m / 60).cast("bigint").cast("string"), F.lit("h")))
        .otherwise(F.concat(m.cast("string"), F.lit("m")))
    )


def stream_name(symbol, interval) -> Column:
    """Subscription stream name ``<lower symbol>@kline_<interval>``."""
    return F.concat(F.lower(_col(symbol)), F.lit("@kline_"), _col(interval))


def sql_interval_minutes(name: str) -> str:
    cnt = f"TRY_CAST(NULLIF(regexp_extract({name}, '^([0-9]+)([mhd])$', 1), '') AS BIGINT)"
    unit = f"regexp_extract({name}, '^([0-9]+)([mhd])$', 2)"
    return f"(CASE {unit} WHEN 'm' THEN {cnt} WHEN 'h' THEN {cnt} * 60 WHEN 'd' THEN {cnt} * 1440 END)"


def sql_canonical_interval(name: str) -> str:
    m = sql_interval_minutes(name)
    return f"(CASE WHEN {m} IS NOT NULL THEN CAST({m} AS VARCHAR) || 'm' ELSE {name} END)"
