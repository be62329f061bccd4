"""Bars (candlesticks) resampled from the driver's event-level tables.

The reference receives finished bars from the exchange; our inputs are raw
events, so this is the step the exchange would have done.  It is one
``groupBy(symbol, slot)`` with map-side partial aggregation: a symbol that
holds a third of all events still spreads over as many groups as it has
time slots, so no task sees more than one slot's partial aggregate per map
partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import interval_name
from ..functions.time import epoch_ms, label_utc8

BAR_COLUMNS = [
    "exchange", "symbol", "open_time_ms", "close_time_ms", "open_time_h", "interval",
    "open", "high", "low", "close", "volume", "trades_count",
]

# Exchange names given to bars built from the driver's tables.
EVENTS_EXCHANGE = "synthetic"
LINEITEM_EXCHANGE = "tpch"


def slot_of(ms: str, minutes: int) -> Column:
    """Start of the bar that a time falls in."""
    return F.col(ms) - F.pmod(F.col(ms), F.lit(minutes * 60000))


def bar_aggregates(order_cols: list[str], sparse: bool = False) -> list[Column]:
    """open, high, low, close, volume and trades_count of a slot's ticks (ms,
    price, qty, *order_cols); ``sparse``: rows without a price are no ticks."""
    order, tick = F.struct(*[F.col(c) for c in ["ms", *order_cols]]), F.lit(1)
    if sparse:
        order, tick = F.when(F.col("price").isNotNull(), order), F.col("price")
    return [
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", order).alias("close"), F.sum("qty").alias("volume"), F.count(tick).alias("trades_count"),
    ]


def bars_of_slots(slots: DataFrame, minutes: int) -> DataFrame:
    """Aggregated slots (exchange, symbol, open_time_ms, ...) as bars."""
    return slots.select(
        "exchange",
        "symbol",
        "open_time_ms",
        (F.col("open_time_ms") + F.lit(minutes * 60000 - 1)).alias("close_time_ms"),
        label_utc8("open_time_ms").alias("open_time_h"),
        interval_name(F.lit(minutes)).alias("interval"),
        "open", "high", "low", "close", "volume", "trades_count",
    )


def _ohlcv(ticks: DataFrame, minutes: int, order_cols: list[str]) -> DataFrame:
    """ticks: (exchange, symbol, ms, price, qty, *order_cols) -> bars."""
    slots = ticks.withColumn("open_time_ms", slot_of("ms", minutes)).groupBy("exchange", "symbol", "open_time_ms")
    return bars_of_slots(slots.agg(*bar_aggregates(order_cols)), minutes)


def _fault(columns: dict[str, Column]) -> Column:
    """The first reason why a row is no tick, or null."""
    out = None
    for reason, bad in columns.items():
        out = F.when(bad, F.lit(reason)) if out is None else out.when(bad, F.lit(reason))
    return out


def event_fault() -> Column:
    return _fault({"no_time": F.col("ts").isNull(), "no_price": F.col("value").isNull(), "no_symbol": F.col("event_type").isNull()})


def lineitem_fault() -> Column:
    return _fault({
        "no_time": F.col("l_shipdate").isNull(), "no_quantity": F.col("l_quantity").isNull() | (F.col("l_quantity") <= 0),
        "no_price": F.col("l_extendedprice").isNull(),
    })


def tick_rejects(rows: DataFrame, fault: Column) -> DataFrame:
    """The rows that give no tick, with ``reject_reason`` (``event_fault`` or ``lineitem_fault``)."""
    return rows.withColumn("reject_reason", fault).filter(F.col("reject_reason").isNotNull())


def event_rows(events: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Every event as a tick's columns: symbol = upper(event_type), price =
    value, quantity = value, and the columns in ``keep``.  Rows without a time,
    price or type have no price."""
    price = F.when(event_fault().isNull(), F.col("value"))
    return events.select(
        F.lit(EVENTS_EXCHANGE).alias("exchange"), F.upper("event_type").alias("symbol"), epoch_ms("ts").alias("ms"),
        price.alias("price"), price.alias("qty"), "event_id", *keep,
    )


def event_ticks(events: DataFrame) -> DataFrame:
    """events -> ticks.  Rows without a time, price or type are in ``tick_rejects``."""
    return event_rows(events.filter(event_fault().isNull()))


def resample_bars(events: DataFrame, minutes: int | Iterable[int]) -> DataFrame:
    """Events -> bars of one or several widths (in minutes), unioned.

    Several widths share one aggregation of the events, into slots of their
    greatest common divisor; Spark reuses its shuffle for every width, and the
    wider bars are made of slots."""
    widths = [minutes] if isinstance(minutes, int) else list(minutes)
    ticks = event_ticks(events)
    if len(widths) == 1:
        return _ohlcv(ticks, widths[0], ["event_id"])
    base = math.gcd(*widths)
    tick = F.struct("ms", "event_id", "price")
    slots = ticks.withColumn("_slot", slot_of("ms", base)).groupBy("exchange", "symbol", "_slot").agg(
        F.min(tick).alias("_first"), F.max(tick).alias("_last"), F.max("price").alias("_high"), F.min("price").alias("_low"),
        F.sum("qty").alias("_volume"), F.count(F.lit(1)).alias("_count"),
    )
    out = None
    for m in widths:
        wider = slots.withColumn("open_time_ms", slot_of("_slot", m))
        if m != base:
            wider = wider.groupBy("exchange", "symbol", "open_time_ms").agg(
                F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.max("_high").alias("_high"), F.min("_low").alias("_low"),
                F.sum("_volume").alias("_volume"), F.sum("_count").alias("_count"),
            )
        wider = wider.withColumnsRenamed({"_high": "high", "_low": "low", "_volume": "volume", "_count": "trades_count"})
        b = bars_of_slots(wider.withColumn("open", F.col("_first.price")).withColumn("close", F.col("_last.price")), m)
        out = b if out is None else out.unionByName(b)
    return out


def lineitem_daily_bars(lineitem: DataFrame) -> DataFrame:
    """Daily bars per supplier: price = extendedprice / quantity, volume = quantity."""
    ticks = lineitem.filter(lineitem_fault().isNull()).select(
        F.lit(LINEITEM_EXCHANGE).alias("exchange"),
        F.col("l_suppkey").cast("string").alias("symbol"),
        epoch_ms("l_shipdate").alias("ms"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("qty"),
        "l_orderkey",
        "l_linenumber",
    )
    return _ohlcv(ticks, 1440, ["l_orderkey", "l_linenumber"])


# ---- oracle SQL fragments (DuckDB) -------------------------------------------------

def sql_event_bars(minutes: int) -> str:
    from ..functions.time import sql_label_utc8

    width = minutes * 60000
    name = {15: "15m", 60: "1h", 240: "4h", 1440: "1d"}.get(minutes, f"{minutes}m")
    return f"""
SELECT exchange, symbol, open_time_ms, open_time_ms + {width - 1} AS close_time_ms,
       {sql_label_utc8('open_time_ms')} AS open_time_h, '{name}' AS interval,
       open, high, low, close, volume, trades_count
FROM (
  SELECT '{EVENTS_EXCHANGE}' AS exchange, symbol, open_time_ms,
         first(price ORDER BY ms, event_id) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY ms, event_id) AS close, sum(price) AS volume, count(*) AS trades_count
  FROM (
    SELECT upper(event_type) AS symbol, (epoch_us(ts) // 1000) AS ms, value AS price, event_id,
           (epoch_us(ts) // 1000) - ((epoch_us(ts) // 1000) % {width} + {width}) % {width} AS open_time_ms
    FROM events WHERE ts IS NOT NULL AND value IS NOT NULL AND event_type IS NOT NULL
  ) t GROUP BY symbol, open_time_ms
) g"""


def sql_lineitem_bars() -> str:
    from ..functions.time import sql_label_utc8

    width = 1440 * 60000
    return f"""
SELECT exchange, symbol, open_time_ms, open_time_ms + {width - 1} AS close_time_ms,
       {sql_label_utc8('open_time_ms')} AS open_time_h, '1d' AS interval,
       open, high, low, close, volume, trades_count
FROM (
  SELECT '{LINEITEM_EXCHANGE}' AS exchange, symbol, open_time_ms,
         first(price ORDER BY ms, l_orderkey, l_linenumber) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY ms, l_orderkey, l_linenumber) AS close, sum(qty) AS volume, count(*) AS trades_count
  FROM (
    SELECT CAST(l_suppkey AS VARCHAR) AS symbol, (epoch_us(l_shipdate) // 1000) AS ms,
           l_extendedprice / l_quantity AS price, l_quantity AS qty, l_orderkey, l_linenumber,
           (epoch_us(l_shipdate) // 1000) - ((epoch_us(l_shipdate) // 1000) % {width} + {width}) % {width} AS open_time_ms
    FROM lineitem WHERE l_shipdate IS NOT NULL AND l_quantity > 0 AND l_extendedprice IS NOT NULL
  ) t GROUP BY symbol, open_time_ms
) g"""
