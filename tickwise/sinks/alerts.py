"""Alert payloads, one row per (alert, URL).

The reference posts every alert to every configured URL.  Here a payload is
a JSON document built with ``to_json``; the URL list is configuration, and the
fan-out repeats each alert for its entries.  Sending is the caller's: a
function over a partition's (url, body) rows, run by ``foreachBatch`` on a
stream (``send_stream``) or by ``foreachPartition`` on a table.  Keys come out sorted, as a sorted JSON map prints them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.text import trade_text
from ..functions.time import alert_time

# Payload keys and the start message.
KEY_STRATEGY = "策略名"
KEY_SYMBOL = "标的名"
KEY_TRADE = "交易信息"
KEY_TIME = "当前时间"
KEY_MESSAGE = "消息"
KEY_PING = "ping"
START_MESSAGE = "开始计算策略"
DEFAULT_STRATEGY_NAME = "Bandtastic Strategy"


def trade_alerts(trades: DataFrame, strategy_name: str = DEFAULT_STRATEGY_NAME, now_ms=None) -> DataFrame:
    """Trade events -> (kind, body).  The time shown is the event's own time
    (exit time of a close, entry time of an open) unless ``now_ms`` is given."""
    ts = F.lit(now_ms) if now_ms is not None else F.when(F.col("event") == "close", F.col("exit_time")).otherwise(F.col("enter_time"))
    body = F.to_json(F.struct(
        trade_text().alias(KEY_TRADE), alert_time(ts).alias(KEY_TIME), F.col("symbol").alias(KEY_SYMBOL),
        F.lit(strategy_name).alias(KEY_STRATEGY),
    ))
    return trades.select(F.lit("trade").alias("kind"), F.col("symbol"), ts.alias("ts_ms"), body.alias("body"))


def ping_alerts(heartbeats: DataFrame, strategy_name: str = DEFAULT_STRATEGY_NAME) -> DataFrame:
    ping = F.struct(F.col("recv_ts_ms").alias("recv_ts_ms"), F.col("remark").alias("remark"), F.col("source").alias("source"))
    body = F.to_json(F.struct(alert_time("recv_ts_ms").alias(KEY_TIME), ping.alias(KEY_PING), F.lit(strategy_name).alias(KEY_STRATEGY)))
    return heartbeats.select(F.lit("ping").alias("kind"), F.lit(None).cast("string").alias("symbol"),
                             F.col("recv_ts_ms").alias("ts_ms"), body.alias("body"))


def start_alerts(starts: DataFrame, strategy_name: str = DEFAULT_STRATEGY_NAME) -> DataFrame:
    """The message that evaluation begins: one per row of ``ts_ms``."""
    body = F.to_json(F.struct(F.col("ts_ms").alias(KEY_TIME), F.lit(START_MESSAGE).alias(KEY_MESSAGE), F.lit(strategy_name).alias(KEY_STRATEGY)))
    return starts.select(F.lit("start").alias("kind"), F.lit(None).cast("string").alias("symbol"), "ts_ms", body.alias("body"))


def fan_out(alerts: DataFrame, urls: Iterable[str]) -> DataFrame:
    """Every alert to every URL of the configured list."""
    return alerts.select("*", F.explode(F.array(*[F.lit(u) for u in urls])).alias("url"))


def alert_payloads(trades: DataFrame, heartbeats: DataFrame, urls: Iterable[str], strategy_name: str = DEFAULT_STRATEGY_NAME,
                   starts: DataFrame | None = None) -> DataFrame:
    alerts = trade_alerts(trades, strategy_name).unionByName(ping_alerts(heartbeats, strategy_name))
    if starts is not None:
        alerts = alerts.unionByName(start_alerts(starts, strategy_name))
    return fan_out(alerts, urls)


def send_batch(send: Callable[[Iterator[Row]], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands each partition's payload rows to
    ``send``.  A retried batch is sent again: senders see payloads at least once."""
    return lambda batch, _: batch.select("url", "body").foreachPartition(send)


def send_stream(payloads: DataFrame, send: Callable[[Iterator[Row]], None], checkpoint: str, **trigger):
    """Start sending a streaming payload table; returns the streaming query."""
    return payloads.writeStream.foreachBatch(send_batch(send)).option("checkpointLocation", checkpoint).trigger(**trigger).start()
