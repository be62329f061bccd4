"""One message stream, several sinks.

A message is a row of a tagged table: its kind, when it came, and one of three
nullable structs -- a bar, a heartbeat or an error.  A micro-batch is written
once, divided by route, into a folder of its batch; the sinks (strategy,
alerts, log) read their route.  A batch that is run again replaces its own
folder, so every message arrives exactly once, from one read of the feed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.frames import PING_SOURCE, bar_fields, decode_all

# Kinds of messages and where they go.
KLINE, PING, ERROR = "kline", "ping", "error"
ROUTES = {KLINE: "strategy", PING: "alerts", ERROR: "log"}
BAR = "struct<exchange:string,symbol:string,open_time_ms:bigint,close_time_ms:bigint,open_time_h:string,interval:string,open:double,high:double,low:double,close:double,volume:double,trades_count:bigint>"
MESSAGE_SCHEMA = f"kind string, recv_ms bigint, frame_no bigint, kline {BAR}, ping struct<source:string,recv_ts_ms:bigint,remark:string>, error struct<reason:string>"


def tagged_messages(feed: DataFrame) -> DataFrame:
    """feed (is_ping, recv_ms, frame_no, text) -> the tagged table, row by row.

    Pings become heartbeats, closed frames bars, texts that are no frame
    errors; frames of bars that are still open are no message.  A ping without
    a time is none either."""
    decoded = decode_all(feed.select("recv_ms", F.col("frame_no").cast("bigint").alias("frame_no"), "text", "is_ping"), keep=["is_ping"])
    # Out of a generator, so that the decoded leaves are computed once and not again for every column that reads them.
    decoded = decoded.select(F.explode(F.array(F.struct(*decoded.columns))).alias("d")).select("d.*")
    one = F.struct(*[c.alias(n) for n, c in bar_fields().items()]).cast(BAR)
    ping, bad = F.coalesce("is_ping", F.lit(False)), F.col("reject_reason").isNotNull()
    kind = F.when(ping & F.col("recv_ms").isNotNull(), PING).when(ping, F.lit(None)).when(bad, ERROR).when(F.col("closed"), KLINE)
    return decoded.withColumn("kind", kind).where("kind IS NOT NULL").select(
        "kind", "recv_ms", "frame_no", F.when(F.col("kind") == KLINE, one).alias("kline"),
        F.when(F.col("kind") == PING, F.struct(F.lit(PING_SOURCE).alias("source"), F.col("recv_ms").alias("recv_ts_ms"), F.lit("").alias("remark"))).alias("ping"),
        F.when(F.col("kind") == ERROR, F.struct(F.col("reject_reason").alias("reason"))).alias("error"),
    )


def route_of(kind: Column) -> Column:
    out = None
    for name, route in ROUTES.items():
        out = F.when(kind == name, route) if out is None else out.when(kind == name, route)
    return out


def route_batch(messages: DataFrame, batch_id: int, path: str) -> None:
    """Write a batch of messages to all sinks in one pass; a repeated batch replaces what it wrote."""
    messages.withColumn("route", route_of(F.col("kind"))).write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={batch_id}")


def route_stream(messages: DataFrame, path: str, checkpoint: str, write: Callable[[DataFrame, int, str], None] = route_batch, **trigger) -> StreamingQuery:
    writer = messages.writeStream.foreachBatch(lambda batch, number: write(batch, number, path)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_route(spark: SparkSession, path: str, route: str) -> DataFrame:
    """The messages of one sink, from its files alone: the fields of its struct, with recv_ms."""
    kind = next(k for k, r in ROUTES.items() if r == route)
    rows = spark.read.schema(MESSAGE_SCHEMA + ", batch bigint, route string").parquet(path).where(F.col("route") == route)
    return rows.select("recv_ms", "frame_no", f"{kind}.*")
