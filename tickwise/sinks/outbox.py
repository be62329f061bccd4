"""S4 delivery, once per alert: an outbox of acknowledged payloads.

An outbox is a folder of small Parquet files: the (url, hash of the body) of
every payload that a sender accepted, and when.  ``deliver`` sends what is not
in it yet.  A task writes down what it has sent every ``every`` payloads and
when its sender fails, and a repeated task first reads what its earlier tries
wrote down; so a sender that fails midway sees each payload once, and what it
has seen is not sent again by the next run.  Only a lost machine can repeat up
to ``every`` sends of a task.

Payloads that are equal in url and body are one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import materialize, ship_package
from . import files

ACK_SCHEMA = "url string, body_sha256 string, acknowledged_ms bigint"
_FIELDS = [("url", pa.string()), ("body_sha256", pa.string()), ("acknowledged_ms", pa.int64())]


def acknowledged(spark: SparkSession, outbox: str) -> DataFrame:
    """What has been delivered: url, body_sha256, acknowledged_ms."""
    if not files.names(outbox):
        return spark.createDataFrame([], ACK_SCHEMA)
    return spark.read.schema(ACK_SCHEMA).parquet(outbox)


def pending(payloads: DataFrame, outbox: str) -> DataFrame:
    """url, body, body_sha256 of the payloads that no sender has accepted yet, each once."""
    every = payloads.select("url", "body", F.sha2("body", 256).alias("body_sha256")).dropDuplicates(["url", "body_sha256"])
    return every.join(acknowledged(payloads.sparkSession, outbox), ["url", "body_sha256"], "left_anti")


def deliver(payloads: DataFrame, outbox: str, send: Callable[[str, str], None], every: int = 100) -> int:
    """Send every pending (url, body); returns how many were sent.  A sender
    that raises ends the run with its error, after what it has accepted was
    written down."""
    ship_package(payloads.sparkSession)
    run_id = uuid.uuid4().hex
    waiting = materialize(pending(payloads, outbox).repartition("url", "body_sha256"))  # the same rows in the same task of a retried job

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = f"ack-{run_id}-{TaskContext.get().partitionId():06d}-"
        done, new, sent = set(), [], 0
        for name in files.names(outbox):
            if name.startswith(mark):
                system, path = files.located(f"{outbox}/{name}")
                table = pq.read_table(path, filesystem=system)
                done |= set(zip(table["url"].to_pylist(), table["body_sha256"].to_pylist()))

        def keep() -> None:
            if new:
                out = pa.BufferOutputStream()
                pq.write_table(pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*new), _FIELDS)], names=[n for n, _ in _FIELDS]), out)
                files.create(f"{outbox}/{mark}{uuid.uuid4().hex}.parquet", out.getvalue().to_pybytes())
                new.clear()

        try:
            for batch in batches:
                for url, body, digest in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if (url, digest) in done:
                        continue
                    send(url, body)
                    sent += 1
                    new.append((url, digest, int(time.time() * 1000)))
                    if len(new) >= every:
                        keep()
        finally:
            keep()
        yield pa.RecordBatch.from_pydict({"sent": [sent]})

    found = waiting.select("url", "body", "body_sha256").mapInArrow(run, "sent bigint")
    return found.agg(F.sum("sent")).first()[0] or 0


def deliver_stream(payloads: DataFrame, outbox: str, send: Callable[[str, str], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Deliver a streaming payload table; a micro-batch that is run again sends only what is not acknowledged."""
    writer = payloads.writeStream.foreachBatch(lambda batch, _: deliver(batch, outbox, send) and None)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
