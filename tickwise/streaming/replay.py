"""Replaying a table as a file stream, and running a stream to its end.

The rows are written once, by one job, into files that follow each other in
the given order; the file source takes the next ones in each micro-batch.  The
source reads the oldest file first, so the files' times are set in their order.

A micro-batch costs a commit of every state partition, whatever it holds: a
larger table is replayed in larger micro-batches, about ``BATCHES`` of them, and
``replay`` has as many state partitions as the rows of a micro-batch need.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sinks.archive import scratch_path

#: Rows of a replayed file, about.
FILE_ROWS = 100_000
#: Micro-batches of a replay, at most, unless ``most`` files of each are fewer.
BATCHES = 12
#: Files of a micro-batch whose rows are sorted in memory per key, at most.
KEYED_FILES = 10
#: Rows of a micro-batch to a partition of its state, about.
STATE_ROWS = 250_000
_PARTITIONS = "spark.sql.shuffle.partitions"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: Spark's state store that typed state needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time) of a folder's data files by name."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted((f.getPath().toString(), f.getModificationTime()) for f in found if f.getPath().getName().startswith("part-"))


def order_files(spark: SparkSession, path: str) -> int:
    """Give a folder's data files times that follow their names; returns how many there are."""
    jvm = spark._jvm
    system = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files = data_files(spark, path)
    first = min([t for _, t in files], default=0)
    for n, (name, _) in enumerate(files):
        system.setTimes(jvm.org.apache.hadoop.fs.Path(name), first + n, -1)
    return len(files)


def write_in_order(rows: DataFrame, order: list[str], path: str | None = None, files: int | None = None, least: int = 4) -> str:
    """Write ``rows`` once as files that follow each other in ``order``."""
    spark = rows.sparkSession
    path = path or scratch_path(spark, "replay")
    if files is None:
        files = max(least, -(-rows.count() // FILE_ROWS))
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(path)
    order_files(spark, path)
    return path


def batch_files(spark: SparkSession, path: str, most: int | None = None) -> int:
    """Files of a micro-batch: a replay has ``BATCHES`` at most, or more of ``most`` files each."""
    files = max(1, -(-len(data_files(spark, path)) // BATCHES))
    return files if most is None else min(files, most)


def read_in_order(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None, most: int | None = None) -> DataFrame:
    """The files as a stream; without ``files_per_trigger`` in ``BATCHES``
    micro-batches at most, or in more of ``most`` files each."""
    if files_per_trigger is None:
        files_per_trigger = batch_files(spark, path, most)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def state_partitions(spark: SparkSession, path: str, most: int | None = None) -> int:
    """Partitions of a replay's state: one for each ``STATE_ROWS`` rows of a
    micro-batch, a wave of tasks at least, the session's number at most."""
    needed = -(-batch_files(spark, path, most) * FILE_ROWS // STATE_ROWS)
    return min(int(spark.conf.get(_PARTITIONS)), max(spark.sparkContext.defaultParallelism, needed))


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session inside; its own is put back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def typed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which typed state
    needs; the session's own setting is put back."""
    with _setting(spark, _PROVIDER, ROCKSDB):
        yield


def start(rows: DataFrame, out: str, checkpoint: str, partitions: int | None = None, **trigger) -> StreamingQuery:
    """Append a stream's rows to Parquet files; ``partitions`` of state are the session's unless given."""
    spark = rows.sparkSession
    with typed_state(spark), _setting(spark, _PARTITIONS, str(partitions or spark.conf.get(_PARTITIONS))):
        writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start(out)


def run_to_end(rows: DataFrame, out: str | None = None, checkpoint: str | None = None, partitions: int | None = None) -> DataFrame:
    """Run a stream over all that its source has now; the rows it appended."""
    spark = rows.sparkSession
    out, checkpoint = out or scratch_path(spark, "stream-out"), checkpoint or scratch_path(spark, "stream-checkpoint")
    start(rows, out, checkpoint, partitions).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def replay(spark: SparkSession, path: str, schema, shape: Callable[[DataFrame], DataFrame], out: str | None = None,
           checkpoint: str | None = None, most: int | None = None) -> DataFrame:
    """``shape`` of the files as a stream, run to its end; the rows it appended.

    The checkpoint keeps the number of state partitions it began with."""
    rows = shape(read_in_order(spark, path, schema, most=most))
    return run_to_end(rows, out, checkpoint, state_partitions(spark, path, most))
