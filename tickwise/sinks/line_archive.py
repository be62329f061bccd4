"""S3 as files that other programs read: one JSON line per bar in
``kline_<period>.zst``, a zstd frame per flush.

A Spark data source (``LineArchive``) writes them, in batch and on streams.
A task writes below a staging folder of its job, under a name of its own, and
reports its files; the driver moves them to their names when all tasks have
succeeded, and drops the staging folder otherwise.  So a failed task or job
leaves no file, and a retried or speculative task leaves none twice.

A period is one file while it has up to ``file_rows`` bars.  More bars, and
later batches, go to ``kline_<period>.<n>.zst``: finished files are never
written to again.  On a stream the names carry the batch, so a repeated batch
replaces its own files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import BAR_FIELDS, encode_bars
from ..functions.time import archive_period
from ..session import ship_package
from . import files
from .archive import DEFAULT_ROTATION_S, FILE_ROWS, parse_lines

# Name of the files, and the level of their frames.
PREFIX, SUFFIX, LEVEL = "kline_", ".zst", 3
#: Lines of a frame.
FLUSH_ROWS = 4096


@dataclass
class Staged(WriterCommitMessage):
    """Files of a task: (staged name, period)."""

    files: list[tuple[str, str]]


class _Lines:
    """What the batch and the stream writer share.  Rows are (value, period,
    part); in ``ordered`` input one (period, part) follows another, else a
    task holds the compressed frames of all its periods until the end."""

    ordered = True

    def __init__(self, path: str, flush_rows: int):
        self.path, self.flush_rows = path.rstrip("/"), flush_rows
        self.staging = f"{self.path}/_staging-{self.staging_mark()}"

    def staging_mark(self) -> str:
        return uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        codec, done = pa.Codec("zstd", compression_level=LEVEL), []
        held: dict[tuple[str, int], tuple[list[str], list[bytes]]] = {}  # lines to come, frames made

        def flush(lines: list[str], frames: list[bytes]) -> None:
            if lines:
                frames.append(codec.compress(("\n".join(lines) + "\n").encode(), asbytes=True))
                lines.clear()

        def close() -> None:
            for (period, _), (lines, frames) in held.items():
                flush(lines, frames)
                name = f"{uuid.uuid4().hex}{SUFFIX}"
                files.create(f"{self.staging}/{name}", b"".join(frames))
                done.append((name, period))
            held.clear()

        for batch in iterator:
            value, period, part = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("value", "period", "part"))
            for line, here in zip(value, zip(period, part)):
                if here not in held:
                    if self.ordered:
                        close()
                    held[here] = ([], [])
                held[here][0].append(line)
                if len(held[here][0]) >= self.flush_rows:
                    flush(*held[here])
        close()
        return Staged(done)

    def _move(self, messages: list, taken: set[str], mark: str) -> None:
        system, folder = files.located(self.path)
        _, staging = files.located(self.staging)
        for name, period in sorted((f for m in messages if m is not None for f in m.files), key=lambda f: (f[1], f[0])):
            number = 0
            while True:
                final = f"{PREFIX}{period}{mark}{f'.{number}' if number else ''}{SUFFIX}"
                if final not in taken:
                    break
                number += 1
            taken.add(final)
            system.move(f"{staging}/{name}", f"{folder}/{final}")
        files.drop_folder(self.staging)


class LineWriter(_Lines, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self._move(messages, set(files.names(self.path)), "")

    def abort(self, messages: list) -> None:
        files.drop_folder(self.staging)


class LineStreamWriter(_Lines, DataSourceStreamArrowWriter):
    ordered = False  # streams can't be sorted: lines are in order of arrival

    def staging_mark(self) -> str:
        return "stream"  # tasks and commits are given writers of their own; one query writes to an archive

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        mark = f".b{batchId}"
        system, folder = files.located(self.path)
        for name in files.names(self.path):  # of an earlier try of this batch
            if f"{mark}." in name:
                system.delete_file(f"{folder}/{name}")
        self._move(messages, set(), mark)

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        files.drop_folder(self.staging)


class LineArchive(DataSource):
    """``format("tickwise_lines")``: options ``path`` and ``flush_rows``."""

    @classmethod
    def name(cls) -> str:
        return "tickwise_lines"

    def schema(self) -> str:
        return "value string, period string, part bigint"

    def _options(self) -> tuple[str, int]:
        return self.options["path"], int(self.options.get("flush_rows", FLUSH_ROWS))

    def writer(self, schema, overwrite: bool) -> LineWriter:
        if overwrite:
            raise ValueError("an archive is appended to")
        return LineWriter(*self._options())

    def streamWriter(self, schema, overwrite: bool) -> LineStreamWriter:  # noqa: N802
        return LineStreamWriter(*self._options())


def _lines(bars: DataFrame, rotation_s: int) -> DataFrame:
    b = bars.select(*BAR_FIELDS)
    return b.select("symbol", "close_time_ms", "open_time_ms", encode_bars(b).alias("value"), archive_period("close_time_ms", rotation_s).alias("period"))


def archive_lines(bars: DataFrame, path: str, rotation_s: int = DEFAULT_ROTATION_S, file_rows: int = FILE_ROWS, flush_rows: int = FLUSH_ROWS) -> None:
    """Append bars to the archive at ``path``, a file per rotation period (and ``file_rows`` bars), in time order within a file."""
    spark = bars.sparkSession
    ship_package(spark)
    spark.dataSource.register(LineArchive)
    lines = _lines(bars, rotation_s)
    parts = lines.groupBy("period").agg(F.ceil(F.count("*") / F.lit(file_rows)).alias("parts"))
    dealt = lines.join(parts, "period").withColumn("part", F.pmod(F.xxhash64("symbol", "open_time_ms"), "parts"))
    ordered = dealt.repartition("period", "part").sortWithinPartitions("period", "part", "close_time_ms", "symbol", "open_time_ms")
    ordered.select("value", "period", "part").write.format("tickwise_lines").mode("append").option("path", path).option("flush_rows", flush_rows).save()


def archive_line_stream(bars: DataFrame, path: str, checkpoint: str, rotation_s: int = DEFAULT_ROTATION_S, **trigger) -> StreamingQuery:
    """Append a stream of bars: every micro-batch adds a file per period, with its bars in order of arrival."""
    spark = bars.sparkSession
    ship_package(spark)
    spark.dataSource.register(LineArchive)
    lines = _lines(bars, rotation_s).withColumn("part", F.lit(0).cast("bigint"))
    dealt = lines.repartition("period").select("value", "period", "part")
    writer = dealt.writeStream.format("tickwise_lines").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(bars with their file's period, rejected lines) of an archive, flat or legacy lines."""
    lines = spark.read.option("pathGlobFilter", f"{PREFIX}*{SUFFIX}").text(path)
    period = F.regexp_extract(F.col("_metadata.file_name"), rf"^{PREFIX}([0-9]+-[0-9]+)", 1)
    return parse_lines(lines.select("value", period.alias("period")))
