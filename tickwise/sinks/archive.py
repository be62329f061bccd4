"""S3: bar archive partitioned by rotation period, and X2: reading it back.

The reference appends one JSON line per bar to ``kline_<period>.zst`` and
starts a new file every ``rotation_s`` seconds of wall clock.  Here the
period comes from the bar's close time (so a replay lands in the same
place) and is a partition column: Parquet with zstd by default, gzip JSON
lines on request.  Appends never rewrite earlier periods, and reads prune
partitions by period.  Streams use the same function in ``foreachBatch`` or
a file sink with a checkpoint.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BAR_FIELDS, encode_bars
from ..functions.time import archive_period
from ..session import ensure_checkpoint_dir

# Fixed value: the rotation interval of the archive programs (8 hours).
DEFAULT_ROTATION_S = 8 * 3600

BAR_SCHEMA = (
    "exchange string, symbol string, open_time_ms bigint, close_time_ms bigint, open_time_h string, interval string, "
    "open double, high double, low double, close double, volume double, trades_count bigint"
)


def with_period(bars: DataFrame, rotation_s: int = DEFAULT_ROTATION_S) -> DataFrame:
    return bars.withColumn("period", archive_period("close_time_ms", rotation_s))


#: Bars in an archive file, about.
FILE_ROWS = 1_000_000


def archive_bars(bars: DataFrame, path: str, rotation_s: int = DEFAULT_ROTATION_S, fmt: str = "parquet", mode: str = "append",
                 file_rows: int = FILE_ROWS) -> None:
    """Write bars under ``path/period=<yyyyMMdd-HHmm>/``.

    Rows are clustered by (period, part) first, with as many parts as the
    period has ``file_rows``, so a period is a few files however many tasks
    write, and a large period is never one task."""
    out = with_period(bars.select(*BAR_FIELDS), rotation_s)
    parts = out.groupBy("period").agg(F.ceil(F.count("*") / F.lit(file_rows)).alias("_parts"))
    part = F.pmod(F.xxhash64("symbol", "open_time_ms"), F.col("_parts"))
    out = out.join(parts, "period").withColumn("_part", part).repartition("period", "_part").drop("_parts", "_part")
    if fmt == "parquet":
        out.select(*BAR_FIELDS, "period").write.mode(mode).partitionBy("period").option("compression", "zstd").parquet(path)
    elif fmt == "json":
        out.select(encode_bars(out).alias("value"), "period").write.mode(mode).partitionBy("period").option(
            "compression", "gzip").text(path)
    else:
        raise ValueError(f"unknown archive format {fmt!r}")


def parse_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Archive lines (column ``value``, others kept) -> (bars, rejects with the
    ``value`` and a reason).  A line may be a flat object or the legacy
    two-element form ``[index, {bar}]``; what is no bar with a symbol and an
    open time is rejected, never returned as an empty bar."""
    others = [c for c in lines.columns if c != "value"]
    value = F.trim(F.col("value"))
    legacy = F.regexp_extract(value, r"^\[\s*-?[0-9]+\s*,\s*(\{.*\})\s*\]$", 1)
    obj = F.when(value.startswith("["), legacy).otherwise(value)
    parsed = lines.withColumn("_b", F.from_json(obj, BAR_SCHEMA + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    reason = (
        F.when(F.col("_b").isNull() | F.col("_b._bad").isNotNull() | ~obj.startswith("{"), F.lit("malformed"))
        .when(F.col("_b.symbol").isNull() | F.col("_b.open_time_ms").isNull(), F.lit("incomplete"))
    )
    parsed = parsed.withColumn("reject_reason", reason)
    good = parsed.filter(F.col("reject_reason").isNull()).select(*[f"_b.{c}" for c in BAR_FIELDS], *others)
    return good, parsed.filter(F.col("reject_reason").isNotNull()).select("value", *others, "reject_reason")


def read_archive(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The bars of an archive."""
    if fmt == "parquet":
        return spark.read.parquet(path).select(*BAR_FIELDS, "period")
    return parse_lines(spark.read.text(path))[0]


def archive_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a text archive that are no bars."""
    return parse_lines(spark.read.text(path))[1]


def legacy_lines(bars: DataFrame, index_col: str = "symbol_index") -> DataFrame:
    """Archive lines in the legacy ``[index, {bar}]`` form (what the reference's
    programs actually wrote)."""
    return bars.select(F.concat(F.lit("["), F.col(index_col).cast("string"), F.lit(","), encode_bars(bars), F.lit("]")).alias("value"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's checkpoint folder (shared storage)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")
