"""F2, stable: a symbol dictionary that only grows.

Symbols are numbered 1, 2, 3, ... as they first arrive, open frames included.
A run reads the numbers given so far, appends those of new symbols in order of
arrival, and never changes one: state that is kept by number stays with its
symbol over reconnects and restarts.  The dictionary has one row per symbol.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

SCHEMA = "symbol string, symbol_index bigint"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """symbol, symbol_index; empty if nothing was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def grow_dictionary(frames: DataFrame, path: str) -> DataFrame:
    """Number the symbols of ``frames`` (symbol, recv_ms, frame_no) that have no
    number yet, and return the dictionary.

    Simultaneous arrivals are ordered by name; rows without a symbol are left
    out.  One writer at a time; running the same frames again adds nothing."""
    spark = frames.sparkSession
    known = read_dictionary(spark, path)
    last = known.agg(F.max("symbol_index")).first()[0] or 0
    first = frames.where(F.col("symbol").isNotNull()).groupBy("symbol").agg(F.min(F.struct("recv_ms", "frame_no", "symbol")).alias("_first"))
    new = materialize(first.join(known, "symbol", "left_anti"))
    if not new.isEmpty():
        number = F.row_number().over(Window.orderBy("_first"))  # one row per new symbol
        new.select("symbol", (number + F.lit(last)).cast("bigint").alias("symbol_index")).coalesce(1).write.mode("append").parquet(path)
    return read_dictionary(spark, path)


def indexed(frames: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``frames`` with their symbol's number, null where it has none (whether the dictionary is broadcast is left to its size)."""
    return frames.join(dictionary, "symbol", "left")
