"""Bar sanity.  A bar whose numbers cannot be a candlestick would stop
the reference's indicator library; here it goes to a rejects table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


NUMBERS = ["open", "high", "low", "close", "volume"]


def sanity_reason() -> Column:
    """The first fault of a bar, or null."""
    some = lambda test: reduce(lambda a, b: a | b, [test(F.col(c)) for c in NUMBERS])
    return (
        F.when(some(lambda c: c.isNull()), F.lit("missing"))
        .when(some(F.isnan), F.lit("nan"))
        .when(some(lambda c: F.abs(c) == float("inf")), F.lit("infinite"))
        .when(F.col("low") > F.col("high"), F.lit("low_above_high"))
        .when((F.col("open") < F.col("low")) | (F.col("open") > F.col("high")), F.lit("open_outside_range"))
        .when((F.col("close") < F.col("low")) | (F.col("close") > F.col("high")), F.lit("close_outside_range"))
        .when(F.col("volume") < 0, F.lit("negative_volume"))
    )


def bar_sanity(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    t = bars.withColumn("reject_reason", sanity_reason())
    return t.filter(F.col("reject_reason").isNull()).drop("reject_reason"), t.filter(F.col("reject_reason").isNotNull())


SQL_SANITY_REASON = """CASE WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL THEN 'missing'
  WHEN isnan(open) OR isnan(high) OR isnan(low) OR isnan(close) OR isnan(volume) THEN 'nan'
  WHEN isinf(open) OR isinf(high) OR isinf(low) OR isinf(close) OR isinf(volume) THEN 'infinite'
  WHEN low > high THEN 'low_above_high'
  WHEN open < low OR open > high THEN 'open_outside_range'
  WHEN close < low OR close > high THEN 'close_outside_range'
  WHEN volume < 0 THEN 'negative_volume' END"""
