"""Literal modes of the reference's defects, and a restored position."""

from pyspark.sql import functions as F

from tickwise.operators.ledger import trade_ledger
from tickwise.plans import catalog
from tickwise.strategies.mtf_macd import MacdParams, MultiTimeFrameMacd

SF = "/root/testdata/sf0.001"


def test_macd_literal_mode_never_enters(spark):
    bars = catalog.bars(spark, SF, [60, 240])
    literal = MultiTimeFrameMacd(MacdParams(carry_forward=False)).signals(bars, chunk_rows=64)
    assert literal.filter(F.col("kind") == "Enter").count() == 0
    carried = MultiTimeFrameMacd(MacdParams()).signals(bars, chunk_rows=64)
    assert carried.filter(F.col("kind") == "Enter").count() > 0


def test_restored_position_can_exit_in_literal_mode(spark):
    bars = catalog.bars(spark, SF, [60, 240])
    symbols = bars.select("exchange", "symbol").distinct()
    # Every symbol starts holding a long position at a price it will fall below.
    init = symbols.select("exchange", "symbol", F.lit(1.0).alias("pos_size"), F.lit(1e9).alias("pos_price"),
                          F.lit(0).cast("bigint").alias("pos_index"), F.lit(None).cast("double").alias("entry_price"),
                          F.lit(False).alias("armed"))
    sig = MultiTimeFrameMacd(MacdParams(carry_forward=False)).signals(bars, chunk_rows=64, initial_state=init).collect()
    assert all(r.kind == "Exit" for r in sig)
    assert len({r.symbol for r in sig}) >= 1


def test_literal_roi_is_null(spark):
    sig = catalog.raw_signals(spark, SF)
    assert trade_ledger(sig, literal_roi=True).filter("event = 'close' AND roi IS NOT NULL").count() == 0
    assert trade_ledger(sig).filter("event = 'close' AND roi IS NOT NULL").count() > 0
