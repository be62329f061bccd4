"""A sample of registered queries against their DuckDB oracles (sf0.001)."""

import pytest

from tickwise.plans import catalog
from tickwise.plans.verify import compare, oracle_connection

SF = "/root/testdata/sf0.001"
SAMPLE = ["resample_bars", "bollinger", "ema", "rsi", "macd_asof", "strategy_params", "macd_signals", "trade_ledger",
          "decode_frames", "collapse_updates", "trade_text", "strategy_plugin", "stream_signals"]


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    q = catalog.REGISTRY[name]
    res = compare(spark, name, q.build, q.sql, SF, con)
    assert res["status"] == "match", res


def test_entry_runs(spark):
    import importlib.util
    import os

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() >= 0
    assert set(mod.oracle_sql()) <= set(mod.queries())
