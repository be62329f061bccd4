"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line.  Each query runs to completion into Spark's ``noop``
sink (the whole result is produced, nothing is collected)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "resample_bars", "bollinger", "ema", "macd", "macd_asof", "bandtastic_signals", "strategy_params",
    "macd_signals", "trade_ledger", "macd_trades", "decode_frames", "normalize_bars", "collapse_updates",
    "stream_signals", "daily_bars", "daily_bandtastic_signals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    from tickwise.plans import catalog
    from tickwise.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="tickwise-bench")
    qs = catalog.queries()
    # Untimed warm-up (JVM start-up, first code generation) on the smallest tables.
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        qs["resample_bars"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in only:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf, "cpus": cpus, "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
