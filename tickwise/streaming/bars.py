"""X1 on a stream: bars from ticks by event time.

``stream_bars`` is a windowed aggregation with a watermark, in append mode: a
bar is emitted once, when the watermark passes its end, and the state holds
only the bars still open.  Rows without a price (heartbeats) move the
watermark and nothing else, so a quiet feed still closes its bars.

Ticks that come behind the watermark are no longer part of a bar's state.
They are not lost: ``late_ticks`` counts them per bar against the ticks the
feed archived, and ``corrected_bars`` builds exactly those bars again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_ms
from ..sources.bars import bar_aggregates, bars_of_slots, event_rows, event_ticks, slot_of

_SLOT = ["exchange", "symbol", "open_time_ms"]


def stream_bars(events: DataFrame, minutes: int, delay: str = "10 minutes") -> DataFrame:
    """Bars of ``minutes`` from a stream of events; ticks may be ``delay`` out of order."""
    at = F.timestamp_millis(epoch_ms("ts"))
    # Rows without a price stay in until they are aggregated: a filter would be
    # pushed below the watermark, which they are there to move.
    rows = event_rows(events.withColumn("_at", at).withWatermark("_at", delay), keep=["_at"])
    slots = rows.groupBy("exchange", "symbol", F.window("_at", f"{minutes} minutes").alias("_w"))
    bars = slots.agg(*bar_aggregates(["event_id"], sparse=True)).where("trades_count > 0")
    return bars_of_slots(bars.withColumn("open_time_ms", F.unix_millis("_w.start")), minutes)


def late_ticks(events: DataFrame, bars: DataFrame, minutes: int) -> DataFrame:
    """exchange, symbol, open_time_ms, late: ticks of the archive that their bar does not hold (bars without any are left out)."""
    there = event_ticks(events).withColumn("open_time_ms", slot_of("ms", minutes)).groupBy(*_SLOT).agg(F.count("*").alias("n"))
    held = bars.select(*_SLOT, F.col("trades_count").alias("held"))
    late = F.col("n") - F.coalesce("held", F.lit(0))
    return there.join(held, _SLOT, "left").select(*_SLOT, late.alias("late")).where("late > 0")


def corrected_bars(events: DataFrame, bars: DataFrame, minutes: int, late: DataFrame | None = None) -> DataFrame:
    """``bars`` with those that miss late ticks built again from all their ticks; no other bar is touched."""
    late = late_ticks(events, bars, minutes) if late is None else late
    slots = late.select(*_SLOT)
    ticks = event_ticks(events).withColumn("open_time_ms", slot_of("ms", minutes)).join(slots, _SLOT, "left_semi")
    again = bars_of_slots(ticks.groupBy(*_SLOT).agg(*bar_aggregates(["event_id"])), minutes)
    return bars.join(slots, _SLOT, "left_anti").select(*again.columns).unionByName(again)
