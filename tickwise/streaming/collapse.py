"""F5 on a stream: the last update of each run of equal start times.

Keyed state per (symbol, interval) holds one cached update, the latest.  When
an update with another start time arrives, the cached one is emitted; the last
run of a key stays cached, as in the batch form.  State and checkpoint carry
the cache over restarts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ship_package

KEYS = ["symbol", "interval"]


class CollapseProcessor(StatefulProcessor):
    """One series' cached update.  Within a micro-batch updates are taken in arrival order."""

    def __init__(self, schema, order: list[str], start: str):
        self.schema, self.order, self.start = schema, order, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cached = handle.getValueState("cached", self.schema)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        names = self.schema.fieldNames()
        new = pd.concat(list(rows))[names]
        if self.cached.exists():
            new = pd.concat([pd.DataFrame([self.cached.get()], columns=names).astype(new.dtypes.to_dict()), new])
        # The cached update arrived before any of these: a stable sort keeps it first among equals.
        new = new.sort_values(self.order, kind="stable")
        ended = new[self.start].ne(new[self.start].shift(-1)).to_numpy()
        ended[-1] = False
        last = new.iloc[-1].tolist()
        self.cached.update(tuple(v.item() if hasattr(v, "item") else v for v in last))
        yield new[ended]


def stream_collapse(frames: DataFrame, order: tuple[str, ...] = ("recv_ms", "frame_no"), start: str = "start_ms") -> DataFrame:
    """Updates that end a run, as they become known; same columns as ``frames``.

    Micro-batches must follow each other in arrival order (the source's
    order); inside one, rows may come in any order.  Columns must not be null
    (decoded frames have every leaf)."""
    ship_package(frames.sparkSession)
    return frames.groupBy(*KEYS).transformWithStateInPandas(CollapseProcessor(frames.schema, list(order), start), frames.schema, "Append", "None")
