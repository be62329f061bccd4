"""Packing documents into sequences by minimum bin slack.

How full a bin can get depends on the lengths left, not on which piece has
them.  The lengths lie in 1..capacity, so a histogram of at most ``capacity``
rows describes any corpus, and the whole packing is planned on it:

* per bin, the longest length left is taken, and a bitset subset-sum dynamic
  program over the lengths still available finds the combination that fills
  the rest best;
* that combination is removed -- as many times at once as the histogram holds
  it, since it stays a fullest one for the next bins.

The plan (a few thousand combinations, whatever the corpus size) tells for
each length which bins its pieces go to, in order.  Spark numbers the pieces
of a length (in salted groups, so one frequent length never meets in one task)
and looks the number up in the plan.  Texts are encoded once and never
shuffled: only the narrow piece rows are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .encode import encoded

#: Pieces numbered together in one group.
GROUP_ROWS = 1024


def fullest(slack: int, counts: dict[int, int]) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to
    ``slack``: bit s of ``reach`` is set when some combination has sum s."""
    reach, mask, steps = 1, (1 << (slack + 1)) - 1, []
    for length in sorted((x for x in counts if x <= slack), reverse=True):
        left, size = min(counts[length], slack // length), 1
        while left and not reach >> slack & 1:
            take = min(size, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left, size = left - take, size * 2
        if reach >> slack & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if total and not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, pieces of each length in one such bin), until every piece has a bin."""
    left = {x: n for x, n in counts.items() if n}
    out = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        if not rest[longest]:
            del rest[longest]
        bin_ = fullest(capacity - longest, rest)
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(left[x] // n for x, n in bin_.items())
        for x, n in bin_.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        out.append((times, bin_))
    return out


def _places(steps: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: numbers at which its steps begin, pieces a bin, first bin, offset of its first piece in a bin."""
    rows: dict[int, list] = {}
    taken: dict[int, int] = {}
    first = 0
    for times, bin_ in steps:
        offset = 0
        for length in sorted(bin_, reverse=True):
            rows.setdefault(length, []).append((taken.get(length, 0), bin_[length], first, offset))
            taken[length] = taken.get(length, 0) + bin_[length] * times
            offset += length * bin_[length]
        first += times
    return {x: tuple(np.array(c, np.int64) for c in zip(*r)) for x, r in rows.items()}


def pieces(
    docs: DataFrame, tokenizer: str, style: str, end_id: int, capacity: int,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, on
    request, ids.  A document's ids are its text's and ``end_id``; only a
    longer document than ``capacity`` is cut."""
    ship_package(docs.sparkSession)
    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_type = batch.schema.field(0).type
            docs_ = batch.column(0).to_pylist()
            out: list[tuple] = []
            size = 0
            for row, ids in encoded(batch.column(1), tokenizer, style):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for n, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    out.append((docs_[row], n, at, len(part), zlib.crc32(part.tobytes()), part))
                size += len(ids)
                if size >= 1 << 20:
                    yield _batch(out, ids_type, with_ids)
                    out, size = [], 0
            if out:
                yield _batch(out, ids_type, with_ids)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def _batch(rows: list[tuple], ids_type: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    kinds = [ids_type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    columns = list(zip(*rows))
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
    if with_ids:
        arrays.append(pa.array([x.astype(np.int32) for x in columns[5]], pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def assign(rows: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to piece rows (``length`` in 1..capacity, and
    a unique stable ``uid``)."""
    spark = rows.sparkSession
    histogram = rows.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in histogram}
    places = _places(plan(counts, capacity))
    groups = spark.createDataFrame([(x, -(-n // GROUP_ROWS)) for x, n in counts.items()], "length bigint, parts bigint")
    salted = rows.join(F.broadcast(groups), "length").withColumn("part", F.pmod(F.xxhash64("uid"), "parts")).drop("parts")
    before = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("uid"))
    numbered = (
        salted.withColumn("own", own).join(before, ["length", "part"])
        .withColumn("number", (F.col("before") + F.col("own") - 1).cast("bigint")).drop("before", "own", "part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            number = batch.column(batch.schema.get_field_index("number")).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                mine = np.flatnonzero(length == x)
                begins, each, first, at = places[int(x)]
                step = np.searchsorted(begins, number[mine], "right") - 1
                nth = number[mine] - begins[step]
                sequence[mine] = first[step] + nth // each[step]
                offset[mine] = at[step] + nth % each[step] * x
            keep = [i for i, f in enumerate(batch.schema.names) if f != "number"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(sequence), pa.array(offset)],
                [*[batch.schema.names[i] for i in keep], "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number")
    return numbered.mapInArrow(run, schema + ", sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame, tokenizer: str, style: str = "word", end_id: int = 1, capacity: int = 4096,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece that holds the end id.  Repeated rows
    and equal or null ids are packed as rows of their own.  An empty table
    gives an empty table; columns other than the two named are not read."""
    rows = pieces(docs, tokenizer, style, end_id, capacity, id_col, text_col)
    rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()))
    return assign(rows, capacity).drop("uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(
    docs: DataFrame, tokenizer: str, style: str = "word", end_id: int = 1, capacity: int = 4096,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (at most ``capacity``) and doc_ids, one per piece, in place order."""
    rows = pieces(docs, tokenizer, style, end_id, capacity, id_col, text_col, with_ids=True)
    rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()))
    placed = assign(rows.select("uid", "doc_id", "length"), capacity).select("uid", "sequence_id", "offset")
    parts = rows.join(placed, "uid").groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts")  # at most ``capacity`` ids
    )
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
