"""Token ids in bit-packed shard files, with random access.

A shard holds the ids of consecutive documents:

    header    magic, version, bits an id, ids a block
    blocks    ids in ``bits`` bits each, least significant bit first, every block from a full byte
    footer    block offsets (u64, one more than blocks); per document: id (i64), whether it has one (u8), ids (u64)
    trailer   footer position, blocks, documents, ids, magic

``bits`` is the least number that holds every id of the vocabulary.  A block's
place comes from the offsets table, so any range of ids is read by its blocks
alone and unpacked with numpy.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .encode import encoded, encoder
from .store import new_folder, open_in, open_out

# Fixed values of the file format.
MAGIC, VERSION = b"TKBITS01", 1
HEADER, TRAILER = struct.Struct("<8sHHI"), struct.Struct("<QQQQ8s")
BLOCK_IDS = 1 << 16


def bits_for(vocabulary: int) -> int:
    """The least bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} does not fit {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=count * bits).reshape(count, bits)
    return (spread.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class ShardWriter:
    """Writes one shard; holds one block of ids and the document table."""

    def __init__(self, folder: str, name: str, bits: int, block_ids: int = BLOCK_IDS):
        self.uri, self.out = open_out(folder, name)
        self.bits, self.block_ids = bits, block_ids
        self.out.write(HEADER.pack(MAGIC, VERSION, bits, block_ids))
        self.at, self.offsets = HEADER.size, [HEADER.size]
        self.waiting, self.held, self.total = [], 0, 0
        self.docs, self.known, self.counts = [], [], []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc or 0)
        self.known.append(doc is not None)
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.block_ids:
            self._flush(False)

    def _flush(self, all_: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        end = len(ids) if all_ else len(ids) - len(ids) % self.block_ids
        for at in range(0, end, self.block_ids):
            block = pack_bits(ids[at : min(end, at + self.block_ids)], self.bits)
            self.out.write(block)
            self.at += len(block)
            self.offsets.append(self.at)
        self.waiting, self.held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(True)
        for column, kind in ((self.offsets, "<u8"), (self.docs, "<i8"), (self.known, "u1"), (self.counts, "<u8")):
            self.out.write(np.array(column, kind).tobytes())
        self.out.write(TRAILER.pack(self.at, len(self.offsets) - 1, len(self.docs), self.total, MAGIC))
        self.out.close()


class Shard:
    """Reads a shard: its document table at once, its ids by range."""

    def __init__(self, uri: str):
        self.file = open_in(uri)
        magic, version, self.bits, self.block_ids = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        footer, blocks, docs, self.total, end = TRAILER.unpack(self.file.read_at(TRAILER.size, self.file.size() - TRAILER.size))
        if magic != MAGIC or end != MAGIC or version != VERSION:
            raise ValueError(f"not a token shard: {uri}")
        table = self.file.read_at(self.file.size() - TRAILER.size - footer, footer)
        cuts = np.cumsum([8 * (blocks + 1), 8 * docs, docs, 8 * docs])
        parts = [table[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]
        self.offsets, self.docs = np.frombuffer(parts[0], "<u8").astype(np.int64), np.frombuffer(parts[1], "<i8")
        self.known, self.counts = np.frombuffer(parts[2], "u1").astype(bool), np.frombuffer(parts[3], "<u8").astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def block(self, n: int) -> np.ndarray:
        data = self.file.read_at(int(self.offsets[n + 1] - self.offsets[n]), int(self.offsets[n]))
        return unpack_bits(data, self.bits, min(self.block_ids, self.total - n * self.block_ids))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop - 1 of the shard; reads the blocks they lie in."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        found = np.concatenate([self.block(n) for n in range(first, last + 1)])
        return found[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, n: int) -> np.ndarray:
        return self.ids(int(self.starts[n]), int(self.starts[n] + self.counts[n]))

    def document_crcs(self) -> Iterator[int]:
        """CRC-32 of each document's ids as little-endian u32, every block read once."""
        data, at, block = b"", 0, 0  # ``data`` begins with id number ``at``
        for start, count in zip(self.starts.tolist(), self.counts.tolist()):
            crc, pos, stop = 0, start, start + count
            while pos < stop:
                have = at + len(data) // 4
                if pos >= have:
                    at, data = have, self.block(block).astype("<u4").tobytes()
                    block += 1
                    have = at + len(data) // 4
                end = min(stop, have)
                crc = zlib.crc32(memoryview(data)[4 * (pos - at) : 4 * (end - at)], crc)
                pos = end
            yield crc

    def close(self) -> None:
        self.file.close()


def vocabulary_size(tokenizer: str, style: str = "byte") -> int:
    """One more than the largest id of a vocabulary file, special tokens included."""
    return encoder(tokenizer, style).size


def write_shards(
    docs: DataFrame, tokenizer: str, vocabulary: int | None = None, style: str = "byte", end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Encode and write all documents in ascending id order; returns the
    manifest (one row per shard: shard, uri, docs, ids, start), written once.

    ``vocabulary``: one more than the largest id (None: the file's).  The
    texts are range-partitioned by (id, hash of the text) -- a repeated id can
    be split -- and one task encodes and writes one shard.  ``start`` is the
    number of ids in all earlier shards, a running sum over one row per shard."""
    spark = docs.sparkSession
    ship_package(spark)
    folder, bits = new_folder(spark, "tokens"), bits_for(vocabulary or vocabulary_size(tokenizer, style))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        writer = None
        for batch in batches:
            docs_ = batch.column(0).to_pylist()
            for row, ids in encoded(batch.column(1), tokenizer, style):
                writer = writer or ShardWriter(folder, f"shard-{shard:06d}.tkb", bits, block_ids)
                writer.add(docs_[row], np.append(ids, np.uint32(end_id)))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "uri": [writer.uri], "docs": [len(writer.docs)], "ids": [writer.total]}
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("t")]
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = materialize(ordered.mapInArrow(run, "shard bigint, uri string, docs bigint, ids bigint"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32.  One task reads one shard, a block at a time."""
    ship_package(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(uri)
                crcs = np.fromiter(shard.document_crcs(), np.int64, len(shard.docs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.docs, mask=~shard.known), pa.array(start + shard.starts), pa.array(shard.counts), pa.array(crcs)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                shard.close()

    spread = manifest.select("uri", "start").repartition(max(1, manifest.count()))
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_read(docs: DataFrame, tokenizer: str, vocabulary: int | None = None, **options) -> DataFrame:
    """``write_shards``, then ``read_documents``.

    Null texts count as empty (the end id alone).  Null ids come first.
    Documents with equal ids follow each other in an order fixed by their
    texts; repeated rows are documents of their own.  An empty table writes no
    file.  Columns other than the two named are not read."""
    return read_documents(write_shards(docs, tokenizer, vocabulary, **options))
