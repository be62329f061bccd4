"""WARC archives with a two-level capture index.

Writing: every task writes the records of its partition to archive files of
its own (one gzip member per record) and reports a capture per record.  The
captures are range-partitioned by (reversed-host URL key, time, page id) --
one key can be split -- and each partition becomes an index shard: sorted
lines in zlib-compressed blocks, and after them a sparse directory of each
block's first key and place.

Reading: a URL key is looked up among the shards' first keys, then by binary
search in the shard's directory, and only the blocks that can hold it are
read.  The captures found are dealt by archive file and read by byte range in
file order, neighbouring ranges together.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .heavy import with_largest
from .store import new_folder, open_in, open_out

# Fixed values of the formats.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
INDEX_MAGIC = b"CAPIDX01"

#: Compressed bytes after which a task begins its next archive file.
ARCHIVE_BYTES = 256 << 20
#: Captures in an index block.
BLOCK_LINES = 1024
#: Payloads from this size are stored once.
LEAST_REVISIT = 1000
#: Neighbouring ranges are read together up to this many bytes.
READ_BYTES = 4 << 20
#: Bytes of archives that a task reads, about.
STRETCH_BYTES = 1 << 23


def url_key(url: str | None) -> str:
    """Reversed-host key: ``com,example,www)/path?query``, host in lower case,
    a port other than the scheme's kept.  No host: the text after ``)``; null: ``)``."""
    if not url:
        return ")"
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return ")" + url
    if not host:
        return ")" + url
    default = {"http": 80, "https": 443}.get(parts.scheme.lower())
    tail = (parts.path or "/") + ("?" + parts.query if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, default) else "") + ")" + tail


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member."""
    lines = [VERSION, b"WARC-Type: " + kind.encode()]
    lines += [f"{k}: {v}".encode() for k, v in headers]
    lines.append(b"Content-Length: %d" % len(block))
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.decode(): v.decode() for k, _, v in (x.partition(b": ") for x in lines[1:])}
    return headers, rest[: int(headers["Content-Length"])]


def _record_id(page: int | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest.hex()}')}>"


def _one_line(text: str) -> str:
    """A header value cannot hold line ends (percent-encoded as in a URL)."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in text or "\n" in text else text


def _page_record(page: int | None, url: str | None, date: str, payload: bytes, digest: bytes, refers: int | None, revisit: bool) -> bytes:
    headers = [
        ("WARC-Record-ID", _record_id(page, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _one_line(url or "")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode()),
        ("X-Payload-Length", str(len(payload))),
        ("X-Page-Id", "" if page is None else str(page)),
    ]
    if not revisit:
        return record("response", [*headers, ("Content-Type", "application/http; msgtype=response")], HTTP_HEAD + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers, digest)), ("X-Refers-To-Page-Id", str(refers))]
    return record("revisit", headers, b"")


def write_archives(pages: DataFrame, date: str = "2000-01-01T00:00:00Z", least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write the archives; returns the captures, written once: key, time,
    page_id, uri, at, size.  pages: page_id, url, html."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = new_folder(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page"), F.unhex(F.sha1(payload)).alias("digest"), F.length(payload).alias("bytes")
    )
    large = with_largest(materialize(narrow.where(F.col("bytes") >= least_revisit).select("page", "digest")), "digest", ["page"])
    revisits = large.where(~F.col("w.page").eqNullSafe(F.col("page"))).select("page", "digest", F.col("w.page").alias("refers")).distinct()
    revisits = materialize(revisits.toDF("_page", "_digest", "refers"))
    rows = pages.select(F.col("page_id").cast("long").alias("page"), "url", payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest"))
    rows = rows.join(revisits, F.col("page").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")
    rows = rows.select("page", "url", "payload", "digest", "refers", F.col("_digest").isNotNull().alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, uri, at, number = TaskContext.get().partitionId(), None, "", 0, 0
        for batch in batches:
            out = []
            for values in zip(*batch.columns):
                page, url, body, digest, refers, revisit = (v.as_py() for v in values)
                if file is None or at >= ARCHIVE_BYTES:
                    if file:
                        file.close()
                    uri, file = open_out(folder, f"pages-{part:06d}-{number:04d}.warc.gz")
                    info = record("warcinfo", [("WARC-Record-ID", _record_id(None, uri.encode())), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    file.write(info)
                    at, number = len(info), number + 1
                member = _page_record(page, url, date, body, digest, refers, revisit)
                file.write(member)
                out.append((url_key(url), date, page, uri, at, len(member)))
                at += len(member)
            if out:
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "time", "page_id", "uri", "at", "size"])
        if file:
            file.close()

    return materialize(rows.mapInArrow(run, "key string, time string, page_id bigint, uri string, at bigint, size bigint"))


class IndexWriter:
    """Writes an index shard: compressed blocks of sorted lines, then the sparse directory."""

    def __init__(self, folder: str, name: str):
        self.uri, self.out = open_out(folder, name)
        self.at, self.lines, self.directory, self.first, self.last = 0, [], [], None, None

    def add(self, key: str, time: str, page: int | None, uri: str, at: int, size: int) -> None:
        self.first = key if self.first is None else self.first
        self.last = key
        self.lines.append(json.dumps([key, time, page, uri, at, size], ensure_ascii=False))
        if len(self.lines) >= BLOCK_LINES:
            self._flush()

    def _flush(self) -> None:
        if self.lines:
            block = zlib.compress("\n".join(self.lines).encode("utf-8", "surrogatepass"))
            self.out.write(block)
            self.directory.append([json.loads(self.lines[0])[0], self.at, len(block)])
            self.at += len(block)
            self.lines = []

    def close(self) -> None:
        self._flush()
        directory = zlib.compress(json.dumps(self.directory).encode())
        self.out.write(directory + len(directory).to_bytes(8, "little") + INDEX_MAGIC)
        self.out.close()


class IndexShard:
    """Binary search in the directory, then range reads of the blocks that can hold a key."""

    def __init__(self, uri: str):
        self.file = open_in(uri)
        end = self.file.read_at(16, self.file.size() - 16)
        if end[8:] != INDEX_MAGIC:
            raise ValueError(f"not an index shard: {uri}")
        size = int.from_bytes(end[:8], "little")
        self.directory = json.loads(zlib.decompress(self.file.read_at(size, self.file.size() - 16 - size)))
        self.first = [d[0].encode("utf-8", "surrogatepass") for d in self.directory]
        self.kept: tuple[int, list] = (-1, [])

    def block(self, n: int) -> list[list]:
        if self.kept[0] != n:
            _, at, size = self.directory[n]
            text = zlib.decompress(self.file.read_at(size, at)).decode("utf-8", "surrogatepass")
            self.kept = (n, [json.loads(x) for x in text.split("\n")])
        return self.kept[1]

    def find(self, key: str) -> Iterator[list]:
        """The captures of a key, in order."""
        want = key.encode("utf-8", "surrogatepass")
        # Equal keys may begin in the block before the first that starts with them.
        n = max(0, bisect.bisect_left(self.first, want) - 1)
        while n < len(self.first) and self.first[n] <= want:
            yield from (x for x in self.block(n) if x[0] == key)
            n += 1


def write_index(captures: DataFrame) -> DataFrame:
    """Write the index; returns its shards, written once: shard, uri, first, last (keys)."""
    spark = captures.sparkSession
    ship_package(spark)
    folder = new_folder(spark, "captures")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer = TaskContext.get().partitionId(), None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                writer = writer or IndexWriter(folder, f"captures-{shard:06d}.idx")
                writer.add(*row)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "uri": [writer.uri], "first": [writer.first], "last": [writer.last]})

    order = ["key", "time", "page_id", "uri", "at"]
    dealt = captures.select("key", "time", "page_id", "uri", "at", "size").repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(dealt.mapInArrow(run, "shard bigint, uri string, first string, last string"))


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Captures (page_id, uri, at, size) of distinct URL keys (column ``key``).

    A key goes to every shard whose key range holds it: a range test against
    one row per shard.  The shards' bounds travel with the task as a list (one
    entry per index shard, that is per task that wrote one)."""
    spark = index.sparkSession
    shards = sorted((r["first"].encode(), r["last"].encode(), r["uri"]) for r in index.collect())  # one row per shard
    firsts, lasts = [s[0] for s in shards], [s[1] for s in shards]

    @F.arrow_udf("array<int>")
    def places(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = []
            for key in column.to_pylist():
                want = key.encode()
                out.append(list(range(bisect.bisect_left(lasts, want), bisect.bisect_right(firsts, want))))
            yield pa.array(out, pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, shard = -1, None
        for batch in batches:
            out = []
            for key, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != place:
                    place, shard = n, IndexShard(shards[n][2])
                for found in shard.find(key):
                    out.append(found[2:])
                    if len(out) >= 10_000:
                        yield _captures(out)
                        out = []
            if out:
                yield _captures(out)

    asked = keys.select("key", F.explode(places(F.col("key"))).alias("place"))
    asked = asked.repartition(max(1, len(shards)), "place").sortWithinPartitions("place", "key")
    return asked.mapInArrow(run, "page_id bigint, uri string, at bigint, size bigint")


def _captures(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["page_id", "uri", "at", "size"])


def read_records(captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """Read captures' records by byte range: page_id, payload_bytes,
    payload_digest, record_type, refers_to and, on request, url and payload
    (null for a revisit).  Length and digest of a response are taken from its
    payload and compared with its headers."""
    ship_package(captures.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, file, begin, data = None, None, 0, b""
        for batch in batches:
            out = []
            wanted = list(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))))
            for n, (place, at, size) in enumerate(wanted):
                if place != uri:
                    uri, file, begin, data = place, open_in(place), 0, b""
                if not begin <= at <= at + size <= begin + len(data):
                    stop = at + size
                    for other, start, more in wanted[n + 1 :]:
                        if other != uri or start != stop or stop + more - at > READ_BYTES:
                            break
                        stop = start + more
                    begin, data = at, file.read_at(stop - at, at)
                out.append(_parsed(data[at - begin : at - begin + size], with_payload))
            if out:
                names, kinds = zip(*[("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())][: 7 if with_payload else 5])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], list(names))

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    # One archive file's captures are dealt in stretches, so a large file is read by several tasks.
    # As many tasks as there are bytes for: the captures themselves are narrow.
    stretch = F.floor(F.col("at") / F.lit(STRETCH_BYTES))
    tasks = -(-(captures.agg(F.sum("size")).first()[0] or 1) // STRETCH_BYTES)
    dealt = captures.select("page_id", "uri", "at", "size").repartition(tasks, "uri", stretch).sortWithinPartitions("uri", "at")
    return dealt.mapInArrow(run, schema + ", url string, payload binary" * with_payload)


def _parsed(member: bytes, with_payload: bool) -> tuple:
    headers, block = parse_record(member)
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size, payload = int(headers["X-Payload-Length"]), None
    if headers["WARC-Type"] == "response":
        payload = block[len(HTTP_HEAD) :]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("payload does not match its digest")
    page, refers = headers["X-Page-Id"], headers.get("X-Refers-To-Page-Id")
    row = (int(page) if page else None, size, digest, headers["WARC-Type"], int(refers) if refers else None)
    return (*row, headers["WARC-Target-URI"], payload) if with_payload else row


def archive(pages: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Write archives and index of ``pages`` (page_id, url, html); returns (captures, index shards)."""
    captures = write_archives(pages, **options)
    return captures, write_index(captures)


def keys_of(pages: DataFrame) -> DataFrame:
    """The distinct URL keys of a ``url`` column."""
    ship_package(pages.sparkSession)

    @F.arrow_udf("string")
    def keys(urls: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in urls:
            yield pa.array([url_key(u) for u in column.to_pylist()], pa.string())

    return pages.select("url").distinct().select(keys(F.col("url")).alias("key")).distinct()


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Archive the pages and read every one back through the index: one row per
    page with page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload; a null or odd URL has a key of its own
    kind and is found like any other.  Of equal payloads of ``LEAST_REVISIT``
    bytes or more, the rows with the largest page_id are responses (repeated
    rows of that page too) and all others revisits; a null page_id is smaller
    than any other.  An empty table writes no file and gives no row.  Columns other than the
    three are not read."""
    _, index = archive(pages)
    return read_records(lookup(index, keys_of(pages)))


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), w AS (
  SELECT *, CASE WHEN payload_bytes >= {LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS w FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN w = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN w = page_id THEN NULL ELSE w END AS refers_to
FROM w
"""
