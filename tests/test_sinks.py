"""Line archive, outbox, routing and the symbol dictionary: whole results, failures and retries."""

import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tickwise.functions.text import BAR_FIELDS, encode_bars
from tickwise.plans import catalog
from tickwise.sinks import line_archive, outbox, router
from tickwise.sources import frames as fr
from tickwise.sources.dictionary import grow_dictionary, indexed, read_dictionary
from tickwise.streaming.replay import read_in_order, write_in_order

SF = "/root/testdata/sf0.001"
ROW = "exchange string, symbol string, open_time_ms bigint, close_time_ms bigint, open_time_h string, interval string, open double, high double, low double, close double, volume double, trades_count bigint"


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="tw-sinks-")


def key(df):
    return sorted(tuple(r[c] for c in BAR_FIELDS) for r in df.collect())


def test_line_archive_round_trip(spark, folder):
    bars = catalog.bars(spark, SF, 15).cache()
    for odd in (0, 1):  # the second run finds the first one's files
        line_archive.archive_lines(bars.filter(F.col("trades_count") % 2 == odd), folder, file_rows=20, flush_rows=3)
    names = [os.path.basename(f) for f in glob.glob(f"{folder}/*")]
    assert all(n.startswith("kline_") and n.endswith(".zst") for n in names) and any(n.endswith(".1.zst") for n in names)
    back, bad = line_archive.read_lines(spark, folder)
    assert key(back) == key(bars) and bad.count() == 0
    with open(glob.glob(f"{folder}/kline_*.zst")[0], "rb") as f:
        assert f.read().count(b"\x28\xb5\x2f\xfd") >= 1  # zstd frames
    periods = {r.period for r in back.select("period").distinct().collect()}
    assert periods == {n.split("_")[1].split(".")[0] for n in names}


def test_a_failed_task_leaves_no_file(spark, folder):
    bars = catalog.bars(spark, SF, 15)
    broken = bars.withColumn("close", F.when(F.col("symbol") == "VIEW", F.raise_error(F.lit("broken bar")).cast("double")).otherwise(F.col("close")))
    with pytest.raises(Exception, match="broken bar"):
        line_archive.archive_lines(broken, folder)
    assert glob.glob(f"{folder}/**/*.zst", recursive=True) == []
    assert not [d for d in os.listdir(folder) if d.startswith("_staging")]


def test_line_archive_on_a_stream(spark, folder):
    bars = catalog.bars(spark, SF, 15)
    stream = read_in_order(spark, write_in_order(bars, ["close_time_ms"], f"{folder}/src", files=3), bars.schema)
    line_archive.archive_line_stream(stream, f"{folder}/out", f"{folder}/ckpt").awaitTermination()
    assert key(line_archive.read_lines(spark, f"{folder}/out")[0]) == key(bars)
    writer = line_archive.LineStreamWriter(f"{folder}/out", 10)
    before = set(os.listdir(f"{folder}/out"))
    one = next(n for n in before if ".b1." in n)
    with open(f"{folder}/out/{one}", "rb") as f:
        line_archive.files.create(f"{writer.staging}/x.zst", f.read())
    writer.commit([line_archive.Staged([("x.zst", one.split("_")[1].split(".")[0])])], 1)  # a repeated batch replaces its own files
    after = set(os.listdir(f"{folder}/out"))
    assert {n for n in after if ".b1." in n} == {one} and {n for n in before if ".b1." not in n} == {n for n in after if ".b1." not in n}


def test_json_of_absent_and_non_finite_numbers(spark):
    rows = [("x", "s", 1, 2, None, "15m", float("nan"), float("inf"), -0.5, None, 1e300, None)]
    text = spark.createDataFrame(rows, ROW)
    got = json.loads(text.select(encode_bars(text).alias("j")).first().j, parse_constant=lambda c: pytest.fail(c))
    assert list(got) == BAR_FIELDS
    assert [got[c] for c in ("open", "high", "low", "close", "open_time_h", "trades_count")] == [None, None, -0.5, None, None, None]


def test_a_failing_sender_sees_each_payload_once(spark, folder):
    payloads = spark.createDataFrame([(f"u{i % 2}", f"body {i}") for i in range(60)] + [("u0", "body 0")], "url string, body string").repartition(3)
    seen, refuse = f"{folder}/seen", f"{folder}/refuse"
    os.makedirs(seen)
    open(refuse, "w").close()

    def send(url, body):
        if body.endswith("7") and os.path.exists(refuse):
            raise OSError("the other side is down")
        with open(f"{seen}/{os.getpid()}", "a") as f:
            f.write(f"{url} {body}\n")

    box = f"{folder}/outbox"
    with pytest.raises(Exception, match="the other side is down"):
        outbox.deliver(payloads, box, send, every=5)
    part = outbox.acknowledged(spark, box).count()
    assert 0 < part < 60
    os.remove(refuse)
    assert outbox.deliver(payloads, box, send, every=5) == 60 - part
    assert outbox.deliver(payloads, box, send) == 0 and outbox.pending(payloads, box).isEmpty()
    lines = [line for name in glob.glob(f"{seen}/*") for line in open(name)]
    assert sorted(lines) == sorted(f"u{i % 2} body {i}\n" for i in range(60))


def test_routes_of_a_batch_that_fails_and_runs_again(spark, folder):
    feed = catalog.mixed_feed(spark, SF).cache()
    src = write_in_order(feed, ["recv_ms"], f"{folder}/src", files=2)
    messages = lambda: router.tagged_messages(read_in_order(spark, src, feed.schema))

    def fails_after_writing(batch, number, path):
        router.route_batch(batch, number, path)
        if number == 1:
            raise RuntimeError("after the write")

    with pytest.raises(Exception, match="after the write"):
        router.route_stream(messages(), f"{folder}/out", f"{folder}/ckpt", fails_after_writing).awaitTermination()
    router.route_stream(messages(), f"{folder}/out", f"{folder}/ckpt").awaitTermination()
    frames, rejects = fr.decode_frames(feed.filter("NOT is_ping"))
    assert key(router.read_route(spark, f"{folder}/out", "strategy")) == key(fr.normalize_bars(fr.closed_bars(frames)))
    assert router.read_route(spark, f"{folder}/out", "alerts").count() == feed.filter("is_ping AND recv_ms IS NOT NULL").count()
    assert router.read_route(spark, f"{folder}/out", "log").count() == rejects.count()


def test_symbol_numbers_never_change(spark, folder):
    frame = lambda rows: spark.createDataFrame(rows, "symbol string, recv_ms bigint, frame_no int")
    path = f"{folder}/symbols"
    assert read_dictionary(spark, path).count() == 0
    first = grow_dictionary(frame([("B", 5, 0), ("A", 9, 0), ("A", 1, 1), (None, 0, 0)]), path)
    assert sorted(map(tuple, first.collect())) == [("A", 1), ("B", 2)]
    again = grow_dictionary(frame([("Z", 0, 0), ("A", 0, 0), ("C", 0, 0)]), path)
    assert sorted(map(tuple, again.collect())) == [("A", 1), ("B", 2), ("C", 3), ("Z", 4)]
    assert grow_dictionary(frame([("Z", 0, 0)]), path).count() == 4
    got = indexed(frame([("Z", 7, 0), ("?", 8, 0), (None, 9, 0)]), again).select("recv_ms", "symbol_index").collect()
    assert sorted(map(tuple, got)) == [(7, 4), (8, None), (9, None)]
