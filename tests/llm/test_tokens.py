"""Encoding, packing and token files against the tokenizers library on whole texts."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickwise.llm import encode, packing, queries, token_files

SF = "/root/testdata/sf0.001"
BYTE, WORD = queries.vocabulary_path("byte_bpe_50k.json"), queries.vocabulary_path("word_bpe_49k.json")

ODD = [
    "", " ", "\n", "  ", " a", "a ", "a  b", "a   b c", "a \n b", "a\n\nb\n", "\n\na", "it's we'll ''s 'Tis", "x  y z  w",
    "é ́a ́", "\x1c \x1d a\x85b", "İΣ Σς ﬁ", "<|endoftext|> <|startoftext|>", "1234 5 67\t\t8 \t9",
    "tab\tand\r\nline \r\n end  x", "\U0001f600 \U0001f468‍\U0001f469 ok", "a" * 5000, "no_space" * 400 + " \n\n \n x", "### $$$ !!\n | a |",
    "a <|endoftext|> b", "x<|ENDOFTEXT|>,", "<|startoftext|>", "null \x00 byte", "word's, 'quoted' a!! b,.c d_e. ...", "ÀÉ, ça!!! Straße. ŒUVRE, Ωmega.",
]


def whole(path, text):
    tok = Tokenizer.from_file(path)
    return [e.ids for e in tok.encode_batch(text, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path,style", [(BYTE, "byte"), (WORD, "word")])
def test_chunks_give_the_ids_of_whole_texts(path, style, spark):
    texts = ODD + [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += [a + b for a in ODD[:20] for b in ODD[:20]]
    ids, ends = encode.Encoder(path, style).encode(texts)
    for text, a, b, want in zip(texts, ends, ends[1:], whole(path, texts)):
        assert ids[a:b].tolist() == want, repr(text[:80])


def slow_pieces(rows, path, end_id, capacity):
    out = []
    for (doc, text), ids in zip(rows, whole(path, [t or "" for _, t in rows])):
        ids = [*ids, end_id]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc, n, at, len(part), crc(part)))
    return sorted(out, key=str)


def check_packing(rows, want, capacity):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_pack_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = slow_pieces(docs, WORD, 1, 4096)
    bins = check_packing(queries.op4_pack(spark, SF).collect(), want, 4096)
    assert bins <= -(-sum(x[3] for x in want) // 4096) + 1


def test_pack_odd_rows(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 2)
    rows = [(None, "a b c"), (1, None), (1, ""), (2, "dog " * 100), (2, "dog " * 100), (3, "x y"), (None, None)] + [(i, "same words here") for i in range(9, 40)]
    got = packing.pack(make_docs(rows), WORD, capacity=16)
    check_packing(got.collect(), slow_pieces(rows, WORD, 1, 16), 16)
    assert packing.pack(make_docs([]), WORD).count() == 0


def test_sequences_hold_the_ids(make_docs):
    rows = [(i, "the cat sat " * (i % 7)) for i in range(40)]
    out = packing.sequences(make_docs(rows), WORD, capacity=32).collect()
    assert all(len(r.ids) <= 32 for r in out)
    assert sorted(i for r in out for i in r.ids) == sorted(i for x in whole(WORD, [t for _, t in rows]) for i in [*x, 1])


def test_fullest_and_plan_against_enumeration():
    import itertools
    import random

    rng = random.Random(5)
    for _ in range(60):
        items = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        counts = {x: items.count(x) for x in items}
        slack = rng.randint(0, 40)
        best = max(s for n in range(len(items) + 1) for c in itertools.combinations(items, n) if (s := sum(c)) <= slack)
        found = packing.fullest(slack, counts)
        assert sum(x * n for x, n in found.items()) == best and all(n <= counts[x] for x, n in found.items())
        used = {}
        for times, bin_ in packing.plan(counts, 20):
            assert sum(x * n for x, n in bin_.items()) <= 20
            for x, n in bin_.items():
                used[x] = used.get(x, 0) + n * times
        assert used == counts


def slow_documents(rows, path, end_id):
    out, start = [], 0
    for doc, text in rows:
        ids = [*whole(path, [text or ""])[0], end_id]
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_token_files_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted(tuple(r) for r in queries.op10_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == slow_documents(docs, BYTE, 0)


def test_token_files_odd_rows(make_docs):
    rows = [(None, None), (1, ""), (2, "b c"), (2, "b c"), (5, "long text " * 9000), (7, None)]
    got = sorted(map(tuple, token_files.write_and_read(make_docs(rows[::-1]), BYTE, 50257, block_ids=64).collect()), key=lambda r: r[1])
    assert got == slow_documents(rows, BYTE, 0)
    assert token_files.write_and_read(make_docs([]), BYTE, 50257).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 32])
def test_bits_round_trip_and_random_access(tmp_path, bits):
    rng = np.random.default_rng(bits)
    docs = [rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32) for n in (0, 5, 300, 1, 64, 0, 129)]
    writer = token_files.ShardWriter(f"file://{tmp_path}", "x.tkb", bits, 64)
    for n, ids in enumerate(docs):
        writer.add(n, ids)
    writer.close()
    shard = token_files.Shard(writer.uri)
    assert [shard.document(n).tolist() for n in range(len(docs))] == [d.tolist() for d in docs]
    assert list(shard.document_crcs()) == [crc(d) for d in docs]
    every = np.concatenate(docs)
    assert shard.ids(3, 401).tolist() == every[3:401].tolist()
    assert token_files.bits_for(50257) == 16 and token_files.bits_for(2) == 1


def test_extra_columns(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, "c")]).withColumn("uid", F.lit(1)).withColumn("length", F.lit(2)).withColumn("id", F.lit(3))
    assert packing.pack(docs, WORD).count() == 2
    assert token_files.write_and_read(docs, BYTE, 50257).count() == 2
