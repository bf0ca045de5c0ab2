import bisect
import random

import numpy as np
import pytest

from voxloom.llm import catalog
from voxloom.llm.packing import best_fit, pack_documents, sequences, unpack, write_packed
from voxloom.llm.tables import documents

VOCABULARY = catalog.byte_vocabulary()


def plain_best_fit(lengths, length):
    """Number of rows by best fit over a sorted list."""
    free, rows = [], 0
    for n in lengths:
        k = bisect.bisect_left(free, n)
        if k == len(free):
            rows += 1
            rest = length - n
        else:
            rest = free.pop(k) - n
        if rest:
            bisect.insort(free, rest)
    return rows


@pytest.mark.parametrize("length", [1, 7, 64, 100, 2048])
def test_packing_is_best_fit_decreasing(length):
    rng = random.Random(length)
    lengths = sorted((rng.randint(1, length) for _ in range(2000)), reverse=True)
    rows = best_fit(lengths, length)
    assert sorted(k for r in rows for k in r) == list(range(2000))
    assert all(sum(lengths[k] for k in r) <= length for r in rows)
    assert len(rows) == plain_best_fit(lengths, length)


def texts_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r.id, []).append((r.piece, bytes(r.data)))
    return {i: b"".join(d for _, d in sorted(p)).decode() for i, p in out.items()}


def test_round_trip_and_matrices(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "hello world " * 300, 9), (2, None, 9), (3, "", 9), (4, "<|endoftext|> é 漢字😀\n", 9), (5, "x" * 3000, 9), (6, "short", 9), (None, "none", 9)], "doc_id long, text string, ids int"
    )
    blocks = pack_documents(docs, VOCABULARY, length=64, shard_bytes=2000)
    write_packed(blocks, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert texts_of(unpack(back, VOCABULARY).collect()) == {1: "hello world " * 300, 4: "<|endoftext|> é 漢字😀\n", 5: "x" * 3000, 6: "short", None: "none"}
    encode = VOCABULARY.encoding().encode_ordinary
    total = 0
    for r in sequences(back).collect():
        ids, positions = np.frombuffer(r.ids, "<i4"), np.frombuffer(r.positions, "<i4")
        assert len(ids) == len(positions) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64
        for a, b, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.segments):
            assert b - a == s.n and positions[a:b].tolist() == list(range(s.n))
        assert not ids[r.n_tokens :].any()
        total += r.n_tokens
    assert total == sum(len(encode(t)) for t in ("hello world " * 300, "<|endoftext|> é 漢字😀\n", "x" * 3000, "short", "none"))


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 50, "doc_id long, text string")
    assert sum(len(r.segments) for r in sequences(pack_documents(docs, VOCABULARY, 16)).collect()) == 50
    assert pack_documents(docs.limit(0), VOCABULARY).count() == 0


def test_query_packs_every_document_tightly(spark):
    d = "/root/testdata/sf0.01"
    rows = catalog.op6_packing(spark, d).collect()
    texts = {r.doc_id: r.text for r in documents(spark, d).collect()}
    encode = VOCABULARY.encoding().encode_ordinary
    want = {(i, k // 2048): min(2048, n - k) for i, t in texts.items() if (n := len(encode(t))) for k in range(0, n, 2048)}
    got = {(i, p): b - a for r in rows for i, p, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:])}
    assert got == want and sum(len(r.doc_ids) for r in rows) == len(want)
    assert len(rows) < 1.02 * sum(want.values()) / 2048 + 2


def test_rows_are_the_same_in_any_layout(spark):
    docs = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text")
    of = lambda n: sorted((r.shard, r.row, bytes(r.ids), tuple(r.cu_seqlens)) for r in sequences(pack_documents(docs.repartition(n), VOCABULARY, shard_bytes=50_000)).collect())
    assert of(1) == of(8)
