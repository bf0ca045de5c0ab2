import random
import re

import numpy as np
import pytest

from tests.oracle import assert_same
from voxloom.llm import catalog, near_dedup
from voxloom.llm.components import connected_components
from voxloom.llm.near_dedup import BANDS, Centres, bands, keep_one, linked, near_duplicates, shingle_set
from voxloom.llm.storage import Scratch
from voxloom.llm.tables import documents


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, size, percent=80):
    """All pairs on exact shingle tuples, through an inverted index."""
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        k = min(size, len(w))
        sets.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()))
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    def union(a, b):
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)

    holders = {}
    for n, (i, s) in enumerate(sets):
        both = {}
        for g in s:
            for m in holders.setdefault(g, []):
                both[m] = both.get(m, 0) + 1
            holders[g].append(n)
        for m, k in both.items():
            if i is not None and sets[m][0] is not None and 100 * k >= percent * (len(s) + len(sets[m][1]) - k):
                union(i, sets[m][0])
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


def run(spark, rows, size=5):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, node int")
    got = near_duplicates(docs, size)
    return sorted(((r.id, r.n_shingles, r.component) for r in got.collect()), key=repr)


def family(rng, base, n, rate):
    out = []
    for _ in range(n):
        w = list(base)
        for k in range(len(w)):
            if rng.random() < rate:
                w[k] = f"z{rng.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("size", [4, 5])
def test_equals_brute_force(spark, size, monkeypatch):
    # Copies whose similarity straddles the threshold: stars alone miss links between them.
    monkeypatch.setattr(near_dedup, "CENTRE_BLOCK", 7)
    monkeypatch.setattr(near_dedup, "MEMBER_BLOCK", 20)
    monkeypatch.setattr(near_dedup, "STAR_PART", 10)
    rng = random.Random(size)
    texts = []
    for f in range(6):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([6, 12, 40, 150]))]
        texts += family(rng, base, 25, rng.choice([0.01, 0.02, 0.03]))
    texts += [" ".join(f"q{rng.randint(0, 30)}" for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts += ["a b c", "A  b\nc", "a b c d", "", None, " \t", "x", "x", "é É", "word " * 3000] + ["same text in many rows here"] * 30
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert run(spark, rows, size) == brute(rows, size)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f g"), (1, "q r s t u v w"), (2, "q r s t u v w"), (3, "a b c d e f g"), (None, "a b c d e f g"), (4, None), (5, "")]
    assert run(spark, rows) == brute(rows, 5)
    kept = {(r.id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {(1, True), (2, False), (3, False), (None, True), (4, True), (5, True)}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_every_bin_is_filled_and_similar_sets_share_bands():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 50, 5000):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        assert len(bands(base)) == BANDS
        miss = 0
        for _ in range(100):
            other = np.unique(np.concatenate([base[: max(1, int(0.9 * n))], rng.integers(0, 2**63, n // 10).astype(np.uint64)]))
            both = len(np.intersect1d(base, other))
            if both / (len(base) + len(other) - both) >= 0.8:
                miss += not set(bands(base).tolist()) & set(bands(other).tolist())
        assert miss == 0


def test_block_index_equals_pairs():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(80)]
    centres = Centres(list(range(40)), [None] * 40, sets[:40])
    for b in sets[40:]:
        assert centres.links(None, b, 50) == [k for k in range(40) if linked(sets[k], b, 50)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000), (7, 3)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    assert {(r.node, r.component) for r in got.collect()} == {(i, 0) for i in range(301)} | {(1000 + i, 1000) for i in range(400)}
    assert got.count() == 701


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in documents(spark, d).collect()]
    got = catalog.op5_near_dedup(spark, d)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute(rows, 4))


def test_hash_set():
    assert len(shingle_set(b"a b c d", 4, {})) == 1 and len(shingle_set(b"a b", 4, {})) == 1 and len(shingle_set(b" ", 4, {})) == 0


def test_keep_one_with_a_clashing_column(spark):
    rows = [(i, "same words in all of these texts", i) for i in range(4)]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string, __near_id long"))
    assert [(r.doc_id, r["__near_id"]) for r in kept.collect()] == [(0, 0)]


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    assert assert_same(catalog.op5_near_dedup(spark, d), catalog.ORACLES["op5_near_dedup"], d) > 0
