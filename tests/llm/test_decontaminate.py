import random
import re
from collections import Counter

import numpy as np

from voxloom.llm import catalog
from voxloom.llm.decontaminate import RADIUS, Benchmark, find_leaks, lanes, occurrences, without_leaks
from voxloom.llm.tables import documents, table


def words_of(t):
    return re.findall(r"\w+", (t or "").lower())


def brute(text, items, threshold=0.8):
    """Every window of every item's size, by exact multiset similarity."""
    words, found = words_of(text), {}
    for name, item in items:
        own = words_of(item)
        if not own or not words:
            continue
        k = min(5, len(own))
        grams = lambda w: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))  # noqa: B023, E731
        b, best = grams(own), 0.0
        # A window without a shingle of the item has similarity 0.
        last = max(0, len(words) - len(own))
        hits = [i for i in range(len(words) - k + 1) if tuple(words[i : i + k]) in b]
        for s in sorted({min(max(0, s), last) for i in hits for s in range(i - len(own) + k, i + 1)}):
            a = grams(words[s : s + len(own)])
            both = sum((a & b).values())
            if both:
                best = max(best, both / (sum(a.values()) + sum(b.values()) - both))
        if best >= threshold:
            found[name] = round(best, 9)
    return found


def corpus(rng, n_items=30, n_docs=80):
    vocabulary = [f"{a}{b}" for a in ("ta", "re", "mo", "li", "ne", "su") for b in ("n", "r", "st", "ck", "", "ve", "lo")]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(8, 60)))) for i in range(n_items)] + [(100, "one two"), (101, ""), (102, None), (103, "a b c d e")]
    docs = []
    for d in range(n_docs):
        w = text(rng.randint(0, 120))
        if d % 2:
            part = items[rng.randrange(n_items)][1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                at = rng.randrange(len(part))
                part[at : at + 1] = rng.choice([[], ["zz"], [part[at], "yy"]])
            at = rng.randint(0, len(w))
            w = w[:at] + part + w[at:]
        docs.append((d, " ".join(w)))
    return docs + [(900, "One, TWO!"), (901, None), (902, ""), (903, "x a b c d e y"), (904, "a b c d")], items


def test_equals_brute_force(spark):
    docs, items = corpus(random.Random(4))
    got = find_leaks(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int"), spark.createDataFrame(items, "item_id long, text string"))
    rows = {r.id: {m.item: round(m.similarity, 9) for m in r.matches} for r in got.collect()}
    want = {i: brute(t, items) for i, t in docs}
    assert rows == want
    assert sum(map(bool, want.values())) > 15


def test_long_items_with_replaced_words_equal_brute_force():
    rng = random.Random(11)
    known = [f"k{i}" for i in range(400)]
    text = lambda n: [rng.choice(known) for _ in range(n)]
    found = 0
    for n, spots, run, by in [(50, 1, 1, None), (55, 1, 1, None), (59, 1, 1, None), (100, 2, 1, None), (200, 4, 1, None), (100, 1, 6, "zz"), (200, 1, 17, "zz"), (200, 1, 17, "k1")]:
        for case in range(12):
            item = text(n)
            changed = list(item)
            for k in range(spots):
                at = n * (k + 1) // (spots + 1) - run // 2
                changed[at : at + run] = [by or f"new{case}x{k}"] * run
            doc = " ".join(text(20) + changed + [f"u{case}x{k}" for k in range(20)])
            items = [("own", " ".join(item)), ("other", " ".join(text(n)))]
            want = brute(doc, items)
            assert {i: round(s, 9) for i, s, _ in Benchmark(items).matches([doc], 0.8)[0]} == want, (n, spots, run, by)
            found += bool(want)
    assert found == 96


def test_window_sums_are_those_of_each_window_alone():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 4, 60).astype(np.uint64)
    ending, beginning = occurrences(codes, 12)
    total = np.concatenate([np.zeros((1, 128), int), np.cumsum(lanes(codes, ending), 0)])
    gone = np.concatenate([np.zeros((1, 128), int), np.cumsum(lanes(codes, beginning), 0)])
    for s in range(49):
        alone = codes[s : s + 12]
        assert (total[s + 12] - gone[s] == lanes(alone, occurrences(alone, 12)[0]).sum(0)).all()


def test_slices_give_the_same(spark):
    docs, items = corpus(random.Random(5), 20, 40)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted((r.id, sorted(m.item for m in r.matches)) for r in find_leaks(d, b, max_bytes=n).collect()) for n in (10**9, 1500))
    assert one == many
    clean = {i for i, m in one if not m}
    assert {r.doc_id for r in without_leaks(d, b, max_bytes=1500).collect()} == clean == {r.doc_id for r in without_leaks(d, b).collect()}


def test_blocks_miss_no_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    bench = Benchmark([(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(300)])
    for _ in range(200):
        item = int(rng.integers(300))
        bits = np.unpackbits(bench.prints[item].view(np.uint8))
        bits[rng.choice(128, RADIUS, replace=False)] ^= 1
        query = np.packbits(bits).view(np.uint16)[None]
        assert any(item in k.tolist() for _, k in bench.within(query))


def test_repeated_rows_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "q")], "doc_id long, text string")
    b = spark.createDataFrame([("i", "a b c d e f g"), ("j", "a b c d e f g")], "item_id string, text string")
    assert sorted(len(r.matches) for r in find_leaks(d, b).collect()) == [0, 2, 2]
    assert [r.matches for r in find_leaks(d, b.limit(0)).collect()] == [[], [], []]
    assert find_leaks(d.limit(0), b).count() == 0


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    items = [(r.item_id, r.text) for r in table(spark, d, "benchmark").collect()]
    rows = {r.doc_id: r for r in catalog.op10_decontaminate(spark, d).collect()}
    texts = [(r.doc_id, r.text) for r in documents(spark, d).collect()]
    assert len(texts) == len(rows) == 1000
    for i, t in texts:
        want = brute(t, items)
        assert rows[i].item_ids == sorted(want) and rows[i].contaminated == bool(want), i
        assert rows[i].similarity == max(want.values(), default=0.0) or abs(rows[i].similarity - max(want.values())) < 1e-8


def test_very_long_texts(spark):
    item = " ".join(f"q{k}" for k in range(60))
    filler = " ".join(f"w{k % 5000}" for k in range(200_000))
    docs = spark.createDataFrame([(1, f"{filler} {item} {filler}"), (2, filler), (3, "y" * 1_000_000)], "doc_id long, text string")
    got = {r.id: [(m.item, round(m.similarity, 9), m.word) for m in r.matches] for r in find_leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert got == {1: [(7, 1.0, 200_000)], 2: [], 3: []}
