import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from voxloom.llm import catalog, lm_score
from voxloom.llm.gru import RecurrentModel
from voxloom.llm.lm_score import language_scores
from voxloom.llm.tables import documents


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + ["\n"]


def base(rows, learned):
    c = Counter(w for (i, t), y in zip(rows, learned) if y for w in words_of(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = words_of(t)
        out.append((len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
    return out


def small_model(seed=3):
    rng = np.random.default_rng(seed)
    m = RecurrentModel(rng.integers(1, 50, 150).astype(float), 40.0, seed)
    m.p = {k: v.astype(np.float64) + (0.2 * rng.standard_normal(v.shape) if k != "word_b" else 0) for k, v in m.p.items()}
    return m, rng


def test_gradients_are_those_of_the_loss():
    m, rng = small_model()
    given, target = rng.integers(0, 152, (5, 4)), rng.integers(0, 151, (5, 4))
    given[2, 1] = m.start
    live, h = rng.random((5, 4)) < 0.8, rng.standard_normal((4, 24)) * 0.3
    g, _, _ = m.window_gradients(given, target, live, h)
    for k in m.p:
        flat, at = m.p[k].reshape(-1), int(np.abs(g[k].reshape(-1)).argmax())
        old = flat[at]
        ends = []
        for step in (1e-5, -1e-5):
            flat[at] = old + step
            ends.append(m.window_gradients(given, target, live, h)[2])
        flat[at] = old
        assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(g[k].reshape(-1)[at], rel=2e-3, abs=1e-6), k


def test_probabilities_sum_to_one():
    m, rng = small_model()
    h = rng.standard_normal((1, 24))
    p = np.exp(m.log_probabilities(np.repeat(h, 151, 0), np.arange(151)))
    assert p.sum() == pytest.approx(1, abs=1e-5)


def test_score_of_lanes_is_that_of_single_texts():
    m, rng = small_model()
    texts = [rng.integers(0, 151, n).astype(np.int32) for n in (1, 3, 70, 16, 17, 200, 5, 5)]
    want = []
    for t in texts:
        h, total = np.zeros((1, 24)), 0.0
        for k, w in enumerate(t):
            x = m.p["embed"][[t[k - 1] if k else m.start]] @ m.p["input"] + m.p["gate_b"]
            h = m._step(x, h)[0]
            total += m.log_probabilities(h, np.array([w]))[0]
        want.append(total)
    for lanes in (1, 3, 100):
        assert m.score(texts, lanes) == pytest.approx(want, rel=1e-4)


def test_training_learns_a_sequence():
    counts = np.array([100.0] * 10)
    m = RecurrentModel(counts, 1.0)
    texts = [(np.arange(60) + k).astype(np.int32) % 10 for k in range(200)]
    before = m.score(texts).sum()
    for _ in range(4):
        m.fit(texts, rate=0.02)
    assert m.score(texts).sum() > 0.5 * before


def test_every_word_gives_a_gradient():
    m, learned = RecurrentModel(np.full(10, 100.0), 1.0), []
    output = m._output
    m._output = lambda flat, aim, weight, g: (learned.append(int((weight > 0).sum())), output(flat, aim, weight, g))[1]
    texts = [np.arange(n).astype(np.int32) % 10 for n in (900, 5, 16, 40, 3, 70, 0, 33)]
    assert m.fit(texts) == sum(learned) == sum(map(len, texts))


def test_gathered_windows_have_the_gradients_of_their_sum():
    m, rng = small_model()
    windows, alone, h = [], [], rng.standard_normal((4, 24)) * 0.3
    for lanes in (4, 2):
        given, target, live = rng.integers(0, 152, (5, lanes)), rng.integers(0, 151, (5, lanes)), np.ones((5, lanes), bool)
        cache, states, last = m._forward(given, h[:lanes])
        windows.append((given, target, live, cache, states))
        alone.append((m.window_gradients(given, target, live, h[:lanes])[0], 5 * lanes))
        h = last
    both, _ = m.gradients(windows, 30)
    for k, x in both.items():
        assert x == pytest.approx(sum(g[k] * n for g, n in alone) / 30, abs=1e-6), k


def test_one_long_text_does_not_outweigh_the_others():
    rng = np.random.default_rng(0)
    texts = [(np.arange(60) + k).astype(np.int32) % 10 for k in range(2000)]
    m = RecurrentModel(np.full(20, 100.0), 1.0)
    before = m.score(texts[:50]).sum()
    m.fit([*texts, rng.integers(10, 20, 20_000).astype(np.int32)])
    assert m.score(texts[:50]).sum() > 0.025 * before


ROWS = [(i, " ".join(("der die das und" if i % 2 else "the of and to").split()[(i * k) % 4] + ("" if k % 5 else f"x{i * k}") for k in range(40))) for i in range(120)] + [
    (900, None), (901, ""), (902, "ÄÖ ÄÖ"), (903, "unseen words only"), (None, "The END\n"),
]


@pytest.mark.parametrize("head,known", [(20, 8), (100_000, 4096), (20, 64)])
def test_base_equals_brute_force(spark, head, known):
    learned = [i is not None and i % 5 != 1 and i < 900 for i, _ in ROWS]
    docs = spark.createDataFrame([(*r, 5) for r in ROWS], "doc_id long, text string, score int").repartition(3)
    got = language_scores(docs, (catalog.F.col("doc_id") % 5 != 1) & (catalog.F.col("doc_id") < 900), head=head, known=known)
    rows = {r.id: r for r in got.collect()}
    assert len(rows) == len(ROWS)
    for (i, t), y, want in zip(ROWS, learned, base(ROWS, learned)):
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and r.in_training == y
        assert r.base_score == pytest.approx(want[3], rel=1e-9)
        assert r.score < 0


def test_no_training_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    rows = language_scores(docs, catalog.F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9), round(r.score, 9)) for r in rows] == [(3, 0, 0, 0.0, 0.0)] * 2
    assert language_scores(docs.limit(0), catalog.F.lit(True)).count() == 0


def test_query_beats_the_base_on_held_out_texts(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in catalog.op4_lm_score(spark, d).collect()}
    rows = [(r.doc_id, r.text) for r in documents(spark, d).collect()]
    learned = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    for (i, _), y, want in zip(rows, learned, base(rows, learned)):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and r.held_out == (not y)
        assert r.base_score == pytest.approx(want[3], rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_the_layout_does_not_change_the_model(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "REPLICA_WORDS", 20_000)  # several replicas a round
    docs = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text")
    learned = catalog.fold(catalog.F.col("doc_id")) != 1
    one, eight = ({r.id: r for r in language_scores(docs.repartition(n), learned).collect()} for n in (1, 8))
    for k, r in one.items():
        assert r.score == pytest.approx(eight[k].score, rel=1e-3)
        assert r.base_score == pytest.approx(eight[k].base_score, rel=1e-9)
    held = [r for r in one.values() if not r.in_training]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_long_texts(spark):
    long = "le chat noir " * 10_000
    docs = spark.createDataFrame([(1, long), (2, "le chat noir"), (3, "x" * 300_000), (4, long)], "doc_id long, text string")
    rows = {r.id: r for r in language_scores(docs, catalog.F.col("doc_id") < 4).collect()}
    assert rows[1].n_tokens == 30_001 and rows[4].n_known == 30_001 and rows[3].n_tokens == 2
    assert rows[4].score == pytest.approx(rows[1].score, rel=1e-4) and rows[4].score > rows[4].base_score


def test_words_and_their_numbers_are_those_of_plain_python():
    rows = [b"", b" ", b" The  the\n", b"A\x0bB\x0cC\x1cD\x85E\x00F", b"\xff\xfe \xc3 x", "ÄÖ \xa0 The".encode(), b"the"]
    data = pa.array([b"unseen", *rows], pa.binary()).slice(1)
    words, begins = lm_score.words_of(data)
    plain = [r.lower().split() for r in rows]
    assert [words[a:b].to_pylist() for a, b in zip(begins, begins[1:])] == plain
    for head in ([b"the", b"\n", b"x"], [b"x"], [b"\xff\xfe", b"the"]):
        numbers, begins = lm_score.numbered(words, begins if len(words) == begins[-1] else lm_score.words_of(data)[1], pa.array(head, pa.binary()))
        assert [numbers[a:b].tolist() for a, b in zip(begins, begins[1:])] == [[head.index(w) if w in head else len(head) for w in [*p, b"\n"]] for p in plain]


def test_states_lie_feature_by_feature():
    m, rng = small_model()
    given = rng.integers(0, 152, (5, 4))
    cache, states, last = m._forward(given, np.zeros((4, 24), order="F"))
    assert states.flags.c_contiguous  # rows for the output layer
    assert last.flags.f_contiguous and all(x.flags.f_contiguous for step in cache for x in (step[1], step[4]))
