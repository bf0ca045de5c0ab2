import collections
import re

import numpy as np
import pytest

from tests.oracle import connect
from voxloom.llm import catalog
from voxloom.llm.quality import RULES, expectation_maximisation, features, quality_rules

SCHEMA = "doc_id long, text string, words string, n_words int, id string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " \t\n", "one", "a b c a b c", "a a a a a", "x\ny\nx\n\n \n x\nx", "é ü *# 漢字\x0bz\x0cq\rw", "the cat sat " * 400,
    "p q r s t u v w p q r z z z", "\n".join(["same line here"] * 20), "a b c d", "😀 😀 😀 😀",
]


def test_statistics_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "w", 1, "x") for i, t in enumerate(TEXTS)] + [(None, "a b", "w", 1, "x")], SCHEMA)
    rows = {r.id: r for r in features(docs).collect()}
    for i, t in enumerate(TEXTS):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), t
    assert rows[None].n_words == 2


def test_verdicts(spark):
    clean = " ".join(f"word{i} plain{i * 7 % 31}" for i in range(60))
    noisy = " ".join(f"word{i}*** plain{i * 7 % 31}###" for i in range(60))
    docs = spark.createDataFrame([(i, f"{clean} {i}") for i in range(40)] + [(100 + i, f"{noisy} {i}") for i in range(8)] + [(200, "few words")], "doc_id long, text string")
    rows = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert all(rows[i].kept for i in range(40))
    assert not any(rows[100 + i].kept for i in range(8))
    assert rows[200].base_failed and not rows[200].kept


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert quality_rules(docs).count() == 2
    assert quality_rules(docs.limit(0)).count() == 0


def test_em_prefers_rules_that_agree():
    votes = lambda bad: tuple(-1 if r.name in bad else 1 for r in RULES)
    good, bad = votes([]), votes(["symbols", "wordless"])
    model = expectation_maximisation([(good, 900), (bad, 100)])
    assert model.log_odds(good) > 2 > -2 > model.log_odds(bad)
    assert expectation_maximisation([]).good == pytest.approx(0.8)


def test_one_wrong_vote_is_outvoted_and_a_useless_rule_weighs_nothing():
    votes = lambda bad: tuple(-1 if r.name in bad else 1 for r in RULES)
    patterns = [(votes([]), 8000), (votes(["symbols", "letters"]), 300), (votes(["repeats", "distinct"]), 300), (votes(["short"]), 900), (votes(["dup_lines"]), 40)]
    model = expectation_maximisation(patterns)
    assert model.log_odds(votes(["short"])) > 0 and model.log_odds(votes(["dup_lines"])) > 0
    assert model.log_odds(votes(["symbols", "letters"])) < 0 and model.log_odds(votes(["repeats", "distinct"])) < 0
    at = [r.name for r in RULES].index("short")
    # Votes bad among good documents only, so both classes get one rate.
    assert model.bad_if_good[at] == model.bad_if_bad[at]


def brute_votes(text):
    """The rules once more, from their definitions."""
    text = text or ""
    words, word_chars, n_symbols, n_dup, n_repeat = brute(text)
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    letter = lambda c: c.isascii() and c.isalpha() or ord(c) >= 128
    lines = max(1, sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n")))
    w, c = max(1, words), max(1, word_chars)
    rows = [
        (-words, -200, -100), (abs(word_chars / w - 6), 2, 4), (n_symbols / w, 0.05, 0.1), (len(re.findall(r"[#*$%&|<>]{3,}", text)) / w, 0.01, 0.05),
        (-sum(map(letter, text)) / c, -0.9, -0.8), (sum(not any(map(letter, t)) for t in tokens) / w, 0.05, 0.2), (n_dup / lines, 0.1, 0.3),
        (n_repeat / w, 0.2, 0.4), (-len(set(tokens)) / w, -0.4, -0.25), (sum(x.isascii() and x.isupper() for x in text) / c, 0.1, 0.3), (text.count("!") / w, 0.1, 0.4),
    ]
    return [1 if x <= good else -1 if x > bad else 0 for x, good, bad in rows]


def brute_posterior(votes):
    """Expectation-maximisation over documents, not patterns, as arrays."""
    votes = np.array(votes)
    bad, cast = votes < 0, votes != 0
    pi, g, b = 0.8, np.full(votes.shape[1], 0.05), np.full(votes.shape[1], 0.3)
    odds = lambda: np.log(pi / (1 - pi)) + np.where(bad, np.log(g / b), np.where(cast, np.log((1 - g) / (1 - b)), 0)).sum(1)
    for _ in range(200):
        p = 1 / (1 + np.exp(-odds()))
        pi = (p.sum() + 8) / (len(p) + 10)
        by_good, by_bad = (p[:, None] * cast).sum(0), ((1 - p)[:, None] * cast).sum(0)
        g, b = ((p[:, None] * bad).sum(0) + 0.5) / (by_good + 10), (((1 - p)[:, None] * bad).sum(0) + 3) / (by_bad + 10)
        both = (bad.sum(0) + 1) / (cast.sum(0) + 2)
        g, b = np.where(g > b, both, g), np.where(g > b, both, b)
    return 1 / (1 + np.exp(-odds()))


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = connect(d).execute("SELECT d.doc_id, text, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id ORDER BY d.doc_id").fetchall()
    votes = [brute_votes(t) for _, t, _ in docs]
    posterior = brute_posterior(votes)
    rows = {r.doc_id: r for r in catalog.op8_quality_rules(spark, d).collect()}
    assert len(rows) == len(docs)
    outvoted = 0
    for (doc, text, label), v, p in zip(docs, votes, posterior, strict=True):
        r, stats = rows[doc], brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats
        assert r.base_failed == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert r.posterior == pytest.approx(p, abs=1e-6)
        assert r.kept == (not r.base_failed and p >= 0.5)
        if label is not None and not r.base_failed:
            assert r.kept == (label == 1)
        outvoted += r.kept and -1 in v
    assert outvoted > 50  # bad votes do not decide alone


def test_base_columns_equal_sql(spark):
    d = "/root/testdata/sf0.01"
    want = connect(d).execute(r"""
        WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                          list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents)
        SELECT doc_id, len(words)::BIGINT, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT, (len(lines) - len(list_distinct(lines)))::BIGINT FROM w""").fetchall()
    got = catalog.op8_quality_rules(spark, d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines").collect()
    assert sorted(map(tuple, got)) == sorted(want)
