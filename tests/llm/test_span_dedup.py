import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voxloom.llm import catalog
from voxloom.llm.span_dedup import remove_repeats, sentences, spans, stream_repeats
from voxloom.llm.tables import documents


@settings(max_examples=200, deadline=None)
@given(st.text("ab .!?\n", max_size=60))
def test_sentences_partition_the_text(text):
    assert "".join(sentences(text)) == text


@pytest.mark.parametrize("text,n", [("A b. C d! E?", 3), ("v1.2 is out. Yes", 2), ("one\n\ntwo\nthree", 3), ("", 1), ("...", 1), ("a.", 1), ("No end", 1)])
def test_sentence_ends(text, n):
    assert len(sentences(text)) == n


def test_long_texts_split_fast():
    assert len(sentences("a" * 200_000)) == 1
    assert len(sentences("a. " * 50_000)) == 50_000
    assert len(list(spans("a b. " * 50_000, 2, 12))) > 40_000


def split(text):
    """Sentences once more, character by character; more than 48 words without an end are cut."""
    out, now, i = [], "", 0
    while i < len(text):
        j = i
        while j < len(text) and text[j] in ".!?":
            j += 1
        ends = text[i] == "\n" or (j > i and j < len(text) and text[j].isspace())
        j = max(j, i + 1)
        while ends and j < len(text) and text[j].isspace():
            j += 1
        now, i = now + text[i:j], j
        if ends:
            out.append(now)
            now = ""
    parts = []
    for s in [*out, now] if now or not out else out:
        words = re.findall(r"\S+\s*", s)
        if len(words) <= 48:
            parts.append(s)
            continue
        words[0] = re.match(r"\s*", s)[0] + words[0]
        now = []
        for w in words:
            now.append(w)
            if len(now) >= 6 and (len(now) >= 32 or zlib.crc32(w.strip().lower().encode()) % 8 == 0):
                parts.append("".join(now))
                now = []
        if now:
            parts.append("".join(now))
    return parts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["one ", "Two. ", "v1.2 ", "end!\n", "word " * 60, "why? ", "x\n\ny "]), max_size=8).map("".join))
def test_sentences_equal_a_plain_splitter(text):
    assert sentences(text) == split(text)


def test_sentences_of_prose_stay_whole():
    text = " ".join(f"w{k}" for k in range(48)) + ". " + " ".join(f"v{k}" for k in range(30)) + "."
    assert len(sentences(text)) == 2
    assert len(sentences("u " * 200)) > 2


def brute(rows, least_sentences, least_words):
    seen, places = {}, []
    for i, t in rows:
        s = split(t or "")
        words = [re.findall(r"\S+", x.lower()) for x in s]
        for a in range(len(s)):
            if not words[a]:
                continue
            for b in range(a + least_sentences, len(s) + 1):
                if sum(map(len, words[a:b])) >= least_words:
                    places.append((i, a, b))
                    seen.setdefault(tuple(w for part in words[a:b] for w in part), []).append((i, a))
                    break
    out = {}
    for i, t in rows:
        s, gone = split(t or ""), set()
        words = [re.findall(r"\S+", x.lower()) for x in s]
        for j, a, b in places:
            if j == i and min(seen[tuple(w for part in words[a:b] for w in part)]) != (i, a):
                gone |= set(range(a, b))
        out[i] = (sorted(gone), "".join(x for k, x in enumerate(s) if k not in gone))
    return out


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_equals_brute_force(spark, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    line = lambda n: " ".join(word() for _ in range(n)) + rng.choice([". ", "! ", "?\n", "\n"])
    passages = ["".join(line(rng.randint(3, 20)) for _ in range(5)) for _ in range(4)]
    rows = []
    for i in range(60):
        body = [line(rng.randint(1, 15)) for _ in range(rng.randint(0, 8))]
        if i % 2:
            body.insert(rng.randint(0, len(body)), rng.choice(passages).upper() if i % 5 == 0 else rng.choice(passages))
        if i % 7 == 0:
            body += body[:4]
        rows.append((i, "".join(body)))
    rows += [(100, None), (101, ""), (102, "x")]
    got = remove_repeats(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, at int"), 2, 12)
    assert {r.doc_id: (r["__span_removed"], r["__span_kept"]) for r in got.collect()} == brute(rows, 2, 12)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_stream_is_the_same_in_any_batches(size):
    rows = [(h, h, i, 0, a, 2) for h, n in ((1, 3), (2, 1), (3, 9), (4, 1), (5, 2)) for i in range(n) for a in (0, 0, 4)]
    names = ["h1", "h2", "id", "th", "at", "n"]
    parts = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[k : k + size]]) for k in range(0, len(rows), size)]
    out = [x for b in stream_repeats(iter(parts)) for x in b.to_pylist()]
    assert sorted((x["h1"], x["id"], x["at"]) for x in out if x["state"] == 1) == sorted((h, i, a) for h, _, i, _, a, _ in rows if (i, a) != (0, 0))
    assert [x["h1"] for x in out if x["state"] == 2] == [1, 5]


def test_a_hash_cut_by_partitions_has_one_first(spark):
    text = "a b c d e f g. h i j k l m n. "
    rows = [(i, text) for i in range(500)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect() if not r["__span_removed"]) == [0]


def test_shared_passage_stays_once_and_clean_text_stays(spark):
    passage = " ".join(f"p{k} q{k} r{k} s{k} t{k} u{k} v{k} w{k}." for k in range(8))
    rows = [(i, f"Own {i} text a{i}. {passage} More own {i} words b{i} c{i} d{i} e{i} f{i} g{i} h{i}.") for i in range(50)]
    kept = {r.doc_id: r["__span_kept"] for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept[0] == rows[0][1]
    assert all("p3 q3" not in kept[i] and f"h{i}." in kept[i] and f"a{i}." in kept[i] for i in range(1, 50))


def test_a_passage_without_full_stops_within_other_sentences(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join(word() for _ in range(rng.randint(3, 40))) + " " + passage + " " + " ".join(word() for _ in range(20))) for i in range(40)]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not got[0]["__span_removed"] and all(got[i]["__span_removed"] for i in range(1, 40))
    for i in range(1, 40):
        own = len(rows[i][1].split()) - 60
        assert own - 12 <= len(got[i]["__span_kept"].split()) <= own + 40


def test_repeated_rows_and_empty_table(spark):
    text = "a b c d e f g. h i j k l m n. "
    rows = [(1, text), (1, text), (None, text + "x")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, len(r["__span_removed"])) for r in got.collect()), key=repr) == [(1, 2), (1, 2), (None, 0)]
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    want = brute(sorted((r.doc_id, r.text) for r in documents(spark, d).collect()), 2, 12)
    rows = catalog.op9_span_dedup(spark, d).collect()
    assert {r.doc_id: (r.removed, r.kept_sha256) for r in rows} == {i: (g, hashlib.sha256(t.encode()).hexdigest()) for i, (g, t) in want.items()}
