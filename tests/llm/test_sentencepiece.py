import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from voxloom.llm import catalog, sentencepiece_stream
from voxloom.llm.sentencepiece_stream import Lattice, StreamingEncoder, Vocabulary, decode_documents, encode_documents
from voxloom.llm.tables import documents

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=catalog.PIECE_MODEL)
VOCABULARY = Vocabulary.load(catalog.PIECE_MODEL)
LATTICE = Lattice(VOCABULARY)


def encoded(text):
    return np.frombuffer(LATTICE.encode(text), "<i4").tolist()


EDGES = ["", " ", "   ", "\n", "a\nb", "  a  b ", "hello world", "漢字😀", "\x00", "<s>", "é", "a\r\nb\t", "▁x", "x" * 400, "ab" * 3000, "the " * 100, "!!!???", "ſß", "1234567890" * 20, "🏴󠁧󠁢󠁥󠁮󠁧󠁿"]


@pytest.mark.parametrize("text", EDGES)
def test_ids_and_text_equal_the_library(text):
    ids = LIBRARY.encode(text)
    assert encoded(text) == ids
    assert LATTICE.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("abc det ▁\n.é", max_size=120))
def test_random_texts_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoded(text) == LIBRARY.encode(text)
    if "▁" not in text and "�" not in text:
        assert LATTICE.decode(encoded(text)) == text


def test_streaming_in_parts_is_the_same_and_bounded():
    rng = random.Random(3)
    text = "".join(rng.choice(["tion", "the", "er", "a", "re", "ing", "é", "x", " ", "漢", "ab"]) for _ in range(6000))
    for joined in (text, text.replace(" ", "")):
        stream, out, most, at = StreamingEncoder(LATTICE), [], 0, 0
        while at < len(joined):
            n = rng.randint(1, 40)
            out += stream.feed(joined[at : at + n])
            most = max(most, stream.held)
            at += n
        out += stream.finish()
        assert out == LIBRARY.encode(joined)
        assert most <= 8 * LATTICE.longest


def test_ordinary_documents_commit_as_they_are_read(spark):
    texts = [r.text for r in documents(spark, "/root/testdata/sf0.01").collect() if r.text]
    early = total = 0
    for text in texts:
        stream, out, most = StreamingEncoder(LATTICE), [], 0
        for word in text.split(" "):
            out += stream.feed(word + " ")
            most = max(most, stream.held)
        early += len(out)
        total += len(out) + len(stream.finish())
        # At a space, what is undecided is the spaces and what a line's other end leaves.
        assert most <= LATTICE.longest, text
    assert early > 0.99 * total


def test_commits_come_from_the_search_not_from_the_memory(monkeypatch):
    """The same documents without any remembered step, and with the paths' meeting counted."""
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(4, 9))) for _ in range(700))
    fresh = Lattice(VOCABULARY)
    search, meetings = fresh._search, []

    def counted(state, part):
        ids, after = search(state, part)
        meetings.append(bool(ids))
        return ids, after

    monkeypatch.setattr(fresh, "_search", counted)
    first = fresh.encode(text)
    assert sum(meetings) > 600  # boundaries at which all paths met, in one pass over the text
    assert np.frombuffer(first, "<i4").tolist() == LIBRARY.encode(text)
    done = len(meetings)
    assert fresh.encode(text) == first and len(meetings) == done  # now by remembered steps alone


def test_memory_of_steps_is_bounded(monkeypatch):
    monkeypatch.setattr(sentencepiece_stream, "MEMO", 50)
    monkeypatch.setattr(sentencepiece_stream, "COMPARED", 100)
    small = Lattice(VOCABULARY)
    rng = random.Random(9)
    for _ in range(60):
        text = " ".join("".join(rng.choice("abcdefgh  \n.") for _ in range(9)) for _ in range(20))
        assert np.frombuffer(small.encode(text), "<i4").tolist() == LIBRARY.encode(text)
        assert sum(len(s.young) + len(s.old) for s in small.states.values()) <= 102


def test_documents_equal_the_library(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in documents(spark, d).collect()}
    rows = catalog.op2_sentencepiece(spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == LIBRARY.encode(texts[r.doc_id]) and r.round_trip and r.n_tokens == len(r.ids)


def test_nulls_extra_columns_and_decoding(spark):
    docs = spark.createDataFrame([(1, None, 3), (None, "", 3), (2, "a b", 3), (2, "a b", 3), (3, "▁", 3)], "doc_id long, text string, ids int")
    coded = encode_documents(docs, VOCABULARY)
    rows = {(r.id, r.n_tokens): r for r in coded.collect()}
    assert rows[(1, 0)].ids == [] and rows[(None, 0)].round_trip and not [r for r in rows.values() if r.id == 3][0].round_trip
    assert sorted((r.id or 0, r.text) for r in decode_documents(coded, VOCABULARY).collect()) == [(0, ""), (1, ""), (2, "a b"), (2, "a b"), (3, " ")]
    assert encode_documents(docs.limit(0), VOCABULARY).count() == 0
