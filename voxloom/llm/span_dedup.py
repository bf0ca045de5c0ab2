"""Substring dedup by sliding spans of sentences.

A sentence ends after ``.``, ``!`` or ``?`` before white space, or at a line's end, and is
removed whole.  Only a run of more than LONG words without any such end, which is no
sentence of prose, is cut: after words that their own hash chooses, so a passage without
full stops has the same parts wherever it occurs.  A span is the shortest run of consecutive sentences, at least ``least_sentences`` of them,
with ``least_words`` words or more; one starts at each sentence that has such a run.
Spans are hashed over their lower-cased words.  All spans meet in one global join on
the hash, carried out as a merge: they are range-partitioned by hash, document and
position, sorted within partitions, and streamed, so that each row is held against the
first row of its hash.  Sentences that any other span of the hash covers are removed.

A span that a third of all documents share spans as many partitions as its rows need.
Each task reports the first rows of its first and last hash; these few, two for each
partition, tell which of them is the first in the corpus.  Texts move once, to meet the
sentences to remove.

Cases: null and empty texts have one empty sentence and no spans.  A text's own repeats
count.  Rows that share an id are ordered by their text's hash; equal rows, which are
the same document again, count as one occurrence and get equal results.  Null ids come
first.  An empty table gives no rows.  Other columns pass through, working columns start
with ``__span_``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import Scratch
from .worker import keep

#: Everything up to an end of sentence with the white space after it, or the rest.
SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?!\s)[^.!?\n]*)*(?:[.!?]+\s+|\n\s*|[.!?]*$)")
WORD = re.compile(r"\S+")
PLACED = re.compile(r"(\S+)\s*")
#: Words of a sentence that stays whole, and of the parts of a longer run without an end.
LONG, LEAST_PART, MOST_PART = 48, 6, 32
#: What a streamed row says: its sentences go, or it leads a hash at a partition's edge.
REPEAT, LEAD = 1, 2


def _cut(sentence: str) -> list[str]:
    """A long sentence in parts of LEAST_PART words or more that end at chosen words."""
    parts, begin, n = [], 0, 0
    for m in PLACED.finditer(sentence):
        n += 1
        if n >= LEAST_PART and (n >= MOST_PART or zlib.crc32(m[1].lower().encode("utf-8", "replace")) % 8 == 0):
            parts.append(sentence[begin : m.end()])
            begin, n = m.end(), 0
    if begin < len(sentence) or not parts:
        parts.append(sentence[begin:])
    return parts


def sentences(text: str) -> list[str]:
    """Parts of a text, which joined are the text again."""
    out: list[str] = []
    for s in SENTENCE.findall(text):
        if len(s) > 2 * LONG and len(s.split()) > LONG:
            out += _cut(s)
        elif s:
            out.append(s)
    return out or [""]


def spans(text: str, least_sentences: int, least_words: int) -> Iterator[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, digest) of each span."""
    words = [WORD.findall(s.lower()) for s in sentences(text)]
    counts = [len(w) for w in words]
    end, total = 0, 0
    for start in range(len(words)):
        while end < len(words) and (end - start < least_sentences or total < least_words):
            total += counts[end]
            end += 1
        if end - start < least_sentences or total < least_words:
            return
        if counts[start]:  # a span starts with a sentence that has words
            yield start, end - start, xxhash.xxh3_128_digest(" ".join(w for part in words[start:end] for w in part).encode("utf-8", "replace"))
        total -= counts[start]


def span_rows(docs: DataFrame, least_sentences: int, least_words: int, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2, id, th, at, n): the spans of each text; th is the text's hash."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep("spans", "", dict)
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                batch = whole.slice(begin, 500)
                row, at, n, digests = [], [], [], []
                for r, text in enumerate(batch.column(2).to_pylist()):
                    for start, many, digest in spans(text, least_sentences, least_words):
                        row.append(r)
                        at.append(start)
                        n.append(many)
                        digests.append(digest)
                h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                index = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), batch.column(0).take(index), batch.column(1).take(index), pa.array(at, pa.int32()), pa.array(n, pa.int32())],
                    names=["h1", "h2", "id", "th", "at", "n"],
                )

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text")).mapInArrow(run, f"h1 long, h2 long, id {kind}, th long, at int, n int")


def stream_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition's spans in order: rows that repeat an earlier one of their hash, and the
    first rows of the partition's first and last hash."""

    def marked(batch: pa.RecordBatch, rows: np.ndarray, state: int) -> pa.RecordBatch:
        part = batch.take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(rows), state, np.int32))], names=[*batch.schema.names, "state"])

    lead: pa.RecordBatch | None = None  # the first row of the hash that the stream is in
    leads = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        # The lead goes before the batch, so that a hash over several batches has its first row at hand.
        whole = batch if lead is None else pa.Table.from_batches([lead, batch]).combine_chunks().to_batches()[0]
        h1, h2, th, at = (whole.column(c).to_numpy() for c in ("h1", "h2", "th", "at"))
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        ids = whole.column("id")
        codes = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        # A row equal to its first is the same document again.
        other = (th != th[first]) | (at != at[first]) | (codes != codes[first])
        if lead is None:
            yield marked(whole, np.array([0]), LEAD)
            leads = 1
        repeats = np.flatnonzero(~new & other)
        if len(repeats):
            yield marked(whole, repeats, REPEAT)
        start = int(first[-1])
        leads += start > 0
        lead = whole.slice(start, 1)
    if lead is not None and leads > 1:
        yield marked(lead, np.array([0]), LEAD)


def repeated_sentences(
    docs: DataFrame, least_sentences: int = 2, least_words: int = 12, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, th, at): numbers of the sentences to remove, in order, of each text that has some."""
    scratch = Scratch(docs.sparkSession, "spans")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = span_rows(docs, least_sentences, least_words, id_col, text_col)
    ordered = rows.repartitionByRange("h1", "h2", "id", "th", "at").sortWithinPartitions("h1", "h2", "id", "th", "at")
    marks = scratch.save(ordered.mapInArrow(stream_repeats, f"h1 long, h2 long, id {kind}, th long, at int, n int, state int"))
    place = F.struct("id", "th", "at")
    leads = marks.where(F.col("state") == LEAD)
    firsts = leads.groupBy("h1", "h2").agg(F.min(place).alias("first"))  # two for each partition at most
    later = leads.join(F.broadcast(firsts), ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    both = marks.where(F.col("state") == REPEAT).select("id", "th", "at", "n").unionAll(later.select("id", "th", "at", "n"))
    # A document's own sentences.
    runs = both.groupBy("id", "th").agg(F.collect_list(F.struct("at", "n")).alias("runs"))
    return runs.select("id", "th", F.expr("sort_array(array_distinct(flatten(transform(runs, r -> sequence(r.at, r.at + r.n - 1)))))").alias("at"))


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, at: pd.Series) -> pd.Series:
    def cut(t: str | None, drop: np.ndarray | None) -> str | None:
        if t is None or drop is None:
            return None
        gone = set(drop.tolist())
        return "".join(s for k, s in enumerate(sentences(t)) if k not in gone)

    return pd.Series([cut(t, d) for t, d in zip(text, at, strict=True)], dtype=object)


def remove_repeats(
    docs: DataFrame, least_sentences: int = 2, least_words: int = 12, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``__span_removed`` (sentence numbers) and ``__span_kept`` (the text that stays)."""
    marks = repeated_sentences(docs, least_sentences, least_words, id_col, text_col)
    marks = marks.select(F.col("id").alias("__span_id"), F.col("th").alias("__span_th"), F.col("at").alias("__span_at"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined = docs.withColumn("__span_hash", F.xxhash64(text)).join(
        marks, F.col(id_col).eqNullSafe(F.col("__span_id")) & (F.col("__span_hash") == F.col("__span_th")), "left"
    )
    changed = F.col("__span_at").isNotNull()
    return joined.withColumns(
        {
            "__span_removed": F.coalesce("__span_at", F.array().cast("array<int>")),
            "__span_kept": F.when(changed, _without(F.when(changed, text), "__span_at")).otherwise(text),
        }
    ).drop("__span_id", "__span_th", "__span_hash", "__span_at")
