"""Language-model scores of whole texts by a gated recurrent network.

1. Word counts of all training texts: counted within batches, summed by a shuffle.
2. The head: as many of the most frequent words as ``head`` allows, found from a
   histogram of counts, is the bounded table that tasks hold.  Its first ``known``
   words, and one token for any other word, are the network's vocabulary.
3. Training: texts are dealt to rounds and replicas by a hash of id and text.  In each of
   ``rounds`` rounds every replica takes the common weights over its texts, state carried
   through every window, and returns its weights; their mean by words, summed in a tree
   whose fan-in is bounded, is what the next round starts from.  All rounds together are
   one pass over all training texts.  The number of replicas comes from the corpus' words
   (``REPLICA_WORDS`` each and round), never from partitions or machines, and a replica's
   texts are in the order of their hashes, so the model is the same however the table
   lies but for rounding.
4. Scoring: each task runs whole texts and gives, per text, the sums over words of the
   head, and its other words with how often they occur; those meet the counts by a
   shuffle join on the word, so no table of all words is held anywhere.

A word that the network does not number has the probability of "any other word" times
its smoothed share among those.  The model so gives a distribution over the same words
as the base, with one place for all unseen ones.

Cases: null and empty texts are one end token.  Null ids are in fold crc32('') and are
scored.  Repeated rows are learned from as often as they occur, by one replica, and get
equal scores but for rounding.  Without training texts all words are unseen: base and score are 0.  An
empty table gives no rows.  Only the id and the text are read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gru import RecurrentModel
from .storage import Scratch
from .worker import keep, one_thread

#: The end token; no word holds a line feed.
END = b"\n"
#: Words, about, that a task counts, learns from or scores together.
TOGETHER = 4_000_000
FAN_IN = 8
#: Training words of a replica in a round, and the most replicas of a round; beyond that each
#: takes more words.
REPLICA_WORDS, MOST_REPLICAS = 2_000_000, 1024
LN10 = math.log(10)


def words_of(data: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts with A-Z lower-cased, without end tokens, and where each text's begin."""
    text = pc.cast(data, options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))  # only ASCII is looked at
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))  # at space and U+0009 to U+000D alone
    words = lists.flatten().cast(pa.binary())
    full = pc.not_equal(pc.binary_length(words), 0)  # texts that begin or end with a space, or are empty, have empty ones
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    begins = lists.offsets.to_numpy() - (lists.offsets[0].as_py() or 0)
    return words.filter(full), kept[begins]


def numbered(words: pa.Array, begins: np.ndarray, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words and each text's end token in the vocabulary, its length for others; where each text's begin."""
    many, texts = len(vocabulary), np.arange(len(begins) - 1)
    found = pc.index_in(words, value_set=vocabulary).fill_null(many).to_numpy()
    out = np.full(len(found) + len(texts), pc.fill_null(pc.index_in(pa.scalar(END, pa.binary()), value_set=vocabulary), many).as_py(), np.int32)
    out[np.arange(len(found)) + np.repeat(texts, np.diff(begins))] = found
    return out, begins + np.arange(len(begins))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of (data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            found = pc.value_counts(words_of(rows.column("data"))[0])
            yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "c"])
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([rows.num_rows], pa.int64())], names=["word", "c"])

    return texts.select("data").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, head: int) -> list[tuple[bytes, int]]:
    """The most frequent words, ``head`` at most: all with a count from some bound on.

    The bound comes from a histogram of at most a few thousand classes of counts."""
    kind = F.when(F.col("c") < 1000, F.col("c")).otherwise(F.floor(F.log2("c") * 64 + 1000)).cast("long")
    at, total = None, 0
    for r in sorted(counts.groupBy(kind.alias("kind")).count().collect(), reverse=True):
        total += r["count"]
        if total > head:
            break
        at = r.kind
    if at is None:
        return []
    rows = counts.where(kind >= at).collect()  # head words at most
    return sorted(((bytes(r.word), r.c) for r in rows), key=lambda x: (-x[1], x[0]))


def averaged(replicas: DataFrame, scratch: Scratch) -> np.ndarray | None:
    """Mean of (words, weights) rows by their words, summed FAN_IN rows at a time."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, words = None, None, 0.0
        for batch in batches:
            for g, n, w in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                w = np.frombuffer(w, np.float64)
                if g != key:
                    if key is not None:
                        yield _replica_batch(key, words, total)
                    key, total, words = g, np.zeros(len(w)), 0.0
                total, words = total + w, words + n
        if key is not None:
            yield _replica_batch(key, words, total)

    rows = replicas.select(F.floor(F.col("place") / FAN_IN).alias("place"), "words", "weights")
    while True:
        rows = scratch.save(rows.repartition("place").sortWithinPartitions("place").mapInArrow(add, "place long, words double, weights binary"))
        if rows.count() <= FAN_IN:
            break
        rows = rows.select(F.floor(F.col("place") / FAN_IN).alias("place"), "words", "weights")
    found = rows.orderBy("place").collect()  # FAN_IN rows at most
    if not found:
        return None
    return sum(np.frombuffer(r.weights, np.float64) for r in found) / sum(r.words for r in found)


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def _replica_batch(place: int, words: float, weights: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([float(words)]), pa.array([weights.tobytes()], pa.binary())], names=["place", "words", "weights"])


def _vocabulary(head: list[bytes], key: str) -> pa.Array:
    """The head as an Arrow array, built once per run in a worker process."""
    one_thread()
    return keep("lm", key, lambda: pa.array(head, pa.binary()))


def _grouped(batches: Iterator[pa.RecordBatch], key: str | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of one ``key``, as many together as hold about TOGETHER words in ``data``."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None

    def together() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        begin = 0
        sizes = pc.binary_length(batch.column("data")).to_pylist()
        for at, (n, own) in enumerate(zip(sizes, batch.column(key).to_pylist() if key else [None] * len(sizes), strict=True)):
            if size and (size >= TOGETHER or own != last):
                if at > begin:
                    held.append(batch.slice(begin, at - begin))
                yield together()
                held, size, begin = [], 0, at
            size, last = size + n // 6 + 1, own
        if begin < len(sizes):
            held.append(batch.slice(begin))
    if held:
        yield together()


def language_scores(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", known: int = 4096, head: int = 262_144,
    rounds: int = 4, rate: float = 0.02, lanes: int = 256, seed: int = 1,
) -> DataFrame:
    """(id, in_training, n_tokens, n_known, train_tokens, base_score, score) of each row.

    ``training`` says which rows are learned from.  Scores are log10 likelihoods of the
    text and its end: ``base_score`` by smoothed counts, ``score`` by the network."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("learn"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))
    counts = scratch.save(count_words(texts.where("learn")))
    n_words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = most_frequent(counts, head)
    vocabulary = [w for w, _ in frequent]
    smooth = np.array([c + 0.5 for _, c in frequent])
    whole = n_words + 0.5 * (distinct + 1)
    size = min(known, len(vocabulary))
    other = whole - float(smooth[:size].sum())
    key = uuid.uuid4().hex
    start = RecurrentModel(smooth[:size], other, seed)
    small_counts = smooth[:size]

    replicas = int(min(MOST_REPLICAS, max(1, -(-n_words // (rounds * REPLICA_WORDS)))))
    lot = F.xxhash64(F.col("id").cast("string"), "data")
    place = F.pmod(lot, F.lit(replicas * rounds))
    dealt = texts.where("learn").select((place % rounds).alias("round"), F.floor(place / rounds).alias("place"), lot.alias("lot"), "data")

    def learner(weights: np.ndarray):
        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = _vocabulary(vocabulary[:size], key + "learn")
            place, model, kept, total = None, None, {}, 0
            for rows in _grouped(batches, "place"):
                own = rows.column("place")[0].as_py()
                if own != place:
                    if total:
                        yield _replica_batch(place, total, model.weights().astype(np.float64) * total)
                    place, model, kept, total = own, RecurrentModel(small_counts, other, seed), {}, 0
                    model.load(weights)
                numbers, begins = numbered(*words_of(rows.column("data")), words)
                total += model.fit(np.split(numbers, begins[1:-1]), rate, lanes, kept)
            if total:
                yield _replica_batch(place, total, model.weights().astype(np.float64) * total)

        return learn

    # Four times as many partitions as replicas, so that few tasks get two; an empty one costs little.
    for number in range(rounds if size else 0):
        mine = dealt.where(F.col("round") == number).select("place", "lot", "data").repartition(4 * replicas, "place").sortWithinPartitions("place", "lot")
        mean = averaged(scratch.save(mine.drop("lot").mapInArrow(learner(start.weights()), "place long, words double, weights binary")), scratch)
        if mean is not None:
            start.load(mean)
    weights = start.weights()
    log_counts = np.log10(smooth)
    log_whole, log_other = math.log10(whole), math.log10(max(other, 1e-12))
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_words = _vocabulary(vocabulary, key)
        model = RecurrentModel(small_counts, other, seed)
        model.load(weights)
        place, many = TaskContext.get().partitionId() << 33, len(vocabulary)
        logs = np.append(log_counts, 0.0)
        for rows in _grouped(batches):
            words, bare = words_of(rows.column("data"))
            numbers, begins = numbered(words, bare, head_words)
            texts, lengths = rows.num_rows, np.diff(begins)
            text = np.repeat(np.arange(texts), lengths)
            n_known, n_numbered = (np.bincount(text[numbers < top], minlength=texts) for top in (many, size))
            base = np.bincount(text, logs[numbers], texts) - lengths * log_whole
            unnumbered = numbers >= size
            log_likelihood = np.bincount(text[unnumbered], logs[numbers[unnumbered]], texts) - (lengths - n_numbered) * log_other
            log_likelihood += model.score(np.split(np.minimum(numbers, size), begins[1:-1])) / LN10
            # Words beyond the head, and how often a text has each; an end token can be one too.
            far = np.flatnonzero(numbers == many)
            ends = np.zeros(len(numbers), bool)
            ends[begins[1:] - 1] = True
            if ends[far].any():
                places = np.where(ends, len(words), np.cumsum(~ends) - 1)[far]
                names = pa.concat_arrays([words, pa.array([END], pa.binary())]).take(pa.array(places))
            else:
                names = words.take(pa.array(far - text[far]))
            tail = pa.table({"text": text[far], "word": names}).group_by(["text", "word"], use_threads=False).aggregate([([], "count_all")])
            tail = tail.take(pa.array(np.argsort(tail.column("text").to_numpy(), kind="stable")))
            cuts = np.searchsorted(tail.column("text").to_numpy(), np.arange(texts + 1))
            pairs = pa.StructArray.from_arrays([_flat(tail.column("word")), _flat(tail.column("count_all"))], ["word", "n"])
            columns = {
                "place": place + 1 + np.arange(texts), "id": rows.column("id"), "learn": rows.column("learn"), "n_tokens": lengths.astype(np.int64),
                "n_known": n_known.astype(np.int64), "base": base, "score": log_likelihood, "tail": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pairs),
            }
            place += texts
            yield from pa.table(columns).to_batches(max_chunksize=500)

    shape = f"place long, id {kind}, learn boolean, n_tokens long, n_known long, base double, score double, tail array<struct<word:binary,n:long>>"
    scored = scratch.save(texts.mapInArrow(score, shape))
    tail = scored.select("place", F.explode("tail").alias("t")).select("place", "t.word", "t.n").join(counts, "word", "left")
    share = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    both = scored.select("place", "id", "learn", "n_tokens", "n_known", "base", "score", F.lit(1).alias("own")).unionByName(
        tail.select("place", F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"), share.alias("base"), share.alias("score"), F.lit(0).alias("own")), allowMissingColumns=True
    )
    return (
        both.groupBy("place").agg(F.max("id").alias("id"), F.max("learn").alias("in_training"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
        .select("id", "in_training", "n_tokens", "n_known", F.lit(int(n_words)).cast("long").alias("train_tokens"), "base_score", "score")
    )
