"""Token ids packed into fixed-length rows, as binary matrices.

Texts are encoded by a public byte-level BPE vocabulary and cut into pieces of at most
``length`` ids, so no id is lost.  Pieces are dealt to shards by a hash of id
and text, so the rows are the same however the table lies (equal rows, which may change
places, are spread by the number of times that a task has met them); the number of shards follows from the corpus' bytes, since a text has no
more ids than bytes, so a shard has a bounded number of ids whatever the corpus holds.
Within a shard, pieces stream in decreasing length to best-fit-decreasing packing: a
segment tree over remaining capacities gives the fullest row that still has room.  At
most the last rows of each shard stay partly empty.

Each output row is a block of packed sequences: the id matrix and the position matrix
(positions start again at 0 with each segment), little-endian int32, row by row, with
the cumulative lengths of the segments and which piece of which document each one is.

Cases: null and empty texts have no ids and appear in no row.  Special tokens' strings
are ordinary text.  Repeated rows are packed as often as they occur.  An empty table
gives no rows.  Only the id and the text are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .worker import keep

#: Sequences in a block.
BLOCK = 64
#: Rows whose copies a task counts at a time.
COPIES = 50_000


@dataclass(frozen=True)
class ByteVocabulary:
    """Ranks of byte sequences, and the pattern that cuts text before merging."""

    ranks: dict[bytes, int]
    pattern: str
    name: str

    @staticmethod
    def load(path: str, pattern: str) -> ByteVocabulary:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return ByteVocabulary(ranks, pattern, path)

    def encoding(self):
        """The tokenizer, built once in a worker process."""
        import tiktoken

        key = f"{self.name} {len(self.ranks)} {self.pattern}"
        return keep("packing", key, lambda: tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={}))


class CapacityTree:
    """Open rows by remaining capacity; finds the least capacity that is enough."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.full = bytearray(2 * self.base)  # whether a leaf below holds a row
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        at = self.base + capacity
        while at and not self.full[at]:
            self.full[at] = 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of the fullest row with room for ``need``, removed from the tree."""
        at, full = self.base + need, self.full
        while not full[at]:
            while at & 1:  # a right child: its parent has nothing further to the right
                at >>= 1
                if at <= 1:
                    return None
            at += 1
        while at < self.base:
            at = 2 * at if full[2 * at] else 2 * at + 1
        capacity = at - self.base
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            full[at] = 0
            at >>= 1
            while at:
                if full[2 * at] or full[2 * at + 1]:
                    break
                full[at] = 0
                at >>= 1
        return capacity, row


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers, for pieces in decreasing length."""
    tree, rows = CapacityTree(length), []
    for k, n in enumerate(lengths):
        found = tree.take(n)
        capacity, row = found or (length, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(k)
        if capacity > n:
            tree.put(capacity - n, row)
    return rows


def pieces(docs: DataFrame, vocabulary: ByteVocabulary, length: int, shards: int, id_col: str, text_col: str) -> DataFrame:
    """(shard, n, id, piece, ids): the ids of each text in parts of at most ``length``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.encoding().encode_ordinary
        # Copies of a row are numbered, so that many of them are not one shard's.
        met: dict[tuple, int] = {}
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                batch = whole.slice(begin, 500)
                row, number, n, data, place = [], [], [], [], []
                for r, (name, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                    ids = np.array(encode(text), "<u4")
                    own = (name, xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")))
                    copy = met.get(own, 0)
                    if len(met) >= COPIES:
                        met.clear()
                    met[own] = copy + 1
                    seen = xxhash.xxh3_64_intdigest(repr((*own, copy)).encode()) >> 1
                    for k in range(0, len(ids), length):
                        row.append(r)
                        number.append(k // length)
                        n.append(min(length, len(ids) - k))
                        data.append(ids[k : k + length].astype("<u2" if len(vocabulary.ranks) <= 65536 else "<u4").tobytes())
                        place.append(seen)
                kept = batch.column(0).take(pa.array(row, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place, pa.int64()), pa.array(n, pa.int32()), kept, pa.array(number, pa.int32()), pa.array(data, pa.binary())], names=["place", "n", "id", "piece", "ids"]
                )

    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = texts.mapInArrow(run, f"place long, n int, id {kind}, piece int, ids binary")
    return found.select(F.pmod(F.xxhash64("id", "place", "piece"), F.lit(shards)).cast("int").alias("shard"), "n", "id", "piece", "ids")


def pack_documents(
    docs: DataFrame, vocabulary: ByteVocabulary, length: int = 2048, pad: int = 0, shard_bytes: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Blocks (shard, first_row, n_rows, length, ids, positions, cu_seqlens, segments) of packed sequences.

    ``cu_seqlens`` has for each sequence 0 and the ends of its segments; ``segments`` the
    (id, piece, n) of each; unused places of the matrices hold ``pad`` and position 0."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    kind = docs.schema[id_col].dataType.simpleString()
    width = "<u2" if len(vocabulary.ranks) <= 65536 else "<u4"

    def packed(shard: int, rows: list[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        bins = best_fit([r[0] for r in rows], length)
        segment = pa.struct([("id", id_type), ("piece", pa.int32()), ("n", pa.int32())])
        for at in range(0, len(bins), BLOCK):
            part = bins[at : at + BLOCK]
            ids, positions = np.full((len(part), length), pad, "<i4"), np.zeros((len(part), length), "<i4")
            ends, segments = [], []
            for k, row in enumerate(part):
                to, own = [0], []
                for p in row:
                    n, name, piece, data = rows[p]
                    ids[k, to[-1] : to[-1] + n] = np.frombuffer(data, width)
                    positions[k, to[-1] : to[-1] + n] = np.arange(n)
                    to.append(to[-1] + n)
                    own.append({"id": name, "piece": piece, "n": n})
                ends.append(to)
                segments.append(own)
            columns = ([shard], [at], [len(part)], [length], [ids.tobytes()], [positions.tobytes()], [ends], [segments])
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.list_(segment)))
            names = ["shard", "first_row", "n_rows", "length", "ids", "positions", "cu_seqlens", "segments"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows, id_type = None, [], None
        for batch in batches:
            id_type = batch.schema.field(2).type
            for s, n, name, piece, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if s != shard:
                    if rows:
                        yield from packed(shard, rows, id_type)
                    shard, rows = s, []
                rows.append((n, name, piece, data))
        if rows:
            yield from packed(shard, rows, id_type)

    dealt = pieces(docs, vocabulary, length, shards, id_col, text_col).repartition("shard").sortWithinPartitions("shard", F.desc("n"), "id", "piece", "ids")
    schema = f"shard int, first_row int, n_rows int, length int, ids binary, positions binary, cu_seqlens array<array<int>>, segments array<array<struct<id:{kind},piece:int,n:int>>>"
    return dealt.mapInArrow(run, schema)


def write_packed(blocks: DataFrame, path: str) -> None:
    """Write blocks as Parquet, one folder for each of up to 256 groups of shards."""
    blocks.withColumn("part", F.pmod("shard", F.lit(256))).write.partitionBy("part").parquet(path)


def sequences(blocks: DataFrame) -> DataFrame:
    """(shard, row, n_tokens, ids, positions, cu_seqlens, segments), one row per sequence; matrices' rows as bytes."""
    one = blocks.select("*", F.posexplode("segments").alias("k", "own"))
    cut = lambda c: F.substring(c, F.col("k") * F.col("length") * 4 + 1, F.col("length") * 4)
    ends = F.get("cu_seqlens", F.col("k"))
    return one.select(
        "shard", (F.col("first_row") + F.col("k")).alias("row"), F.element_at(ends, -1).alias("n_tokens"), cut("ids").alias("ids"), cut("positions").alias("positions"),
        ends.alias("cu_seqlens"), F.col("own").alias("segments"),
    )


def unpack(blocks: DataFrame, vocabulary: ByteVocabulary) -> DataFrame:
    """(id, piece, data): the bytes of each piece again; joined by piece they are the text."""
    kind = blocks.schema["segments"].dataType.elementType.elementType["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = vocabulary.encoding().decode_bytes
        for batch in batches:
            rows = []
            for ids, ends, own in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids = np.frombuffer(ids, "<i4").tolist()
                rows += [(s["id"], s["piece"], decode(ids[a:b])) for s, a, b in zip(own, ends, ends[1:], strict=False)]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            kinds = (batch.schema.field(2).type.value_type.field(0).type, pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["id", "piece", "data"])

    return sequences(blocks).select("ids", "cu_seqlens", "segments").mapInArrow(run, f"id {kind}, piece int, data binary")
