"""Line dedup: range-partitioned hashes, streamed in order, answered by bitmaps.

Each document gives one row per distinct line key: a 128-bit hash, the id and the
positions of its lines.  The rows are range-partitioned by (hash, id) and sorted
within partitions by hash, document and position.  A hash that a third of the
corpus shares so spans as many partitions as its rows need.  Every task streams
its rows and holds one run's first documents at most, fewer than ``min_docs`` (rows that
repeat an id are one document, so of those a task holds as many as share a line).

A run that a partition boundary cuts cannot be decided by one task.  Each task
therefore reports the document count of its first and last run, and their
undecided rows (fewer than ``min_docs`` documents); both are bounded by the
number of partitions, and a join of those few rows settles them.

The answer is a keep bitmap per document that loses a line, zlib-compressed, one
bit per line.  Text moves only when a caller applies bitmaps.

Cases: a null or empty text is one empty line.  Keys shorter than ``min_chars``
code points are never dropped.  Rows that repeat an id count as one document, and
each such row is treated by its own text.  Rows with a null id count together as
one document.  An empty table gives no bitmaps.  Only the id and the text are
read; other columns pass through :func:`apply_bitmaps` unchanged, with working
columns under names that start with ``__line_``.
"""

from __future__ import annotations

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

WS_BYTES = b" \t\n\x0b\x0c\r"
#: What a streamed row says.
DROP, UNDECIDED, FRAGMENT, LEAD = 1, 2, 3, 4


def line_key(line: bytes) -> bytes:
    """White space off both ends, A-Z lower-cased (bytes.lower touches ASCII alone)."""
    return line.strip(WS_BYTES).lower()


def _id_type(docs: DataFrame, id_col: str) -> T.DataType:
    return docs.schema[id_col].dataType


def line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, th, h1, h2, at): the positions of each distinct line key of each document."""
    kind = _id_type(docs, id_col)
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("th", T.LongType()), T.StructField("h1", T.LongType()),
         T.StructField("h2", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType()))]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep("lines", "", dict)
        for batch in batches:
            row, hashes, at = [], [], []
            for r, data in enumerate(batch.column(2).to_pylist()):
                groups: dict[bytes, list[int]] = {}
                for position, line in enumerate(data.split(b"\n")):
                    key = line_key(line)
                    if len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars):
                        groups.setdefault(xxhash.xxh3_128_digest(key), []).append(position)
                row += [r] * len(groups)
                hashes += groups
                at += groups.values()
            h = np.frombuffer(b"".join(hashes), ">i8").astype(np.int64).reshape(-1, 2)
            index = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(index), batch.column(1).take(index), pa.array(np.ascontiguousarray(h[:, 0])),
                 pa.array(np.ascontiguousarray(h[:, 1])), pa.array(at, pa.list_(pa.int32()))],
                names=["id", "th", "h1", "h2", "at"],
            )

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("data")).mapInArrow(split, schema)


class _Run:
    """The rows of one hash that a partition has streamed so far."""

    __slots__ = ("key", "first", "docs", "last", "held", "decided", "lead")

    def __init__(self, key: tuple[int, int], first: bool):
        self.key, self.first = key, first
        self.docs, self.last, self.held, self.decided, self.lead = 0, (), [], False, None


def stream_runs(batches: Iterator[pa.RecordBatch], min_docs: int, keep_first: bool, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One partition's rows in (h1, h2, id, th) order, to rows to drop or to settle."""
    out: list[tuple] = []
    run: _Run | None = None
    started = False

    def feed(ident, th: int, at: list[int]) -> None:
        if run.last == (ident, th):  # the same row again
            return
        if not run.last or run.last[0] != ident:
            run.docs += 1
        run.last = (ident, th)
        if keep_first and run.lead is None:
            run.lead = (ident, th, at[:1])
            at = at[1:]
        if run.decided:
            out.append((ident, th, at, DROP, *run.key, 0))
            return
        run.held.append((ident, th, at))
        if run.docs >= min_docs:
            run.decided = True
            out.extend((*x, DROP, *run.key, 0) for x in run.held)
            run.held = []

    def close(last: bool) -> None:
        if run.first or last:
            out.append((None, 0, [], FRAGMENT, *run.key, run.docs))
            out.extend((*x, UNDECIDED, *run.key, 0) for x in run.held)
            if run.lead:
                out.append((*run.lead, LEAD, *run.key, 0))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*[x for x in out if x[3] != DROP or x[2]], strict=True)) or [[]] * 7
        out.clear()
        kinds = (id_type, pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ("id", "th", "at", "state", "h1", "h2", "docs")
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        ends = np.r_[starts[1:], n]
        # A run inside the batch with too few rows decides nothing, so it is never looked at.
        wanted = ends - starts >= max(min_docs, 1 if min_docs <= 1 else 2)
        wanted[0] = wanted[-1] = True
        ids, ths, ats = batch.column("id"), batch.column("th").to_numpy(), batch.column("at")
        for s, e in zip(starts[wanted], ends[wanted], strict=True):
            key = (int(h1[s]), int(h2[s]))
            if run is None or run.key != key:
                if run is not None:
                    close(False)
                run = _Run(key, not started)
                started = True
            for ident, th, at in zip(ids.slice(s, e - s).to_pylist(), ths[s:e].tolist(), ats.slice(s, e - s).to_pylist(), strict=True):
                feed(ident, th, at)
            if len(out) > 20_000:
                yield flush()
    if run is not None:
        close(True)
        yield flush()


def line_bitmaps(
    docs: DataFrame, min_docs: int = 10, keep: str = "none", min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, th, n_dropped, bitmap) of each document that loses a line.

    A key found in at least ``min_docs`` documents loses all its lines (``keep="none"``)
    or all but its first, by id and position (``keep="first"``).  ``th`` is the
    text's xxhash64, which tells rows apart that repeat an id."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be 'none' or 'first', not {keep!r}")
    scratch = Scratch(docs.sparkSession, "lines")
    kind = _id_type(docs, id_col)
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("th", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType())),
         T.StructField("state", T.IntegerType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("docs", T.LongType())]
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        yield from stream_runs(batches, min_docs, keep == "first", to_arrow_type(kind))

    rows = line_rows(docs, id_col, text_col, min_chars)
    marks = scratch.save(rows.repartitionByRange("h1", "h2", "id").sortWithinPartitions("h1", "h2", "id", "th").mapInArrow(stream, schema))
    # At most two hashes for each partition.
    cut = marks.where(F.col("state") == FRAGMENT).groupBy("h1", "h2").agg(F.sum("docs").alias("total")).where(F.col("total") >= min_docs).select("h1", "h2")
    edge = marks.where(F.col("state").isin(UNDECIDED, LEAD)).join(F.broadcast(cut), ["h1", "h2"])
    leads = edge.where(F.col("state") == LEAD)
    first = leads.groupBy("h1", "h2").agg(F.min(F.struct("id", "th")).alias("first"))
    later = leads.join(first, ["h1", "h2"]).where(~F.struct("id", "th").eqNullSafe(F.col("first"))).select("id", "th", "at")
    dropped = marks.where(F.col("state") == DROP).select("id", "th", "at").unionAll(edge.where(F.col("state") == UNDECIDED).select("id", "th", "at")).unionAll(later)
    positions = dropped.where(F.size("at") > 0).groupBy("id", "th").agg(F.flatten(F.collect_list("at")).alias("at"))  # a document's own lines
    return positions.select("id", "th", F.size("at").cast("long").alias("n_dropped"), _bitmap("at").alias("bitmap"))


@F.pandas_udf(T.BinaryType())
def _bitmap(at: pd.Series) -> pd.Series:
    """Drop positions to a zlib-compressed keep bitmap; bits after the last drop mean keep."""

    def pack(positions: np.ndarray) -> bytes:
        keep = np.ones((int(max(positions)) // 8 + 1) * 8, np.uint8)
        keep[np.asarray(positions)] = 0
        return zlib.compress(np.packbits(keep).tobytes(), 1)

    return at.map(pack)


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Keep flags of ``n_lines`` lines."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
    return np.concatenate([bits, np.ones(max(0, n_lines - len(bits)), np.uint8)]).astype(bool)


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def join(t: str | None, b: bytes | None) -> str | None:
        if b is None or t is None:
            return t
        lines = t.split("\n")
        return "\n".join(x for x, k in zip(lines, unpack_bitmap(b, len(lines)), strict=True) if k)

    return pd.Series([join(t, b) for t, b in zip(text, bitmap, strict=True)], dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``__line_total``, ``__line_dropped`` and ``__line_kept`` (the text that stays).

    Rows without a bitmap keep their text; only texts that change go through Python."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marks = bitmaps.select(F.col("id").alias("__line_id"), F.col("th").alias("__line_th"), F.col("n_dropped").alias("__line_n"), F.col("bitmap").alias("__line_bitmap"))
    joined = docs.withColumn("__line_hash", F.xxhash64(text)).join(
        marks, F.col(id_col).eqNullSafe(F.col("__line_id")) & (F.col("__line_hash") == F.col("__line_th")), "left"
    )
    changed = F.col("__line_bitmap").isNotNull()
    return joined.withColumns(
        {
            "__line_total": (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long"),
            "__line_dropped": F.coalesce(F.col("__line_n"), F.lit(0)).cast("long"),
            "__line_kept": F.when(changed, _kept(F.when(changed, text), "__line_bitmap")).otherwise(text),
        }
    ).drop("__line_id", "__line_th", "__line_hash", "__line_n", "__line_bitmap")


def dedup_lines(docs: DataFrame, min_docs: int = 10, keep: str = "first", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the columns it has, its texts without the lines that are dropped."""
    found = apply_bitmaps(docs, line_bitmaps(docs.select(id_col, text_col), min_docs, keep, id_col=id_col, text_col=text_col), id_col, text_col)
    return found.withColumn(text_col, F.col("__line_kept")).select(docs.columns)
