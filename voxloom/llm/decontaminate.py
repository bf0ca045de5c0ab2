"""Benchmark decontamination by SimHash over item-sized windows.

Words are runs of word characters, lower-cased; shingles are five words (all words
of a shorter item).  A window has as many words as the item it is held against.
Its 128-bit SimHash sums a +1/-1 vector for each occurrence of a shingle in the window:
the first, second and so on have vectors of their own, so what replaces a word, be it
unknown words or one word again and again, adds independent votes.

Items are found by multi-index Hamming search: 128 bits are eight blocks of 16, and
fingerprints within ``RADIUS`` bits agree in some block but for RADIUS // 8 bits, so a
table of all block values within that distance of each item's blocks misses none.
Windows that pass by Hamming distance are then verified exactly: the weighted
Jaccard similarity of the shingle multisets must reach ``threshold``.

At similarity 0.8 the expected distance is about 20 bits with a deviation of 4, so
the radius of 38 loses some five in a million windows that lie just at the threshold.
A window without any shingle of the benchmark has similarity 0; its fingerprint is
not computed.

Texts stay where they are, without a shuffle: one pass for each four slices of the
benchmark.  A slice has about ``max_bytes`` of text, by a count made before, so what a
task holds does not grow with the benchmark.  Where there are several passes, each writes
the ids and matches of the rows that match something, never texts, and a join on id and
text hash puts them together.

Cases: null and empty texts are clean; null, empty and wordless items match nothing.
A text shorter than an item is one window.  Repeated rows get equal results, repeated
items are reported under each id.  Empty tables give no rows or no matches.  Only the
ids and texts are read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import Scratch
from .worker import keep

WORD = re.compile(r"\w+")
SHINGLE = 5
BLOCKS, BLOCK_BITS, RADIUS = 8, 16, 38
#: Items that share one table of block values; slices of the benchmark that are searched in one pass.
GROUP, SLICES = 256, 4
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser; equal inputs give equal bits in every process."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((_MIX[0] * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
        return x ^ (x >> np.uint64(31))


def shingle_codes(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit code of each run of ``width`` word numbers; 0 where one is unknown."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    code, known = np.zeros(n, np.uint64), np.ones(n, bool)
    with np.errstate(over="ignore"):
        for k in range(width):
            part = ids[k : k + n]
            code = code * np.uint64(_MIX[1]) + part.astype(np.uint64)
            known &= part > 0
    return np.where(known, _mixed(code, width), np.uint64(0))


def occurrences(codes: np.ndarray, per: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each place's code occurs in the ``per`` places that end there, and in those that begin there."""
    n = len(codes)
    code = np.unique(codes, return_inverse=True)[1].reshape(-1) * (n + 1)
    places = np.arange(n)
    keys = np.sort(code + places)
    before = keys.searchsorted(code + places)
    ending = before - keys.searchsorted(code + np.maximum(places - per + 1, 0)) + 1
    beginning = keys.searchsorted(code + np.minimum(places + per, n)) - before
    return ending, beginning


def lanes(codes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """(shingles, 128) of +1 and -1, for the given occurrence of each."""
    codes = codes + number.astype(np.uint64) * np.uint64(_MIX[2])
    words = np.stack([_mixed(codes, 101), _mixed(codes, 202)], 1)
    bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(codes), 16), axis=1, bitorder="little")
    return bits.astype(np.int16) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """(windows, 8) blocks of 16 bits from (windows, 128) sums."""
    return np.packbits(sums > 0, axis=1, bitorder="little").reshape(-1).view("<u2").reshape(len(sums), BLOCKS)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(-1)


class Benchmark:
    """Items prepared for search: word numbers, shingles, fingerprints, block tables."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.words: dict[str, int] = {}
        self.names, self.sizes, self.counts, prints = [], [], [], []
        self.holders: dict[int, dict[int, list[int]]] = {}  # shingle width, code, items
        for name, text in items:
            words = WORD.findall((text or "").lower())
            if not words:
                continue
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in words])
            width = min(SHINGLE, len(words))
            codes = shingle_codes(ids, width)
            item = len(self.names)
            self.names.append(name)
            self.sizes.append(len(words))
            self.counts.append(Counter(codes.tolist()))
            number = occurrences(codes, len(codes))[0]
            prints.append(fingerprints(lanes(codes, number).sum(0, dtype=np.int64)[None])[0])
            for c in self.counts[-1]:
                self.holders.setdefault(width, {}).setdefault(c, []).append(item)
        self.prints = np.array(prints, np.uint16).reshape(-1, BLOCKS)
        self.codes = {w: np.array(sorted(x), np.uint64) for w, x in self.holders.items()}
        self.by_size = np.array(self.sizes)
        reach = RADIUS // BLOCKS
        self.masks = np.array([sum(1 << b for b in x) for k in range(reach + 1) for x in itertools.combinations(range(BLOCK_BITS), k)], np.uint16)
        self.tables: dict[int, np.ndarray] = {}

    def near(self, group: int) -> np.ndarray:
        """(block, value, word) bits of the group's items with a block near the value."""
        if group not in self.tables:
            if len(self.tables) >= 4:
                self.tables.pop(next(iter(self.tables)))
            table = np.zeros((BLOCKS, 1 << BLOCK_BITS, GROUP // 64), np.uint64)
            for k, own in enumerate(self.prints[group * GROUP : (group + 1) * GROUP]):
                for b in range(BLOCKS):
                    table[b, self.masks ^ own[b], k // 64] |= np.uint64(1 << (k % 64))
            self.tables[group] = table
        return self.tables[group]

    def within(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, item) numbers of all pairs within RADIUS."""
        for group in range((len(self.names) + GROUP - 1) // GROUP):
            table = self.near(group)
            hit = table[0, prints[:, 0]]
            for b in range(1, BLOCKS):
                hit = hit | table[b, prints[:, b]]
            bits = np.unpackbits(hit.astype("<u8").view(np.uint8).reshape(len(prints), -1), axis=1, bitorder="little")
            w, k = np.nonzero(bits)
            k = k + group * GROUP
            near = _popcount(prints[w] ^ self.prints[k]) <= RADIUS
            yield w[near], k[near]

    def search(self, ids: np.ndarray, hits: np.ndarray, width: int, threshold: float) -> dict[int, tuple[float, int]]:
        """Best (similarity, first word) of each item in a text, from shingles that hit."""
        found: dict[int, tuple[float, int]] = {}
        codes = shingle_codes(ids, width)
        if not len(codes):
            return found
        # Only sizes whose items hold a shingle that occurs here can match.
        sizes = sorted({self.sizes[i] for c in set(codes[hits].tolist()) for i in self.holders[width].get(c, ())})
        for size in sizes:
            per = min(size, len(ids)) - width + 1  # shingles of a window
            if per < 1:
                continue
            last = len(codes) - per
            starts = np.unique(np.clip((hits[:, None] + np.arange(-per + 1, 1)).ravel(), 0, last))
            # Prefix sums over stretches of windows that touch, so a long text is never expanded whole.
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > per) + 1):
                for at in range(0, len(part), 4096):
                    some = part[at : at + 4096]
                    low = some[0]
                    span = codes[low : some[-1] + per]
                    # From a window to the next, the last occurrence of its first shingle goes.
                    total, gone = (np.zeros((len(span) + 1, 128), np.int32) for _ in range(2))
                    for sums, number in zip((total, gone), occurrences(span, per), strict=True):
                        np.cumsum(lanes(span, number), axis=0, out=sums[1:])
                    prints = fingerprints(total[some - low + per] - gone[some - low])
                    for w, k in self.within(prints):
                        same = (self.by_size[k] == size)
                        for start, item in zip(some[w[same]].tolist(), k[same].tolist(), strict=True):
                            own, other = Counter(codes[start : start + per].tolist()), self.counts[item]
                            both = sum(min(n, other[c]) for c, n in own.items() if c in other)
                            similarity = both / (per + sum(other.values()) - both)
                            if similarity >= threshold and similarity > found.get(item, (0.0, 0))[0]:
                                found[item] = (similarity, start)
        return found

    def matches(self, texts: list[str], threshold: float) -> list[list[tuple[object, float, int]]]:
        """(item id, similarity, first word) of each text's items."""
        out: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
        get = self.words.get
        numbers = [list(map(get, WORD.findall(t.lower()), repeat(0))) for t in texts]
        begins = np.cumsum([0] + [len(x) + 1 for x in numbers])
        flat = np.array([i for x in numbers for i in (*x, 0)] or [0])  # a 0 between texts
        for width, known in self.codes.items():
            codes = shingle_codes(flat, width)
            at = np.flatnonzero(codes)
            place = np.minimum(np.searchsorted(known, codes[at]), len(known) - 1)
            at = at[known[place] == codes[at]]
            for r, hits in itertools.groupby(at.tolist(), lambda p: int(np.searchsorted(begins, p, "right")) - 1):
                out[r] |= self.search(np.array(numbers[r]), np.array(list(hits)) - begins[r], width, threshold)
        return [sorted(((self.names[i], s, p) for i, (s, p) in x.items()), key=lambda m: (str(m[0]), m[0])) for x in out]


def benchmark_of(items: list[tuple[object, str | None]]) -> Benchmark:
    """One prepared benchmark for each slice in a worker process."""
    return keep("decontaminate", hashlib.md5(repr(items).encode()).hexdigest(), lambda: Benchmark(items), most=SLICES)


def _matches(text: Column, items: list, threshold: float, kind: T.DataType) -> Column:
    """The matches of one slice of items in a text column."""

    def run(texts: pa.Array) -> pa.Array:
        prepared = benchmark_of(items)
        found = []
        for at in range(0, len(texts), 200):
            found += [[{"item": i, "similarity": s, "word": p} for i, s, p in x] for x in prepared.matches(texts.slice(at, 200).to_pylist(), threshold)]
        return pa.array(found, arrow_kind)

    from pyspark.sql.pandas.types import to_arrow_type

    match = T.StructType([T.StructField("item", kind), T.StructField("similarity", T.DoubleType()), T.StructField("word", T.IntegerType())])
    arrow_kind = to_arrow_type(T.ArrayType(match))
    return F.arrow_udf(run, T.ArrayType(match))(text)


def _rounds(benchmark: DataFrame, item_col: str, item_text: str, max_bytes: int) -> Iterator[tuple[list[list], bool]]:
    """(slices of items, whether they are the last), SLICES of about ``max_bytes`` of text at a time.

    The slices' number comes from a count, so the driver and a task hold one round's."""
    own = F.coalesce(F.col(item_text).cast("string"), F.lit(""))
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(own) + 64), F.lit(0))).first()[0]
    total = 1 + size // max_bytes
    sliced = benchmark.select(F.col(item_col).alias("item"), own.alias("text"), F.pmod(F.xxhash64(own, F.col(item_col)), F.lit(total)).alias("slice"))
    for at in range(0, total, SLICES):
        rows = sliced.where(F.col("slice").between(at, at + SLICES - 1)).collect()
        slices = [sorted(((r.item, r.text) for r in rows if r.slice == k), key=lambda x: (str(x[0]), x[1])) for k in range(at, min(at + SLICES, total))]
        yield slices, at + SLICES >= total


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", threshold: float = 0.8, max_bytes: int = 4_000_000,
) -> DataFrame:
    """(id, matches) of each row; a match is (item, similarity, word), word the first of the item's best window."""
    scratch, kind = Scratch(docs.sparkSession, "leaks"), benchmark.schema[item_col].dataType
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    found: list[DataFrame] = []
    for slices, last in _rounds(benchmark, item_col, item_text, max_bytes):
        own = F.concat(*[_matches(F.col("text"), items, threshold, kind) for items in slices])
        if last and not found:
            return rows.select("id", own.alias("matches"))
        found.append(_hits(rows.select("id", F.xxhash64("text").alias("hash"), own.alias("matches")), scratch))
    # Equal rows have equal matches and become one; those of one row come from several rounds.
    all_found = functools.reduce(DataFrame.unionAll, found).distinct().groupBy("id", "hash").agg(F.flatten(F.collect_list("matches")).alias("matches"))
    hit = all_found.select(F.col("id").alias("hit_id"), F.col("hash").alias("hit_hash"), "matches")
    keys = rows.select("id", F.xxhash64("text").alias("hash"))
    none = F.array().cast(all_found.schema["matches"].dataType)
    return keys.join(hit, keys["id"].eqNullSafe(hit["hit_id"]) & (keys["hash"] == hit["hit_hash"]), "left").select("id", F.coalesce("matches", none).alias("matches"))


def _hits(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows that match something, written: ids, hashes and matches, never texts."""
    return scratch.save(rows.where(F.size("matches") > 0))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = 0.8, max_bytes: int = 4_000_000) -> DataFrame:
    """The rows of ``docs`` whose text matches no item."""
    scratch, kind = Scratch(docs.sparkSession, "leaks"), benchmark.schema["item_id"].dataType
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = "__leak_text"
    while name in docs.columns:
        name += "_"
    gone: list[DataFrame] = []
    for slices, last in _rounds(benchmark, "item_id", "text", max_bytes):
        own = F.concat(*[_matches(text, items, threshold, kind) for items in slices])
        if last and not gone:
            return docs.where(F.size(own) == 0)
        gone.append(_hits(docs.select(F.xxhash64(text).alias(name), F.md5(text.cast("binary")).alias("digest"), own.alias("matches")), scratch).select(name, "digest"))
    # Equal texts match the same items, so the text's hashes tell which rows go.
    leaks = functools.reduce(DataFrame.unionAll, gone).distinct()
    return docs.join(leaks, (F.xxhash64(text) == leaks[name]) & (F.md5(text.cast("binary")) == leaks["digest"]), "left_anti")
