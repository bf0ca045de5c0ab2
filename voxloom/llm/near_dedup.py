"""Near-duplicate components by one-permutation MinHash.

A document's set is its distinct word shingles, as 64-bit hashes.  One permutation
of them fills ``BANDS * ROWS`` bins; an empty bin copies a full one found by a hash
sequence of its own (optimal densification).  Bands of bins are buckets.

1. Equal sets become one class, by an aggregate over a 128-bit digest.
2. In each bucket the least class is the centre of a star; its edges to the others
   are the candidates, as many as members and not as pairs of them.
3. Edges are verified on full sets, which are built again from the texts of just the
   documents that have an edge.
4. A bucket whose other members now lie in several components could hide a link between
   two that are not its centre.  There, the members outside the largest component meet
   all of another component: block by block, against an index of the block's sets, so
   that rows grow with members and blocks and only links come out.  No link that shares
   a bucket is lost.

With five rows and 36 bands, a pair of similarity 0.8 shares no bucket with a chance
of 6e-7.  A hot centre or group goes to as many tasks as its edges or blocks need, and a
task holds one block of centres at a time.

Cases: without words a set is empty and linked with nothing; with fewer words than a
shingle the whole sequence is the one shingle.  Rows that share an id are one document
with several texts and in one component.  Rows with a null id are linked with nothing,
get a null component and are kept.  An empty table gives no rows.  Only the id and the
text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import Scratch
from .worker import keep

BANDS, ROWS = 36, 5
BINS = BANDS * ROWS
#: Edges of one centre that a task verifies together; sides of a block of a group.
STAR_PART, CENTRE_BLOCK, MEMBER_BLOCK = 500, 256, 2048
#: Ids that are few enough to be broadcast; more are joined by a shuffle.
FEW_IDS = 1_000_000
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x + _M1
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
        return x ^ (x >> np.uint64(31))


def shingle_set(data: bytes, size: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = data.lower().split()  # bytes: A-Z alone, and space and U+0009 to U+000D alone
    if not words:
        return np.zeros(0, np.uint64)
    get, digest = memo.get, xxhash.xxh3_64_intdigest
    hashes = []
    for w in words:
        h = get(w)
        if h is None:
            if len(memo) > 300_000:
                memo.clear()
            h = memo[w] = digest(w)
        hashes.append(h)
    ids = np.array(hashes, np.uint64)
    width = min(size, len(ids))
    n = len(ids) - width + 1
    code = np.full(n, width, np.uint64)
    for k in range(width):
        code = mix(code ^ ids[k : k + n])
    return np.unique(code)


def _probes() -> np.ndarray:
    """Bins that an empty bin tries in turn: a fixed pseudo-random sequence for each."""
    bins, tries = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(1, 65, dtype=np.uint64), indexing="ij")
    return (mix(bins * np.uint64(1_000_003) + tries) % np.uint64(BINS)).astype(np.int64)


PROBES = _probes()


def bands(codes: np.ndarray) -> np.ndarray:
    """Bucket hashes of a non-empty set: one-permutation minima, densified, by bands."""
    h = mix(codes ^ np.uint64(0x5851F42D4C957F2D))
    where = ((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    value = np.full(BINS, np.uint64(0xFFFFFFFFFFFFFFFF))
    np.minimum.at(value, where.astype(np.int64), (h & np.uint64(0xFFFFFFFF)) << np.uint64(8))
    full = value != np.uint64(0xFFFFFFFFFFFFFFFF)
    empty = np.flatnonzero(~full)
    taken = np.arange(BINS)
    for t in range(PROBES.shape[1]):
        if not len(empty):
            break
        source = PROBES[empty, t]
        good = full[source]
        taken[empty[good]] = source[good]
        empty = empty[~good]
    if len(empty):  # the sequences found no full bin: the next one round the circle
        filled = np.flatnonzero(full)
        taken[empty] = filled[np.searchsorted(filled, empty) % len(filled)]
    # The source bin is part of the value, so equal minima of different bins stay apart.
    value = mix(value[taken] ^ mix(taken.astype(np.uint64)))
    code = np.arange(BANDS, dtype=np.uint64)
    for row in value.reshape(BANDS, ROWS).T:
        code = mix(code ^ row)
    return code


def prints(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, h1, h2, bands) of each row: size and digest of its set, and its buckets."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = keep("near", "words", dict)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                n, digests, buckets = [], [], []
                for data in batch.column(1).to_pylist():
                    codes = shingle_set(data, size, memo)
                    n.append(len(codes))
                    digests.append(xxhash.xxh3_128_digest(codes.tobytes()))
                    buckets.append(bands(codes) if len(codes) else np.zeros(0, np.uint64))
                h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                offsets = np.concatenate([[0], np.cumsum([len(b) for b in buckets])]).astype(np.int32)
                flat = np.concatenate(buckets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=["id", "n", "h1", "h2", "bands"],
                )

    return _texts(docs, id_col, text_col).mapInArrow(run, f"id {kind}, n long, h1 long, h2 long, bands array<long>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """(id, codes): the shingle set as the bytes of its sorted hashes."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = keep("near", "words", dict)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                codes = [shingle_set(d, size, memo).tobytes() for d in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], names=["id", "codes"])

    return texts.mapInArrow(run, f"id {kind}, codes binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


class Centres:
    """Sets of a block of centres; intersects all of them with one other set at once."""

    def __init__(self, nodes: list, labels: list, sets: list[np.ndarray]):
        self.nodes, self.labels, self.sets = nodes, labels, sets
        self.sizes = np.array([len(x) for x in sets])
        codes = np.concatenate(sets)
        order = np.argsort(codes, kind="stable")
        self.codes, self.owners = codes[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def links(self, label, codes: np.ndarray, percent: int) -> list:
        """Centres of another label that are similar enough to a set."""
        if len(self.sets) == 1:
            near = [0] if linked(self.sets[0], codes, percent) else []
        else:
            low, high = np.searchsorted(self.codes, codes, "left"), np.searchsorted(self.codes, codes, "right")
            n = high - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            both = np.bincount(self.owners[at], minlength=len(self.sets))
            near = np.flatnonzero((100 * both >= percent * (self.sizes + len(codes) - both)) & (both > 0)).tolist()
        return [self.nodes[k] for k in near if label is None or self.labels[k] != label]


def node_sets(nodes: DataFrame, texts: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """(id, codes) of the given nodes, from their texts alone."""
    nodes = scratch.save(nodes.distinct())
    wanted = F.broadcast(nodes) if nodes.count() <= FEW_IDS else nodes
    return scratch.save(_sets(texts.join(wanted, texts["id"] == nodes["node"], "left_semi"), size))


def compare(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the centres (role 0) and the members (role 1) of each (g, part).

    ``dealt`` has (g, part, role, node, label); two of one label are not compared.  A
    task streams its rows in order and holds the centres of one part."""
    kind = sets.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, centres = None, [], None
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                out = []
                for g, part, role, node, label, codes in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    codes = np.frombuffer(codes, np.uint64)
                    if key != (g, part):
                        key, own, centres = (g, part), [], None
                    if role == 0:
                        own.append((node, label, codes))
                        continue
                    if centres is None:
                        centres = Centres([x[0] for x in own], [x[1] for x in own], [x[2] for x in own])
                    out += [(a, node) for a in centres.links(label, codes, percent) if a != node]
                kinds = batch.schema.field(3).type
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], kinds), pa.array([b for _, b in out], kinds)], names=["a", "b"])

    rows = dealt.join(sets, dealt["node"] == sets["id"]).select("g", "part", "role", "node", "label", "codes")
    return rows.repartition("g", "part").sortWithinPartitions("g", "part", "role").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _star_parts(stars: DataFrame) -> DataFrame:
    """Edges (a, b) dealt for :func:`compare`: about STAR_PART of a centre's to a part."""
    none = F.lit(None).cast(stars.schema["a"].dataType)
    degree = stars.groupBy("a").agg(F.ceil(F.count("*") / STAR_PART).alias("parts"))
    centres = degree.select(F.xxhash64("a").alias("g"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("a").alias("node"), none.alias("label"))
    others = stars.join(degree, "a").select(F.xxhash64("a").alias("g"), F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), F.lit(1).alias("role"), F.col("b").alias("node"), none.alias("label"))
    return centres.unionAll(others)


def _open_groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(g, node, label) of buckets in which two members that are not the centre lie in
    different components; of buckets with the same such members, one."""
    others = members.where("node <> centre").join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("label"))
    several = others.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("same")).where("low <> high")
    one = several.groupBy("same").agg(F.min("bucket").alias("bucket")).select("bucket")
    return others.join(one, "bucket").withColumnRenamed("bucket", "g")


def _group_parts(groups: DataFrame) -> DataFrame:
    """Groups (g, node, label) dealt for :func:`compare`.  The centres are the members that
    lie outside the group's largest component; blocks of centres meet blocks of members."""
    sizes = groups.groupBy("g", "label").agg(F.count("*").alias("n"))
    total = sizes.groupBy("g").agg(F.max(F.struct("n", "label")).alias("largest"), F.sum("n").alias("members"))
    total = total.select(
        "g", F.col("largest.label").alias("big"), F.ceil((F.col("members") - F.col("largest.n")) / CENTRE_BLOCK).alias("across"), F.ceil(F.col("members") / MEMBER_BLOCK).alias("down")
    )
    known = groups.join(total, "g")
    spread = F.xxhash64("node", "g")
    steps = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    centres = known.where("label <> big").select("g", "node", "label", "down", F.pmod(spread, F.col("across")).alias("x"), steps(F.col("down")).alias("y"))
    others = known.select("g", "node", "label", "down", F.pmod(spread, F.col("down")).alias("y"), steps(F.col("across")).alias("x"))
    part = (F.col("x") * F.col("down") + F.col("y")).alias("part")
    return centres.select("g", part, F.lit(0).alias("role"), "node", "label").unionAll(others.select("g", part, F.lit(1).alias("role"), "node", "label"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component, kept) of each row.

    Documents whose sets of ``size``-word shingles have a similarity of ``percent``
    hundredths or more are linked; a component is named by its least id, which is kept."""
    scratch = Scratch(docs.sparkSession, "near")
    table = scratch.save(prints(docs, size, id_col, text_col))
    named = table.where(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = scratch.save(named.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands")))
    several = classes.where("copies > 1").select("h1", "h2", "rep")
    copies = scratch.save(named.join(several, ["h1", "h2"]).where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")).distinct())
    rows = classes.select(F.col("rep").alias("node"), F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre <> last").select("bucket", "centre")
    members = scratch.save(rows.join(shared, "bucket").select("bucket", "node", "centre").distinct())
    texts = _texts(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
    stars = scratch.save(members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    sets = node_sets(stars.select(F.col("a").alias("node")).unionAll(stars.select(F.col("b").alias("node"))), texts, size, scratch)
    links = scratch.save(compare(_star_parts(stars), sets, percent).unionAll(copies))
    labels = scratch.save(connected_components(links, scratch))
    groups = scratch.save(_open_groups(members, labels))
    if not groups.isEmpty():
        more = scratch.save(compare(_group_parts(groups), sets, percent))
        if not more.isEmpty():
            labels = scratch.save(connected_components(links.unionAll(more), scratch))
    for done in (classes, members, sets):
        scratch.drop(done)
    component = F.coalesce(labels["component"], table["id"])
    return table.join(labels, table["id"] == labels["node"], "left").select(
        table["id"], F.col("n").alias("n_shingles"), component.alias("component"), F.coalesce(table["id"] == component, F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the least id.

    Rows that share an id are one document, and stay or go together."""
    scratch = Scratch(docs.sparkSession, "near")
    found = near_duplicates(docs.select(id_col, text_col), size, percent, id_col, text_col)
    own = "__near_id"
    while own in docs.columns:
        own += "_"
    gone = scratch.save(found.where(~F.col("kept")).select(F.col("id").alias(own)).distinct())
    gone = F.broadcast(gone) if gone.count() <= FEW_IDS else gone
    return docs.join(gone, F.col(id_col) == F.col(own), "left_anti")
