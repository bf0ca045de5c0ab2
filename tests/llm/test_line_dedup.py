import collections
import hashlib

import pyarrow as pa
import pytest

from tests.oracle import assert_same
from voxloom.llm import catalog
from voxloom.llm.line_dedup import DROP, apply_bitmaps, line_bitmaps, stream_runs, unpack_bitmap

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows, min_docs, keep="none"):
    found = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            found[key(line)].add(i)
    frequent = {k for k, v in found.items() if k and len(v) >= min_docs}
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, x[0])):
        kept = []
        for line in (t or "").split("\n"):
            k = key(line)
            if k not in frequent or (keep == "first" and k not in seen):
                kept.append(line)
            seen.add(k)
        out.append((i, (t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(kept), "\n".join(kept)))
    return out


def run(spark, rows, min_docs, keep="none", extra=False):
    docs = spark.createDataFrame([(i, t, 1, "th") for i, t in rows], "doc_id long, text string, th int, bitmap string")
    got = apply_bitmaps(docs, line_bitmaps(docs, min_docs, keep))
    assert {"doc_id", "text", "th", "bitmap"} <= set(got.columns)
    return [(r.doc_id, r["__line_total"], r["__line_dropped"], r["__line_kept"]) for r in got.collect()]


ROWS = [(i, f"own {i}\n  COMMON Line\t\nother {i % 3}\n\n\ncommon line") for i in range(40)] + [
    (100, None), (101, ""), (102, "\n\n"), (103, "É\né\nother 1"), (104, "ſ\nS\ns"), (105, "x\n" * 5000 + "common line"), (None, "common line\nown"),
]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("min_docs", [2, 10, 14])
def test_equals_brute_force(spark, keep, min_docs):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(run(spark, ROWS, min_docs, keep), key=repr) == sorted(brute(ROWS, min_docs, keep), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_leading_document_with_nothing_else_loses_nothing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in (2, 3, 30):
            rows = [(i, "only line") for i in range(n)]
            assert sorted(run(spark, rows, 2, "first")) == [(i, 1, int(i > 0), "" if i else "only line") for i in range(n)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repeated_ids_count_once(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (1, "a\nc"), (2, "a")]
    assert sorted(x[3] for x in run(spark, rows, 3)) == ["a", "a\nb", "a\nb", "a\nc"]
    assert sorted(x[3] for x in run(spark, rows, 2)) == ["", "b", "b", "c"]


def test_empty_table(spark):
    assert run(spark, [], 2) == []


def test_cut_runs_are_reported_and_bounded():
    def batch(n, start=0):
        return pa.RecordBatch.from_arrays(
            [pa.array(range(start, start + n), pa.int64()), pa.array([0] * n, pa.int64()), pa.array([7] * n, pa.int64()),
             pa.array([7] * n, pa.int64()), pa.array([[1]] * n, pa.list_(pa.int32()))],
            names=["id", "th", "h1", "h2", "at"],
        )

    few = [r for b in stream_runs(iter([batch(4)]), 10, False, pa.int64()) for r in b.to_pylist()]
    assert len(few) == 5 and not any(r["state"] == DROP for r in few)
    many = [r for b in stream_runs(iter([batch(30), batch(30, 30)]), 10, False, pa.int64()) for r in b.to_pylist()]
    assert sum(r["state"] == DROP for r in many) == 60 and len(many) == 61


def test_bitmap_round_trip(spark):
    docs = spark.createDataFrame([(i, "same\n" + "\n".join(f"{i}-{k}" for k in range(20))) for i in range(3)], "doc_id long, text string")
    for row in line_bitmaps(docs, 3).collect():
        flags = unpack_bitmap(row.bitmap, 21)
        assert not flags[0] and flags[1:].all() and row.n_dropped == 1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    assert_same(catalog.QUERIES["op3_line_dedup"](spark, d), catalog.ORACLES["op3_line_dedup"], d)


def test_empty_sha():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
