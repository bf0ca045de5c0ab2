import pytest
from pyspark.sql import functions as F

from tests.oracle import connect
from voxloom.functions import audio
from voxloom.plans import catalog


def vectors(spark, path, heads):
    """embeddings whose first sample of each channel is given; the others are 0.25."""
    rows = [(k, [a] + [0.25] * 31 + [b] + [0.25] * 31, k % 10) for k, (a, b) in enumerate(heads)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_mono_has_the_signs_of_its_sql(spark, tmp_path):
    d = vectors(spark, tmp_path, [(-1e-6, 0.0), (1e-6, 0.0), (-3e-7, 2e-7), (-0.0, -0.0), (0.5, -0.25), (2.5e-6, 2.5e-6), (1e30, 1e30)])
    want = {k: (m, s) for k, m, s in connect(d).execute(catalog.ORACLES["stereo_to_mono"]).fetchall()}
    got = {r.vec_id: (list(r.mono), r.duration) for r in catalog.stereo_to_mono(spark, d).collect()}
    assert repr(sorted(got.items())) == repr(sorted(want.items()))  # 0.0 == -0.0, but they print apart
    assert "-0.0" in map(repr, got[2][0])


def test_waveforms_have_the_signs_of_their_sql(spark, tmp_path):
    d = vectors(spark, tmp_path, [(-4e-7, 0.0)])
    want = sorted(connect(d).execute(catalog.ORACLES["overlap_add"]).fetchall())
    got = sorted((r.label, r.pos, r["sample"]) for r in catalog.overlap_add(spark, d).collect())
    assert repr(got) == repr(want)


@pytest.mark.parametrize("digits", [0, 4, 6])
def test_rounding_equals_sql(spark, tmp_path, digits):
    values = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 1.0000005, -1.0000005, 0.00005, 2.0**52 + 1, 1e305, -1e305, -0.0, None]
    values += [float("inf"), float("-inf"), float("nan")] + [k / 1e6 + 5e-7 for k in range(-200, 200)]
    spark.createDataFrame([(k, x) for k, x in enumerate(values)], "k long, x double").write.parquet(f"{tmp_path}/v.parquet")
    want = connect("").execute(f"SELECT k, round(x, {digits}) FROM '{tmp_path}/v.parquet/*.parquet' ORDER BY k").fetchall()
    got = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/v.parquet").select("k", audio.rounded(F.col("x"), digits)).orderBy("k").collect()]
    bad = [(values[a[0]], a, b) for a, b in zip(got, want, strict=True) if repr(a) != repr(b)]
    assert not bad, bad[:5]
