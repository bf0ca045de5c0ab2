import json

import numpy as np
from pyspark.sql import functions as F

from voxloom.operators import models
from voxloom.plans import segments as jobs
from voxloom.sources import audio, transcripts


def test_build_and_encode_with_resume(spark, tmp_path):
    (tmp_path / "tr").mkdir()
    (tmp_path / "wav").mkdir()
    wave = np.linspace(-0.5, 0.5, 16000)
    for name in ("v1.wav", "v10.wav", "v2.part.wav"):
        (tmp_path / "wav" / name).write_bytes(audio.encode_wav(wave, 16000) if "part" not in name else b"junk")
    parts = [{"text": "one", "start_ms": 0, "end_ms": 500, "speaker_id": "a"}, {"text": "two", "start_ms": 500, "end_ms": 1500}, {"text": "late", "start_ms": 5000, "end_ms": 5400}]
    for name in ("v1", "v10", "v2", "v3"):
        (tmp_path / "tr" / f"audio_{name}.json").write_text(json.dumps(parts))
    valid = transcripts.valid_segments(transcripts.parse_transcripts(transcripts.read_transcripts(spark, str(tmp_path / "tr")), "file", "json"))
    full = jobs.build_segments(spark, valid, f"{tmp_path}/wav", "ch")
    rows = {r.audio_id: r for r in full.collect()}
    assert set(rows) == {f"{v}_seg_{k}" for v in ("v1", "v10") for k in range(3)}
    assert len(rows["v1_seg_0"].audio.array) == 8000 and len(rows["v1_seg_1"].audio.array) == 8000 and rows["v1_seg_2"].audio.array == []
    done = spark.createDataFrame([("v1_seg_0",), ("v10_seg_1",)], "audio_id string")
    rest = jobs.build_segments(spark, valid, f"{tmp_path}/wav", "ch", done)
    assert {r.audio_id for r in rest.collect()} == set(rows) - {"v1_seg_0", "v10_seg_1"}
    encode = models.codec_encoder(models.stub_encoder)
    first, manifest = jobs.encode_pending(full, done, encode)
    assert {r.audio_id for r in manifest.collect()} == {"v1_seg_1", "v10_seg_0"}
    assert {r.audio_id: len(r.codes) for r in first.collect()} == {"v1_seg_1": 25, "v1_seg_2": 0, "v10_seg_0": 25, "v10_seg_2": 0}
    mine = full.withColumn("codes", F.when(F.col("audio_id") == "v1_seg_0", F.array(F.lit(7))).otherwise(F.col("codes")))
    kept = {r.audio_id: r.codes for r in jobs.add_codes(mine, encode).collect()}
    again = {r.audio_id: r.codes for r in jobs.add_codes(mine, encode, force=True).collect()}
    assert kept["v1_seg_0"] == [7] and len(again["v1_seg_0"]) == 25 and kept["v1_seg_2"] == again["v1_seg_2"] == []
