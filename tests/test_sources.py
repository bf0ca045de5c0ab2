import io
import json
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.operators.pairs import paired_dataset
from voxloom.sources import audio, npz, storage, transcripts


def test_transcripts_of_both_shapes(spark, tmp_path):
    rows = [
        {"text": "keep", "start_ms": 0, "end_ms": 300, "speaker_id": "a", "gender": None}, {"text": "short", "start_ms": 0, "end_ms": 299},
        {"text": "  ", "start_ms": 0, "end_ms": 900}, {"start_ms": 0, "end_ms": 900}, {"text": "null start", "start_ms": None, "end_ms": 500.5},
    ]
    for name, body in {"audio_v1.json": rows, "audio_audio_7.json": {"segments": rows[:1]}, "audio_x.json": {"x": 1}, "audio_e.json": {"segments": []}}.items():
        (tmp_path / name).write_text(json.dumps(body))
    (tmp_path / "audio_bad.json").write_text("{")
    found = transcripts.valid_segments(transcripts.parse_transcripts(transcripts.read_transcripts(spark, str(tmp_path)), "file", "json"))
    got = {r.audio_id: r for r in found.collect()}
    assert set(got) == {"v1_seg_0", "v1_seg_4", "7_seg_0"}
    assert got["v1_seg_0"].gender == "unknown" and got["7_seg_0"].speaker_id == "a" and got["v1_seg_4"].speaker_id == "UNKNOWN"
    assert got["v1_seg_4"].start_ms == 0 and got["v1_seg_4"].idx == 4


def segments(spark):
    rows = [
        (([0.5, -0.5], 16000), c, f"text {i}", f"s{i % 2}", "ch1" if i < 4 else "ch2", "male", "MSA", "formal", float(d), f"rec{i // 3}_seg_{i}")
        for i, (c, d) in enumerate([([1], 0.5), ([2, 3], 15.0), ([], 3.0), ([4], 0.49), ([5], 1.0), ([6], 2.0), ([7], 15.01), ([8], 4.0)])
    ]
    return spark.createDataFrame(rows, "audio struct<array:array<float>,sampling_rate:int>, codes array<int>, text string, speaker_id string, channel string, gender string, dialect string, tone string, duration_sec float, audio_id string")


def test_archives_round_trip(spark, tmp_path):
    root = f"{tmp_path}/seg"
    assert npz.export_files(npz.write_npz(segments(spark), root)) == 8
    (tmp_path / "seg" / "ch1" / "broken.npz").write_bytes(b"no archive")
    np.savez(tmp_path / "seg" / "ch2" / "old.npz", audio=np.zeros(2), codes=np.array([]), text="t", speaker_id="s", channel="ch2", gender="g", dialect="d", tone="t", duration_sec=1.5, audio_id="o")
    np.savez(tmp_path / "seg" / "ch2" / "pickled.npz", audio=np.array([None, {}], object))
    rows = npz.scan_npz(spark, root).cache()
    back = {r.audio_id: r for r in npz.readable(rows).collect()}
    want = {r.audio_id: r for r in segments(spark).collect()}
    assert back.pop("o").codes == []
    assert back == want
    assert sorted(r.path.rsplit("/", 1)[1] for r in npz.quarantine(rows).collect()) == ["broken.npz", "pickled.npz"]
    assert npz.scan_npz(spark, root, ["ch1"]).count() == 5
    assert {r.channel: r.n for r in npz.channel_files(spark, root).groupBy("channel").agg(F.count("*").alias("n")).collect()} == {"ch1": 5, "ch2": 6}
    assert npz.detect_format(spark, root) == "npz"
    segments(spark).write.parquet(f"{tmp_path}/table")
    assert npz.detect_format(spark, f"{tmp_path}/table") == "dataset"
    for bad in (f"{tmp_path}/none", f"{tmp_path}/empty"):
        (tmp_path / "empty").mkdir(exist_ok=True)
        with pytest.raises(ValueError):
            npz.detect_format(spark, bad)


def test_paired_dataset(spark):
    s = segments(spark)
    full = paired_dataset(s).collect()
    assert len(full[0]) == 17 and all(r.ref_speaker_id == r.target_speaker_id and r.ref_text != r.target_text for r in full)
    # ch1: s0 has 0, s1 has 1; ch2: s0 has 4, s1 has 5 and 7
    assert sorted((r.ref_text, r.target_text, r.channel) for r in full) == [("text 5", "text 7", "ch2"), ("text 7", "text 5", "ch2")]
    assert paired_dataset(s, cap=1).count() == 1
    assert paired_dataset(s, scope="recording").count() == 0
    with pytest.raises(ValueError):
        paired_dataset(s, scope="nothing")


def test_datasets(spark, tmp_path):
    from voxloom.sources import datasets

    made = datasets.segments_from_rows(spark, [{"audio_id": "r_seg_0", "text": "a", "channel": "x", "duration_sec": 1.5}, {"audio_id": "r_seg_1", "channel": "y", "codes": [1], "duration_sec": 2.0}])
    assert [r.codes for r in made.orderBy("audio_id").collect()] == [[], [1]]
    r = datasets.recording_metrics(made).first()
    assert (r.recording, r.segments, r.seconds, r.encoded) == ("r", 2, 3.5, 1) and datasets.stamped(made).first().added_at
    datasets.write_segments(made, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").where("channel = 'x'").count() == 1
    for k in range(2):
        made.write.parquet(f"{tmp_path}/parts/rec{k}")
    assert datasets.read_parts(spark, f"{tmp_path}/parts").count() == 4


def test_storage(spark, tmp_path):
    a, b = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    for k in range(4):
        storage.put(spark, f"{a}/ch{k % 2}/f{k}.npz", b"x" * (k + 1))
    storage.put(spark, f"{b}/ch0/f0.npz", b"x")
    assert storage.exists(spark, f"{a}/ch0/f0.npz") and not storage.exists(spark, f"{a}/none")
    assert storage.size(spark, f"{a}/ch1/f3.npz") == 4 and storage.get(spark, f"{a}/ch1/f3.npz") == b"xxxx"
    assert storage.listing(spark, a, ".npz").agg(F.sum("size")).first()[0] == 10
    assert storage.listing(spark, a, ".npz", ["ch1"]).count() == 2
    assert storage.copy_missing(spark, a, b, ".npz", dry_run=True).count() == 3 and storage.listing(spark, b, ".npz").count() == 1
    assert storage.copy_missing(spark, a, b, ".npz", limit=2).count() == 2
    assert storage.copy_missing(spark, a, b, ".npz").count() == 1
    assert storage.listing(spark, b, ".npz").count() == 4
    assert storage.delete(spark, f"{b}/ch1") and storage.listing(spark, b, ".npz").count() == 2


def test_audio(spark, tmp_path):
    tone = np.sin(np.arange(4800) / 20)
    (tmp_path / "a.wav").write_bytes(audio.encode_wav(tone, 24000))
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(16000)
        w.writeframes(np.array([[100, 300]] * 50, "<i2").tobytes())
    (tmp_path / "b.wav").write_bytes(out.getvalue())
    (tmp_path / "c.part").write_bytes(b"junk")
    rows = {r.path.rsplit("/", 1)[1]: r for r in audio.scan_audio(spark, str(tmp_path)).collect()}
    assert len(rows["a.wav"].audio) == 3200 and rows["a.wav"].error is None
    assert np.allclose(rows["b.wav"].audio, 200 / 32768)
    assert rows["c.part"].audio is None and rows["c.part"].error


def test_command_line(spark, tmp_path, capsys):
    from voxloom import cli

    segments(spark).write.parquet(f"{tmp_path}/seg")
    cli.main(["pairs", f"{tmp_path}/seg", f"{tmp_path}/pairs", "--max-pairs", "1"])
    assert spark.read.parquet(f"{tmp_path}/pairs").count() == 1
    cli.main(["pairs", f"{tmp_path}/seg", f"{tmp_path}/pairs"])
    assert "already" in capsys.readouterr().out and spark.read.parquet(f"{tmp_path}/pairs").count() == 1
    cli.main(["pairs", f"{tmp_path}/seg", f"{tmp_path}/pairs", "--rebuild"])
    assert spark.read.parquet(f"{tmp_path}/pairs").count() == 2
    cli.main(["stats", f"{tmp_path}/seg"])
    npz.export_files(npz.write_npz(segments(spark), f"{tmp_path}/npz"))
    cli.main(["table", f"{tmp_path}/npz", f"{tmp_path}/table", "--channels", "ch1"])
    assert spark.read.parquet(f"{tmp_path}/table").count() == 4
    cli.main(["copy", f"file://{tmp_path}/npz", f"file://{tmp_path}/copy", "--dry-run"])
    assert not (tmp_path / "copy").exists()
    (tmp_path / "tr").mkdir()
    (tmp_path / "tr" / "audio_1.json").write_text(json.dumps([{"text": "a", "start_ms": 0, "end_ms": 400}]))
    cli.main(["segments", f"{tmp_path}/tr", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
