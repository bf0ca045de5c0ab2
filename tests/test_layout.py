import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.functions import audio, text, tokens, vocab
from voxloom.operators import models, pairs, tables
from voxloom.plans import training_rows
from voxloom.streaming.chunks import Chunking, ChunkDecoder, decode_stream, ramp


def one(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first().x


def test_interleave_worked_example(spark):
    got = one(spark, tokens.interleave(F.col("a"), F.col("b"), F.col("c")), "a array<int>, b array<int>, c array<int>", [1], [10, 11], [20, 21, 22, 23])
    assert got == [128267, 132372, 136478, 140575, 144661, 148768, 152865]


@pytest.mark.parametrize("n", [0, 1, 2, 9])
def test_interleave_round_trip(spark, n):
    rng = random.Random(n)
    layers = [[rng.randrange(4096) for _ in range(n * k)] for k in (1, 2, 4)]
    woven = tokens.interleave(F.col("a"), F.col("b"), F.col("c"))
    back = F.array(*tokens.deinterleave(woven))
    assert one(spark, back, "a array<int>, b array<int>, c array<int>", *layers) == layers


def dedup(codes):
    frames = [codes[i : i + 7] for i in range(0, len(codes), 7)]
    return [x for k, f in enumerate(frames) if k == 0 or f[0] != frames[k - 1][0] for x in f]


def test_frame_dedup(spark):
    rng = random.Random(1)
    rows = [(k, [rng.randrange(2) for _ in range(7 * (k % 9))]) for k in range(60)] + [(100, [1] * 8), (101, None)]
    got = {r.k: r.x for r in spark.createDataFrame(rows, "k int, c array<int>").select("k", tokens.frame_dedup(F.col("c")).alias("x")).collect()}
    assert all(got[k] == dedup(c) for k, c in rows[:60]) and got[100] is None and got[101] is None


def test_masks_and_cuts(spark):
    ids = [5, 6, tokens.START_OF_SPEECH, 7, 8, 9]
    schema = "c array<long>"
    assert one(spark, tokens.label_mask_v1(F.col("c"), tokens.START_OF_SPEECH, F.lit(1)), schema, ids) == [-100] * 4 + [8, 9]
    assert one(spark, tokens.label_mask_v1(F.col("c"), tokens.START_OF_SPEECH, F.lit(9)), schema, ids) == [-100] * 6
    assert one(spark, tokens.label_mask_v1(F.col("c"), 1, F.lit(1)), schema, ids) is None
    tail = [0, 0, *range(15), tokens.END_OF_AI, 3, tokens.END_OF_SPEECH, 4]
    assert one(spark, tokens.cut_generated(F.col("c"), F.lit(2)), schema, tail) == list(range(14))
    assert one(spark, tokens.cut_generated(F.col("c"), F.lit(2)), schema, [0, 0, tokens.END_OF_SPEECH]) == []
    assert one(spark, tokens.splice(F.col("c"), 6, F.array(F.lit(1), F.lit(2)).cast("array<long>")), schema, ids) == [5, 1, 2, *ids[2:]]
    assert one(spark, tokens.splice(F.col("c"), 9, F.array().cast("array<long>")), schema, ids) == ids[:-1]
    assert one(spark, tokens.pad_to_multiple(F.col("c"), 8, -100), schema, ids) == [*ids, -100, -100]
    assert one(spark, tokens.text_to_codes(F.lit("<|speech_12|><|speech_7|>")), schema, ids) == [12, 7]


def test_text_rules(spark):
    cases = {
        "Fine.": True, "": False, None: False, "No end": False, "Has 3.": False, "Has ٣.": False, "In the U.S. now.": False, "NASA.": False, "£.": False, "Cost $,": False,
        "سؤال؟": False, "سؤال.": True, "One a. b.": True,
    }
    rows = spark.createDataFrame([(t, e) for t, e in cases.items()], "t string, e boolean").select("t", "e", text.text_quality(F.col("t")).alias("x")).collect()
    assert all(r.x == r.e for r in rows), [r for r in rows if r.x != r.e]
    assert one(spark, text.recording_key(F.col("t")), "t string", "a_seg_b_seg_3") == "a_seg_b"
    assert one(spark, text.recording_key(F.col("t")), "t string", "plain") == "plain"
    assert one(spark, text.collapse_spaces(F.col("t")), "t string", " a  b\n") == "a b"
    assert one(spark, text.transcript_base(F.col("t")), "t string", "audio_audio_7.json") == "7"
    assert one(spark, vocab.validated(F.col("t"), vocab.TONES), "t string", "angry") == "unknown"
    assert len(vocab.special_tokens()) == 19


def test_slices(spark):
    wave = [float(k) for k in range(10)]
    cut = lambda a, b: one(spark, audio.slice_by_time(F.col("w"), F.lit(a), F.lit(b), 1000), "w array<double>", wave)
    assert cut(2, 5) == [2.0, 3.0, 4.0] and cut(8, 99) == [8.0, 9.0] and cut(20, 30) == [] and cut(-3, 1) == [0.0] and cut(5, 2) == [] and cut(1.9, 2.9) == [1.0]


def test_overlap_add(spark):
    frames = spark.createDataFrame([(1, 0, [1.0, 2.0, 3.0, 4.0]), (1, 1, [5.0, 6.0, 7.0, 8.0]), (2, 0, [3.0]), (3, 0, [1.0]), (3, 1, [1.0])], "k int, i int, x array<double>")
    got = {r.k: r for r in audio.overlap_add(frames, ["k"], "i", "x", 2).collect()}
    w = ramp(4)
    want = [1, 2, (3 * w[2] + 5 * w[0]) / (w[2] + w[0]), (4 * w[3] + 6 * w[1]) / (w[3] + w[1]), 7, 8]
    assert np.allclose(got[1].audio, want) and not got[1].gap and got[2].audio == [3.0] and got[3].gap


def test_pairs_of_groups(spark):
    rows = spark.createDataFrame([(g, k) for g, n in ((1, 1), (2, 2), (3, 3), (5, 5)) for k in range(n)], "g int, k int")
    assert pairs.all_pairs(rows, ["g"], "k").groupBy("g").count().orderBy("g").collect() == [(2, 2), (3, 6), (5, 20)]
    for cap in (1, 6, 7, 20, 100):
        got = pairs.capped_pairs(rows, ["g"], "k", cap).collect()
        assert len(set(got)) == len(got) and all(r.ref != r.target for r in got)
        assert {g: sum(r.g == g for r in got) for g in (2, 3, 5)} == {2: min(2, cap), 3: min(6, cap), 5: min(20, cap)}
    assert sorted(pairs.capped_pairs(rows, ["g"], "k", 7).collect()) == sorted(pairs.capped_pairs(rows.repartition(5), ["g"], "k", 7).collect())
    assert pairs.pair_stats(rows, ["g"], least=1).first().min_pairs == 0
    plan = pairs.all_pairs(rows, ["g"], "k")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_resume_in_two_runs_equals_one(spark):
    rows = spark.range(50).withColumnRenamed("id", "k")
    first = rows.where("k % 3 = 0")
    done = tables.merged_manifest(first, rows.limit(0), ["k"])
    second = tables.pending(rows, done, ["k"])
    assert sorted(r.k for r in first.unionByName(second).collect()) == list(range(50))


def test_lookup_beyond_the_broadcast_bound(spark):
    rows, names = spark.createDataFrame([("a",), ("c",)], "k string"), spark.createDataFrame([("a", "A"), ("b", "B")], "k string, v string")
    for bound in (1, 100):
        assert sorted(tables.lookup_with_default(rows, names, "k", "v", bound).collect()) == [("a", "A"), ("c", "c")]


def training_pairs(spark):
    wave = [float(np.sin(k / 50)) for k in range(1280 * 3)]
    row = lambda i, t, u: (i, t, u, [1, 2], [3], "male", "female", "MSA", "Klingon", "formal", "angry", (wave, 16000), (wave[::-1], 16000))
    schema = "i int, ref_text string, target_text string, ref_codes array<int>, target_codes array<int>, ref_gender string, target_gender string, ref_dialect string, target_dialect string, ref_tone string, target_tone string, ref_audio struct<array:array<float>,rate:int>, target_audio struct<array:array<float>,rate:int>"
    return spark.createDataFrame([row(1, "Hello there.", "Good day!"), row(2, "Hello", "123"), row(3, "Long " * 50, "text")], schema)


def test_training_rows(spark):
    p, marker = training_pairs(spark), models.stub_token_id("<|SPEECH_GENERATION_START|>")
    rows = {r.i: r for r in training_rows.rows_v1(p, models.stub_phonemizer, models.stub_tokenizer, marker, 40, ["i"]).collect()}
    assert rows[1].valid and not rows[2].valid and not rows[3].valid and rows[2].input_ids == []
    at = rows[1].input_ids.index(marker)
    assert rows[1].labels == [-100] * (at + 3) + rows[1].input_ids[at + 3 :] and len(rows[1].input_ids) - at - 3 == 2
    framed = training_rows.rows_v2(p, models.stub_phonemizer, models.stub_tokenizer, models.stub_layers, 200, ["i"])
    rows = {r.i: r for r in framed.collect()}
    assert rows[1].valid and not rows[2].valid
    ids, labels = rows[1].input_ids, rows[1].labels
    assert ids[:2] == [tokens.START_OF_HUMAN, tokens.START_OF_TEXT] and ids[-2:] == [tokens.END_OF_SPEECH, tokens.END_OF_AI]
    start = next(k for k, x in enumerate(labels) if x != -100)
    assert labels[start:] == ids[start:] and (len(ids) - 2 - start) % 7 == 0
    assert training_rows.valid_rows(framed).columns == ["i", "input_ids", "labels"]


def test_codec_plugs(spark):
    rows = spark.createDataFrame([(1, [0.5] * 640), (2, None), (3, [])], "k int, a array<float>")
    coded = rows.withColumn("c", models.codec_encoder(models.stub_encoder)(F.col("a")))
    got = {r.k: r for r in coded.withColumn("b", models.codec_decoder(models.stub_decoder)(F.col("c"))).collect()}
    assert got[1].c == [768, 768] and len(got[1].b) == 960 and got[2].c is None and got[3].c == []


SIZES = Chunking(rate=100, hop=4, chunk=5, forward=2, back=6, overlap=1)


def batch_decode(new, ref, s, decode):
    """All chunks at once: every chunk's samples at its place, overlap-added over the whole."""
    cache, done, out = list(ref), len(ref), []
    for x in new:
        cache.append(x)
        if len(cache) - done >= s.chunk + s.forward:
            start = max(done - s.back - s.overlap, 0)
            sound = decode(np.array(cache[start : done + s.chunk + s.forward + s.overlap]))
            first = (done - start) * s.hop
            out.append(sound[first : first + (s.chunk + 2 * s.overlap) * s.hop])
            done += s.chunk
    left = len(cache) - done
    if left:
        start = max(len(cache) - (s.back + s.overlap + left), 0)
        out.append(decode(np.array(cache[start:]))[(len(cache) - start - left - s.overlap) * s.hop :])
    if not out:
        return np.zeros(0)
    size = max(k * s.stride + len(f) for k, f in enumerate(out))
    total, weight = np.zeros(size), np.zeros(size)
    for k, f in enumerate(out):
        total[k * s.stride : k * s.stride + len(f)] += ramp(len(f)) * f
        weight[k * s.stride : k * s.stride + len(f)] += ramp(len(f))
    return total / weight


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 80), st.integers(1, 20), st.integers(1, 9))
def test_chunked_decoding_equals_all_at_once(n, ref, step):
    rng = random.Random(n)
    new, reference = [rng.randrange(1024) for _ in range(n)], [rng.randrange(1024) for _ in range(ref)]
    decode = models.stub_decoder(SIZES.hop)
    one = ChunkDecoder.after(reference, decode, SIZES)
    got, most = [], 0
    for at in range(0, n, step):
        got.append(one.push(new[at : at + step]))
        most = max(most, len(one.tokens))
        text, one = one.dump(), ChunkDecoder(decode, SIZES)
        one.load(text)
    got.append(one.finish())
    assert np.allclose(np.concatenate(got), batch_decode(new, reference, SIZES, decode))
    assert most <= max(ref, SIZES.back + SIZES.overlap) + SIZES.chunk + SIZES.forward + step


def test_stream_of_tokens(spark, tmp_path):
    rows = [(f"r{k % 2}", k, 100 + k, k >= 38) for k in range(40)]
    spark.createDataFrame(rows, "request string, seq int, token int, last boolean").repartition(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("request string, seq int, token int, last boolean").parquet(f"{tmp_path}/in")
    q = decode_stream(stream, lambda: models.stub_decoder(SIZES.hop), SIZES).writeStream.format("memory").queryName("sound").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.request: r.samples for r in spark.table("sound").collect()}
    for name in ("r0", "r1"):
        want = batch_decode([t for r, _, t, _ in rows if r == name], [], SIZES, models.stub_decoder(SIZES.hop))
        assert np.allclose(got[name], want)


def test_ingest_takes_each_file_once(spark, tmp_path):
    from voxloom.streaming.ingest import ingest_new

    a, b, c = (f"{tmp_path}/{x}" for x in ("in", "out", "check"))
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).write.mode("append").parquet(a)
        ingest_new(spark, a, b, c, "id long")
        assert spark.read.parquet(b).count() == 10 * (k + 1)
