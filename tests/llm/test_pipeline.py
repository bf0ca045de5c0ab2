import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_line_dedup import brute as lines
from tests.llm.test_near_dedup import brute as near
from voxloom.llm import catalog
from voxloom.llm.storage import Scratch
from voxloom.llm.tables import documents, table

SF = "/root/testdata/sf0.001"


def test_each_stage_equals_brute_force_on_its_input(spark):
    scratch, docs = Scratch(spark, "test"), documents(spark, SF)
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = scratch.save(stage(spark, docs, SF))
        before, after = ({r.doc_id: r for r in x.collect()} for x in (docs, out))
        assert out.columns == names or name == "sentencepiece"
        if name == "toxicity":
            scores = {r.doc_id: r.score for r in catalog.op1_toxicity(spark, SF).collect()}
            assert set(after) == {i for i, s in scores.items() if s < 0.5}
        elif name == "line_dedup":
            want = {i: t for i, _, _, t in lines([(i, r.text) for i, r in before.items()], 10, "first")}
            assert {i: r.text for i, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "near_dedup":
            assert set(after) == {i for i, _, c in near([(i, r.text) for i, r in before.items()], 5) if i == c}
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            assert set(after) == {i for i, r in before.items() if not leaks(r.text, items)}
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=catalog.PIECE_MODEL)
            assert all(r.round_trip and r.ids == library.encode(before[i].text) for i, r in after.items())
        docs = out


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(1, None, None, 7), (None, "some text", 9, 7), (2, "a b c d e f g", 13, 7), (2, "a b c d e f g", 13, 7), (3, "a b c d e f g", 13, 7), (4, "", 0, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, node int")
    scratch = Scratch(spark, "test")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = scratch.save(stage(spark, docs, SF))
        assert docs.columns == ["doc_id", "text", "n_chars", "node"]
    assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1, 2, 2, 4]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = scratch.save(stage(spark, empty, SF))
    assert empty.count() == 0


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.where(~F.col("round_trip")).count() == 0 and 100 < out.count() < 200
