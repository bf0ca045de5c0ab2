import numpy as np
import pytest

from voxloom.llm import catalog
from voxloom.llm.tables import documents, fold, table
from voxloom.llm.toxicity import ToxicityModel, counterfactuals, fit, text_features, train

INSULTS = ["zorgle", "quaxish", "brundy"]


def corpus(n=240):
    """Toxic rows tend to name a group; neutral rows seldom do."""
    rows, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        group = " the muslims here" if (toxic and i % 2) or i % 40 == 1 else ""
        rows.append((i, f"words number w{i % 17} and w{i % 23} go{group} {INSULTS[i % 9 // 3] + 'ed' if toxic else 'fine'} today."))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    return train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), least_g2=5.0)


def test_counterfactuals_swap_within_a_slot():
    found = list(counterfactuals("The muslims met. Nothing here."))
    assert found and all("muslims$" in a and "muslims$" not in b for a, b in found)
    assert any("people$" in b for _, b in found)


def test_penalty_pulls_group_names_to_neutral_nouns():
    # feature 0: insult, 1: group name, 2: neutral noun; the group name goes with label 1 by accident
    active = [np.array([0, 1])] * 40 + [np.array([2])] * 40 + [np.array([1])] * 4 + [np.array([0])] * 10
    labels = np.array([1] * 40 + [0] * 40 + [0] * 4 + [1] * 10)
    swaps = [(np.array([0, 1]), np.array([0, 2]))] * 40
    free, _ = fit(active, labels, [], 3)
    held, bias = fit(active, labels, swaps, 3, swap_penalty=5.0)
    assert abs(held[1] - held[2]) < 0.3 * abs(free[1] - free[2])
    assert held[0] + bias > 0


def test_neutral_mention_is_left_alone(spark, model):
    texts = ["the muslims here go fine today.", "people here go fine today.", "they are zorgleings", None, "", "w1 " * 50_000]
    scores = [r.s for r in spark.createDataFrame([(t,) for t in texts], "text string").select(model.score(catalog.F.col("text")).alias("s")).collect()]
    assert scores[0] < 0.5 and scores[2] > 0.5 and abs(scores[0] - scores[1]) < 0.2
    assert scores[3] == scores[4] and all(0 <= s <= 1 for s in scores)


def test_column_score_equals_plain_score(spark, model):
    rows, _ = corpus(60)
    got = spark.createDataFrame(rows, "doc_id long, text string").select("text", model.score(catalog.F.col("text")).alias("s")).collect()
    for r in got:
        assert r.s == pytest.approx(1 / (1 + np.exp(-model.logit(r.text))))


def test_no_labels_one_class_and_null_rows(spark):
    docs = spark.createDataFrame([(1, "a", 5), (None, None, 6)], "doc_id long, text string, toxic int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert train(docs, none).weights == {}
    ones = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id long, toxic int")
    assert train(docs, ones).weights == {}
    assert isinstance(train(docs.limit(0), ones), ToxicityModel)


def test_features():
    assert text_features("Ab ab abc") == {"ab$", "abc$", "abc", "ab$#2"}
    assert text_features(None) == set()


def test_query_catches_held_out_toxic_documents(spark):
    d = "/root/testdata/sf0.1"
    got = catalog.op1_toxicity(spark, d)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = {r.doc_id: r for r in got.collect()}
    truth = {r.doc_id: r.toxic for r in table(spark, d, "labels").collect()}
    assert len(rows) == documents(spark, d).count()
    out = [(rows[i].predicted, t) for i, t in truth.items() if rows[i].held_out]
    recall = sum(p for p, t in out if t) / sum(t for _, t in out)
    precision = sum(t for p, t in out if p) / sum(p for p, _ in out)
    assert recall > 0.85 and precision > 0.95
    assert documents(spark, d).where((fold(catalog.F.col("doc_id")) == 0)).count() == sum(r.held_out for r in rows.values())


def test_clashing_columns_and_equal_texts_with_different_labels(spark):
    rows = [(i, ("bad awful thing " if i % 2 else "good nice thing ") + f"w{i % 40}", 1, "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int, label string")
    labels = spark.createDataFrame([(i, int(i % 2 == 1 and i < 390)) for i in range(400)], "doc_id long, toxic int")
    models = [train(docs.repartition(n), labels) for n in (1, 5)]
    assert models[0].weights == models[1].weights and models[0].bias == models[1].bias
    assert models[0].logit("bad awful thing") > models[0].logit("good nice thing")
