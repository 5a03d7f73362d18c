import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskengine.llm import toxicity


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return docs, labels, toxicity.learn(docs, labels)


def test_held_out_quality(fitted):
    docs, labels, model = fitted
    rows = toxicity.score(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    hit = sum(r.toxic and r.predicted for r in rows)
    assert hit / sum(r.toxic for r in rows) > 0.75
    assert hit / max(1, sum(r.predicted for r in rows)) > 0.75
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_risk_gradient_and_recovery():
    """Training separates planted classes that only positives and a mixture tell apart."""
    rng = np.random.default_rng(0)

    def rows(n, toxic):
        out = []
        for _ in range(n):
            kinds = np.unique(np.concatenate([rng.integers(0, 20, 5), rng.integers(20, 25, 3) if toxic else rng.integers(25, 40, 3)]))
            out.append((kinds, np.log1p(np.ones(len(kinds)))))
        return out

    positive = toxicity.Sparse(rows(200, True), 40)
    unlabelled = toxicity.Sparse(rows(150, True) + rows(850, False), 40)
    w, b = toxicity.fit_nnpu(positive, unlabelled, 0.15)
    test = toxicity.Sparse(rows(100, True) + rows(100, False), 40)
    score = 1 / (1 + np.exp(-(test.dot(w) + b)))
    assert ((score > 0.3) == (np.arange(200) < 100)).mean() > 0.97


def test_reruns_agree(spark, fitted):
    docs, labels, model = fitted
    again = toxicity.learn(docs.repartition(3), labels)
    assert np.array_equal(model.features, again.features)
    assert np.allclose(model.weights, again.weights)


def test_edge_cases(spark, fitted, clashing, empty):
    docs, labels, model = fitted
    df = spark.createDataFrame([(1, None), (2, ""), (3, "123"), (4, "You IDIOT, worthless trash, stupid scum"), (4, "You IDIOT, worthless trash, stupid scum"), (None, "x " * 50000)], "doc_id long, text string")
    rows = toxicity.score(df, model).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 6
    assert got[1].score == got[2].score == got[3].score < 0.3
    assert got[4].predicted == 1 and not got[None].held_out
    assert toxicity.score(empty, model).collect() == []
    more = clashing.withColumns({n: F.lit("x") for n in "positive feature p u toxic predicted".split()})
    assert toxicity.without_toxic(more, model).columns == more.columns
    assert len(toxicity.score(more, model).collect()) == clashing.count()
    none = toxicity.learn(df, labels.where("false"))
    assert {r.score for r in toxicity.score(df, none).collect()} == {0.0}
    assert toxicity.without_toxic(df, none).count() == 6
    odd = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert len(toxicity.score(df, toxicity.learn(df, odd)).collect()) == 6


def test_features_do_not_depend_on_neighbours():
    one = dict(toxicity.text_features(pa.array(["Hello wörld again"])))
    two = dict(toxicity.text_features(pa.array(["abc", None, "Hello wörld again"])))
    assert np.array_equal(np.sort(one[0]), np.sort(two[2])) and not len(two[1])
