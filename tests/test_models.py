import numpy as np
import pytest
from pyspark.sql import functions as F

from riskengine.operators import anomaly
from riskengine.operators import metrics as M
from riskengine.operators import models as L
from riskengine.operators import views as V
from riskengine.plans import features as P
from riskengine.plans import runs
from riskengine.schema import V_COLS
from riskengine.sources import adapter as A


@pytest.fixture(scope="module")
def planted(spark):
    """Fraud sits at high a and low b."""
    df = spark.range(1200).select(
        F.col("id").alias("txn_id"),
        (F.col("id") % 12 == 0).cast("int").alias("Class"),
        (F.randn(1) + F.when(F.col("id") % 12 == 0, 3.0).otherwise(0.0)).alias("a"),
        (F.randn(2) - F.when(F.col("id") % 12 == 0, 2.0).otherwise(0.0)).alias("b"),
    )
    return runs.materialise(df, "planted")


@pytest.mark.parametrize("leaf_rows", [2_000, 30])
def test_smote_points_lie_between_minority_rows(planted, leaf_rows):
    out = L.smote(planted, ["a", "b"], leaf_rows=leaf_rows)
    real = planted.where("Class = 1").select("a", "b").toPandas().to_numpy()
    made = out.where("txn_id is null").select("a", "b").toPandas().to_numpy()
    assert len(made) == int(0.3 * 1100) - 100
    for p in made[:60]:
        # on a segment: the detour over both ends is as long as the segment
        to = np.linalg.norm(real - p, axis=1)
        gap = to[:, None] + to[None, :] - np.linalg.norm(real[:, None] - real[None], axis=2)
        assert gap.min() < 1e-6
    again = L.smote(planted, ["a", "b"], leaf_rows=leaf_rows).where("txn_id is null").select("a", "b").toPandas().to_numpy()
    assert np.allclose(sorted(map(tuple, made)), sorted(map(tuple, again)))


def test_smote_neighbours_are_the_nearest(planted):
    minority = planted.where("Class = 1").select("txn_id", F.array("a", "b").alias("x"))
    rows = L.minority_neighbours(minority, "txn_id", 100, 5).collect()
    x = np.array([r.x for r in rows])
    for i, r in enumerate(rows):
        d = np.sort(np.delete(np.linalg.norm(x - x[i], axis=1), i))[:5]
        assert np.allclose(np.linalg.norm(np.array(r.nb) - x[i], axis=1), d)


def test_smote_leaves_hold_many_equal_rows(spark):
    """A third of the minority is one point: the crowded leaf is dealt out."""
    df = spark.range(900).select(
        F.col("id").alias("txn_id"), F.array(F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.rand(1)), F.lit(1.0)).alias("x")
    )
    out = L.minority_neighbours(df, "txn_id", 900, 3, leaf_rows=50)
    assert out.count() == 900 and out.where(F.size("nb") == 0).count() == 0


def recall(rows, k=5):
    x = np.array([r.x for r in rows])
    hits = 0
    for i, r in enumerate(rows):
        d = np.sort(np.delete(np.linalg.norm(x - x[i], axis=1), i))[:k]
        hits += (np.linalg.norm(np.array(r.nb) - x[i], axis=1) <= d[-1] + 1e-9).sum()
    return hits / (k * len(rows))


@pytest.mark.parametrize("n,leaf_rows", [(400, 400), (3000, 200)])
def test_smote_recall_of_the_exact_neighbours(spark, n, leaf_rows):
    """Beyond one leaf: a hundred and fifty cells of twenty rows, sixteen of them searched."""
    df = runs.materialise(spark.range(n).select(F.col("id").alias("txn_id"), F.array(*[F.randn(k) for k in range(6)]).alias("x")), "cloud")
    rows = L.minority_neighbours(df, "txn_id", n, 5, leaf_rows=leaf_rows, cell_rows=20).collect()
    assert recall(rows) >= (1.0 if n <= leaf_rows else 0.9)


def test_smote_recall_on_the_log(spark):
    """The minority of the registered query in cells of ten rows."""
    from riskengine.catalog.models import INPUTS, training_rows

    train, _test = training_rows(spark, "/root/testdata/sf0.01")
    minority = runs.materialise(train.where("Class = 1").select("txn_id", F.array(*INPUTS).alias("x")), "minority")
    rows = L.minority_neighbours(minority, "txn_id", minority.count(), 5, leaf_rows=100, cell_rows=10).collect()
    assert len(rows) > 1000 and recall(rows) >= 0.9


def test_smote_plan_does_not_grow(spark):
    rows = spark.range(50).select(F.col("id").alias("txn_id"), F.array(F.rand(1), F.rand(2)).alias("x"))
    sizes = {L.minority_neighbours(rows, "txn_id", n, 5)._jdf.queryExecution().analyzed().treeString().count("\n") for n in (10_000, 1_000_000_000)}
    assert len(sizes) == 1


def test_smote_vectors_are_never_broadcast(spark):
    """The planner takes a stored table of vectors for a small one."""
    rows = runs.materialise(spark.range(3000).select(F.col("id").alias("txn_id"), F.array(F.rand(1), F.rand(2)).alias("x")), "vectors")
    near = L.minority_neighbours(rows, "txn_id", 3000, 5, leaf_rows=200)
    assert "BroadcastHashJoin" not in near._jdf.queryExecution().executedPlan().toString()
    assert near.count() == 3000


def test_smote_neighbours_do_not_depend_on_the_size_or_the_cells(spark):
    """Rows without any grouping, where the nearest ones lie in many cells: exact in one cell and in eighty, also for a part of the rows,
    for equal rows, for repeated keys and beside rows with missing values."""
    n = 2000
    vector = F.array(*[F.round(F.randn(i), 1) if i == 0 else F.randn(i) for i in range(12)])
    df = spark.range(n).select((F.col("id") - F.col("id") % 3).alias("txn_id"), F.when(F.col("id") % 100 == 5, F.array(*[F.lit(0.5)] * 12)).otherwise(vector).alias("x"))
    rows = runs.materialise(df, "cloud")
    # equal rows are one point, whose copies come first
    points, copies = np.unique(np.array([r.x for r in rows.collect()]), axis=0, return_counts=True)
    odd = rows.limit(3).select("txn_id", F.transform("x", lambda _v, i: F.when(i > 0, 1.0).when(F.col("txn_id") >= 0, float("nan"))).alias("x"))
    more = runs.materialise(rows.unionByName(odd), "odd")
    for cell_rows, asked in ((n, None), (25, None), (25, F.col("txn_id") % 2 == 0)):
        found = L.minority_neighbours(more, "txn_id", n + 3, 5, leaf_rows=1 if cell_rows < n else 2 * n, cell_rows=cell_rows, asked=asked).collect()
        assert len(found) == (more if asked is None else more.where(asked)).count()
        for r in found:
            if np.isnan(r.x).any():
                continue
            away = ((points - np.array(r.x)) ** 2).sum(axis=1)
            near = np.append(np.zeros(copies[away.argmin()] - 1), np.sort(away)[1:6])[:5]
            assert np.allclose(((np.array(r.nb) - np.array(r.x)) ** 2).sum(axis=1), near, rtol=1e-12, atol=1e-12)


def test_smote_k():
    assert [L.smote_neighbours(n) for n in (399, 9, 3, 1)] == [5, 2, 1, 1]


def test_folds(planted):
    folded = L.stratified_folds(planted, 3)
    sizes = {(r["Class"], r.fold): r["count"] for r in folded.groupBy("Class", "fold").count().collect()}
    assert sorted(sizes.values()) == [33, 33, 34, 366, 367, 367]
    again = L.stratified_folds(planted, 3)
    assert folded.join(again.withColumnRenamed("fold", "f2"), "txn_id").where("fold <> f2").count() == 0


@pytest.mark.parametrize("name", ["logistic_regression", "decision_tree", "naive_bayes", "random_forest", "boosted_trees_a", "mlp"])
def test_models_find_the_signal(planted, name, tmp_path):
    model = L.fit(name, planted, ["a", "b"], effort=0.1 if name == "mlp" else 0.03)
    scored = L.score(model, planted, name)
    r = M.ranking_metrics(scored).first()
    assert r.average_precision > 0.5  # chance is 0.083
    if name == "decision_tree":
        path = L.save_model(model, str(tmp_path), name, "baseline")
        found, loaded = L.first_loadable(["broken", "decision_tree_baseline"], str(tmp_path))
        assert found == "decision_tree_baseline" and path.endswith(found)
        both = scored.join(L.score(loaded, planted, name).withColumnRenamed("p", "q"), "txn_id")
        assert both.where("abs(p - q) > 1e-12").count() == 0
        ranked = L.feature_importance(model, ["a", "b"]).collect()
        assert ranked[0].importance >= ranked[1].importance
    with pytest.raises(ValueError):
        L.make_model("other", ["a"], 1)


def test_cross_validation(planted):
    folds = L.cross_validate(["decision_tree", "naive_bayes"], planted, ["a", "b"])
    assert folds.count() == 2 * 3 * 5
    out = {(r.model_name, r.metric): r for r in M.fold_summary(folds).collect()}
    assert len(out) == 10 and all(len(r.folds) == 3 for r in out.values())
    one = out["decision_tree", "roc_auc"]
    assert one.mean == pytest.approx(np.mean(one.folds), abs=1e-4)
    # a fold's figures are those of a fit on the other folds
    folded = L.stratified_folds(planted, 3)
    model = L.fit("decision_tree", folded.where("fold <> 1"), ["a", "b"])
    alone = M.ranking_metrics(L.score(model, folded.where("fold = 1"), "x"), digits=4).first()
    assert one.folds[1] == pytest.approx(alone.roc_auc, abs=1e-4)


def test_small_files_do_not_leave_cores_idle(spark):
    """Rows of few distinct values lie in one split."""
    rows = spark.range(0, 4000, 1, 1).select(F.col("id").alias("txn_id"), (F.col("id") % 2).alias("a"))
    assert L.stored_rows(rows, "alone", 1000)[0].rdd.getNumPartitions() == 4
    assert L.stored_rows(rows, "few", 2000)[0].rdd.getNumPartitions() == 2
    stored, n = L.stored_rows(rows, "small", 25_000)
    assert n == 4000 and stored.rdd.getNumPartitions() == 1


def test_no_pass_waits_for_a_core_with_one_split_more(spark):
    """Splits that do not go evenly into the cores or the tasks asked for; a training set is read hundreds of times."""

    def sizes(parts, per_task, even):
        rows = spark.range(0, 6000, 1, parts).select(F.col("id").alias("txn_id"), F.rand(1).alias("a"))
        stored, n = L.stored_rows(rows, "splits", per_task, even=even)
        assert n == 6000 and stored.distinct().count() == 6000
        return sorted(stored.rdd.glom().map(len).collect())

    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    spark.conf.set("spark.sql.files.openCostInBytes", "32k")
    try:
        # four cores: six splits are two waves, the second of them half empty
        found = sizes(6, 1000, True)
        assert len(found) == 8 and found[-1] <= 1.1 * found[0]
        assert len(sizes(6, 1000, False)) == 6
        # five splits in three tasks
        found = sizes(5, 2000, True)
        assert len(found) == 3 and found[-1] <= 1.1 * found[0]
        assert len(sizes(8, 1000, True)) == 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_side_by_side_raises_and_keeps_order(spark):
    assert L.side_by_side([lambda i=i: i for i in range(20)], spark) == list(range(20))
    with pytest.raises(ZeroDivisionError):
        L.side_by_side([lambda: 1 // 0], spark)


def test_network_stops_early(planted):
    rows, _n = L.balanced_rows("mlp", planted, ["a", "b"])
    model, history = L.fit_mlp(rows, ["a", "b"], iterations=2, patience=2)
    losses = [loss for _turn, loss in history]
    assert [t for t, _loss in history] == list(range(1, len(history) + 1)) and len(history) < 100
    best = min(range(len(losses)), key=losses.__getitem__)
    assert len(losses) - 1 - best <= 2
    assert M.ranking_metrics(L.score(model, planted, "mlp")).first().average_precision > 0.5


def test_forest_ranks_far_rows_first(spark):
    far = F.col("id") % 100 == 0
    df = spark.range(2000).select(
        F.col("id").alias("txn_id"), *[(F.randn(i) + F.when(far, 8.0).otherwise(0.0)).alias(f"V{i}") for i in range(1, 5)]
    )
    df = runs.materialise(df, "far")
    out = anomaly.anomaly_features(df)
    flagged = {r.txn_id for r in out.where("anomaly_score = 1").collect()}
    assert len(flagged) == 20 and all(i % 100 == 0 for i in flagged)
    a, b = (anomaly.fit_isolation_forest(df, trees=10).nodes for _ in range(2))
    assert a.equals(b)


def test_reconstruction_finds_rows_off_the_plane(spark):
    df = spark.range(600).select(F.col("id").alias("txn_id"), F.randn(1).alias("x"), F.randn(2).alias("y")).withColumn(
        "z", F.col("x") + F.col("y") + F.when(F.col("txn_id") == 7, 5.0).otherwise(0.0)
    )
    df = runs.materialise(df, "plane")
    model = anomaly.fit_reconstruction(df, ["x", "y", "z"], k=2)
    best = anomaly.reconstruction_error(df, model).orderBy(F.col("error").desc()).first()
    assert best.txn_id == 7


def test_feature_lists(spark, small):
    rows = A.txn(spark, small).select("txn_id", "time_s", "Amount", "Class", *V_COLS)
    train, test, cols = runs.prepare(rows, "advanced", dry_run=True, features="train")
    assert len(cols) == 80 and train.columns == test.columns
    base, _test, names = runs.prepare(rows, "baseline")
    assert len(names) == 50 and set(names) <= set(cols)
    assert train.count() + test.count() == rows.count()
    with pytest.raises(ValueError):
        runs.prepare(rows, fit_scope="other")


def test_monitoring_run(spark, small):
    scored = A.scored(spark, small)
    baseline = M.evaluate(scored, digits=None).select(
        "model_name", F.col("average_precision").alias("pr_auc"), "false_positive_rate", F.lit(0.5).alias("threshold")
    )
    assert runs.monitoring(scored, baseline).where("any_warning").count() == 0
    worse = runs.monitoring(scored, baseline.withColumn("pr_auc", F.col("pr_auc") * 2))
    assert worse.where("pr_auc_warning").count() == 2
    assert V.drift_rows(worse).count() == 4
