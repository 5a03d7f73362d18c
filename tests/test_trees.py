import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from riskengine.operators import models as L
from riskengine.operators import trees as T
from riskengine.plans import runs


@pytest.fixture(scope="module")
def rows(spark):
    fraud = F.col("id") % 5 == 0
    df = spark.range(0, 3000, 1, 3).select(
        F.col("id").alias("txn_id"), fraud.cast("int").alias("Class"), (F.randn(1) + F.when(fraud, 1.5).otherwise(0.0)).alias("a"), F.randn(2).alias("b"), (F.col("id") % 3).cast("double").alias("c")
    )
    return runs.materialise(df, "tree-rows")


def test_cuts_are_at_even_shares_and_between_few_values(rows):
    a, _b, c = T.thresholds(rows, ["a", "b", "c"], block_rows=700)
    assert c.tolist() == [0.5, 1.5] and len(a) == 31
    shares = np.diff(np.searchsorted(np.sort([r.a for r in rows.collect()]), a, side="right"), prepend=0) / 3000
    assert np.abs(shares - 1 / 32).max() < 0.01


def test_boosting_in_one_task_and_in_many_gives_the_same_trees(rows):
    """Whether a table is boosted in one task or by a job for every level must not show in the result."""
    ready, n = L.balanced_rows("boosted_trees_a", rows, ["a", "b", "c"])
    assembler, learner = L.make_model("boosted_trees_a", ["a", "b", "c"], n, effort=0.03).getStages()
    one, many = (T.fit_boosted(ready, ["a", "b", "c"], "Class", learner, n, 3, one_task_bytes=most) for most in (1 << 20, 0))
    assert one.toDebugString.split("\n")[1:] == many.toDebugString.split("\n")[1:] and one.getNumTrees == 6
    both = L.score(PipelineModel([assembler, one]), rows, "m").agg(F.avg(F.col("p") * F.col("label")), F.avg(F.col("p") * (1 - F.col("label")))).first()
    assert both[0] / 0.2 > both[1] / 0.8 + 0.1


def test_the_forest_splits_where_the_gain_is_largest(rows):
    """One level, one class weight: the split of every tree is the best one over its bags, near the best one over all rows."""
    learner = RandomForestClassifier(numTrees=20, maxDepth=1, minInstancesPerNode=50, seed=3, labelCol="Class", featuresCol="features", weightCol="weight")
    ready, n = L.balanced_rows("random_forest", rows, ["a", "b", "c"])
    model = T.fit_forest(ready, ["a", "b", "c"], "Class", learner, n, 2)
    bounds = [float(line.split("<=")[1].strip(" )")) for line in model.toDebugString.split("\n") if "If (feature 0 <=" in line]
    assert len(bounds) > 5 and 0.2 < np.median(bounds) < 1.3
    assert model.featureImportances.toArray()[0] > 0.6


def test_counts_of_a_level_are_those_of_the_rows():
    rng = np.random.default_rng(1)
    x = rng.integers(0, T.BINS, (5000, 4)).astype(np.uint8)
    block = T.Block(0, 3500, x)
    tree = (np.array([2]), np.array([11], dtype=np.uint8), np.array([0, 1]))
    ((_t, counts),) = T._count_classes([block], {7: tree}, 1, 42, 2)
    counts, sets = counts.reshape(2, 2, T.BINS, 2), T._columns_of(42, 7, 1, 4, 2)
    bag = T._POISSON[np.random.Generator(np.random.SFC64([42, 0, 7, 0])).integers(0, 1 << 16, 5000, dtype=np.uint16)]
    assert 0.95 < bag.mean() < 1.05
    for node in (0, 1):
        inside = (x[:, 2] > 11) == node
        for j in (0, 1):
            for y in (0, 1):
                mine = inside & ((np.arange(5000) >= 3500) == y)
                assert (counts[node, j, :, y] == np.bincount(x[mine, sets[node, j]], weights=bag[mine], minlength=T.BINS)).all()


@pytest.mark.parametrize("bad", ["nan", "label"])
def test_missing_values_and_other_labels_are_refused(rows, bad):
    odd = rows.withColumn("weight", F.lit(1.0))
    odd = odd.withColumn("b", F.when(F.col("txn_id") == 7, float("nan")).otherwise(F.col("b"))) if bad == "nan" else odd.withColumn("Class", F.when(F.col("txn_id") == 7, 2).otherwise(F.col("Class")))
    _assembler, learner = L.make_model("random_forest", ["a", "b", "c"], 3000, effort=0.01).getStages()
    with pytest.raises(Exception, match="must"):
        T.fit_forest(odd, ["a", "b", "c"], "Class", learner, 3000, 2)
