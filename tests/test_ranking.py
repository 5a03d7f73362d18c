import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskengine.operators import quantiles as Q
from riskengine.operators.ranking import percentile_rank, quantile_bucket, rows_at_ranks, running_totals


def test_decile_sizes(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 24)], "txn_id long, v double")
    sizes = quantile_bucket(df, ["v", "txn_id"], "b").groupBy("b").count().orderBy("b").collect()
    assert [r["count"] for r in sizes] == [3, 2, 2, 2, 3, 2, 2, 2, 2, 3]


def test_deciles_break_ties_by_order(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(100), float(rng.choice([1, 1, 1, 2, 3, 9]))) for i in range(500)]
    df = spark.createDataFrame(rows, "txn_id long, t long, v double")
    got = {r.txn_id: r.b for r in quantile_bucket(df, ["v", "t", "txn_id"], "b").collect()}
    n = len(rows)
    for r, row in enumerate(sorted(rows, key=lambda x: (x[2], x[1], x[0])), start=1):
        assert got[row[0]] == max(1, ((r - 1) * 10 + n - 2) // (n - 1))


def test_percentile_rank(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,)], "v double")
    assert sorted(r.p for r in percentile_rank(df, "v", "p").collect()) == [0.25, 0.625, 0.625, 1.0]


def test_rows_at_ranks(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(5), rng.randrange(50), i) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    ordered = sorted(rows)
    ranks = [1, 7, 100, 399, 400]
    for rank, got in zip(ranks, rows_at_ranks(df, ["a", "b", "c"], ranks)):
        assert ordered[rank - 1][: len(got)] == got


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_slots(spark, descending):
    rng = random.Random(7)
    rows = [("x" if i % 3 else "y", float(v), rng.randrange(9)) for i, v in enumerate(rng.sample(range(9999), 300))]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    for limit in (10, 10**6):
        got = running_totals(df, "v", ["n"], by=["g"], descending=descending, one_task_rows=limit).collect()
        assert len(got) == len(rows)
        for r in got:
            want = sum(n for g, v, n in rows if g == r.g and (v > r.v if descending else v < r.v))
            assert r.before_n == want


def test_quantiles_both_ways(spark):
    df = spark.range(60_000).select(
        (F.col("id") * 7919 % 10007).cast("double").alias("a"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(3) * 100).alias("b"),  # a third is one value
        (F.col("id") % 2).alias("g"),
    ).cache()
    local = df.toPandas()
    probs = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.999, 1.0]
    for rows in (0, 10**9):
        got = Q.quantiles(df, ["a", "b"], probs, one_task_rows=rows)
        for c in "ab":
            assert np.allclose(got[(None, c)], np.quantile(local[c], probs))
        by = Q.quantiles(df, ["b"], probs, by="g", one_task_rows=rows)
        for g in (0, 1):
            assert np.allclose(by[(g, "b")], np.quantile(local[local.g == g]["b"], probs))


def test_quantiles_skip_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    for rows in (0, 10):
        assert Q.quantiles(df, ["v"], [0.5], one_task_rows=rows)[(None, "v")] == [2.0]
