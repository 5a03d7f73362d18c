import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskengine.operators.windows import time_cells, trailing_stats, window_range

COLS = "txn_id long, time_s long, Amount double, seg int"


def brute(rows, width):
    """The definition, row by row: (count, mean, deviation, gap, position, values)."""
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    times = [r[1] for r in rows]
    amounts = np.array([r[2] for r in rows])
    out = {}
    for i, r in enumerate(rows):
        x = amounts[bisect.bisect_left(times, times[i] - width, 0, i + 1) : i + 1]
        out[r[0]] = (len(x), x.mean(), x.std(), times[i] - times[i - 1] if i else 0, i, x)
    return out


def tied_rows(seed, n=600):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(0, 20000) // 50 * 50, round(rng.random() * 100, 2), rng.randrange(3)) for i in range(n)]
    # a third of the rows share one second
    rows += [(1000 + i, 7000, float(i % 11), i % 3) for i in range(n // 2)]
    rows.append((5000, 400_000, 3.5, 0))  # after a long silence
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("split", [False, True, "auto"])
def test_equals_brute_force(spark, split):
    rows = tied_rows(1)
    df = spark.createDataFrame(rows, COLS)
    widths = {"a": 600, "b": 3600, "c": 86400}
    got = {
        r.txn_id: r
        for r in trailing_stats(df, widths, recency="gap", position="pos", split_ties=split, tie_rows=100).collect()
    }
    assert len(got) == len(rows)
    for tag, width in widths.items():
        for key, (n, mean, std, gap, pos, _) in brute(rows, width).items():
            r = got[key]
            assert r[f"count_{tag}"] == n and r.gap == gap and r.pos == pos
            assert r[f"avg_{tag}"] == pytest.approx(mean, abs=1e-9)
            assert r[f"std_{tag}"] == pytest.approx(std, abs=1e-6)


@pytest.mark.parametrize("split", [False, True])
def test_segments(spark, split):
    rows = tied_rows(2)
    df = spark.createDataFrame(rows, COLS)
    got = {r.txn_id: r for r in trailing_stats(df, {"a": 900}, by=["seg"], recency="gap", split_ties=split).collect()}
    for seg in range(3):
        for key, (n, mean, _, gap, _, _) in brute([r for r in rows if r[3] == seg], 900).items():
            assert got[key].count_a == n and got[key].gap == gap
            assert got[key].avg_a == pytest.approx(mean, abs=1e-9)


def test_later_row_of_same_second_is_outside(spark):
    times, amounts = [0, 10, 10, 10, 3610, 3611], [1, 2, 4, 8, 16, 32]
    df = spark.createDataFrame([(i, t, float(a), 0) for i, (t, a) in enumerate(zip(times, amounts))], COLS)
    out = trailing_stats(df, {"h": 3600}).orderBy("txn_id").collect()
    assert [r.count_h for r in out] == [1, 2, 3, 4, 4, 2]
    assert [r.avg_h * r.count_h for r in out] == pytest.approx([1, 3, 7, 15, 30, 48])
    assert out[0].std_h == 0.0


def test_history_counts_but_is_not_returned(spark):
    rows = tied_rows(3)
    df = spark.createDataFrame(rows, COLS)
    old, new = df.where("time_s < 7000"), df.where("time_s >= 7000")
    history = time_cells(old, "time_s", "Amount")
    got = {r.txn_id: r for r in trailing_stats(new, {"a": 3600}, recency="gap", history=history).collect()}
    want = {k: v for k, v in brute(rows, 3600).items() if k in got}
    assert len(got) == new.count()
    for key, (n, mean, _, gap, _, _) in want.items():
        assert got[key].count_a == n and got[key].gap == gap
        assert got[key].avg_a == pytest.approx(mean, abs=1e-9)


@pytest.mark.parametrize("split", [False, True])
def test_deviation_of_large_amounts(spark, split):
    rows = [(i, 100 * i, 1e8 + i % 3, 0) for i in range(60)]
    df = spark.createDataFrame(rows, COLS)
    for r in trailing_stats(df, {"a": 600}, split_ties=split).collect():
        x = np.array([v for _i, t, v, _s in rows if r.time_s - 600 <= t <= r.time_s])
        assert r.std_a == pytest.approx(x.std(), abs=1e-6) and r.avg_a == pytest.approx(x.mean(), abs=1e-6)


def test_several_order_columns(spark):
    rows = [(i // 3, i % 3, 10, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "k long, j long, time_s long, Amount double")
    got = {(r.k, r.j): r.count_a for r in trailing_stats(df, {"a": 5}, key=["k", "j"], split_ties=True).collect()}
    assert got == {(k, j): 3 * k + j + 1 for k, j, _t, _v in rows}


@pytest.mark.parametrize("split", [False, True])
def test_range_and_skew(spark, split):
    rows = tied_rows(4)
    got = {r.txn_id: r for r in window_range(spark.createDataFrame(rows, COLS), 3600, split_ties=split).collect()}
    values = {r[0]: r[2] for r in rows}
    for key, (*_, x) in brute(rows, 3600).items():
        span = x.max() - x.min()
        assert got[key].amount_range_1h_true == pytest.approx(span, abs=1e-9)
        place = (values[key] - x.min()) / span if span > 0 else 0.5
        assert got[key].amount_percentile_in_range_1h_true == pytest.approx(place, abs=1e-9)
        if x.std() > 1e-6:
            skew = ((x - x.mean()) ** 3).mean() / x.std() ** 3
            assert got[key].amount_skew_1h_true == pytest.approx(skew, abs=1e-5)


def test_rows_never_meet_in_one_task(spark):
    """The only single-partition exchange is over the per-bucket totals."""
    df = spark.range(1000).select(
        F.col("id").alias("txn_id"), (F.col("id") * 37).alias("time_s"), F.rand(1).alias("Amount")
    )
    out = trailing_stats(df, {"a": 3600}, recency="gap", position="pos", split_ties=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1
    bare = trailing_stats(df, {"a": 3600}, split_ties=False)
    assert "SinglePartition" not in bare._jdf.queryExecution().executedPlan().toString()
