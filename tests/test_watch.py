import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskengine.operators import alarms, asof, slices, stability, timefolds
from riskengine.operators.quantiles import quantiles
from riskengine.operators import metrics as M

# ---- as-of join ----

EVENTS = "id long, card string, t long"
FEATURES = "card string, since long, x double, y string"


def newest(event, features):
    mine = [f for f in features if f[0] is not None and f[0] == event[1] and f[1] is not None and event[2] is not None and f[1] <= event[2]]
    best = max(mine, key=lambda f: (f[1], f[2], f[3]), default=(None,) * 4)
    return (event[0], best[1], best[2], best[3])


@pytest.mark.parametrize("one_task_rows", [10, 1_000_000])
def test_asof_equals_a_plain_search(spark, one_task_rows):
    rng = random.Random(4)
    cards = ["hot"] * 8 + ["b", "c", "never", None]
    events = [(i, rng.choice(cards), rng.choice([None, *range(60)])) for i in range(400)] + [(1000, "hot", 30)] * 3
    features = [(rng.choice(["hot", "hot", "b", "c", None, "unasked"]), rng.choice([None, *range(5, 60)]), float(rng.randrange(4)), rng.choice("pq")) for _ in range(120)]
    out = asof.asof_join(spark.createDataFrame(events, EVENTS), spark.createDataFrame(features, FEATURES), ["card"], "t", "since", ["x", "y"], one_task_rows=one_task_rows)
    assert out.columns == ["id", "card", "t", "since", "x", "y"]
    got = sorted(((r["id"], r["since"], r["x"], r["y"]) for r in out.collect()), key=repr)
    assert got == sorted((newest(e, features) for e in events), key=repr)


def test_asof_tie_column_and_empty_sides(spark):
    e = spark.createDataFrame([(1, "a", 5)], EVENTS)
    f = spark.createDataFrame([("a", 5, 1.0, "z"), ("a", 5, 2.0, "b")], FEATURES)
    assert asof.asof_join(e, f, ["card"], "t", "since", ["x"], tie=["y"]).first()["x"] == 1.0
    assert asof.asof_join(e, f.where("false"), ["card"], "t", "since", ["x"]).first()["x"] is None
    assert asof.asof_join(e.where("false"), f, ["card"], "t", "since", ["x"]).count() == 0
    with pytest.raises(ValueError):
        asof.asof_join(e.withColumn("x", F.lit(1)), f, ["card"], "t", "since", ["x"])


# ---- stability ----


def figures(r, c):
    r, c = (np.array([v for v in side if v is not None and not np.isnan(v)]) for side in (r, c))
    edges = np.quantile(r, [k / 10 for k in range(1, 10)])
    shares = [np.bincount(np.searchsorted(edges, side, side="left"), minlength=10) / len(side) for side in (r, c)]
    psi = sum((max(b, 1e-4) - max(a, 1e-4)) * np.log(max(b, 1e-4) / max(a, 1e-4)) for a, b in zip(*shares, strict=True))
    line = np.concatenate((r, c))
    ks = max(abs((r <= v).mean() - (c <= v).mean()) for v in line)
    return psi, ks


@pytest.mark.parametrize("one_task_rows", [20, 1_000_000])
def test_stability_equals_numpy(spark, one_task_rows):
    rng = random.Random(5)
    ref = [(rng.gauss(0, 1), float(rng.randrange(4)), None) for _ in range(300)] + [(None, float("nan"), 1.0)]
    cur = [(rng.gauss(0.5, 2), float(rng.randrange(1, 6)), 2.0) for _ in range(170)]
    schema = "a double, b double, c double"
    out = stability.stability(spark.createDataFrame(ref, schema), spark.createDataFrame(cur, schema), ["a", "b", "c"], one_task_rows=one_task_rows)
    got = {r["feature"]: r for r in out.collect()}
    for i, c in enumerate("abc"):
        psi, ks = figures([r[i] for r in ref], [r[i] for r in cur])
        assert got[c]["psi"] == pytest.approx(psi, abs=1e-9) and got[c]["ks"] == pytest.approx(ks, abs=1e-12)
    assert got["b"]["n_reference"] == 300 and got["c"]["n_reference"] == 1
    assert got["a"]["moved"] == (got["a"]["psi"] > 0.2)


def test_stability_of_equal_and_empty_sides(spark):
    rows = spark.createDataFrame([(float(i % 7),) for i in range(50)], "a double")
    same = stability.stability(rows, rows, ["a"]).first()
    assert same["psi"] == 0 and same["ks"] == 0 and not same["moved"]
    none = stability.stability(rows, rows.where("false"), ["a"]).first()
    assert none["n_current"] == 0 and none["psi"] is None and none["ks"] is None
    assert stability.stability(rows.where("false"), rows.where("false"), ["a"]).first()["n_reference"] == 0


# ---- time folds ----

REPORTS = "txn_id long, reported_s long, report_id string, label int"


def test_folds_use_only_what_was_known(spark):
    rows = spark.createDataFrame([(i, i * 100) for i in range(101)] + [(500, None)], "txn_id long, time_s long")
    plan = timefolds.plan_folds(rows, k=2, gap_s=300)
    assert [(f.train_end, f.test_start, f.test_end) for f in plan] == [(4700, 5000, 7500), (7200, 7500, 10001)]
    reports = [(i, i * 100 + 1000, "a", i % 2) for i in range(101)]
    # a correction that comes after the first cut, one at the same time, and a label that never comes
    reports += [(3, 6000, "b", 0), (4, 1400, "b", 1)]
    reports = [r for r in reports if r[0] != 20]
    got = timefolds.assign_folds(rows, plan, spark.createDataFrame(reports, REPORTS))
    found = {(r["fold"], r["part"], r["txn_id"]): r["label"] for r in got.collect()}
    assert found[0, "train", 3] == 1 and found[1, "train", 3] == 0 and found[0, "train", 4] == 1
    assert {k[2] for k in found if k[:2] == (0, "train")} == {i for i in range(41) if i != 20}
    assert {k[2] for k in found if k[:2] == (1, "test")} == set(range(75, 101))
    table = {r["fold"]: r for r in timefolds.fold_table(plan, got).collect()}
    assert table[0]["train_rows"] == 40 and table[1]["test_rows"] == 26 and table[0]["test_rows"] == 25


def test_folds_of_nothing(spark):
    rows = spark.createDataFrame([], "txn_id long, time_s long")
    assert timefolds.plan_folds(rows) == []
    got = timefolds.assign_folds(rows, [], spark.createDataFrame([], REPORTS))
    assert got.count() == 0 and got.columns == ["txn_id", "time_s", "fold", "part", "label"]
    some = spark.createDataFrame([(1, 0), (2, 10)], "txn_id long, time_s long")
    plan = timefolds.plan_folds(some, gap_s=0)
    table = timefolds.fold_table(plan, timefolds.assign_folds(some, plan, spark.createDataFrame([], REPORTS)))
    assert [r["train_rows"] for r in table.collect()] == [0, 0, 0]


# ---- slices ----


@pytest.mark.parametrize("one_task_rows", [5, 1_000_000])
def test_slices_equal_their_own_evaluation(spark, one_task_rows):
    rng = random.Random(6)
    rows = [("m", rng.randrange(40) / 40, rng.randrange(2), rng.choice([5.0, 22.0, 99.0, 800.0, None, -1.0]), dt.datetime(2024, 1, 1 + i % 3, i % 5)) for i in range(300)]
    rows += [("n", 0.5, 1, 5.0, dt.datetime(2024, 1, 1)), ("n", None, 1, 5.0, None), ("n", 0.4, None, 5.0, None)]
    scored = slices.with_slices(spark.createDataFrame(rows, "model_name string, p double, label int, Amount double, ts timestamp"))
    out = {(r["model_name"], r["slice_set"], r["slice"]): r for r in slices.evaluate_slices(scored, one_task_rows=one_task_rows).collect()}
    assert {k[2] for k in out if k[:2] == ("m", "amount_band")} == {"0-22", "22-100", "500+", "null"}
    for (model, kind, value), row in out.items():
        mine = scored.where((F.col("model_name") == model) & F.col("p").isNotNull() & F.col("label").isNotNull())
        if kind != "all":
            mine = mine.where(F.coalesce(F.col(kind), F.lit("null")) == value)
        want = M.ranking_metrics(mine, digits=None).first()
        cells = M.confusion_matrix(mine).first()
        for c in ("samples", "positives", "pr_auc", "average_precision", "roc_auc"):
            assert row[c] == pytest.approx(want[c]), (model, kind, value, c)
        assert [row[c] for c in ("tn", "fp", "fn", "tp")] == [cells[c] for c in ("tn", "fp", "fn", "tp")]
    assert slices.evaluate_slices(scored.where("false")).count() == 0


# ---- alarms ----


def test_runs_of_days_over_the_limit(spark):
    day = lambda k: dt.date(2024, 1, k)
    rows = [("a", day(k), 0.5) for k in (1, 2, 3, 5, 6, 9)] + [("a", day(4), None), ("a", day(7), 0.1), ("b", day(1), 0.2)]
    out = alarms.limit_runs(spark.createDataFrame(rows, "model_name string, transaction_date date, false_positive_rate double"), 0.2)
    got = sorted((r["first_day"].day, r["last_day"].day, r["days"], r["alarm"]) for r in out.collect())
    assert got == [(1, 3, 3, True), (5, 6, 2, False), (9, 9, 1, False)]
    assert alarms.limit_runs(spark.createDataFrame([], "model_name string, transaction_date date, false_positive_rate double"), 0.2).count() == 0


def test_merged_sketches_keep_their_bound(spark):
    rng = random.Random(7)
    values = [rng.lognormvariate(2, 1) for _ in range(30_000)]
    rows = [("a", v, dt.datetime(2024, 1, 1 + i % 20)) for i, v in enumerate(values)] + [("a", None, dt.datetime(2024, 1, 1)), ("b", 3.0, dt.datetime(2024, 1, 1))] * 2
    daily = alarms.daily_sketches(spark.createDataFrame(rows, "model_name string, ms double, at timestamp"), "ms", "at")
    assert daily.where("model_name = 'a'").count() == 20
    out = {r["model_name"]: r for r in alarms.merged_percentiles(daily).collect()}
    assert out["a"]["n"] == 30_000 and out["b"]["p50"] == 3.0 and out["b"]["p99"] == 3.0
    for p, c in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
        assert abs(np.mean([v <= out["a"][c] for v in values]) - p) <= alarms.RANK_ERROR
    assert alarms.merged_percentiles(daily.where("false")).count() == 0


def test_promotion_verdicts(spark):
    schema = "model_name string, pr_auc double, false_positive_rate double"
    old = spark.createDataFrame([(c, 0.5, 0.01) for c in "abcde"] + [("g", None, 0.0)], schema)
    new = spark.createDataFrame([("a", 0.52, 0.01), ("b", 0.505, 0.01), ("c", 0.47, 0.01), ("d", 0.9, 0.03), ("e", None, 0.01), ("f", 0.9, 0.01), ("g", 0.9, 0.01)], schema)
    got = {r["model_name"]: (r["verdict"], r["reason"]) for r in alarms.promotion_gate(old, new).collect()}
    assert got == {
        "a": ("promoted", "pr_auc_gain"),
        "b": ("held", "small_gain"),
        "c": ("blocked", "pr_auc_loss"),
        "d": ("blocked", "false_positive_rate"),
        "e": ("held", "no_comparison"),
        "f": ("held", "no_comparison"),
        "g": ("held", "no_comparison"),
    }


def test_quantiles_of_many_columns_beyond_one_task(spark):
    """Thirty columns and nine quantiles each, with ties and nulls: a condition with a term per rank overflowed the planner's stack."""
    rng = np.random.default_rng(3)
    table = rng.normal(size=(3000, 30))
    table[:, 1] = np.round(table[:, 1])
    table[::7, 2] = np.nan
    cols = [f"c{i}" for i in range(30)]
    rows = spark.createDataFrame([tuple(map(float, r)) for r in table], ", ".join(f"{c} double" for c in cols)).withColumn("side", F.col("c0") > 1)
    probs = [k / 10 for k in range(1, 10)]
    found = quantiles(rows, cols, probs, one_task_rows=100)
    by_side = quantiles(rows, cols[:3], probs, by="side", one_task_rows=100)
    for i, c in enumerate(cols):
        assert found[None, c] == pytest.approx(np.nanquantile(table[:, i], probs), abs=1e-12)
    for i, c in enumerate(cols[:3]):
        for side in (True, False):
            assert by_side[side, c] == pytest.approx(np.nanquantile(table[(table[:, 0] > 1) == side, i], probs), abs=1e-12)
