import pytest
from pyspark.sql import functions as F

from riskengine.functions.columns import outcome
from riskengine.operators import metrics as M
from riskengine.operators import views as V


def scores(spark, y, p, name="m"):
    rows = [(name, i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "model_name string, txn_id long, label int, p double")


Y, P = [1, 0, 1, 0, 0, 1, 0, 0], [0.9, 0.8, 0.8, 0.7, 0.6, 0.4, 0.3, 0.1]


@pytest.mark.parametrize("limit", [2, 10**6])
def test_areas(spark, limit):
    r = M.ranking_metrics(scores(spark, Y, P), digits=6, one_task_rows=limit).first()
    assert (r.pr_auc, r.average_precision, r.roc_auc) == (0.761111, 0.722222, 0.766667)


def test_curve_starts_at_precision_one(spark):
    r = M.ranking_metrics(scores(spark, [1, 0, 0, 1, 0, 0, 1, 0], [0.9, 0.9, 0.7, 0.6, 0.5, 0.4, 0.3, 0.1]), digits=6)
    assert r.first().pr_auc == 0.515873


def test_areas_do_not_change_with_a_monotone_map(spark):
    s = scores(spark, Y, P)
    a, b = (M.ranking_metrics(x, digits=None).first() for x in (s, s.withColumn("p", F.exp("p") * 7 - 3)))
    assert (a.pr_auc, a.average_precision, a.roc_auc) == (b.pr_auc, b.average_precision, b.roc_auc)


def test_one_class_gives_zero(spark):
    r = M.ranking_metrics(scores(spark, [0, 0], [0.1, 0.2])).first()
    assert (r.pr_auc, r.roc_auc, r.average_precision) == (0.0, 0.0, 0.0)


# published figures: (tn, fp, fn, tp) -> precision, recall, f1
PUBLISHED = [
    ((56343, 329, 13, 61), (0.1564, 0.8243, 0.2629)),
    ((56115, 557, 13, 61), (0.0987, 0.8243, 0.1763)),
    ((56662, 10, 16, 58), (0.8529, 0.7838, 0.8169)),
    ((55905, 767, 9, 65), (0.0781, 0.8784, 0.1435)),
    ((56153, 519, 10, 64), (0.1098, 0.8649, 0.1948)),
    ((56668, 4, 24, 50), (0.9259, 0.6757, 0.7812)),
    ((55530, 1142, 15, 59), (0.0491, 0.7973, 0.0925)),
    ((55576, 1096, 15, 59), (0.0511, 0.7973, 0.0960)),
    ((56618, 54, 15, 59), (0.5221, 0.7973, 0.6310)),
    ((56585, 87, 15, 59), (0.4041, 0.7973, 0.5364)),
    ((56655, 17, 18, 56), (0.7671, 0.7568, 0.7619)),
]


def test_published_confusion_counts(spark):
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(PUBLISHED)], "i int, tn long, fp long, fn long, tp long")
    for r in M.rates(df).collect():
        assert (r.precision, r.recall, r.f1_score) == PUBLISHED[r.i][1]


@pytest.mark.parametrize(
    "missed, alarms, cost",
    [(22, 32, 20600), (23, 19, 17200), (24, 13, 15900), (9, 2150, 649500), (11, 1096, 334300), (15, 508, 159900)],
)
def test_published_costs(spark, missed, alarms, cost):
    assert spark.range(1).select(M.business_cost(F.lit(missed), F.lit(alarms)).alias("c")).first().c == cost


def test_sweep_equals_loop_on_exact_thresholds(spark):
    y = [i % 3 == 0 for i in range(60)]
    p = [round(0.05 * (i % 21), 2) for i in range(60)]
    for r in M.threshold_sweep(scores(spark, y, p)).collect():
        tp = sum(a and b >= r.threshold for a, b in zip(y, p))
        fp = sum((not a) and b >= r.threshold for a, b in zip(y, p))
        assert (r.fraud_caught, r.false_alarms) == (tp, fp)


def test_best_point_takes_the_lower_threshold_on_a_tie(spark):
    rows = [("m", 0.3, 0.8, 100.0), ("m", 0.2, 0.8, 90.0), ("m", 0.4, 0.1, 90.0)]
    df = spark.createDataFrame(rows, "model_name string, threshold double, f1_score double, business_cost double")
    r = M.best_points(df).first()
    assert (r.best_f1_threshold, r.best_cost_threshold) == (0.2, 0.2)


@pytest.mark.parametrize(
    "base, cur, fpr_warn, pr_warn",
    [
        ((0.8, 0.0), (0.8, 0.01), True, False),
        ((0.8, 0.010), (0.8, 0.01199), False, False),
        ((0.8, 0.010), (0.8, 0.0121), True, False),
        ((0.8, 0.010), (0.7201, 0.010), False, False),
        ((0.8, 0.010), (0.71, 0.010), False, True),
        ((0.0, 0.010), (0.5, 0.010), False, False),
        ((0.8, 0.0), (0.8, 0.0), False, False),
    ],
)
def test_drift(spark, base, cur, fpr_warn, pr_warn):
    def frame(x):
        return spark.createDataFrame([("m", *x)], "model_name string, pr_auc double, false_positive_rate double")

    r = M.drift(frame(base), frame(cur)).first()
    assert (r.fpr_warning, r.pr_auc_warning, r.any_warning) == (fpr_warn, pr_warn, fpr_warn or pr_warn)


def test_top_k_with_ties_at_the_cut(spark):
    # k = 3; two of the three rows at 0.5 belong to the top, highest key first
    s = scores(spark, [1, 0, 1, 0, 1], [0.9, 0.5, 0.5, 0.5, 0.1])
    order = sorted(s.collect(), key=lambda r: (-r.p, -r.txn_id))[:3]
    assert M.top_k_hits(s) == (3, sum(r.label for r in order))


def test_all_outcomes(spark):
    rows = [(p, a) for p in (True, False, None) for a in (1, 0, None)]
    df = spark.createDataFrame(rows, "p boolean, a int")
    got = [r.c for r in df.select(outcome(F.col("p"), F.col("a"), V.CATEGORY).alias("c")).collect()]
    assert got == ["true_positive", "false_positive", "unlabeled", "false_negative", "true_negative"] + ["unlabeled"] * 4
