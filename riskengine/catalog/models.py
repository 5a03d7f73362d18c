"""Model queries (M1-M20) and composed runs. Fitted values differ between engines, so most
have no SQL twin value by value; what holds in any engine (rows, labels, ranges, a floor of
learning) is compared instead. All fits run with the full settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskengine.catalog import sql as Q
from riskengine.catalog.registry import query
from riskengine.functions import features as X
from riskengine.operators import anomaly
from riskengine.operators import metrics as M
from riskengine.operators import models as L
from riskengine.operators import prep
from riskengine.plans import runs
from riskengine.schema import V_COLS
from riskengine.sources import adapter as A

INPUTS = [*V_COLS, "Amount", "amount_log", "hour_sin", "hour_cos", "is_night", "fraud_feature_magnitude"]


def training_rows(spark, sf):
    """Row-local features of the whole log, split by time."""
    rows = A.txn(spark, sf).transform(X.stateless).select("txn_id", "time_s", "Class", *INPUTS)
    train, test, _at = prep.chronological_split(rows)
    return train, test


SPLIT = f"""{Q.LOG}, edge AS (SELECT min(time_s) + 0.8 * (max(time_s) - min(time_s)) AS edge_s FROM log)"""


def facts(scored, key="txn_id"):
    """What any engine's fit must show on the scored rows."""
    p = F.col("p")
    return scored.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("keys"),
        F.sum("label").cast("long").alias("positives"),
        F.min((p >= 0) & (p <= 1)).alias("is_probability"),
        (F.count_distinct("p") > 1).alias("tells_rows_apart"),
    )


def facts_sql(name, rows):
    return f"""WITH {SPLIT} SELECT '{name}' AS model_name, count(*) AS rows, count(DISTINCT txn_id) AS keys, sum(Class)::BIGINT AS positives,
 true AS is_probability, true AS tells_rows_apart FROM log, edge WHERE {rows}"""


#: what a fit must reach on the rows it learned from: the log's labels carry no signal to hold out
LEAST_TRAINING_AREA = 0.52


def _fit_and_score(name):
    def run(spark, sf):
        train, test = training_rows(spark, sf)
        train, _rows = L.stored_rows(train, "train")
        model = L.fit(name, train, INPUTS)
        # the areas read the scores several times
        own = M.ranking_metrics(runs.materialise(L.score(model, train, name), "own-scores"), digits=None)
        learned = own.select("model_name", (F.col("roc_auc") > LEAST_TRAINING_AREA).alias("has_learned"))
        return facts(L.score(model, test, name)).join(learned, "model_name")

    return run


for _id, _name in zip(
    ["m1", "m2", "m3", "m4", "m5", "m6", "m7"], [n for tier in L.TIERS.values() for n in tier]
):
    query(f"{_id}_{_name}", facts_sql(_name, "time_s > edge_s").replace(" FROM log, edge", ", true AS has_learned FROM log, edge"))(_fit_and_score(_name))


@query(
    "m7_early_stopping",
    f"""WITH {SPLIT} SELECT greatest(count(*), CAST(floor(0.3::DOUBLE * count(*) FILTER (Class = 0)) AS BIGINT) + count(*) FILTER (Class = 0)) AS fitted_rows, true AS has_stopped, true AS keeps_the_best,
 true AS rounds_are_in_order FROM log, edge WHERE time_s <= edge_s""",
)
def _(spark, sf):
    """The network's rounds: it stops before the limit, three rounds after the best held-out loss, and the best round's model is kept."""
    train, _test = training_rows(spark, sf)
    rows, n = L.balanced_rows("mlp", train, INPUTS)
    _model, history = L.fit_mlp(rows, INPUTS)
    losses = [loss for _turn, loss in history]
    best = min(range(len(losses)), key=losses.__getitem__)
    in_order = [turn for turn, _loss in history] == list(range(1, len(history) + 1))
    return spark.createDataFrame(
        [(n, len(history) < 20, len(losses) - 1 - best <= 3 and losses[best] <= losses[0], in_order)],
        "fitted_rows long, has_stopped boolean, keeps_the_best boolean, rounds_are_in_order boolean",
    )


def smote_rows(spark, sf):
    """The training rows with the log's own classes: a fifth is fraud, so rows are missing up to 0.3 of the others."""
    train, _test = training_rows(spark, sf)
    return runs.materialise(train, "smote")


@query(
    "m8_smote",
    f"""WITH {SPLIT}, r AS (SELECT Class AS y FROM log, edge WHERE time_s <= edge_s)
 SELECT count(*) FILTER (y = 1) AS positives, CAST(floor(0.3::DOUBLE * count(*) FILTER (y = 0)) AS BIGINT) - count(*) FILTER (y = 1) AS made,
 count(*) AS real_rows, true AS inside_the_box, true AS new_points FROM r""",
)
def _(spark, sf):
    """Synthetic rows lie inside the box of the minority, and few are copies of a real row."""
    rows = smote_rows(spark, sf)
    out = L.smote(rows, INPUTS)
    real = rows.where("Class = 1")
    box = real.agg(*[f(c).alias(f"_{n}_{c}") for c in INPUTS for n, f in (("lo", F.min), ("hi", F.max))])  # one row
    new = F.col("txn_id").isNull()
    inside = F.forall(F.array(*[F.col(c).between(F.col(f"_lo_{c}") - 1e-9, F.col(f"_hi_{c}") + 1e-9) for c in INPUTS]), lambda x: x)
    # a synthetic row's components are not a stored vector unless its neighbour is equal or the gap is zero
    known = real.select(F.xxhash64(*INPUTS).alias("_k")).distinct().withColumn("_known", F.lit(1))
    hashed = out.crossJoin(F.broadcast(box)).withColumn("_k", F.xxhash64(*INPUTS)).join(known.hint("merge"), "_k", "left")
    return hashed.agg(
        F.count(F.when(~new & (F.col("Class") == 1), 1)).alias("positives"),
        F.count(F.when(new, 1)).alias("made"),
        F.count(F.when(~new, 1)).alias("real_rows"),
        F.min(~new | inside).alias("inside_the_box"),
        (F.count(F.when(new & F.col("_known").isNotNull(), 1)) <= 0.01 * F.count(F.when(new, 1))).alias("new_points"),
    )


@query(
    "m8_smote_class_counts",
    f"""WITH {SPLIT}, r AS (SELECT Class AS y FROM log, edge WHERE time_s <= edge_s)
 SELECT 0 AS Class, count(*) FILTER (y = 0) AS n FROM r UNION ALL
 SELECT 1, greatest(count(*) FILTER (y = 1), CAST(floor(0.3::DOUBLE * count(*) FILTER (y = 0)) AS BIGINT)) FROM r""",
)
def _(spark, sf):
    return L.smote(smote_rows(spark, sf), INPUTS).groupBy("Class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m10_stratified_folds",
    f"""WITH {Q.LOG}, f AS (SELECT Class, unnest([0, 1, 2]) AS fold, count(*) AS n FROM log GROUP BY Class)
 SELECT Class, fold, n * (fold + 1) // 3 - n * fold // 3 AS rows FROM f""",
)
def _(spark, sf):
    folded = L.stratified_folds(A.log(spark, sf).select("txn_id", "Class"))
    return folded.groupBy("Class", "fold").agg(F.count(F.lit(1)).alias("rows"))


ALL_MODELS = [name for tier in L.TIERS.values() for name in tier]


def cross_validated(spark, sf, names):
    train, _test = training_rows(spark, sf)
    return L.cross_validate(names, train, INPUTS)


@query(
    "m10_cross_validation",
    f"""SELECT model_name, metric, fold, true AS is_share FROM (SELECT unnest({ALL_MODELS}) AS model_name),
 (SELECT unnest(['roc_auc', 'average_precision', 'precision', 'recall', 'f1_score']) AS metric), (SELECT unnest([0, 1, 2]) AS fold)""",
)
def _(spark, sf):
    return cross_validated(spark, sf, ALL_MODELS).select("model_name", "metric", "fold", F.col("value").between(0, 1).alias("is_share"))


@query("a24_fold_summary")
def _(spark, sf):
    """Folds of every model of both tiers."""
    return M.fold_summary(cross_validated(spark, sf, ALL_MODELS))


@query(
    "m11_isolation_forest",
    f"""WITH {Q.LOG} SELECT count(*) AS rows, count(DISTINCT txn_id) AS keys, true AS in_range, true AS share_is_one_percent, true AS flagged_are_highest FROM log""",
)
def _(spark, sf):
    out = anomaly.anomaly_features(A.txn(spark, sf))
    hit = F.col("anomaly_score") == 1
    score = F.col("anomaly_decision")
    return out.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("txn_id").alias("keys"),
        F.min((score > 0) & (score <= 1)).alias("in_range"),
        (F.abs(F.avg("anomaly_score") - 0.01) < 0.002).alias("share_is_one_percent"),
        (F.min(F.when(hit, score)) > F.max(F.when(~hit, score))).alias("flagged_are_highest"),
    )


@query("m12_batch_scoring", facts_sql("decision_tree", "true"))
def _(spark, sf):
    train, test = training_rows(spark, sf)
    model = L.fit("decision_tree", train, INPUTS)
    return facts(L.score(model, test.unionByName(train), "decision_tree"))


@query("m13_feature_importance")
def _(spark, sf):
    train, _test = training_rows(spark, sf)
    return L.feature_importance(L.fit("random_forest", train, INPUTS), INPUTS)


@query("a23_normalised_importance")
def _(spark, sf):
    train, _test = training_rows(spark, sf)
    return M.normalised_importance(L.feature_importance(L.fit("random_forest", train, INPUTS), INPUTS))


@query("m14_final_fit", facts_sql("logistic_regression", "true"))
def _(spark, sf):
    train, test = training_rows(spark, sf)
    every = runs.materialise(train.unionByName(test), "final")
    return facts(L.score(L.fit("logistic_regression", every, INPUTS), every, "logistic_regression"))


@query("m16_reconstruction_error")
def _(spark, sf):
    rows = A.txn(spark, sf)
    return anomaly.reconstruction_error(rows, anomaly.fit_reconstruction(rows)).select("txn_id", "Class", "error")


@query("m17_embedding")
def _(spark, sf):
    rows = A.txn(spark, sf).select("txn_id", *V_COLS)
    model = anomaly.fit_reconstruction(rows)
    return anomaly.reconstruction_error(rows, model, keep_embedding=True).select("txn_id", "embedding")


@query("m18_evaluation_run")
def _(spark, sf):
    return runs.evaluation(A.scored(spark, sf))["documents"]


@query("m19_end_to_end_run")
def _(spark, sf):
    rows = A.txn(spark, sf).select("txn_id", "time_s", "Amount", "Class", *V_COLS)
    return runs.end_to_end(rows, "full")["documents"]


@query("m20_anomaly_run")
def _(spark, sf):
    out = runs.anomaly_run(A.txn(spark, sf))
    named = [out[f"{n}_metrics"].withColumn("split", F.lit(n)) for n in ("train", "test")]
    return named[0].unionByName(named[1])


_NUMERIC = [*V_COLS, "Amount"]
_DISTINCT = " UNION ALL ".join(f"SELECT '{c}' AS name, count(DISTINCT {c}) AS k FROM txn" for c in [*_NUMERIC, "Class"])


@query(
    "v24_profile_run",
    f"""WITH {Q.TXN}, c AS ({_DISTINCT}), n AS (SELECT count(*) AS n FROM txn) SELECT name AS "column", k AS unique_values,
 round(k / n, 9) AS cardinality_ratio, k = 1 AS is_constant, 0::BIGINT AS missing FROM c, n""",
)
def _(spark, sf):
    """The profile of all numeric columns; every one of its tables is computed."""
    rows = runs.materialise(A.txn(spark, sf).select(*_NUMERIC, "Class"), "profile")
    tables = runs.profile(rows, _NUMERIC)
    for name, table in tables.items():
        if name not in ("cardinality", "constant", "missing"):
            table.write.format("noop").mode("overwrite").save()
    missing = tables["missing"].select("column", "missing")
    kept = tables["cardinality"].select("column", "unique_values", F.round("cardinality_ratio", 9).alias("cardinality_ratio"))
    return kept.join(tables["constant"].select("column", "is_constant"), "column").join(missing, "column")


@query("a29_monitoring_run")
def _(spark, sf):
    s = A.scored(spark, sf)
    edge = F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    before = M.evaluate(s.where(F.col("ts") < edge), digits=None)
    baseline = before.select(
        "model_name",
        F.col("average_precision").alias("pr_auc"),
        "false_positive_rate",
        F.lit(0.5).alias("threshold"),
    )
    return runs.monitoring(s.where(F.col("ts") >= edge), baseline)
