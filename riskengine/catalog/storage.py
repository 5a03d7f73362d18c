"""Queries on sources, sinks, schema checks and stored models: what is written is read back and compared with the table it came from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.catalog import sql as Q
from riskengine.catalog.models import INPUTS, SPLIT, training_rows
from riskengine.catalog.registry import query
from riskengine.catalog.tables import rounded
from riskengine.operators import metrics as M
from riskengine.operators import models as L
from riskengine.operators import prep
from riskengine.operators import quality as V
from riskengine.plans import runs
from riskengine.schema import NULL_TOKENS, RAW_COLUMNS
from riskengine.session import scratch_path
from riskengine.sources import adapter as A
from riskengine.sources import readers, sinks
from riskengine.streaming import events as E

_RAW = f"Time, {Q.V_LIST}, Amount, Class"


def written_csv(df, spark, label):
    path = scratch_path(spark, label)
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


# ---- sources ----


@query("s1_csv_scan", f"WITH {Q.RAW} SELECT {_RAW} FROM raw")
def _(spark, sf):
    return readers.read_csv(spark, written_csv(A.raw(spark, sf).select(*RAW_COLUMNS), spark, "csv"))


@query(
    "s2_csv_null_tokens",
    f"WITH {Q.DIRTY} SELECT CAST(time_s AS DOUBLE) AS Time, {Q.V_LIST}, CASE WHEN NOT isnan(Amount) THEN Amount END AS Amount, CAST(Class AS BIGINT) AS Class FROM dirty",
)
def _(spark, sf):
    """Missing amounts are written with every token in turn."""
    tokens = F.array(*map(F.lit, NULL_TOKENS))
    token = F.element_at(tokens, (F.col("txn_id") % len(NULL_TOKENS) + 1).cast("int"))
    known = F.col("Amount").isNotNull() & ~F.isnan("Amount")
    rows = A.dirty(spark, sf).withColumns({"Time": F.col("time_s").cast("double"), "Amount": F.when(known, F.col("Amount").cast("string")).otherwise(token)})
    return readers.read_csv_null_tokens(spark, written_csv(rows.select(*RAW_COLUMNS), spark, "tokens"))


@query(
    "s4_labelled_batch",
    f"WITH {Q.RAW} SELECT count(*) AS rows, sum(Class)::BIGINT AS fraud, sum(Class) = 0 AS no_fraud_warning, round(sum(Amount), 4) AS amount FROM raw",
)
def _(spark, sf):
    df, info = readers.read_labelled_batch(spark, written_csv(A.raw(spark, sf), spark, "batch"))
    return df.agg(*[F.lit(v).cast("boolean" if k == "no_fraud_warning" else "long").alias(k) for k, v in info.items()], F.round(F.sum("Amount"), 4).alias("amount"))


# ---- sinks ----


@query("s7_parquet_sink", f"WITH {Q.LOG} SELECT txn_id, card_id, Amount, Class FROM log")
def _(spark, sf):
    path = scratch_path(spark, "table")
    sinks.write_table(A.log(spark, sf).select("txn_id", "card_id", "Amount", "Class"), path, ["Class"])
    df, _features = readers.read_parquet(spark, path)
    return df


@query(
    "s8_bulk_append",
    f"""WITH {Q.TXN} SELECT CAST(txn_id AS VARCHAR) AS transaction_id, CAST(time_s AS DOUBLE) AS time_seconds, Amount AS amount, V1 AS v1, V28 AS v28, CAST(card_id AS VARCHAR) AS card_id,
 CAST(NULL AS VARCHAR) AS merchant_id FROM txn""",
)
def _(spark, sf):
    """Two loads into one table."""
    path = scratch_path(spark, "transactions")
    rows = A.txn(spark, sf)
    for part in (0, 1):
        sinks.append_transactions(rows.where(F.col("txn_id") % 2 == part), path)
    return spark.read.parquet(path).select("transaction_id", "time_seconds", "amount", "v1", "v28", "card_id", "merchant_id")


def scored_requests(spark, sf):
    p = F.col("p")
    rows = A.scored(spark, sf).where("model_name = 'model_a'")
    return rows.select("txn_id", "ts", F.unix_seconds(F.col("ts").cast("timestamp")).alias("time_s"), "Amount", p.alias("fraud_probability"), (p >= 0.5).alias("is_fraud"))


@query(
    "s9_prediction_audit",
    f"""WITH {Q.SCORED} SELECT sha256(CAST(txn_id AS VARCHAR) || '|model_a') AS prediction_id, CAST(txn_id AS VARCHAR) AS transaction_id, model_name, round(p, 9) AS fraud_probability, p >= 0.5 AS is_fraud
 FROM scored WHERE model_name = 'model_a'""",
)
def _(spark, sf):
    """The same batch written twice, as a retry does: its rows are there once."""
    paths = [scratch_path(spark, n) for n in ("transactions", "predictions", "log")]
    write = E.audit(*paths, "model_a")
    rows = scored_requests(spark, sf)
    for _turn in range(2):
        write(rows, 0)
    return rounded(spark.read.parquet(paths[1]).select("prediction_id", "transaction_id", "model_name", "fraud_probability", "is_fraud"), ["fraud_probability"], 9)


@query(
    "s12_json_report",
    f"""WITH {Q.LOG} SELECT count(*) AS total, count(*) FILTER (Class = 0) AS legitimate, count(*) FILTER (Class = 1) AS fraud FROM log""",
)
def _(spark, sf):
    path = scratch_path(spark, "report")
    sinks.write_report(V.class_distribution(A.log(spark, sf)), path)
    return spark.read.schema("total long, legitimate long, fraud long").json(path)


@query(
    "s14_run_metadata",
    f"""WITH {SPLIT} SELECT 'chronological_time_based' AS split_method, 0.8::DOUBLE AS train_ratio, any_value(edge_s)::DOUBLE AS split_timestamp,
 count(*) FILTER (time_s <= edge_s) AS train_size, count(*) FILTER (time_s > edge_s) AS test_size FROM log, edge""",
)
def _(spark, sf):
    path = scratch_path(spark, "split")
    train, test, at = prep.chronological_split(A.log(spark, sf))
    sinks.write_split_config(spark, 0.8, at, train.count(), test.count(), path)
    return spark.read.schema("split_method string, train_ratio double, split_timestamp double, train_size long, test_size long").json(path)


@query(
    "s15_prediction_log",
    f"""WITH {Q.SCORED} SELECT sha256(CAST(txn_id AS VARCHAR)) AS transaction_hash, round(p, 6) AS fraud_probability, p >= 0.5 AS is_fraud, round((txn_id % 97) / 10, 2) AS latency_ms,
 round(Amount, 2) AS input_amount, 0.5::DOUBLE AS threshold, model_name FROM scored WHERE model_name = 'model_a'""",
)
def _(spark, sf):
    ident = F.col("txn_id").cast("string")
    rows = scored_requests(spark, sf).withColumns({"transaction_hash": F.sha2(ident, 256), "latency_ms": (F.col("txn_id") % 97) / F.lit(10)})
    return sinks.prediction_log(rows, 0.5, "model_a")


@query(
    "s16_model_save_load",
    f"""WITH {SPLIT} SELECT count(*) AS rows, 0::BIGINT AS differing FROM log, edge WHERE time_s > edge_s""",
)
def _(spark, sf):
    """A stored model scores every row as the fitted one does."""
    train, test = training_rows(spark, sf)
    model = L.fit("decision_tree", train, INPUTS)
    folder = scratch_path(spark, "model")
    L.save_model(model, folder, "decision_tree", "baseline")
    _name, loaded = L.first_loadable(["decision_tree_baseline"], folder)
    both = L.score(model, test, "a").join(L.score(loaded, test, "a").select("txn_id", F.col("p").alias("q")), "txn_id")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p") != F.col("q")).alias("differing"))


# ---- schema checks ----

_EVENT_COLUMNS = "(SELECT column_name AS c, column_type AS t FROM (DESCRIBE events))"
EXPECTED = ["event_id", "user_id", "ts", "value", "channel", "device"]


@query(
    "v2_missing_and_extra_columns",
    f"""WITH h AS {_EVENT_COLUMNS}, e AS (SELECT unnest({EXPECTED}) AS c) SELECT 'missing' AS kind, c AS "column" FROM e WHERE c NOT IN (SELECT c FROM h)
 UNION ALL SELECT 'extra', c FROM h WHERE c NOT IN (SELECT c FROM e)""",
)
def _(spark, sf):
    found = V.column_differences(A.table(spark, sf, "events"), EXPECTED)
    return spark.createDataFrame([(k, c) for k, cs in found.items() for c in cs], "kind string, column string")


@query(
    "u1_column_set_difference",
    """WITH a AS (SELECT column_name AS c FROM (DESCRIBE events)), b AS (SELECT column_name AS c FROM (DESCRIBE orders)), d AS (SELECT column_name AS c FROM (DESCRIBE documents)),
 x AS (SELECT column_name AS c FROM (DESCRIBE labels)) SELECT 'events-orders' AS pair, c AS "column" FROM a WHERE c NOT IN (SELECT c FROM b) UNION ALL SELECT 'documents-labels', c FROM d WHERE c NOT IN (SELECT c FROM x)""",
)
def _(spark, sf):
    rows = []
    for left, right in (("events", "orders"), ("documents", "labels")):
        found = V.column_differences(A.table(spark, sf, left), A.table(spark, sf, right).columns)
        rows += [(f"{left}-{right}", c) for c in found["extra"]]
    return spark.createDataFrame(rows, "pair string, column string")


_WANTED = {"txn_id": "float64", "Amount": "float64", "Class": "int64", "V1": "float64", "time_s": "float64", "unknown": "int64"}


@query(
    "v3_dtype_check",
    f"""WITH {Q.TXN}, w AS (SELECT unnest({list(_WANTED)}) AS c, unnest({list(_WANTED.values())}) AS want), h AS (SELECT column_name AS c, lower(column_type) AS t FROM (DESCRIBE SELECT txn_id, Amount, Class, V1, time_s FROM txn)),
 k AS (SELECT c, want, CASE t WHEN 'integer' THEN 'int' ELSE t END AS t FROM h JOIN w USING (c))
 SELECT 'Column ''' || c || ''' has type ' || t || ', expected ' || want AS problem FROM k WHERE t <> CASE want WHEN 'float64' THEN 'double' ELSE 'bigint' END""",
)
def _(spark, sf):
    found = V.dtype_mismatches(A.txn(spark, sf), _WANTED)
    return spark.createDataFrame([(p,) for p in found], "problem string")


_SIDE = ["txn_id", "time_s", "Class", *INPUTS]


@query(
    "v21_same_feature_list",
    f"""SELECT side, feature, CAST(list_position({_SIDE}, feature) - 1 AS INTEGER) AS place, true AS equal FROM (SELECT unnest(['train', 'test']) AS side), (SELECT unnest({_SIDE}) AS feature)""",
)
def _(spark, sf):
    train, test = training_rows(spark, sf)
    V.same_features(train, test)
    try:
        V.same_features(train, test.drop("V28"))
        equal = False
    except ValueError:
        equal = train.columns == test.columns
    rows = [(side, c, i, equal) for side, df in (("train", train), ("test", test)) for i, c in enumerate(df.columns)]
    return spark.createDataFrame(rows, "side string, feature string, place int, equal boolean")


@query("v22_basic_info", "SELECT count(*) AS rows, (SELECT count(*) FROM (DESCRIBE lineitem)) AS columns, 5::BIGINT AS preview FROM lineitem")
def _(spark, sf):
    info = V.basic_info(A.table(spark, sf, "lineitem"))
    return spark.createDataFrame([(info["rows"], len(info["columns"]), len(info["head"]))], "rows long, columns long, preview long")


@query(
    "v23_setting_validation",
    "SELECT DISTINCT CAST(l_quantity AS DOUBLE) / 25 - 0.2::DOUBLE AS setting, CAST(l_quantity AS DOUBLE) / 25 - 0.2::DOUBLE BETWEEN 0 AND 1 AS accepted FROM lineitem",
)
def _(spark, sf):
    """Candidate limits, one per ordered quantity (a fixed handful)."""
    settings = A.table(spark, sf, "lineitem").select((F.col("l_quantity").cast("double") / 25 - 0.2).alias("setting")).distinct()
    rows = []
    for (value,) in settings.collect():
        try:
            V.check_limits(value, 0.1, 0.1, 1.0)
            rows.append((value, True))
        except ValueError:
            rows.append((value, False))
    return spark.createDataFrame(rows, "setting double, accepted boolean")


@query(
    "p13_time_column",
    f"""WITH {Q.LOG}, t AS (SELECT min(time_s)::DOUBLE AS low, max(time_s)::DOUBLE AS high FROM log)
 SELECT shape, "column", low, high FROM t, (SELECT unnest(['raw', 'seconds', 'plain']) AS shape, unnest(['Time_raw', 'time_s', 'Time']) AS "column")""",
)
def _(spark, sf):
    rows = A.log(spark, sf).select(F.col("time_s").cast("double").alias("t"))
    scaled = F.col("t") / 1000
    shapes = {
        "raw": rows.select(F.col("t").alias("Time_raw"), scaled.alias("Time")),
        "seconds": rows.select(F.col("t").alias("time_s"), scaled.alias("Time")),
        "plain": rows.select(F.col("t").alias("Time")),
    }
    found = []
    for shape, df in shapes.items():
        c = prep.time_column(df)
        found.append(df.agg(F.lit(shape).alias("shape"), F.lit(c).alias("column"), F.min(c).alias("low"), F.max(c).alias("high")))
    return reduce(DataFrame.unionByName, found)


@query(
    "t8_rank_and_load",
    f"""WITH {Q.SCORED}, {Q.areas('scored', 'model_name', 'f')}, o AS (SELECT model_name, row_number() OVER (ORDER BY pr_auc DESC, model_name) AS place FROM f)
 SELECT model_name, place, place = 2 AS loaded FROM o""",
)
def _(spark, sf):
    """Candidates by their area; the best one's file is broken, so the second is loaded."""
    names = L.rank_candidates(M.evaluate(A.scored(spark, sf), digits=None))
    train, _test = training_rows(spark, sf)
    folder = scratch_path(spark, "candidates")
    L.fit("naive_bayes", runs.materialise(train, "train"), INPUTS).write().overwrite().save(f"{folder}/{names[1]}")
    name, _model = L.first_loadable(names, folder)
    return spark.createDataFrame([(n, i, n == name) for i, n in enumerate(names, 1)], "model_name string, place long, loaded boolean")
