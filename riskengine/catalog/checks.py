"""Validation queries (V1-V22) and table reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskengine import schema as S
from riskengine.catalog import sql as Q
from riskengine.catalog.registry import query
from riskengine.functions.columns import missing
from riskengine.operators import prep
from riskengine.operators import quality as V
from riskengine.sources import adapter as A

NUM = [*S.V_COLS, "Amount", "time_s"]
#: the columns of the input contract
RAW_COLS = [*NUM, "Class"]


def each(cols, template, sep=" UNION ALL "):
    """The same SELECT for several columns."""
    return sep.join(template.replace("{c}", c) for c in cols)


@query(
    "s3_parquet_scan",
    f"WITH {Q.TXN} SELECT txn_id, Amount, Class, V1, V28 FROM txn",
)
def _(spark, sf):
    return A.txn(spark, sf).select("txn_id", "Amount", "Class", "V1", "V28")


@query(
    "v1_shape_check",
    f"""WITH {Q.RAW} SELECT count(*) AS rows, 31::BIGINT AS columns, count(*) <> 284807 AS row_count_warning, true AS valid FROM raw""",
)
def _(spark, sf):
    r = V.shape_check(A.raw(spark, sf), S.EXPECTED_ROWS, S.RAW_COLUMNS)
    return spark.createDataFrame(
        [(r["rows"], r["columns"], r["row_count_warning"], r["valid"])],
        "rows long, columns long, row_count_warning boolean, valid boolean",
    )


# one literal cast per rule keeps the types of both sides equal
_D = "(Amount IS NULL OR isnan(Amount))"
_RULES = [(f"not_null:{c}", f"{c} IS NULL OR isnan({c})") for c in [*S.V_COLS, "Amount"]] + [
    ("not_null:Class", "Class IS NULL"),
    ("amount_min", f"NOT {_D} AND Amount < 0"),
    ("amount_max", f"NOT {_D} AND Amount > 26000"),
    ("class_values", "Class NOT IN (0, 1)"),
]


@query(
    "v4_constraint_violations",
    f"WITH {Q.DIRTY} "
    + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER ({c}) AS violations FROM dirty" for n, c in _RULES),
)
def _(spark, sf):
    df = A.dirty(spark, sf)
    return V.constraint_violations(df, V.transaction_rules(df))


@query(
    "v4_quarantine",
    f"""WITH {Q.DIRTY} SELECT txn_id, CASE WHEN {_D} THEN 'not_null:Amount' WHEN Amount < 0 THEN 'amount_min' ELSE 'amount_max' END AS broken
 FROM dirty WHERE {_D} OR Amount < 0 OR Amount > 26000""",
)
def _(spark, sf):
    df = A.dirty(spark, sf)
    return V.quarantine(df, V.transaction_rules(df)).select("txn_id", F.array_join("broken_rules", ",").alias("broken"))


@query(
    "v5_null_counts",
    f"WITH {Q.DIRTY} "
    + each(
        RAW_COLS,
        """SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL OR isnan({c})) AS missing,
 round(count(*) FILTER ({c} IS NULL OR isnan({c})) / count(*) * 100, 6) AS missing_pct FROM dirty""",
    ),
)
def _(spark, sf):
    out = V.null_counts(A.dirty(spark, sf), RAW_COLS)
    return out.withColumn("missing_pct", F.round("missing_pct", 6))


@query(
    "v6_duplicates",
    f"""WITH {Q.DUPLICATED}, g AS (SELECT count(*) AS k FROM duplicated GROUP BY ALL, txn_id, card_id, ts, t_us, time_s, Amount, Class, {Q.V_LIST})
 SELECT CAST(sum(k) AS BIGINT) AS total_rows, CAST(sum(k - 1) AS BIGINT) AS duplicate_rows, round(sum(k - 1) / sum(k) * 100, 4) AS duplicate_pct,
 sum(k - 1) > 0 AS has_duplicates FROM g""".replace("GROUP BY ALL, ", "GROUP BY "),
)
def _(spark, sf):
    return V.duplicates(A.duplicated(spark, sf))


@query(
    "v7_class_distribution",
    f"""WITH {Q.LOG} SELECT count(*) AS total, count(*) FILTER (Class = 0) AS legitimate, count(*) FILTER (Class = 1) AS fraud,
 round(count(*) FILTER (Class = 1) / count(*) * 100, 4) AS fraud_pct, false AS is_imbalanced FROM log""",
)
def _(spark, sf):
    return V.class_distribution(A.log(spark, sf))


@query(
    "v7_class_distribution_rare",
    f"""WITH {Q.LOG}, r AS (SELECT CASE WHEN Class = 1 AND txn_id % 50 = 0 THEN 1 ELSE 0 END AS c FROM log)
 SELECT count(*) AS total, count(*) FILTER (c = 0) AS legitimate, count(*) FILTER (c = 1) AS fraud,
 round(count(*) FILTER (c = 1) / count(*) * 100, 4) AS fraud_pct, count(*) FILTER (c = 1) / count(*) < 0.01 AS is_imbalanced FROM r""",
)
def _(spark, sf):
    rare = ((F.col("Class") == 1) & (F.col("txn_id") % 50 == 0)).cast("int")
    return V.class_distribution(A.log(spark, sf).withColumn("Class", rare))


@query(
    "v8_amount_statistics",
    f"""WITH {Q.LOG} SELECT min(Amount) AS min_amount, max(Amount) AS max_amount, round(avg(Amount), 4) AS mean_amount,
 round(median(Amount), 6) AS median_amount, count(*) FILTER (Amount < 0) AS negative_count, count(*) FILTER (Amount = 0) AS zero_count FROM log""",
)
def _(spark, sf):
    return V.amount_statistics(A.log(spark, sf)).withColumn("median_amount", F.round("median_amount", 6))


_REPORT_SQL = f"""WITH {Q.DIRTY}, f AS (SELECT count(*) FILTER ({_D} OR Amount < 0 OR Amount > 26000) AS broken,
 count(*) FILTER ({_D}) AS nulls, count(*) FILTER (Amount < 0) AS negative FROM dirty)
 SELECT unnest(['schema_validation', 'column_check', 'data_types', 'null_values', 'duplicates', 'amount_validation', 'OVERALL']) AS "check",
 unnest(['FAIL', 'PASS', 'PASS', 'FAIL', 'PASS', 'FAIL', 'FAIL']) AS status,
 unnest([CAST(broken AS VARCHAR), '31', '0', CAST(nulls AS VARCHAR), '0', CAST(negative AS VARCHAR), '']) AS detail FROM f"""


@query("v9_validation_report", _REPORT_SQL)
def _(spark, sf):
    dirty = A.dirty(spark, sf).select(
        F.col("t_us").cast("double").alias("Time"), *S.V_COLS, "Amount", F.col("Class").cast("long").alias("Class")
    )
    return V.validation_report(dirty)


@query(
    "v10_type_profile",
    f"WITH {Q.DIRTY}, x AS (SELECT CASE WHEN txn_id % 500 = 3 THEN 'Infinity'::DOUBLE WHEN isnan(Amount) THEN NULL ELSE Amount END AS Amount, V1, time_s, CAST(card_id AS VARCHAR) AS card FROM dirty) "
    + each(
        ["Amount", "V1"],
        """SELECT '{c}' AS "column", true AS is_numeric, count(*) FILTER (isinf({c})) AS inf_count, min({c}) AS min_value,
 max({c}) AS max_value, CAST(NULL AS BIGINT) AS distinct_values FROM x""",
    )
    + """ UNION ALL SELECT 'time_s', true, 0, CAST(min(time_s) AS DOUBLE), CAST(max(time_s) AS DOUBLE), NULL FROM x
 UNION ALL SELECT 'card', false, 0, NULL, NULL, count(DISTINCT card) FROM x""",
)
def _(spark, sf):
    a = F.when(F.col("txn_id") % 500 == 3, F.lit(float("inf"))).otherwise(F.col("Amount"))
    df = A.dirty(spark, sf).select(
        a.alias("Amount"), "V1", "time_s", F.col("card_id").cast("string").alias("card")
    )
    return V.type_profile(df)


@query(
    "v11_outliers",
    f"WITH {Q.TXN}, "
    + each(
        NUM,
        """s_{c} AS (SELECT '{c}' AS "column", quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
 quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi, avg({c}) AS m, stddev_pop({c}) AS sd FROM txn)""",
        ", ",
    )
    + " "
    + each(
        NUM,
        """SELECT "column", round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound, count(*) FILTER ({c} < lo OR {c} > hi) AS iqr_outliers,
 round(count(*) FILTER ({c} < lo OR {c} > hi) / count(*) * 100, 6) AS iqr_outlier_pct, count(*) FILTER (abs({c} - m) > 3 * sd) AS zscore_outliers,
 round(count(*) FILTER (abs({c} - m) > 3 * sd) / count(*) * 100, 6) AS zscore_outlier_pct,
 count(*) FILTER ({c} < lo OR {c} > hi) / count(*) > 0.1 AS is_high FROM txn, s_{c} GROUP BY 1""",
    ),
)
def _(spark, sf):
    out = V.outliers(A.txn(spark, sf), NUM)
    names = ["lower_bound", "upper_bound", "iqr_outlier_pct", "zscore_outlier_pct"]
    return out.withColumns({c: F.round(c, 6) for c in names})


@query(
    "v12_cardinality",
    f"WITH {Q.TXN} "
    + each(
        ["txn_id", "card_id", *RAW_COLS],
        """SELECT '{c}' AS "column", count(DISTINCT {c}) AS unique_values, round(count(DISTINCT {c}) / count(*), 6) AS cardinality_ratio,
 count(DISTINCT {c}) > 50 AS is_high_cardinality, count(DISTINCT {c}) / count(*) > 0.9 AS is_potential_id FROM txn""",
    ),
)
def _(spark, sf):
    out = V.cardinality(A.txn(spark, sf), ["txn_id", "card_id", *RAW_COLS])
    return out.withColumn("cardinality_ratio", F.round("cardinality_ratio", 6))


_CONST = """SELECT '{c}' AS "column", count(*) = 1 AS is_constant, max(n) / sum(n) > 0.99 AS is_quasi_constant,
 arg_min(CAST(v AS VARCHAR), (-n, CAST(v AS VARCHAR))) AS dominant_value, round(max(n) / sum(n), 6) AS dominant_ratio
 FROM (SELECT {c} AS v, count(*) AS n FROM x GROUP BY 1)"""


@query(
    "v13_constant_features",
    f"WITH {Q.LOG}, x AS (SELECT Class, card_id, 7 AS seven, CASE WHEN txn_id % 500 = 0 THEN 1 ELSE 0 END AS rare, time_s // 86400 AS day FROM log) "
    + each(["Class", "card_id", "seven", "rare", "day"], _CONST),
)
def _(spark, sf):
    df = A.log(spark, sf).select(
        "Class",
        "card_id",
        F.lit(7).alias("seven"),
        (F.col("txn_id") % 500 == 0).cast("int").alias("rare"),
        F.floor(F.col("time_s") / 86400).alias("day"),
    )
    out = V.constant_features(df, df.columns)
    return out.withColumn("dominant_ratio", F.round("dominant_ratio", 6))


_CORR = ["Amount", "double_amount", "neg_amount", "V1", "V2", "V3"]


@query(
    "v14_correlated_pairs",
    f"WITH {Q.TXN}, x AS (SELECT Amount, Amount * 2 + 1 AS double_amount, -Amount + V1 AS neg_amount, V1, V2, V3 FROM txn) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature1, '{b}' AS feature2, round(corr({a}, {b}), 6) AS correlation FROM x HAVING abs(corr({a}, {b})) > 0.95"
        for i, a in enumerate(_CORR)
        for b in _CORR[i + 1 :]
    ),
)
def _(spark, sf):
    df = A.txn(spark, sf).select(
        "Amount",
        (F.col("Amount") * 2 + 1).alias("double_amount"),
        (-F.col("Amount") + F.col("V1")).alias("neg_amount"),
        "V1",
        "V2",
        "V3",
    )
    pairs = V.correlation_pairs(df, _CORR).where(F.abs("correlation") > S.HIGH_CORRELATION)
    return pairs.withColumn("correlation", F.round("correlation", 6))


@query(
    "v15_moments",
    f"WITH {Q.TXN} "
    + each(
        NUM,
        """SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(skewness({c}), 6) AS skewness,
 round(kurtosis({c}), 6) AS kurtosis FROM txn""",
    ),
)
def _(spark, sf):
    out = V.moments(A.txn(spark, sf), NUM)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "skewness", "kurtosis")})


@query("v16_normality")
def _(spark, sf):
    return V.normality(A.txn(spark, sf), NUM)


@query(
    "v17_issue_list",
    f"""WITH {Q.TXN}, x AS (SELECT txn_id, Amount, CASE WHEN txn_id % 3 = 0 THEN NULL ELSE Amount END AS gappy, Amount * 2 AS twice, 1.0::DOUBLE AS one,
 CASE WHEN Class = 1 AND txn_id % 50 = 0 THEN 1 ELSE 0 END AS Class FROM txn UNION ALL SELECT txn_id, Amount, CASE WHEN txn_id % 3 = 0 THEN NULL ELSE Amount END,
 Amount * 2, 1.0, CASE WHEN Class = 1 AND txn_id % 50 = 0 THEN 1 ELSE 0 END FROM txn WHERE txn_id % 100 = 0)
 SELECT 'HIGH_MISSING_VALUES' AS issue_code, 'gappy' AS detail UNION ALL
 SELECT 'DUPLICATE_ROWS', CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM x)) AS VARCHAR) FROM x UNION ALL
 SELECT 'POTENTIAL_ID_COLUMNS', 'txn_id' UNION ALL
 SELECT 'CONSTANT_FEATURES', 'one' UNION ALL SELECT 'QUASI_CONSTANT_FEATURES', 'Class,one' UNION ALL
 SELECT 'HIGH_CORRELATIONS', '3' UNION ALL
 SELECT 'CLASS_IMBALANCE', CAST(round(count(*) FILTER (Class = 1) / count(*) * 100, 4) AS VARCHAR) FROM x""",
)
def _(spark, sf):
    a = F.col("Amount")
    df = A.duplicated(spark, sf).select(
        "txn_id",
        "Amount",
        F.when(F.col("txn_id") % 3 != 0, a).alias("gappy"),
        (a * 2).alias("twice"),
        F.lit(1.0).alias("one"),
        ((F.col("Class") == 1) & (F.col("txn_id") % 50 == 0)).cast("int").alias("Class"),
    )
    return V.issues(df, ["txn_id", "Amount", "gappy", "twice", "one"])


@query(
    "v18_request_errors",
    f"""WITH {Q.DIRTY} SELECT txn_id, CASE WHEN a > 30000 THEN '422:amount_exceeds_maximum' WHEN a IS NULL THEN '422:amount_missing_or_not_numeric'
 WHEN a < 0 THEN '422:amount_negative' END AS error FROM (SELECT txn_id, CASE WHEN NOT isnan(Amount) THEN Amount END AS a FROM dirty)""",
)
def _(spark, sf):
    df = A.dirty(spark, sf)
    a = F.when(~missing(df, "Amount"), F.col("Amount"))
    return df.select("txn_id", V.request_error(a, F.col("time_s")).alias("error"))


@query(
    "v19_negative_repair",
    f"""WITH {Q.DIRTY} SELECT count(*) FILTER (Amount < 0) AS negative_count,
 round(sum(CASE WHEN Amount < 0 THEN 0.0 WHEN isnan(Amount) THEN 0.0 ELSE Amount END), 4) AS repaired_total FROM dirty""",
)
def _(spark, sf):
    df = A.dirty(spark, sf)
    fixed = V.repair_negative_amounts(df).agg(F.round(F.sum(F.nanvl("Amount", F.lit(0.0))), 4).alias("repaired_total"))
    return V.negative_amount_count(df).crossJoin(fixed)  # one row each


_SPLIT = f"""{Q.LOG}, cut AS (SELECT min(time_s) + 0.8 * (max(time_s) - min(time_s)) AS edge FROM log)"""


@query(
    "v20_split_integrity",
    f"""WITH {_SPLIT}, a AS (SELECT l.*, time_s <= edge AS train FROM log l, cut)
 SELECT count(*) FILTER (train) AS train_size, CAST(sum(Class) FILTER (train) AS BIGINT) AS train_fraud,
 round(avg(Class) FILTER (train) * 100, 6) AS train_fraud_pct, min(time_s) FILTER (train) AS train_min_time, max(time_s) FILTER (train) AS train_max_time,
 count(*) FILTER (NOT train) AS test_size, CAST(sum(Class) FILTER (NOT train) AS BIGINT) AS test_fraud,
 round(avg(Class) FILTER (NOT train) * 100, 6) AS test_fraud_pct, min(time_s) FILTER (NOT train) AS test_min_time, max(time_s) FILTER (NOT train) AS test_max_time,
 0::BIGINT AS overlap, round(count(*) FILTER (train) / count(*), 4) AS train_ratio, true AS temporal_ok, true AS fraud_in_both FROM a""",
)
def _(spark, sf):
    train, test, _at = prep.chronological_split(A.log(spark, sf))
    out = V.split_integrity(train, test)
    return out.withColumns({c: F.round(c, 6) for c in ("train_fraud_pct", "test_fraud_pct")})


@query(
    "u2_split_overlap",
    f"""WITH {Q.LOG} SELECT count(*) AS overlap FROM (SELECT txn_id FROM log WHERE txn_id % 3 = 0 INTERSECT SELECT txn_id FROM log WHERE txn_id % 5 = 0)""",
)
def _(spark, sf):
    rows = A.log(spark, sf).select("txn_id")
    return rows.where("txn_id % 3 = 0").intersect(rows.where("txn_id % 5 = 0")).agg(F.count(F.lit(1)).alias("overlap"))


@query(
    "p18_chronological_split",
    f"WITH {_SPLIT} SELECT txn_id, CASE WHEN time_s <= edge THEN 'train' ELSE 'test' END AS side FROM log, cut",
)
def _(spark, sf):
    train, test, _at = prep.chronological_split(A.log(spark, sf).select("txn_id", "time_s"))
    return train.select("txn_id", F.lit("train").alias("side")).unionByName(test.select("txn_id", F.lit("test").alias("side")))
