"""Projection, scaling and window-feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskengine.catalog import sql as Q
from riskengine.catalog.registry import query
from riskengine.functions import features as X
from riskengine.functions.columns import content_hash
from riskengine.operators import prep, ranking, windows
from riskengine.plans import features as P
from riskengine.schema import V_COLS
from riskengine.sources import adapter as A

H, D = windows.HOUR, windows.DAY


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---- cleaning and scaling ----


@query("p1_drop_duplicates", f"WITH {Q.DUPLICATED} SELECT DISTINCT txn_id, time_s, Amount, Class, V1, V28 FROM duplicated")
def _(spark, sf):
    return prep.drop_duplicate_rows(A.duplicated(spark, sf)).select("txn_id", "time_s", "Amount", "Class", "V1", "V28")


@query(
    "p1_first_per_key",
    f"""WITH {Q.LOG} SELECT card_id, arg_min(txn_id, (ts, txn_id)) AS txn_id, arg_min(Amount, (ts, txn_id)) AS Amount, min(ts) AS ts FROM log GROUP BY card_id""",
)
def _(spark, sf):
    return prep.first_per_key(A.log(spark, sf).select("card_id", "txn_id", "Amount", "ts"), ["card_id"], ["ts", "txn_id"])


def _scaled(center, scale):
    return f"""WITH {Q.LOG}, s AS (SELECT {center.format(c='Amount')} AS ca, {scale.format(c='Amount')} AS sa,
 {center.format(c='time_s')} AS ct, {scale.format(c='time_s')} AS st FROM log)
 SELECT txn_id, round((Amount - ca) / sa, 6) AS Amount, round((time_s - ct) / st, 6) AS Time, Amount AS Amount_raw, CAST(time_s AS DOUBLE) AS Time_raw FROM log, s"""


def scaled(spark, sf, kind):
    df = A.log(spark, sf).select("txn_id", "Amount", F.col("time_s").cast("double").alias("Time"))
    out = prep.apply_scaler(df, prep.fit_scaler(df, ["Amount", "Time"], kind))
    return rounded(out, ["Amount", "Time"])


@query("p2_standard_scaling", _scaled("avg({c})", "stddev_pop({c})"))
def _(spark, sf):
    return scaled(spark, sf, "standard")


@query("p3_robust_scaling", _scaled("median({c})", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"))
def _(spark, sf):
    return scaled(spark, sf, "robust")


@query("x9_minmax_scaling", _scaled("min({c})", "(max({c}) - min({c}))"))
def _(spark, sf):
    return scaled(spark, sf, "minmax")


@query(
    "j9_stat_broadcast",
    f"""WITH {Q.LOG} SELECT txn_id, round(Amount / avg(Amount) OVER (), 6) AS share_of_mean FROM log""",
)
def _(spark, sf):
    df = A.log(spark, sf).select("txn_id", "Amount")
    one = df.agg(F.avg("Amount").alias("m"))  # a single row
    return df.crossJoin(F.broadcast(one)).select("txn_id", F.round(F.col("Amount") / F.col("m"), 6).alias("share_of_mean"))


@query(
    "p4_log_transforms",
    f"""WITH {Q.LOG}, s AS (SELECT avg(Amount) AS m, stddev_pop(Amount) AS sd FROM log)
 SELECT txn_id, round(ln(1 + Amount), 6) AS amount_log, CASE WHEN (Amount - m) / sd > -1 THEN round(ln(1 + (Amount - m) / sd), 6) END AS amount_log_scaled FROM log, s""",
)
def _(spark, sf):
    df = A.log(spark, sf).select("txn_id", "Amount")
    out = prep.log_amount(prep.apply_scaler(df, prep.fit_scaler(df, ["Amount"])))
    return rounded(out.transform(X.amount_log), ["amount_log", "amount_log_scaled"]).select(
        "txn_id", "amount_log", "amount_log_scaled"
    )


@query(
    "p26_preprocess_stage",
    f"""WITH {Q.RAW}, c AS (SELECT DISTINCT * FROM raw), s AS (SELECT avg(Amount) AS ma, stddev_pop(Amount) AS sa, avg(Time) AS mt, stddev_pop(Time) AS st FROM c)
 SELECT Time AS Time_raw, Amount AS Amount_raw, round((Time - mt) / st, 6) AS Time, round((Amount - ma) / sa, 6) AS Amount,
 CASE WHEN (Amount - ma) / sa > -1 THEN round(ln(1 + (Amount - ma) / sa), 6) END AS amount_log_scaled, Class, V1, V28 FROM c, s""",
)
def _(spark, sf):
    out, _scaler = prep.preprocess(A.raw(spark, sf))
    return rounded(out, ["Time", "Amount", "amount_log_scaled"]).select(
        "Time_raw", "Amount_raw", "Time", "Amount", "amount_log_scaled", "Class", "V1", "V28"
    )


@query(
    "x9_median_imputation",
    f"""WITH {Q.DIRTY}, c AS (SELECT txn_id, CASE WHEN NOT isnan(Amount) THEN Amount END AS Amount FROM dirty)
 SELECT txn_id, round(coalesce(Amount, (SELECT median(Amount) FROM c)), 6) AS Amount FROM c""",
)
def _(spark, sf):
    return rounded(prep.impute(A.dirty(spark, sf).select("txn_id", "Amount"), ["Amount"], "median"), ["Amount"])


# ---- row-local features ----

_CAL = """CAST(time_s // 3600 % 24 AS INTEGER) AS hour, CAST(time_s // 86400 AS INTEGER) AS day,
 round(sin(2 * pi() * (time_s // 3600 % 24) / 24), 6) AS hour_sin, round(cos(2 * pi() * (time_s // 3600 % 24) / 24), 6) AS hour_cos,
 CAST(time_s // 3600 % 24 AS INTEGER) AS hour_of_day, CASE WHEN time_s // 3600 % 24 <= 5 THEN 1 ELSE 0 END AS is_night"""


@query("p5_calendar", f"WITH {Q.LOG} SELECT txn_id, {_CAL} FROM log")
def _(spark, sf):
    return rounded(A.log(spark, sf).select("txn_id", "time_s").transform(X.calendar), ["hour_sin", "hour_cos"]).drop("time_s")


_PRODUCTS = ", ".join(f"round({a} * {b}, 8) AS {a}_{b}" for a, b in X.INTERACTIONS)
# a quotient of two small numbers can be huge: compare 6 significant digits of it
_RATIOS = ", ".join(f"round({a} / ({b} + 1e-8::DOUBLE), 4) AS {a}_to_{b}" for a, b in X.COMPONENT_RATIOS)


@query("p6_pairwise_products", f"WITH {Q.TXN} SELECT txn_id, {_PRODUCTS} FROM txn")
def _(spark, sf):
    out = A.txn(spark, sf).transform(X.interactions)
    names = [f"{a}_{b}" for a, b in X.INTERACTIONS]
    return rounded(out.select("txn_id", *names), names, 8)


@query("p7_component_ratios", f"WITH {Q.TXN} SELECT txn_id, {_RATIOS} FROM txn")
def _(spark, sf):
    out = A.txn(spark, sf).transform(X.interactions)
    names = [f"{a}_to_{b}" for a, b in X.COMPONENT_RATIOS]
    return rounded(out.select("txn_id", *names), names, 4)


_SIGNAL = "round(" + " + ".join(f"abs({c})" for c in X.SIGNAL_COLUMNS) + ", 8) AS fraud_feature_magnitude, " + " + ".join(
    f"CASE WHEN {c} < 0 THEN 1 ELSE 0 END" for c in X.SIGNAL_COLUMNS
) + " AS fraud_direction_score"


@query("p11_signal_score", f"WITH {Q.TXN} SELECT txn_id, {_SIGNAL} FROM txn")
def _(spark, sf):
    out = A.txn(spark, sf).transform(X.signal_score)
    return rounded(out, ["fraud_feature_magnitude"], 8).select("txn_id", "fraud_feature_magnitude", "fraud_direction_score")


@query(
    "p12_flags",
    f"""WITH {Q.LOG} SELECT txn_id, CASE WHEN floor(Amount) = 0 THEN 1 ELSE 0 END AS is_zero_amount, 0.0::DOUBLE AS amount_skew_1h,
 CASE WHEN time_s // 3600 % 24 <= 5 THEN 1 ELSE 0 END AS is_night FROM log""",
)
def _(spark, sf):
    whole = A.log(spark, sf).withColumn("Amount", F.floor("Amount"))  # so that zero amounts exist
    return whole.transform(X.calendar).transform(X.flags).select("txn_id", "is_zero_amount", "amount_skew_1h", "is_night")


@query(
    "p15_serving_projection",
    f"WITH {Q.TXN} SELECT txn_id, {_CAL}, round(ln(1 + Amount), 6) AS amount_log, {_PRODUCTS}, {_RATIOS}, {_SIGNAL}, CASE WHEN Amount = 0 THEN 1 ELSE 0 END AS is_zero_amount FROM txn",
)
def _(spark, sf):
    rows = A.txn(spark, sf)
    out = rows.transform(X.stateless).drop(*[c for c in rows.columns if c != "txn_id"])
    products = [f"{a}_{b}" for a, b in X.INTERACTIONS]
    ratios = [f"{a}_to_{b}" for a, b in X.COMPONENT_RATIOS]
    out = rounded(out, ["hour_sin", "hour_cos", "amount_log"])
    return rounded(rounded(out, [*products, "fraud_feature_magnitude"], 8), ratios, 4)


@query(
    "p16_content_hash",
    f"""WITH {Q.LOG} SELECT txn_id, sha256('{{"Class":' || Class || ',"card_id":' || card_id || ',"time_s":' || time_s || ',"txn_id":' || txn_id || '}}') AS hash FROM log""",
)
def _(spark, sf):
    return A.log(spark, sf).select("txn_id", content_hash(["txn_id", "card_id", "time_s", "Class"]).alias("hash"))


@query("p19_hash_sample")
def _(spark, sf):
    return prep.hash_sample(A.log(spark, sf), 5000).orderBy("time_s", "txn_id")


@query(
    "p25_generated_ids",
    f"""WITH {Q.LOG} SELECT txn_id, sha256('txn-' || txn_id) AS generated_id, TIMESTAMP '2024-02-01' AS created_at FROM log""",
)
def _(spark, sf):
    return A.log(spark, sf).select(
        "txn_id",
        F.sha2(F.concat(F.lit("txn-"), F.col("txn_id").cast("string")), 256).alias("generated_id"),
        F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'").alias("created_at"),
    )


# ---- windows ----


STD_DIGITS = 6


def snapped(df, cols):
    """Amounts in cents over a power of two are exact ties at six places: take the float
    noise off at nine places first, on both sides."""
    return rounded(rounded(df, cols, 9), cols, 6)


def stats(df, spec, **kw):
    out = snapped(windows.trailing_stats(df, spec, **kw), [f"avg_{t}" for t in spec])
    return rounded(out, [f"std_{t}" for t in spec], STD_DIGITS)


def _stats_sql(table, tags, key="txn_id", by=""):
    ctes = ", ".join(Q.trailing(table, w, t, key, by) for t, w in tags.items())
    first = next(iter(tags))
    joins = " ".join(f"JOIN {t} USING ({key})" for t in tags if t != first)
    cols = ", ".join(
        f"CAST(count_{t} AS BIGINT) AS count_{t}, round(round(avg_{t}, 9), 6) AS avg_{t}, round(std_{t}, {STD_DIGITS}) AS std_{t}" for t in tags
    )
    return ctes, f"SELECT {key}, {cols} FROM {first} {joins}"


def _window_query(name, tags, table=Q.LOG, source="log", key="txn_id", by=""):
    ctes, body = _stats_sql(source, tags, key, by)
    return name, f"WITH {table}, {ctes} {body}"


@query(*_window_query("w1_trailing_window", {"w1h": H}))
def _(spark, sf):
    return stats(A.log(spark, sf).select("txn_id", "time_s", "Amount"), {"w1h": H}).drop("time_s", "Amount")


@query(*_window_query("w1_trailing_window_ties", {"w2d": 2 * D}, Q.SHIPMENTS, "shipments", ", ".join(A.SHIPMENT_KEY)))
def _(spark, sf):
    rows = A.shipments(spark, sf).select(*A.SHIPMENT_KEY, "time_s")
    return stats(rows, {"w2d": 2 * D}, key=A.SHIPMENT_KEY).drop("time_s")


@query(*_window_query("w1_trailing_window_split_ties", {"w1d": D}, Q.SHIPMENTS, "shipments", ", ".join(A.SHIPMENT_KEY)))
def _(spark, sf):
    """The same operator on the plan for seconds too full for one task."""
    rows = A.shipments(spark, sf).select(*A.SHIPMENT_KEY, "time_s")
    return stats(rows, {"w1d": D}, key=A.SHIPMENT_KEY, split_ties=True).drop("time_s")


@query(*_window_query("w2_global_velocity", {"w1h": H, "w24h": D}))
def _(spark, sf):
    return stats(A.log(spark, sf).select("txn_id", "time_s", "Amount"), {"w1h": H, "w24h": D}).drop("time_s", "Amount")


@query(*_window_query("w3_ten_minute_burst", {"w10m": 600}))
def _(spark, sf):
    return stats(A.log(spark, sf).select("txn_id", "time_s", "Amount"), {"w10m": 600}).drop("time_s", "Amount")


@query(*_window_query("x6_card_windows", {"w1h": H, "w6h": 6 * H, "w24h": D, "w7d": 7 * D}, by="card_id"))
def _(spark, sf):
    rows = A.log(spark, sf).select("txn_id", "card_id", "time_s", "Amount")
    out = stats(rows, {"w1h": H, "w6h": 6 * H, "w24h": D, "w7d": 7 * D}, by=["card_id"])
    return out.drop("card_id", "time_s", "Amount")


BUCKET = f"""{Q.LOG}, bucketed AS (SELECT *, greatest(1, ((r - 1) * 10 + n - 2) // (n - 1)) AS amount_bucket FROM (SELECT *,
 row_number() OVER (ORDER BY Amount, time_s, txn_id) AS r, count(*) OVER () AS n FROM log))"""


@query("w4_decile_bucket", f"WITH {BUCKET} SELECT txn_id, CAST(amount_bucket AS INTEGER) AS amount_bucket FROM bucketed")
def _(spark, sf):
    rows = A.log(spark, sf).select("txn_id", "time_s", "Amount")
    return ranking.quantile_bucket(rows, ["Amount", "time_s", "txn_id"], "amount_bucket").select("txn_id", "amount_bucket")


_SEG = f"""{BUCKET}, {Q.trailing('bucketed', H, 'seg', by='amount_bucket')}"""


@query(
    "w5_segment_velocity",
    f"""WITH {_SEG} SELECT txn_id, CAST(amount_bucket AS INTEGER) AS amount_bucket, CAST(count_seg AS BIGINT) AS txn_count_1h_by_bucket,
 round(round(avg_seg, 9), 6) AS avg_amount_1h_by_bucket, round(Amount / (avg_seg + 1e-6::DOUBLE), 6) AS amount_to_bucket_avg_ratio,
 coalesce(time_s - lag(time_s) OVER (PARTITION BY amount_bucket ORDER BY time_s, txn_id), 0) AS time_since_last_txn_same_bucket
 FROM seg JOIN bucketed USING (txn_id)""",
)
def _(spark, sf):
    out = P.segment(A.log(spark, sf).select("txn_id", "time_s", "Amount")).drop("time_s", "Amount")
    return rounded(snapped(out, ["avg_amount_1h_by_bucket"]), ["amount_to_bucket_avg_ratio"])


@query(
    "w6_recency",
    f"""WITH {Q.LOG} SELECT txn_id, coalesce(time_s - lag(time_s) OVER (ORDER BY time_s, txn_id), 0) AS time_since_last_txn,
 coalesce(time_s - lag(time_s) OVER (PARTITION BY card_id ORDER BY time_s, txn_id), 0) AS time_since_last_card FROM log""",
)
def _(spark, sf):
    rows = A.log(spark, sf).select("txn_id", "card_id", "time_s", "Amount")
    overall = windows.trailing_stats(rows, {}, recency="time_since_last_txn")
    both = windows.trailing_stats(overall, {}, by=["card_id"], recency="time_since_last_card", cells_from=rows)
    return both.select("txn_id", "time_since_last_txn", "time_since_last_card")


@query(
    "w7_percentile_rank",
    f"""WITH {Q.LOG} SELECT txn_id, round((rank() OVER (ORDER BY Amount) + (count(*) OVER (PARTITION BY Amount) - 1) / 2) / count(*) OVER (), 9) AS amount_percentile FROM log""",
)
def _(spark, sf):
    out = ranking.percentile_rank(A.log(spark, sf).select("txn_id", "Amount"), "Amount", "amount_percentile")
    return rounded(out, ["amount_percentile"], 9).drop("Amount")


_R = f"ORDER BY time_s RANGE BETWEEN {H} PRECEDING AND CURRENT ROW"


@query(
    "w8_window_range_skew",
    f"""WITH {Q.LOG}, j AS (SELECT a.txn_id, a.Amount, b.Amount AS x FROM log a JOIN log b ON b.time_s BETWEEN a.time_s - {H} AND a.time_s
  AND (b.time_s < a.time_s OR b.txn_id <= a.txn_id)),
 g AS (SELECT txn_id, any_value(Amount) AS a, min(x) AS lo, max(x) AS hi, avg(x) AS m FROM j GROUP BY txn_id),
 h AS (SELECT g.txn_id, avg((x - m) ** 2) AS m2, avg((x - m) ** 3) AS m3 FROM j JOIN g USING (txn_id) GROUP BY g.txn_id)
 SELECT txn_id, round(hi - lo, 6) AS amount_range_1h_true, CASE WHEN hi > lo THEN round((a - lo) / (hi - lo), 6) ELSE 0.5 END AS amount_percentile_in_range_1h_true,
 CASE WHEN hi > lo AND m2 > 0 THEN round(m3 / m2 ** 1.5, 4) ELSE 0.0 END AS amount_skew_1h_true FROM g JOIN h USING (txn_id)""",
)
def _(spark, sf):
    out = windows.window_range(A.log(spark, sf).select("txn_id", "time_s", "Amount"), H)
    out = rounded(out, ["amount_range_1h_true", "amount_percentile_in_range_1h_true"])
    return rounded(out, ["amount_skew_1h_true"], 4).drop("time_s", "Amount")


_DEV = f"""{Q.LOG}, {Q.trailing('log', H, 'w1h')}, {Q.trailing('log', D, 'w24h')},
 j AS (SELECT l.txn_id, l.Amount AS a, avg_w1h AS a1, std_w1h AS s1, avg_w24h AS a24, count_w1h AS n1, count_w24h AS n24
 FROM log l JOIN w1h USING (txn_id) JOIN w24h USING (txn_id))"""


def with_velocity(spark, sf):
    return P.velocity(A.log(spark, sf).select("txn_id", "time_s", "Amount"), P.BASE_WINDOWS)


@query(
    "p8_amount_deviation",
    f"""WITH {_DEV} SELECT txn_id, round(a / (a1 + 1e-6::DOUBLE), 5) AS amount_ratio_1h, round(a / (a24 + 1e-6::DOUBLE), 5) AS amount_ratio_24h,
 round((a - a1) / (s1 + 1e-6::DOUBLE), 5) AS amount_zscore_1h, round(s1 / (a1 + 1e-6::DOUBLE), 5) AS amount_cv_1h FROM j""",
)
def _(spark, sf):
    names = ["amount_ratio_1h", "amount_ratio_24h", "amount_zscore_1h", "amount_cv_1h"]
    out = with_velocity(spark, sf).transform(X.amount_deviation)
    return rounded(out, names, 5).select("txn_id", *names)


@query(
    "p9_constant_features",
    f"WITH {Q.LOG} SELECT txn_id, 0.0::DOUBLE AS amount_range_1h, 0.5::DOUBLE AS amount_percentile_in_range, 0.0::DOUBLE AS amount_skew_1h FROM log",
)
def _(spark, sf):
    out = A.log(spark, sf).transform(X.amount_deviation).transform(X.flags)
    return out.select("txn_id", "amount_range_1h", "amount_percentile_in_range", "amount_skew_1h")


@query(
    "p10_burst_ratio",
    f"WITH {_DEV} SELECT txn_id, round(n1 * 24 / (n24 + 1), 6) AS velocity_spike_ratio FROM j",
)
def _(spark, sf):
    out = with_velocity(spark, sf).transform(X.burst_ratio)
    return rounded(out, ["velocity_spike_ratio"]).select("txn_id", "velocity_spike_ratio")


@query(
    "p23_lonely_segment_fill",
    f"""WITH {Q.LOG}, l AS (SELECT txn_id, Amount, time_s, txn_id AS seg FROM log) SELECT txn_id, 1::BIGINT AS count_own, round(Amount, 6) AS avg_own FROM l""",
)
def _(spark, sf):
    """A segment with a single row has count 1 and its own amount as average."""
    rows = A.log(spark, sf).select("txn_id", "time_s", "Amount", F.col("txn_id").alias("seg"))
    out = windows.trailing_stats(rows, {"own": H}, by=["seg"])
    return rounded(out, ["avg_own"]).select("txn_id", "count_own", "avg_own")


_BASE_CTES = f"""{_SEG}, {Q.trailing('bucketed', H, 'w1h')}, {Q.trailing('bucketed', D, 'w24h')}, rec AS (SELECT txn_id,
 coalesce(time_s - lag(time_s) OVER (ORDER BY time_s, txn_id), 0) AS time_since_last_txn,
 coalesce(time_s - lag(time_s) OVER (PARTITION BY amount_bucket ORDER BY time_s, txn_id), 0) AS time_since_last_txn_same_bucket FROM bucketed),
 vec AS (SELECT vec_id, {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(V_COLS))} FROM embeddings)"""
_BASE_COLUMNS = f"""b.txn_id, b.Class, b.Amount, {_CAL}, CAST(count_w1h AS BIGINT) AS txn_count_1h, round(round(avg_w1h, 9), 6) AS avg_amount_1h, round(std_w1h, 6) AS std_amount_1h,
 CAST(count_w24h AS BIGINT) AS txn_count_24h, round(round(avg_w24h, 9), 6) AS avg_amount_24h, round(std_w24h, 6) AS std_amount_24h,
 CAST(amount_bucket AS INTEGER) AS amount_bucket, CAST(count_seg AS BIGINT) AS txn_count_1h_by_bucket, round(round(avg_seg, 9), 6) AS avg_amount_1h_by_bucket,
 round(round(b.Amount / (avg_seg + 1e-6::DOUBLE), 9), 6) AS amount_to_bucket_avg_ratio, time_since_last_txn, time_since_last_txn_same_bucket,
 round(round(ln(1 + b.Amount), 9), 6) AS amount_log, {Q.V_LIST}"""
_BASE_FROM = """bucketed b JOIN seg USING (txn_id) JOIN w1h USING (txn_id) JOIN w24h USING (txn_id)
 JOIN rec USING (txn_id) JOIN vec ON vec_id = b.txn_id % (SELECT count(*) FROM embeddings)"""
_BASELINE = f"WITH {_BASE_CTES} SELECT {_BASE_COLUMNS} FROM {_BASE_FROM}"

_DEVIATION_COLUMNS = ["std_amount_1h", "std_amount_24h"]
_BASELINE_FLOATS = [
    "hour_sin", "hour_cos", "avg_amount_1h", "std_amount_1h", "avg_amount_24h", "std_amount_24h",
    "avg_amount_1h_by_bucket", "amount_to_bucket_avg_ratio", "amount_log",
]


@query("p14_baseline_feature_set", _BASELINE)
def _(spark, sf):
    out = P.baseline(A.txn(spark, sf).drop("card_id", "ts", "t_us")).drop("time_s")
    return snapped(rounded(out, _DEVIATION_COLUMNS), [c for c in _BASELINE_FLOATS if c not in _DEVIATION_COLUMNS])


_DEVIATIONS = ["amount_ratio_1h", "amount_ratio_24h", "amount_zscore_1h", "amount_cv_1h"]
_ADVANCED = f"""WITH {_BASE_CTES}, {Q.trailing('bucketed', 600, 'w10m')}, pr AS (SELECT txn_id,
 round((rank() OVER (ORDER BY Amount) + (count(*) OVER (PARTITION BY Amount) - 1) / 2) / count(*) OVER (), 9) AS amount_percentile FROM bucketed)
 SELECT {_BASE_COLUMNS}, {_PRODUCTS}, {_RATIOS}, {_SIGNAL}, round(b.Amount / (avg_w1h + 1e-6::DOUBLE), 5) AS amount_ratio_1h,
 round(b.Amount / (avg_w24h + 1e-6::DOUBLE), 5) AS amount_ratio_24h, round((b.Amount - avg_w1h) / (std_w1h + 1e-6::DOUBLE), 5) AS amount_zscore_1h,
 round(std_w1h / (avg_w1h + 1e-6::DOUBLE), 5) AS amount_cv_1h, 0.0::DOUBLE AS amount_range_1h, 0.5::DOUBLE AS amount_percentile_in_range,
 0.0::DOUBLE AS amount_skew_1h, CAST(count_w10m AS BIGINT) AS txn_count_10min, round(round(avg_w10m, 9), 6) AS avg_amount_10min,
 round(count_w1h * 24 / (count_w24h + 1), 6) AS velocity_spike_ratio, time_since_last_txn AS seconds_since_last_txn, amount_percentile,
 CAST(amount_bucket AS INTEGER) AS amount_decile, CASE WHEN b.Amount = 0 THEN 1 ELSE 0 END AS is_zero_amount, true AS anomaly_decision, true AS anomaly_share
 FROM {_BASE_FROM} JOIN w10m USING (txn_id) JOIN pr USING (txn_id)"""


@query("p14_advanced_feature_set", _ADVANCED)
def _(spark, sf):
    """The anomaly columns have no SQL twin value by value: each row shows whether the score lies in
    (0, 1], and whether the flagged share of all rows is the contamination."""
    out = P.advanced(A.txn(spark, sf).drop("card_id", "ts", "t_us")).drop("time_s")
    share = out.agg(F.avg("anomaly_score").alias("_share"))  # one row
    out = out.crossJoin(F.broadcast(share)).withColumns(
        {"anomaly_decision": (F.col("anomaly_decision") > 0) & (F.col("anomaly_decision") <= 1), "anomaly_share": F.abs(F.col("_share") - 0.01) < 0.002}
    ).drop("_share", "anomaly_score")
    products = [f"{a}_{b}" for a, b in X.INTERACTIONS]
    ratios = [f"{a}_to_{b}" for a, b in X.COMPONENT_RATIOS]
    out = rounded(out, _DEVIATION_COLUMNS)
    out = snapped(out, [*[c for c in _BASELINE_FLOATS if c not in _DEVIATION_COLUMNS], "avg_amount_10min"])
    out = rounded(rounded(out, [*products, "fraud_feature_magnitude"], 8), ratios, 4)
    return rounded(rounded(rounded(out, _DEVIATIONS, 5), ["velocity_spike_ratio"]), ["amount_percentile"], 9)
