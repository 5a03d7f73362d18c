"""Descriptive queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskengine.catalog import sql as Q
from riskengine.catalog.checks import each
from riskengine.catalog.registry import query
from riskengine.operators import profiling as D
from riskengine.operators import quality as V
from riskengine.schema import V_COLS
from riskengine.sources import adapter as A


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query(
    "a11_fraud_by_hour",
    f"""WITH {Q.LOG} SELECT CAST(time_s // 3600 % 24 AS INTEGER) AS hour, count(*) AS total, CAST(sum(Class) AS BIGINT) AS fraud,
 round(sum(Class) / count(*) * 100, 6) AS fraud_rate FROM log GROUP BY 1""",
)
def _(spark, sf):
    return rounded(D.hourly_rate(A.log(spark, sf)), ["fraud_rate"])


@query(
    "a11_fraud_by_absolute_hour",
    f"""WITH {Q.LOG} SELECT time_s // 3600 AS abs_hour, count(*) AS volume, round(avg(Class) * 100, 6) AS fraud_rate FROM log GROUP BY 1""",
)
def _(spark, sf):
    return rounded(D.absolute_hour_rate(A.log(spark, sf)), ["fraud_rate"])


@query(
    "a12_amount_by_class",
    f"""WITH {Q.LOG} SELECT Class, round(avg(Amount), 6) AS mean, round(stddev_samp(Amount), 6) AS std, min(Amount) AS min, max(Amount) AS max,
 round(quantile_cont(Amount, 0.5), 6) AS median, {", ".join(f"round(quantile_cont(Amount, {p / 100}), 6) AS p{p}" for p in D.PERCENTS)} FROM log GROUP BY Class""",
)
def _(spark, sf):
    return rounded(D.amount_by_class(A.log(spark, sf)), ["mean", "std", "median", *[f"p{p}" for p in D.PERCENTS]])


@query(
    "a13_descriptive_statistics",
    f"WITH {Q.TXN}, x AS (SELECT *, time_s / 3600 AS hours FROM txn) "
    + each(
        ["Amount", "hours", *V_COLS],
        """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min,
 round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
 round(CAST(max({c}) AS DOUBLE), 6) AS max, round(var_samp({c}), 4) AS variance, round(CAST(max({c}) - min({c}) AS DOUBLE), 6) AS range FROM x""",
    ),
)
def _(spark, sf):
    out = D.descriptive(A.txn(spark, sf).withColumn("hours", F.col("time_s") / 3600), ["Amount", "hours", *V_COLS])
    return rounded(out, ["mean", "std", "min", "q25", "q50", "q75", "max", "range"]).withColumn(
        "variance", F.round("variance", 4)
    )


_RANK = f"WITH {Q.TXN}, c AS (" + each(
    [*V_COLS, "Amount"], """SELECT '{c}' AS "column", round(corr({c}, Class), 6) AS correlation FROM txn"""
) + ")"


@query(
    "a14_label_correlation",
    f"""{_RANK} SELECT "column", correlation, abs(correlation) AS abs_correlation FROM c""",
)
def _(spark, sf):
    out = D.ranked_correlation(A.txn(spark, sf), [*V_COLS, "Amount"])
    return rounded(out, ["correlation", "abs_correlation"])


@query(
    "s13_correlation_ranking",
    f"""{_RANK} SELECT "column" AS feature, correlation, row_number() OVER (ORDER BY abs(correlation) DESC, "column") AS place FROM c""",
)
def _(spark, sf):
    from pyspark.sql import Window

    # one row per feature, so the numbering is over a fixed handful of rows
    out = rounded(D.label_correlation(A.txn(spark, sf), [*V_COLS, "Amount"]), ["correlation"])
    place = F.row_number().over(Window.orderBy(F.abs("correlation").desc(), "column")).cast("long")
    return out.select(F.col("column").alias("feature"), "correlation", place.alias("place"))


@query(
    "t2_top_features",
    f"""{_RANK} SELECT "column", correlation FROM c ORDER BY abs(correlation) DESC, "column" LIMIT 15""",
)
def _(spark, sf):
    out = D.ranked_correlation(A.txn(spark, sf), [*V_COLS, "Amount"], top=15)
    return rounded(out.select("column", "correlation"), ["correlation"])


_MATRIX = ["Class", "Amount", "time_s", *V_COLS]


@query(
    "a15_correlation_matrix",
    f"WITH {Q.TXN} SELECT unnest([{', '.join(repr(a) for i, a in enumerate(_MATRIX) for b in _MATRIX[i + 1:])}]) AS feature1,"
    f" unnest([{', '.join(repr(b) for i, a in enumerate(_MATRIX) for b in _MATRIX[i + 1:])}]) AS feature2,"
    f" unnest([{', '.join(f'round(corr({a}, {b}), 6)' for i, a in enumerate(_MATRIX) for b in _MATRIX[i + 1:])}]) AS correlation FROM txn",
)
def _(spark, sf):
    return rounded(D.correlation_matrix(A.txn(spark, sf), _MATRIX), ["correlation"])


_SHARE = f"WITH {Q.TXN}, v AS (" + each(V_COLS, """SELECT '{c}' AS "column", var_samp({c}) AS v FROM txn""") + ")"


@query(
    "a16_variance_share",
    f"""{_SHARE} SELECT "column", round(v / sum(v) OVER (), 6) AS explained,
 round(sum(v) OVER (ORDER BY v DESC, "column" ROWS UNBOUNDED PRECEDING) / sum(v) OVER (), 6) AS cumulative FROM v""",
)
def _(spark, sf):
    return rounded(D.variance_share(A.txn(spark, sf), V_COLS), ["explained", "cumulative"])


@query(
    "w9_cumulative_share",
    f"""{_SHARE} SELECT "column", round(sum(v) OVER (ORDER BY v DESC, "column" ROWS UNBOUNDED PRECEDING) / sum(v) OVER (), 6) AS cumulative FROM v""",
)
def _(spark, sf):
    return rounded(D.variance_share(A.txn(spark, sf), V_COLS).select("column", "cumulative"), ["cumulative"])


@query("a17_two_components")
def _(spark, sf):
    projected, ratios = D.two_components(A.txn(spark, sf), V_COLS, ["txn_id", "Class"])
    from pyspark.ml.functions import vector_to_array

    xy = vector_to_array("pc")
    return projected.select(
        "txn_id", "Class", xy[0].alias("pc1"), xy[1].alias("pc2"), F.lit(sum(ratios)).alias("explained_by_two")
    )


def _hist_sql(value, where="true", bins="CASE WHEN Class = 0 THEN 100 ELSE 50 END"):
    return f"""WITH {Q.LOG}, r AS (SELECT Class, {value} AS v, {bins} AS k FROM log WHERE {where}),
 l AS (SELECT Class, min(v) AS lo, max(v) AS hi, count(*) AS t FROM r GROUP BY Class),
 b AS (SELECT r.Class, CAST(least(k - 1, floor((v - lo) / ((hi - lo) / k))) AS BIGINT) AS bin, lo, (hi - lo) / k AS step, t FROM r JOIN l USING (Class))
 SELECT Class, bin, count(*) AS n, round(any_value(lo) + bin * any_value(step), 6) AS bin_start,
 round(count(*) / (any_value(t) * any_value(step)), 6) AS density FROM b GROUP BY Class, bin"""


_BINS = {0: 100, 1: 50}


@query("a18_amount_histogram", _hist_sql("Amount"))
def _(spark, sf):
    return rounded(D.histogram(A.log(spark, sf), F.col("Amount"), _BINS), ["bin_start", "density"])


@query("a18_amount_histogram_zoom", _hist_sql("Amount", "Amount <= 500"))
def _(spark, sf):
    out = D.histogram(A.log(spark, sf), F.col("Amount"), _BINS, where=F.col("Amount") <= 500)
    return rounded(out, ["bin_start", "density"])


@query("a18_log_amount_histogram", _hist_sql("ln(1 + Amount)"))
def _(spark, sf):
    return rounded(D.histogram(A.log(spark, sf), F.log1p("Amount"), _BINS), ["bin_start", "density"])


@query("a18_time_histogram", _hist_sql("CAST(time_s AS DOUBLE)", bins="50"))
def _(spark, sf):
    return rounded(D.histogram(A.log(spark, sf), F.col("time_s"), 50), ["bin_start", "density"])


@query(
    "a19_box_plot",
    f"""WITH {Q.LOG}, q AS (SELECT Class, quantile_cont(Amount, 0.25) AS q1, quantile_cont(Amount, 0.5) AS median, quantile_cont(Amount, 0.75) AS q3 FROM log GROUP BY Class)
 SELECT Class, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
 min(Amount) FILTER (Amount BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
 max(Amount) FILTER (Amount BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
 count(*) FILTER (Amount NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outside FROM log JOIN q USING (Class) GROUP BY Class, q.q1, q.median, q.q3""",
)
def _(spark, sf):
    return rounded(D.box_plot(A.log(spark, sf)), ["q1", "median", "q3"])


@query(
    "p24_class_amount_filters",
    f"""WITH {Q.LOG} SELECT count(*) FILTER (Class = 0) AS legitimate, count(*) FILTER (Class = 1 AND Amount <= 500) AS small_fraud,
 round(sum(Amount) FILTER (Class = 1), 4) AS fraud_amount FROM log""",
)
def _(spark, sf):
    from riskengine.functions.columns import count_if

    c, a = F.col("Class"), F.col("Amount")
    return A.log(spark, sf).agg(
        count_if(c == 0).alias("legitimate"),
        count_if((c == 1) & (a <= 500)).alias("small_fraud"),
        F.round(F.sum(F.when(c == 1, a)), 4).alias("fraud_amount"),
    )


@query(
    "t6_top_outlier_columns",
    f"WITH {Q.TXN}, o AS ("
    + each(
        V_COLS,
        """SELECT '{c}' AS "column", count(*) FILTER (abs({c} - m) > 3 * sd) AS zscore_outliers FROM txn, (SELECT avg({c}) AS m, stddev_pop({c}) AS sd FROM txn)""",
    )
    + """) SELECT * FROM o ORDER BY zscore_outliers DESC, "column" LIMIT 10""",
)
def _(spark, sf):
    found = V.outliers(A.txn(spark, sf), V_COLS).select("column", "zscore_outliers")
    return found.orderBy(F.col("zscore_outliers").desc(), "column").limit(10)
