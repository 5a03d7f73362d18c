"""Validation: every check is one aggregate over the table and returns a small frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, NumericType

from riskengine import schema as S
from riskengine.functions.columns import count_if, missing, nan_to_null, numeric_columns
from riskengine.operators.profiling import correlation_pairs
from riskengine.operators.quantiles import quantiles
from riskengine.operators.shape import one_row, per_column


# ---- schema checks: metadata only, no job ---------------------------------


def column_differences(df: DataFrame, expected: Sequence[str]) -> dict[str, list[str]]:
    """Missing and extra columns, sorted."""
    have, want = set(df.columns), set(expected)
    return {"missing": sorted(want - have), "extra": sorted(have - want)}


def dtype_mismatches(df: DataFrame, expected: Mapping[str, str]) -> list[str]:
    """Exact type comparison, no coercion. Only the 64-bit kinds are checked."""
    kinds = {"float64": DoubleType, "int64": LongType}
    return [
        f"Column '{c}' has type {df.schema[c].dataType.simpleString()}, expected {want}"
        for c, want in expected.items()
        if c in df.columns and want in kinds and not isinstance(df.schema[c].dataType, kinds[want])
    ]


def same_features(left: DataFrame, right: DataFrame) -> None:
    if left.columns != right.columns:
        raise ValueError(f"feature lists differ: {sorted(set(left.columns) ^ set(right.columns))}")


def shape_check(df: DataFrame, rows: int | None, columns: Sequence[str]) -> dict:
    """A wrong row count only warns; a wrong column count or a text column is invalid."""
    found = df.count()
    text = [f.name for f in df.schema if not isinstance(f.dataType, NumericType)]
    return {
        "rows": found,
        "columns": len(df.columns),
        "row_count_warning": rows is not None and found != rows,
        "non_numeric": text,
        "valid": len(df.columns) == len(columns) and not text,
    }


def basic_info(df: DataFrame, preview: int = 5) -> dict:
    return {"rows": df.count(), "columns": df.columns, "head": df.limit(preview).collect()}


# ---- declarative constraints -----------------------------------------------


def transaction_rules(
    df: DataFrame, amount_min: float = S.AMOUNT_MIN, amount_max: float = S.AMOUNT_MAX
) -> dict[str, Column]:
    """The data contract as named conditions that must hold."""
    rules = {f"not_null:{c}": ~missing(df, c) for c in S.RAW_COLUMNS if c in df.columns}
    if "Amount" in df.columns:
        unknown = missing(df, "Amount")
        rules["amount_min"] = unknown | (F.col("Amount") >= amount_min)
        rules["amount_max"] = unknown | (F.col("Amount") <= amount_max)
    if "Class" in df.columns:
        rules["class_values"] = F.col("Class").isNull() | F.col("Class").isin(S.CLASS_VALUES)
    return rules


def constraint_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rules in one pass, none stops the others: (rule, violations)."""
    counted = F.array(
        *[F.struct(F.lit(name).alias("rule"), count_if(~ok).alias("violations")) for name, ok in rules.items()]
    )
    return df.agg(counted.alias("r")).select(F.inline("r"))


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violating rows with the names of the rules they break."""
    broken = F.filter(
        F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull()
    )
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


# ---- one-pass column checks --------------------------------------------------


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return per_column(
        df,
        cols or df.columns,
        {
            "missing": lambda c: count_if(missing(df, c)),
            "missing_pct": lambda c: F.sum(missing(df, c).cast("int")) / F.count(F.lit(1)) * 100,
        },
    )


def require_no_nulls(df: DataFrame) -> None:
    found = {r["column"]: r["missing"] for r in null_counts(df).where("missing > 0").collect()}
    if found:
        raise ValueError(f"unexpected missing values: {found}")


def duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    return (
        df.groupBy(*df.columns)
        .count()
        .agg(F.sum("count").alias("total_rows"), F.sum(F.col("count") - 1).alias("duplicate_rows"))
        .select(
            "total_rows",
            "duplicate_rows",
            F.round(F.col("duplicate_rows") / F.col("total_rows") * 100, 4).alias("duplicate_pct"),
            (F.col("duplicate_rows") > 0).alias("has_duplicates"),
        )
    )


def class_distribution(df: DataFrame, label: str = "Class") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(F.col(label) == 0).alias("legitimate"),
        count_if(F.col(label) == 1).alias("fraud"),
    ).select(
        "*",
        F.round(F.col("fraud") / F.col("total") * 100, 4).alias("fraud_pct"),
        (F.least("fraud", "legitimate") / F.col("total") * 100 < 1).alias("is_imbalanced"),
    )


def amount_statistics(df: DataFrame, amount: str = "Amount") -> DataFrame:
    median = quantiles(df, [amount], [0.5])[(None, amount)][0]
    a = F.col(amount)
    return df.agg(
        F.min(a).alias("min_amount"),
        F.max(a).alias("max_amount"),
        F.round(F.avg(a), 4).alias("mean_amount"),
        F.lit(median).cast("double").alias("median_amount"),
        count_if(a < 0).alias("negative_count"),
        count_if(a == 0).alias("zero_count"),
    )


def type_profile(df: DataFrame) -> DataFrame:
    """Infinite count, minimum and maximum of numbers; distinct count of everything else."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    numeric = set(numeric_columns(df))

    def distinct(c):
        return F.lit(None).cast("long") if c in numeric else F.count_distinct(c)

    clean = nan_to_null(df)
    return per_column(
        clean,
        df.columns,
        {
            "is_numeric": lambda c: F.lit(c in numeric),
            "inf_count": lambda c: count_if(F.abs(F.col(c)) == float("inf")) if c in floating else F.lit(0).cast("long"),
            "min_value": lambda c: F.min(c).cast("double") if c in numeric else F.lit(None).cast("double"),
            "max_value": lambda c: F.max(c).cast("double") if c in numeric else F.lit(None).cast("double"),
            "distinct_values": distinct,
        },
    )


def outliers(df: DataFrame, cols: Sequence[str], z_limit: float = S.OUTLIER_Z) -> DataFrame:
    """Values outside the quartile fences and values further than ``z_limit`` population
    deviations from the mean. Pass one finds the statistics, pass two counts."""
    clean = nan_to_null(df.select(*cols))
    moments = one_row(
        clean,
        [F.expr("count(1) AS _rows")]
        + [F.expr(f"{f}(`{c}`) AS `{name}_{c}`") for c in cols for name, f in (("m", "avg"), ("s", "stddev_pop"))],
    )
    quart = quantiles(clean, cols, [0.25, 0.75], rows=moments["_rows"])
    fences = {}
    for c in cols:
        q1, q3 = quart[(None, c)]
        fences[c] = (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) if q1 is not None else (None, None)

    def lit(x):
        return F.lit(x).cast("double")

    def iqr(c):
        return count_if((F.col(c) < lit(fences[c][0])) | (F.col(c) > lit(fences[c][1])))

    def zed(c):
        # |v - mean| > limit * sd keeps the test free of a division by zero
        return count_if(F.abs(F.col(c) - lit(moments[f"m_{c}"])) > z_limit * lit(moments[f"s_{c}"]))

    rows = F.count(F.lit(1))
    return per_column(
        clean,
        cols,
        {
            "lower_bound": lambda c: lit(fences[c][0]),
            "upper_bound": lambda c: lit(fences[c][1]),
            "iqr_outliers": iqr,
            "iqr_outlier_pct": lambda c: iqr(c) / rows * 100,
            "zscore_outliers": zed,
            "zscore_outlier_pct": lambda c: zed(c) / rows * 100,
        },
    ).withColumn("is_high", F.col("iqr_outlier_pct") > 10)


def value_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) over all columns at once; missing values are left out. Combined
    map-side, so a dominant value travels as one count per task."""
    clean = nan_to_null(df.select(*cols))
    long = clean.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    )
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _column_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values and the most frequent value per column; ties go to the smallest text."""
    freq = value_frequencies(df, cols).groupBy("column").agg(
        F.count(F.lit(1)).alias("unique_values"),
        F.max("n").alias("dominant_count"),
        F.min_by("value", F.struct(F.negative("n"), "value")).alias("dominant_value"),
    )
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    return (
        names.join(freq, "column", "left")
        .crossJoin(F.broadcast(total))
        .select(
            "column",
            F.coalesce("unique_values", F.lit(0)).alias("unique_values"),
            "dominant_value",
            F.coalesce(F.col("dominant_count") / F.col("rows"), F.lit(0.0)).alias("dominant_ratio"),
            "rows",
        )
    )


def cardinality(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column. ``approximate`` answers from one sketch pass, without
    shuffling values, for tables where the exact count is not worth its cost."""
    if approximate:
        counted = per_column(df, cols, {"unique_values": F.approx_count_distinct, "rows": lambda c: F.count(F.lit(1))})
    else:
        counted = _column_summary(df, cols)
    return _cardinality_flags(counted)


def _cardinality_flags(counted: DataFrame) -> DataFrame:
    share = F.col("unique_values") / F.col("rows")
    return counted.select(
        "column",
        "unique_values",
        share.alias("cardinality_ratio"),
        (F.col("unique_values") > S.HIGH_CARDINALITY).alias("is_high_cardinality"),
        (share > 0.9).alias("is_potential_id"),
    )


def constant_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _constant_flags(_column_summary(df, cols))


def _constant_flags(summary: DataFrame) -> DataFrame:
    return summary.select(
        "column",
        (F.col("unique_values") == 1).alias("is_constant"),
        (F.col("dominant_ratio") > 0.99).alias("is_quasi_constant"),
        "dominant_value",
        "dominant_ratio",
    )


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, sample deviation and bias-corrected skewness and excess kurtosis."""
    clean = nan_to_null(df.select(*cols))

    def skew(c):
        n = F.count(c).cast("double")
        return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))

    def kurt(c):
        n = F.count(c).cast("double")
        return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))

    return per_column(
        clean,
        cols,
        {"mean": F.avg, "std": F.stddev_samp, "skewness": skew, "kurtosis": kurt},
    )


def normality(df: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Kolmogorov-Smirnov test of every column against its own fitted normal, on all rows."""
    clean = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    fit = clean.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]
    ).first()
    out = None
    for c in cols:
        if not fit[f"s_{c}"]:
            continue
        one = KolmogorovSmirnovTest.test(
            clean.select(c).where(F.col(c).isNotNull()), c, "norm", fit[f"m_{c}"], fit[f"s_{c}"]
        ).select(
            F.lit(c).alias("column"),
            "statistic",
            F.col("pValue").alias("p_value"),
            (F.col("pValue") > alpha).alias("is_normal"),
        )
        out = one if out is None else out.unionByName(one)
    return out


# ---- issues, report and gate ---------------------------------------------------


def issues(df: DataFrame, numeric: Sequence[str], label: str = "Class") -> DataFrame:
    """Coded findings of all checks: (issue_code, detail)."""

    def listed(found: DataFrame, code: str, flag: str) -> DataFrame:
        names = found.where(flag).agg(F.array_join(F.array_sort(F.collect_list("column")), ",").alias("detail"))
        return names.where(F.col("detail") != "").select(F.lit(code).alias("issue_code"), "detail")

    everything = [*numeric, label]
    # one row per column: computed once and kept as a local table
    found = _column_summary(df, everything)
    counted = df.sparkSession.createDataFrame(found.collect(), found.schema)
    summary = _constant_flags(counted)
    pairs = correlation_pairs(df, numeric).where(F.abs("correlation") > S.HIGH_CORRELATION)
    found = [
        listed(null_counts(df, everything), "HIGH_MISSING_VALUES", f"missing_pct > {S.MISSING_LIMIT * 100}"),
        duplicates(df.select(*everything))
        .where("has_duplicates")
        .select(F.lit("DUPLICATE_ROWS").alias("issue_code"), F.col("duplicate_rows").cast("string").alias("detail")),
        listed(outliers(df, numeric), "HIGH_OUTLIERS", "is_high"),
        listed(_cardinality_flags(counted), "POTENTIAL_ID_COLUMNS", "is_potential_id"),
        listed(summary, "CONSTANT_FEATURES", "is_constant"),
        listed(summary, "QUASI_CONSTANT_FEATURES", "is_quasi_constant"),
        pairs.agg(F.count(F.lit(1)).alias("n"))
        .where("n > 0")
        .select(F.lit("HIGH_CORRELATIONS").alias("issue_code"), F.col("n").cast("string").alias("detail")),
        class_distribution(df, label)
        .where("is_imbalanced")
        .select(F.lit("CLASS_IMBALANCE").alias("issue_code"), F.col("fraud_pct").cast("string").alias("detail")),
    ]
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def validation_report(
    df: DataFrame,
    expected: Sequence[str] = S.RAW_COLUMNS,
    dtypes: Mapping[str, str] | None = None,
    amount_max: float = S.AMOUNT_MAX,
) -> DataFrame:
    """(check, status, detail) with an OVERALL row. Duplicates only warn and a negative
    amount fails its own line; the overall verdict needs the schema rules, the columns,
    the types and the absence of missing values."""
    spark = df.sparkSession
    if dtypes is None:
        dtypes = {c: "int64" if c == "Class" else "float64" for c in expected}
    cols = column_differences(df, expected)
    types = dtype_mismatches(df, dtypes)
    rules = transaction_rules(df, amount_max=amount_max)
    broken = count_if(~F.forall(F.array(*rules.values()), lambda ok: ok))
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + count_if(missing(df, c))
    one = df.agg(
        broken.alias("broken"),
        nulls.alias("nulls"),
        # no such column: the column check fails, and so does this line
        (count_if(F.col("Amount") < 0) if "Amount" in df.columns else F.lit(None).cast("long")).alias("negative"),
    )
    dup = duplicates(df).select("duplicate_rows")
    facts = one.crossJoin(F.broadcast(dup))
    cols_bad, types_bad = bool(cols["missing"] or cols["extra"]), bool(types)

    def line(name, failed, detail, bad="FAIL"):
        return F.struct(
            F.lit(name).alias("check"),
            F.when(failed, bad).otherwise("PASS").alias("status"),
            detail.cast("string").alias("detail"),
        )

    schema_bad = (F.col("broken") > 0) | F.lit(cols_bad or types_bad)
    overall_bad = schema_bad | (F.col("nulls") > 0)
    lines = F.array(
        line("schema_validation", schema_bad, F.col("broken")),
        line("column_check", F.lit(cols_bad), F.lit(len(df.columns))),
        line("data_types", F.lit(types_bad), F.lit(len(types))),
        line("null_values", F.col("nulls") > 0, F.col("nulls")),
        line("duplicates", F.col("duplicate_rows") > 0, F.col("duplicate_rows"), "WARN"),
        line("amount_validation", F.col("negative").isNull() | (F.col("negative") > 0), F.col("negative")),
        line("OVERALL", overall_bad, F.lit("")),
    )
    return facts.select(F.inline(lines))


def gate(report: DataFrame, stop_on_failure: bool = True) -> bool:
    passed = report.where("check = 'OVERALL' AND status = 'PASS'").count() == 1
    if stop_on_failure and not passed:
        raise ValueError(f"validation failed: {[r.asDict() for r in report.where(F.col('status') == 'FAIL').collect()]}")
    return passed


# ---- events -------------------------------------------------------------------


def request_error(amount: Column, time: Column, cap: float = S.SERVING_AMOUNT_CAP) -> Column:
    """Error code of a scoring request, null when it may be scored. The amount cap is
    looked at before the field checks. A number that could not be read is null here."""
    return (
        F.when(amount > cap, "422:amount_exceeds_maximum")
        .when(time.isNull(), "422:time_missing_or_not_numeric")
        .when(amount.isNull(), "422:amount_missing_or_not_numeric")
        .when(amount < 0, "422:amount_negative")
        .when(time < 0, "422:time_negative")
    )


def repair_negative_amounts(df: DataFrame, amount: str = "Amount") -> DataFrame:
    a = F.col(amount)
    return df.withColumn(amount, F.when(a < 0, F.lit(0.0)).otherwise(a))


def negative_amount_count(df: DataFrame, amount: str = "Amount") -> DataFrame:
    return df.agg(count_if(F.col(amount) < 0).alias("negative_count"))


def split_integrity(
    train: DataFrame, test: DataFrame, label: str = "Class", time: str = "time_s", key: str = "txn_id"
) -> DataFrame:
    def side(df, name):
        return df.agg(
            F.count(F.lit(1)).alias(f"{name}_size"),
            F.sum(label).cast("long").alias(f"{name}_fraud"),
            (F.sum(label) / F.count(F.lit(1)) * 100).alias(f"{name}_fraud_pct"),
            F.min(time).alias(f"{name}_min_time"),
            F.max(time).alias(f"{name}_max_time"),
        )

    overlap = train.select(key).intersect(test.select(key)).agg(F.count(F.lit(1)).alias("overlap"))
    return (
        side(train, "train")
        .crossJoin(F.broadcast(side(test, "test")))
        .crossJoin(F.broadcast(overlap))
        .withColumn("train_ratio", F.round(F.col("train_size") / (F.col("train_size") + F.col("test_size")), 4))
        .withColumn("temporal_ok", F.col("train_max_time") < F.col("test_min_time"))
        .withColumn("fraud_in_both", (F.col("train_fraud") > 0) & (F.col("test_fraud") > 0))
    )


def check_limits(threshold: float, fpr_limit: float, pr_auc_limit: float, amount_cap: float) -> None:
    """Settings are refused before any job starts."""
    for name, value in {"threshold": threshold, "fpr_limit": fpr_limit, "pr_auc_limit": pr_auc_limit}.items():
        if not 0.0 <= value <= 1.0:
            raise ValueError(f"{name} must lie in [0, 1], got {value}")
    if amount_cap <= 0:
        raise ValueError(f"amount_cap must be positive, got {amount_cap}")
