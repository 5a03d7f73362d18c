import pytest
from pyspark.sql import functions as F

from riskengine import schema as S
from riskengine.operators import prep
from riskengine.operators import profiling as D
from riskengine.operators import quality as V
from riskengine.operators.shape import one_row
from riskengine.sources import adapter as A


def test_moments_are_bias_corrected(spark):
    df = spark.createDataFrame([(float(2**i),) for i in range(6)], "v double")
    r = V.moments(df, ["v"]).first()
    assert (round(r.skewness, 6), round(r.kurtosis, 6)) == (1.499693, 1.874954)


def test_column_and_type_checks(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "Class long, Amount double, extra string")
    assert V.column_differences(df, ["Class", "Amount", "Time"]) == {"missing": ["Time"], "extra": ["extra"]}
    assert V.dtype_mismatches(df, {"Class": "int64", "Amount": "float64"}) == []
    assert len(V.dtype_mismatches(df, {"Class": "float64"})) == 1
    assert V.shape_check(df, 5, ["a", "b", "c"]) == {
        "rows": 1, "columns": 3, "row_count_warning": True, "non_numeric": ["extra"], "valid": False,
    }
    with pytest.raises(ValueError):
        V.same_features(df, df.drop("extra"))
    assert V.basic_info(df)["rows"] == 1


def test_gate(spark, small):
    clean = A.raw(spark, small)
    assert V.gate(V.validation_report(clean))
    spoiled = clean.withColumn("Amount", F.when(F.col("Time") > 100_000, F.col("Amount")))
    with pytest.raises(ValueError):
        V.gate(V.validation_report(spoiled))
    assert not V.gate(V.validation_report(spoiled), stop_on_failure=False)
    wide = V.validation_report(clean.withColumn("more", F.lit(1.0))).where("check = 'column_check'").first()
    assert (wide.status, wide.detail) == ("FAIL", "32")


def test_nulls_stop_preprocessing(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "Time double, Amount double")
    with pytest.raises(ValueError):
        prep.preprocess(df)


def test_standard_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,), (16.0,), (32.0,)], "Amount double")
    r = prep.fit_scaler(df, ["Amount"]).first()
    assert round(r["scale"], 6) == 10.828204
    out = prep.apply_scaler(df, prep.fit_scaler(df, ["Amount"])).agg(F.avg("Amount"), F.stddev_pop("Amount")).first()
    assert out[0] == pytest.approx(0) and out[1] == pytest.approx(1)
    with pytest.raises(ValueError):
        prep.fit_scaler(df, ["Amount"], "other")


def test_split_boundary_is_in_train(spark):
    df = spark.createDataFrame([(i, i, 0) for i in range(11)], "txn_id long, time_s long, Class int")
    train, test, at = prep.chronological_split(df)
    assert at == 8 and sorted(r.time_s for r in test.collect()) == [9, 10]
    r = V.split_integrity(train, test).first()
    assert r.overlap == 0 and r.temporal_ok and r.train_size == 9
    with pytest.raises(ValueError):
        prep.chronological_split(df.where("time_s = 3"))
    with pytest.raises(ValueError):
        prep.chronological_split(df, time="nope")


def test_hash_sample_repeats(spark):
    df = spark.range(20_000).withColumnRenamed("id", "txn_id")
    a, b = (sorted(r.txn_id for r in prep.hash_sample(df, 500).collect()) for _ in range(2))
    assert a == b and len(a) == 500
    # the filter before the sort must not change the choice
    full = sorted(r.txn_id for r in prep.hash_sample(df, 500, rows=0).collect())
    assert a == full


def test_first_and_latest_keep_whole_rows(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, t int, v string")
    assert {tuple(r) for r in prep.first_per_key(df, ["k"], ["t"]).collect()} == {("a", 1, "y"), ("b", 5, None)}
    assert {tuple(r) for r in prep.latest_per_key(df, ["k"], ["t"]).collect()} == {("a", 2, "x"), ("b", 5, None)}


def test_request_errors(spark):
    rows = [(1.0, 0.0), (40000.0, 0.0), (None, 0.0), (-1.0, 0.0), (1.0, None), (1.0, -5.0), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, t double")
    got = [r.e for r in df.select(V.request_error(F.col("a"), F.col("t")).alias("e")).collect()]
    assert [g is None for g in got] == [True, False, False, False, False, False, True]


def test_settings_are_checked():
    V.check_limits(0.5, 0.2, 0.1, 30000)
    for bad in [(1.5, 0.2, 0.1, 1), (0.5, -1, 0.1, 1), (0.5, 0.2, 0.1, 0)]:
        with pytest.raises(ValueError):
            V.check_limits(*bad)


def test_contract_columns():
    assert len(S.RAW_COLUMNS) == 31 and S.RAW_SCHEMA.names == S.RAW_COLUMNS


def test_report_without_amount(spark):
    df = spark.createDataFrame([(1.0, 0)], "Time double, Class long")
    lines = {r.check: r.status for r in V.validation_report(df).collect()}
    assert lines["amount_validation"] == "FAIL" and lines["OVERALL"] == "FAIL"


def test_histogram_and_box_keep_a_null_class(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, None), (5.0, None), (None, None), (4.0, 1)], "Amount double, Class int")
    bars = D.histogram(df, F.col("Amount"), {0: 2, 1: 3}).collect()
    assert sum(b.n for b in bars) == 5 and all(b.bin is not None for b in bars)
    assert sum(b.n for b in bars if b.Class is None) == 2
    assert {r.Class for r in D.box_plot(df).collect()} == {0, 1, None}


def test_wide_tables_are_aggregated_in_parts(spark):
    """An aggregate of many columns is too long to be compiled: each takes a few and the figures are those of one."""
    cols = [f"c{i}" for i in range(30)]
    df = spark.range(50).select(*[(F.col("id") * (i + 1) % 7).cast("double").alias(c) for i, c in enumerate(cols)])
    out = V.moments(df, cols)
    assert out._jdf.queryExecution().analyzed().toString().count("Aggregate [") == 8
    got = {r["column"]: r for r in out.collect()}
    assert [r["column"] for r in out.collect()] == cols
    want = df.agg(F.avg("c29"), F.stddev_samp("c29")).first()
    assert (got["c29"]["mean"], got["c29"]["std"]) == (pytest.approx(want[0]), pytest.approx(want[1]))
    assert one_row(df, [F.max(c).alias(c) for c in cols]) == {c: 6.0 for c in cols} | {c: 0.0 for i, c in enumerate(cols) if (i + 1) % 7 == 0}
