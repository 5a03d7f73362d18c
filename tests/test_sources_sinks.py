import json
import os

import pytest
from pyspark.sql import functions as F

from riskengine import schema as S
from riskengine.operators import metrics as M
from riskengine.operators import views as V
from riskengine.sources import adapter as A
from riskengine.sources import readers as R
from riskengine.sources import sinks as K

HEADER = ",".join(S.RAW_COLUMNS)


def csv(path, rows):
    path.write_text("\n".join([HEADER, *rows]) + "\n")
    return str(path)


def line(time="1", amount="2.5", label="0", v1="0.1"):
    return ",".join([time, v1, *["0.0"] * 27, amount, label])


def test_csv(spark, tmp_path):
    df = R.read_csv(spark, csv(tmp_path / "a.csv", [line(), line("2", "3.5", "1")]))
    assert df.count() == 2 and df.columns == S.RAW_COLUMNS and dict(df.dtypes)["Class"] == "bigint"
    with pytest.raises(ValueError):
        R.read_csv(spark, csv(tmp_path / "empty.csv", []))
    with pytest.raises(Exception):
        R.read_csv(spark, str(tmp_path / "missing.csv"))


def test_csv_null_tokens(spark, tmp_path):
    tokens = ["", " ", "NA", "N/A", "null", "NULL", "None"]
    df = R.read_csv_null_tokens(spark, csv(tmp_path / "a.csv", [line(amount=t) for t in tokens] + [line(label="1")]))
    assert df.where("Amount is null").count() == len(tokens)
    assert df.where("Amount = 2.5 and Class = 1").count() == 1


def test_labelled_batch(spark, tmp_path):
    df, info = R.read_labelled_batch(spark, csv(tmp_path / "a.csv", [line(), line()]))
    assert info == {"rows": 2, "fraud": 0, "no_fraud_warning": True} and dict(df.dtypes)["V1"] == "double"
    with pytest.raises(ValueError):
        R.read_labelled_batch(spark, str(tmp_path / "a.csv"), label="Target")
    with pytest.raises(ValueError):
        R.read_labelled_batch(spark, csv(tmp_path / "b.csv", []))


def test_metric_files(spark, tmp_path):
    docs = {
        "a_evaluation": {"pr_auc": 0.8, "roc_auc": 0.9, "false_positive_rate": 0.01, "test_samples": 10, "fraud_caught": 2},
        "b_metrics": {"cv_metrics": {"average_precision": {"mean": 0.7}, "specificity": {"mean": 0.98}}, "train_samples": 5},
        "c_eval": {"average_precision": 0.6, "fpr": 0.03},
    }
    for name, doc in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=2))
    got = {r.model_name: r for r in R.read_metrics(spark, str(tmp_path)).collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].pr_auc, got["a"].false_positive_rate, got["a"].fraud_ratio) == (0.8, 0.01, 0.2)
    assert got["b"].pr_auc == 0.7 and got["b"].false_positive_rate == pytest.approx(0.02) and got["b"].test_samples == 5
    assert (got["c"].pr_auc, got["c"].false_positive_rate, got["c"].threshold) == (0.6, 0.03, 0.5)


def test_tables_round_trip(spark, small, tmp_path):
    rows = A.txn(spark, small)
    K.write_table(rows.drop("ts"), str(tmp_path / "t"))
    back, features = R.read_parquet(spark, str(tmp_path / "t"))
    assert back.count() == rows.count() and "Class" not in features and "V1" in features


def test_append_transactions(spark, small, tmp_path):
    rows = A.txn(spark, small).withColumn("V1", F.when(F.col("txn_id") > 0, F.col("V1")))
    for _ in range(2):
        K.append_transactions(rows, str(tmp_path / "t"))
    out = spark.read.parquet(str(tmp_path / "t"))
    assert out.count() == 2 * rows.count() and out.columns == S.TRANSACTIONS.names
    assert out.where("v1 is null").count() == 0 and out.where("transaction_id = '0' and v1 = 0.0").count() == 2
    plain = A.raw(spark, small)
    ids = [K.to_transactions(plain).select("transaction_id").distinct().count() for _ in range(2)]
    assert ids[0] == ids[1] == plain.distinct().count()


def test_monitoring_sinks(spark, small, tmp_path):
    docs = M.evaluate(A.scored(spark, small))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    K.append_evaluation(docs, str(tmp_path / "m"), "baseline", at)
    out = spark.read.parquet(str(tmp_path / "m"))
    assert out.columns == S.MONITORING_METRICS.names and out.count() == 14
    assert {r[0] for r in out.select("metric_type").distinct().collect()} == {
        "pr_auc", "roc_auc", "f1_score", "recall", "precision", "fpr", "fnr",
    }
    K.append_drift(M.drift(docs, docs), str(tmp_path / "m"), at)
    assert spark.read.parquet(str(tmp_path / "m")).count() == 18
    sparse = docs.withColumn("roc_auc", F.lit(None).cast("double"))
    assert V.evaluation_rows(sparse).count() == 12


def test_reports(spark, tmp_path):
    K.write_feature_config(spark, ["a", "b"], str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).first().asDict() == {"features": ["a", "b"], "count": 2}
    K.write_split_config(spark, 0.8, 138233.6, 80, 20, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).first()["split_method"] == "chronological_time_based"
    ranking = spark.createDataFrame([("x", 0.1), ("y", -0.5)], "feature string, r double").orderBy(F.abs("r").desc())
    K.write_ranking(ranking, str(tmp_path / "r"))
    files = [f for f in os.listdir(tmp_path / "r") if f.endswith(".csv")]
    assert len(files) == 1
    assert (tmp_path / "r" / files[0]).read_text().splitlines() == ["feature,r", "y,-0.5", "x,0.1"]


def files_of(path):
    return {os.path.join(d, n): os.path.getmtime(os.path.join(d, n)) for d, _dirs, names in os.walk(path) for n in names if n.endswith(".parquet")}


UPSERT = "id string, at long, rid string, label int"


def test_upsert_rewrites_touched_folders_only(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = [(f"k{i}", 10, "a", 0) for i in range(200)] + [(None, 10, "a", 0)]
    K.create_upsert_table(spark.createDataFrame(stored, UPSERT), path, ["id"], parts=16)
    before = files_of(path)
    # newer, older, equal time with a larger id, a new key, two rows of one new key, a null key
    new = [("k1", 20, "b", 1), ("k2", 5, "b", 1), ("k3", 10, "b", 1), ("fresh", 1, "x", 1), ("twice", 1, "x", 0), ("twice", 2, "x", 1), (None, 30, "z", 1)]
    df = spark.createDataFrame(new, UPSERT)
    touched = K.upsert(df, path, ["id"], ["at", "rid"])
    want = {**{r[0]: r for r in stored}, "k1": new[0], "k3": new[2], "fresh": new[3], "twice": new[5], None: new[6]}
    read = lambda: {r[0]: tuple(r) for r in K.read_upsert_table(spark, path).collect()}
    assert read() == want and K.read_upsert_table(spark, path).count() == len(want)
    left_alone = {f for f in before if int(f.split("_part=")[1].split("/")[0]) not in touched}
    assert left_alone and 0 < len(touched) < 16
    after = files_of(path)
    assert all(after.get(f) == before[f] for f in left_alone)
    # the same rows again
    K.upsert(df, path, ["id"], ["at", "rid"])
    assert read() == want
    assert K.upsert(df.where("false"), path, ["id"], ["at", "rid"]) == []


def test_upsert_into_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, "x", 0)], UPSERT)
    K.create_upsert_table(rows.where("false"), path, ["id"])
    assert K.read_upsert_table(spark, path).count() == 0
    K.upsert(rows, path, ["id"], ["at", "rid"])
    assert K.read_upsert_table(spark, path).collect() == rows.collect()
    with pytest.raises(ValueError):
        K.create_upsert_table(rows.withColumn("_part", F.lit(1)), str(tmp_path / "u"), ["id"])
