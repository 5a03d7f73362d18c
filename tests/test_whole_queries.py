"""Queries without SQL use every model and column."""

import __spark_entry__ as entry
from riskengine.catalog.models import ALL_MODELS, INPUTS, training_rows
from riskengine.operators import metrics as M
from riskengine.operators import models as L
from riskengine.plans import runs
from riskengine.schema import V_COLS
from riskengine.sources import adapter as A


EVERY = {n for tier in L.TIERS.values() for n in tier}


def test_every_model_is_cross_validated(spark, small):
    """The real fits of both tiers, with a hundredth of the trees and rounds."""
    train, _test = training_rows(spark, small)
    got = M.fold_summary(L.cross_validate(ALL_MODELS, train, INPUTS, effort=0.01)).collect()
    assert {r.model_name for r in got} == EVERY and all(len(r.folds) == 3 for r in got) and len(got) == 35


def test_both_tiers_run_end_to_end(spark, small):
    rows = A.txn(spark, small).select("txn_id", "time_s", "Amount", "Class", *V_COLS)
    out = runs.end_to_end(rows, "full", effort=0.01)
    wanted = {f"{n}_{tier}" for tier, names in L.TIERS.items() for n in names}
    assert {r.model_name for r in out["documents"].select("model_name").collect()} == wanted
    assert {r.model_name for r in out["timing"].collect()} == wanted


def test_the_registered_queries_take_all_models_and_settings(spark, small, monkeypatch):
    asked = []

    def folds(names, *_args, **more):
        asked.append((list(names), more.get("effort", 1.0)))
        return spark.createDataFrame([(n, "f1_score", i, 0.5) for n in names for i in range(3)], "model_name string, metric string, fold int, value double")

    def whole(_rows, mode="baseline", effort=1.0, **_more):
        asked.append(([mode], effort))
        return {"documents": spark.range(1)}

    monkeypatch.setattr(L, "cross_validate", folds)
    monkeypatch.setattr(runs, "end_to_end", whole)
    for name in ("a24_fold_summary", "m10_cross_validation", "m19_end_to_end_run"):
        entry.queries()[name](spark, small)
    assert asked == [(ALL_MODELS, 1.0), (ALL_MODELS, 1.0), (["full"], 1.0)] and set(ALL_MODELS) == EVERY


def test_normality_of_every_numeric_column(spark, small):
    got = entry.queries()["v16_normality"](spark, small).collect()
    assert sorted(r.column for r in got) == sorted([*V_COLS, "Amount", "time_s"])
