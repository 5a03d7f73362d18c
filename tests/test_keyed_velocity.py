import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskengine.streaming import events as E
from riskengine.streaming.keyed import _advance, keyed_velocity, windows_of

WIDTHS = {"short": 600, "long": 7200}


def brute(rows):
    """rows: (card, key, second, amount); the trailing windows by plain loops."""
    out = {}
    for card, key, t, _a in rows:
        mine = [r for r in rows if r[0] == card and (r[2], r[1]) <= (t, key)]
        before = [r[2] for r in mine if r[1] != key]
        found = {"time_since_last_txn": t - max(before) if before else 0}
        for tag, width in WIDTHS.items():
            inside = [r[3] for r in mine if r[2] >= t - width]
            known = [a for a in inside if a is not None]
            found[f"count_{tag}"] = len(inside)
            found[f"avg_{tag}"] = float(np.mean(known)) if known else None
            found[f"std_{tag}"] = float(np.std(known)) if known else None
        out[key] = found
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for key, row in want.items():
        for c, v in row.items():
            assert (got[key][c] is None) == (v is None), (key, c)
            assert v is None or got[key][c] == pytest.approx(v, abs=1e-6), (key, c)


class FakeState:
    def __init__(self):
        self.value, self.watermark, self.timer = None, 0, None

    exists = property(lambda s: s.value is not None)
    get = property(lambda s: s.value)

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.watermark

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, at):  # noqa: N802
        assert at > self.watermark
        self.timer = at


def frame(rows):
    return pd.DataFrame({"id": [r[1] for r in rows], "_second": [r[2] for r in rows], "_value": [np.nan if r[3] is None else r[3] for r in rows]})


def test_out_of_order_parts_give_the_figures_of_the_whole():
    rng = random.Random(1)
    rows = [("c", k, 100_000 + rng.randrange(20_000), rng.choice([None, 5.0, 7.25, 300.0])) for k in range(300)]
    rows += [("c", 1000 + k, 100_777, 1.5) for k in range(5)]
    arriving = sorted(rows, key=lambda r: (r[2] + rng.randrange(500), r[1]))
    state, got = FakeState(), {}
    step = _advance(WIDTHS, ["card"], "id", "time_since_last_txn")
    for at in range(0, len(arriving), 37):
        part = arriving[at : at + 37]
        found = [*step(("c",), iter([frame(part)] if part else []), state)]
        for f in found:
            for row in f.to_dict("records"):
                assert row["id"] not in got
                got[row["id"]] = {c: None if isinstance(v, float) and np.isnan(v) else v for c, v in row.items() if c not in ("card", "id", "time_s")}
        state.watermark = max(state.watermark, (max(r[2] for r in arriving[: at + 37]) - 600) * 1000)
    state.watermark = (max(r[2] for r in rows) + 1) * 1000
    for f in step(("c",), iter([]), state):
        for row in f.to_dict("records"):
            got[row["id"]] = {c: None if isinstance(v, float) and np.isnan(v) else v for c, v in row.items() if c not in ("card", "id", "time_s")}
    same(got, brute(rows))


def test_history_expires_and_the_state_goes():
    state = FakeState()
    step = _advance(WIDTHS, ["card"], "id", None)
    list(step(("c",), iter([frame([("c", 1, 50, 2.0)])]), state))
    assert state.value[0] == [1] and state.timer == 50_999
    state.watermark = 51_000
    assert sum(len(f) for f in step(("c",), iter([]), state)) == 1
    assert state.value[0] == [] and state.value[3] == [50] and state.timer == (50 + 7200 + 1) * 1000
    state.watermark = (50 + 7200 + 1) * 1000
    assert list(step(("c",), iter([]), state)) == []
    assert not state.exists


def test_recency_outlives_the_history():
    state = FakeState()
    step = _advance(WIDTHS, ["card"], "id", "gap")
    list(step(("c",), iter([frame([("c", 1, 50, 2.0)])]), state))
    state.watermark = 90_000_000
    list(step(("c",), iter([]), state))
    list(step(("c",), iter([frame([("c", 2, 95_000, 2.0)])]), state))
    state.watermark = 96_000_000
    (f,) = step(("c",), iter([]), state)
    assert f["gap"].tolist() == [94_950] and f["count_long"].tolist() == [1]


def test_no_amounts():
    none = {m: np.zeros(0) for m in ("time", "n", "k", "s", "q")}
    out = windows_of(np.array([5, 6]), np.array([np.nan, np.nan]), none, 0.0, {"w": 10})
    assert out["count_w"].tolist() == [1, 2] and np.isnan(out["avg_w"]).all() and np.isnan(out["std_w"]).all()


def test_stream_with_a_restart(spark, tmp_path):
    rng = random.Random(2)
    base = 1_700_000_000
    rows = [(rng.choice(["a", "b", None]), k, base + rng.randrange(30_000), rng.choice([None, 4.0, 90.5])) for k in range(120)]
    rows += [("a", 500 + k, base + 9_000, 10.0) for k in range(3)]
    arriving = sorted(rows, key=lambda r: r[2] + rng.randrange(500))
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    schema = "card_id string, txn_id long, s long, Amount double, other string"
    for part in range(3):
        some = spark.createDataFrame([(*r, "x") for r in arriving[part * 41 : part * 41 + 41]], schema)
        some.withColumn("ts", F.timestamp_seconds("s")).drop("s").coalesce(1).write.mode("append").parquet(source)
        if part:
            # the second run goes on from the checkpoint of the first
            stream = E.file_events(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
            E.run_available(keyed_velocity(stream, WIDTHS), ckpt, path=out)
    found = spark.read.parquet(out)
    got = {r["txn_id"]: r.asDict() for r in found.collect()}
    assert found.count() == len(got)
    closed = max(r[2] for r in rows) - 600
    want = {k: v for k, v in brute(rows).items() if next(r[2] for r in rows if r[1] == k) < closed}
    same(got, want)


def test_empty_stream(spark, tmp_path):
    empty = spark.createDataFrame([], "card_id long, txn_id long, ts timestamp, Amount double")
    empty.write.parquet(str(tmp_path / "in"))
    stream = E.file_events(spark, str(tmp_path / "in"), empty.schema)
    E.run_available(keyed_velocity(stream, WIDTHS, recency=None), str(tmp_path / "ckpt"), path=str(tmp_path / "out"))
    assert spark.read.schema(keyed_velocity(stream, WIDTHS, recency=None).schema).parquet(str(tmp_path / "out")).count() == 0
