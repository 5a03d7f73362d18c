import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskengine.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Sharing again and again until no source is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, out = share * sum(sizes.values()), {}
    open_ = set(order)
    while open_:
        part = (total - sum(out.values())) / sum(w[s] for s in open_)
        over = {s for s in open_ if part * w[s] > most * sizes[s]}
        if not over:
            return out | {s: part * w[s] for s in open_}
        out |= {s: most * sizes[s] for s in over}
        open_ -= over
    return out


def check(mixed):
    rows = mixed.select(F.col("row.source").alias("source"), F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "size", "source_size", "target", "copies").collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    want = targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    for s, goal in want.items():
        assert abs(taken[s] - goal) <= largest[s] / 2 + 1e-6, (s, taken[s], goal)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    return rows


def test_targets_and_sums(docs):
    check(mixing.mix(docs))


def test_small_data(spark, small):
    check(mixing.mix(spark.read.parquet(f"{small}/documents.parquet")))


def test_reruns_and_other_columns_agree(docs, clashing):
    key = lambda df: Counter((r.row.doc_id, r.row.text, r.copies) for r in df.collect())
    one = key(mixing.mix(docs))
    assert one == key(mixing.mix(docs.repartition(7)))
    assert one == key(mixing.mix(clashing))


def test_one_large_source_and_caps(spark):
    rows = [(i, "w " * 50, "a" if i < 900 else "b" if i < 990 else None) for i in range(1000)]
    check(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")))


def test_preference_raises_inclusion(spark):
    rows = [(i, "w " * 10, "a", float(1 + i % 2)) for i in range(2000)] + [(5000 + i, "w " * 10, "b", 1.0) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, liking double")
    got = mixing.mix(docs, share=0.5, preference=F.col("liking")).where("row.source = 'a'").groupBy("row.liking").agg(F.avg("copies").alias("n")).collect()
    n = {r["liking"]: r["n"] for r in got}
    assert n[2.0] > 1.25 * n[1.0]


def test_edge_cases(spark, empty):
    assert mixing.mix(empty).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["copies"]) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_repeated_rows_are_taken_in_part(spark):
    """A source of a thousand equal rows, without ids or with one, comes as near its target as any other."""
    rows = [(i, "w " * 5, "a", i) for i in range(800)] + [(None, "w " * 30, "b", 1)] * 1000 + [(7, "w " * 9, "c", 2)] * 5000
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    got = check(mixing.mix(docs))
    assert len(got) == len(rows)
    copies = Counter((r["source"], r["copies"]) for r in got)
    assert {c for s, c in copies if s == "b"} == {c for s, c in copies if s == "c"} == {1, 2}
    again = Counter((r["source"], r["copies"]) for r in check(mixing.mix(docs.repartition(5))))
    assert copies == again
    assert mixing.mix(docs).select("row.*").exceptAll(docs).count() == 0
