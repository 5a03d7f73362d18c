from collections import Counter

import numpy as np

from riskengine.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    units = []
    for _i, v, _l in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, dtype=np.float32).astype(float) if ok else None)
    units = [None if u is None else u / np.linalg.norm(u) for u in units]
    n = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95:
                n[a] += 1
                n[b] += 1
                top[find(a)] = find(b)
    low = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            low[find(k)] = min(r[0], low.get(find(k), r[0]))
    return Counter((r[0], n[k], low.get(find(k)), r[0] is not None and low.get(find(k)) == r[0]) for k, r in enumerate(rows))


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for c in range(30):
        centre = rng.standard_normal(24)
        for _ in range(4):
            rows.append((centre + rng.standard_normal(24) * rng.choice([0.01, 0.1, 0.2])).astype(float).tolist())
    hot = rng.standard_normal(24)
    rows += [(hot + 0.02 * rng.standard_normal(24)).tolist() for _ in range(60)]
    rows += [rows[0], rows[0], [2 * x for x in rows[1]], None, [], [0.0] * 24, [None] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, 2.0], [1.0, 2.0], [-0.0, 1.0], [0.0, 1.0], [3e38] * 24]
    out = [(i, v, 0) for i, v in enumerate(rows)]
    return out + [(None, rows[0], None), (3, rows[3], 1), (3, rows[3], 1)]


def test_matches_brute_force(spark, monkeypatch):
    rows = vectors()
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert Counter(map(tuple, embeddings.near_duplicates(df).collect())) == want
    monkeypatch.setattr(embeddings, "BLOCK", 16)  # many blocks
    assert Counter(map(tuple, embeddings.near_duplicates(df.repartition(5)).collect())) == want


def test_small_data(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [tuple(r) for r in df.collect()]
    assert Counter(map(tuple, embeddings.near_duplicates(df).collect())) == brute(rows)


def test_recall_at_the_threshold():
    """Pairs at the threshold itself meet in some table as often as planned."""
    k, tables = embeddings.table_plan(50_000)
    near = embeddings.collision(float(np.sqrt(0.1))) ** k
    assert 1 - (1 - near) ** tables >= 1 - embeddings.MISS


def test_empty_table_and_clashing_names(spark):
    from pyspark.sql import functions as F

    none = spark.createDataFrame([], SCHEMA)
    assert embeddings.near_duplicates(none).collect() == []
    df = spark.createDataFrame(vectors()[:50], SCHEMA)
    more = df.withColumns({n: F.lit(1) for n in "rep cls size keys tab bucket one two block n to component low".split()})
    assert Counter(map(tuple, embeddings.near_duplicates(more).collect())) == brute(vectors()[:50])
