import re
from collections import Counter

import numpy as np

from riskengine.llm import minhash
from riskengine.llm.textbytes import shingle_sets


def brute(rows):
    """Shingle sets, links and components of (doc_id, text) by their definitions."""
    sets = []
    for _i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                top[find(a)] = find(b)
    low = {}
    for k, (i, _t) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return Counter((i, len(sets[k]), low.get(find(k)), i is not None and low.get(find(k)) == i) for k, (i, _t) in enumerate(rows))


def test_matches_brute_force(docs, clashing):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    assert Counter(map(tuple, minhash.near_duplicates(docs).collect())) == want
    assert Counter(map(tuple, minhash.near_duplicates(clashing).collect())) == want


def test_small_data_matches(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(map(tuple, minhash.near_duplicates(docs).collect())) == brute(rows)


def test_chain_joins_what_no_centre_links(spark):
    """Neighbours in a chain are alike, its ends are not: all one component."""
    w = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(w[14 * i : 14 * i + 200])) for i in range(13)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_template_family_below_the_threshold(spark):
    """Each text is 168 shared shingles and 32 others: unlike all but a twin, J = 0.724; twins share 10 more, J = 0.802."""
    template = [f"t{k}" for k in range(172)]

    def text(i, twin):
        own = [f"p{twin}_{k}" for k in range(10)] + [f"o{i}_{k}" for k in range(22)]
        return " ".join(template + own)

    rows = [(i, text(i, i // 2 if i >= 60 else f"s{i}")) for i in range(200)]
    want = brute(rows)
    assert sum(not r[3] for r in want.elements()) == 70
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, got)) == want


def test_empty_table(empty):
    assert minhash.near_duplicates(empty).collect() == []
    assert minhash.keep_one_per_group(empty).columns == empty.columns


def test_keep_one(docs):
    kept = minhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted({k[0] for k in brute(rows) if k[3]})
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == want


def test_rows_without_an_id(spark, docs):
    """They link like others; of a component without an id one row stays, the others' rows go."""
    w = [f"w{k}" for k in range(90)]
    named, alone, pair = " ".join(w[:40]), " ".join(w[40:50]), " ".join(w[50:])
    rows = [(3, named), (None, named), (None, named + " tail"), (None, alone), (None, alone), (None, pair), (None, pair + " end"), (None, None), (None, ""), (None, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, minhash.near_duplicates(table).collect())) == brute(rows)
    left = Counter(map(tuple, minhash.keep_one_per_group(table).collect()))
    assert left in [Counter([(3, named), (None, alone), (None, x), (None, None), (None, ""), (None, "")]) for x in (pair, pair + " end")]
    assert [r.text for r in minhash.keep_one_per_group(docs).collect() if r.doc_id is None] == ["unnamed words stand here now"]


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for size in (8, 60, 3000):
        hits = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(both[: size * 7 // 8]), np.unique(both[size // 8 :])
            hits.append((minhash.one_permutation(a) == minhash.one_permutation(b)).mean())
        shared = (size * 7 // 8 - size // 8) / size
        assert abs(np.mean(hits) - shared) < 0.08


def test_shingles_do_not_depend_on_neighbours():
    raw = np.frombuffer(b"a b c d e f", dtype=np.uint8)
    alone = shingle_sets(raw, np.array([0, len(raw)]))[0]
    two = np.frombuffer(b"zz a b c d e f", dtype=np.uint8)
    assert np.array_equal(shingle_sets(two, np.array([0, 3, len(two)]))[1], alone)
