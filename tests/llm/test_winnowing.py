import hashlib
import random
import re

import pytest
from conftest import words

from riskengine.llm import winnowing as W

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(W._UPPER, W._UPPER.lower())


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items):
    windows = {}
    for item, text in items:
        ws = split(text)
        n = min(len(ws), W.SPAN)
        for s in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[s : s + n]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in texts:
        ws = split(text)
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(ws) - n + 1):
                held = windows.get(tuple(ws[s : s + n]))
                if held:
                    hit.update(range(s, s + n))
                    found |= held
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(ws), len(hit), len(found), listed, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    items = [(i, words(rng, rng.randint(10, 40))) for i in range(12)]
    shared = words(rng, 15)
    items += [(100 + i, f"{words(rng, 4)} {shared} {words(rng, 4)}") for i in range(5)]
    items += [(200, "one two three"), (201, "one two three"), (202, "Zug"), (203, None), (204, ""), (205, "?! --"), (None, words(rng, 12)), (3, words(rng, 11))]
    items += [(300, "the " * 30)]
    docs = [(i, words(rng, rng.randint(1, 60))) for i in range(25)]
    for i in range(25, 60):
        a = items[rng.randrange(17)][1].split()
        cut = rng.randint(0, max(0, len(a) - 10))
        inside = " ".join(a[cut : cut + rng.randint(8, 14)])
        docs.append((i, f"{words(rng, rng.randint(0, 12))} {inside.upper() if i % 2 else inside}, {words(rng, rng.randint(0, 12))}"))
    docs += [(60 + i, f"{words(rng, 5)} {shared} {shared}") for i in range(10)]
    docs += [(80, "the " * 200), (81, "x one two three y one TWO-three"), (82, "zug Zug zügig"), (83, None), (84, ""), (85, "a b c d e f g h i"), (None, items[0][1]), (None, None)]
    docs += [docs[30], docs[30], (86, "\n".join(words(rng, 900).split()) + "\t" + items[2][1])]
    return docs, items


def found(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS words", "1 AS n", "'y' AS mark", "2 AS span", "3 AS key")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS hashes")
    out = W.decontaminate(d, b)
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in out.collect()), key=repr)


def test_equals_brute_force(spark, tables):
    docs, items = tables
    assert found(spark, docs, items) == brute(docs, items)


def test_a_benchmark_too_large_to_broadcast(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(W, "BROADCAST_ROWS", 0)
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark, tables):
    docs, items = tables
    assert found(spark, [], items) == []
    assert found(spark, docs[:5], []) == brute(docs[:5], [])


def test_both_sides_choose_the_same_fingerprint(spark):
    """Every shared span of ten words shares a fingerprint, wherever it stands."""
    rng = random.Random(9)
    span = words(rng, W.SPAN)
    rows = [(i, f"{words(rng, rng.randint(0, 30))} {span} {words(rng, rng.randint(0, 30))}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", W.words_of(W.F.col("text")).alias("words"))
    alone = spark.createDataFrame([(0, span)], "doc_id long, text string").select("doc_id", W.words_of(W.F.col("text")).alias("words"))
    (mark,) = W._fingerprinted(alone).first()["marks"]
    for r in W._fingerprinted(df).collect():
        assert mark >> 32 in {m >> 32 for m in r["marks"]}
        # density: about two in WINDOW + 1 runs
        assert len(r["marks"]) <= len(r["words"]) - W.GRAM + 1
