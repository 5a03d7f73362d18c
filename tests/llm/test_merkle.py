import hashlib
import random
import zlib

import numpy as np
import pytest

from riskengine.llm import merkle as K

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, more=0):
    doc, text, lang, source, n = row
    n = None if n is None else n + more
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i : i + 2])) for i in range(0, len(now), 2)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((i & 1, level[i ^ 1]) if i ^ 1 < len(level) else (2, ""))
        i >>= 1
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0], leaf_of(r), r))
    names = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: (x[0], x[1] or 0, x[2]))]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (_known, doc, leaf, row) in enumerate(sorted(groups[g], key=lambda x: (x[0], x[1] or 0, x[2]))):
            steps = way(trees[g], i) + way(top, k)
            hit = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0
            folded = leaf_of(row, 1) if hit else leaf
            for side, beside in steps:
                folded = sha(beside + folded if side == 1 else folded + beside)
            out.append((doc, leaf, trees[g][-1][0], top[-1][0], sha("".join(b for _s, b in steps)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def proofs(spark, rows, height=K.HEIGHT):
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS tree", "1 AS idx", "2 AS leaf", "3 AS block", "4 AS level", "5 AS digest")
    return sorted((tuple(r) for r in K.prove(K.build(docs, height)).collect()), key=repr)


def rows_of(n, rng):
    rows = [(i * 3, f"text {i} é", rng.choice(["en", "de", "", "日本", None]), rng.choice(["a", None]), rng.choice([i, None])) for i in range(n)]
    rows += [(None, None, None, None, None), (None, "", "lone", "", 0), (7, "x", "en", "s", (1 << 63) - 1), (6, "other", "en", "b", 5)]
    return rows + [rows[2]] * 3


@pytest.mark.parametrize("height", [2, 12])
def test_equals_brute_force(spark, height):
    """Blocks of four leaves make a tree of many levels and blocks."""
    rows = rows_of(70, random.Random(10))
    got = proofs(spark, rows, height)
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(rows)


def test_lone_leaf_and_empty_table(spark):
    one = [(14, "t", "en", "s", 1)]
    assert proofs(spark, one) == brute(one)
    assert proofs(spark, []) == []


def test_proofs_of_some_leaves_fetch_only_what_is_missing(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(40)]
    manifest = K.build(spark.createDataFrame(rows, DOCS))
    some = manifest.leaves.where("doc_id in (3, 4, 5, 17, 39)")
    need = {(r["level"], r["idx"]) for r in K.fetched(some, manifest.nodes).collect()}
    assert need == {(lv, int(i)) for lv, at in K.missing(np.array([3, 4, 5, 17, 39]), 40) for i in at}
    got = sorted(tuple(r) for r in K.prove(manifest, some).collect())
    assert got == [r for r in sorted(brute(rows)) if r[0] in (3, 4, 5, 17, 39)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 21, 64, 100])
def test_missing_nodes_are_the_least_set(n):
    rng = random.Random(n)
    for _ in range(20):
        have = np.array(sorted(rng.sample(range(n), rng.randint(1, n))))
        known = {(0, int(i)) for i in have}
        size, level, needed = n, 0, set()
        while size > 1:
            here = {i for lv, i in known if lv == level}
            for i in list(here):
                if (i ^ 1) < size and i ^ 1 not in here:
                    needed.add((level, i ^ 1))
            known |= {(level + 1, i >> 1) for i in here}
            size, level = (size + 1) >> 1, level + 1
        assert {(lv, int(i)) for lv, at in K.missing(have, n) for i in at} == needed


def test_fold_needs_every_sibling_and_side():
    levels = tree([sha(str(i)) for i in range(11)])
    for i in range(11):
        steps = way(levels, i)
        assert K.fold(levels[0][i], steps) == levels[-1][0]
        assert K.fold(sha("other"), steps) != levels[-1][0]
        if steps and steps[0][0] < 2:
            assert K.fold(levels[0][i], [(1 - steps[0][0], steps[0][1]), *steps[1:]]) != levels[-1][0]
