import random
import zlib

import numpy as np
import pytest

from riskengine.llm import langid


def brute_probability(texts, order=langid.ORDER):
    """Interpolated Kneser-Ney with plain dictionaries."""
    from collections import Counter, defaultdict

    levels = [Counter()]
    for t in texts:
        s = langid.symbols(t).tolist()
        for k in range(len(s) - order + 1):
            levels[0][tuple(s[k : k + order])] += 1
    for n in range(order - 1, 0, -1):
        levels.append(Counter({g: 0 for g in {x[-n:] for x in levels[-1]}}))
        for g in levels[-2]:
            levels[-1][g[-n:]] += 1
    alphabet = len({g[-1] for g in levels[0]})

    def p(g):
        if not g:
            return 1 / (alphabet + 1)
        c = levels[order - len(g)]
        ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.9)
        after = [v for x, v in c.items() if x[:-1] == g[:-1]]
        if not after:
            return p(g[1:])
        return max(c.get(g, 0) - d, 0) / sum(after) + d * len(after) / sum(after) * p(g[1:])

    return p, alphabet, levels[0]


def test_model_equals_definition_and_sums_to_one():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aab bcé") for _ in range(60)) for _ in range(5)]
    p, alphabet, counts = brute_probability(texts)
    pack = lambda g: int(sum(x << (16 * (len(g) - 1 - k)) for k, x in enumerate(g)))
    kinds = sorted(counts, key=pack)
    model = langid.LanguageModel(np.array([pack(g) for g in kinds], dtype=np.uint64), np.array([counts[g] for g in kinds]), alphabet)
    seen = sorted({x for g in counts for x in g})
    some = [tuple(rng.choice(seen + [ord("z")]) for _ in range(4)) for _ in range(300)] + kinds[:50]
    got = model.log_p(np.array([pack(g) for g in some], dtype=np.uint64))
    assert np.exp(got) == pytest.approx([p(g) for g in some])
    for h in kinds[:20]:
        # all symbols and one that was never seen
        every = [(*h[:-1], w) for w in [*{g[-1] for g in counts}, ord("z")]]
        assert sum(map(p, every)) == pytest.approx(1)
        assert np.exp(model.log_p(np.array([pack(g) for g in every], dtype=np.uint64))).sum() == pytest.approx(1)


def test_symbols():
    assert "".join(map(chr, langid.symbols("  Ab--c1 É!").tolist())) == "   ab c é "
    assert not len(langid.symbols("123 !?"))


@pytest.fixture(scope="module")
def model(spark, small):
    return langid.learn(spark.read.parquet(f"{small}/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_cases(spark, model, clashing, empty):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 !"), (4, "x"), (None, "the of and " * 9000), (6, "жжжж щщщщ ыыыы"), (6, "жжжж щщщщ ыыыы")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and [got[i].score for i in (1, 2, 3)] == [0.0] * 3
    assert got[None].lang_pred == "en" and not got[None].held_out
    assert got[6].rejected
    assert langid.identify(empty, model).collect() == []
    assert len(langid.identify(clashing, model).collect()) == clashing.count()
    nothing = langid.learn(empty)
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}
    assert langid.learn(clashing).names == ["en"]
    assert {r.lang_pred for r in langid.identify(df.where("doc_id = 4"), langid.learn(clashing)).collect()} == {"en"}


def test_every_language_is_learned(spark):
    """Three hundred languages with one learnable text each, and a large one under a tight bound."""
    ids = [i for i in range(1, 2000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rng = random.Random(3)
    word = lambda k: "".join(chr(0x4E00 + 40 * k + rng.randrange(8)) for _ in range(5))
    rows = [(i, " ".join(word(k) for _ in range(20)), f"l{k:03d}") for k, i in enumerate(ids[:300])]
    rows += [(i, "the of and to in " * 50, "big") for i in ids[300:400]] + [(ids[400], "12 34", "digits")]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_chars=30_000)
    assert model.names == sorted({r[2] for r in rows} - {"digits"})
    got, _score, _no = model.predict([r[1] for r in rows[:350]])
    assert got == [r[2] for r in rows[:350]]
