import hashlib
from collections import Counter

import corpus_pipeline
from test_linedup import brute as lines_brute
from test_minhash import brute as groups_brute
from test_mixing import targets

from riskengine.llm import bpe, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "minhash_dedup", "source_mix", "bpe_encode"]
    clean = stages["toxicity"](spark, docs, small).cache()
    model = toxicity.learn(docs, spark.read.parquet(f"{small}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad
    lines = stages["line_dedup"](spark, clean, small).cache()
    want = {x[0]: x for x in lines_brute([(r.doc_id, r.text) for r in clean.collect()])}
    got = {r.doc_id: r for r in lines.collect()}
    assert {i: r.text for i, r in got.items()} == {i: x[1] for i, x in want.items() if not x[3] or x[3] < x[2]}
    assert all(r.n_chars == len(r.text) for r in got.values())
    once = stages["minhash_dedup"](spark, lines, small).cache()
    assert {r.doc_id for r in once.collect()} == {k[0] for k in groups_brute([(i, r.text) for i, r in got.items()]) if k[3]}
    mixed = stages["source_mix"](spark, once, small).cache()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in once.collect():
        sizes[r.source] += len(r.text.split())
        largest[r.source] = max(largest[r.source], len(r.text.split()))
    for r in mixed.collect():
        taken[r.source] += len(r.text.split())
    assert all(abs(taken[s] - goal) <= largest[s] / 2 + 1e-6 for s, goal in targets(sizes).items())
    for part in (clean, lines, once, mixed):
        assert part.columns == docs.columns
    coded = stages["bpe_encode"](spark, mixed, small)
    texts = Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect())
    assert Counter((r.doc_id, r.decoded_sha256) for r in coded.collect()) == texts
    assert Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in bpe.decode(coded).collect()) == texts


def test_run_and_other_columns(spark, small, clashing):
    assert corpus_pipeline.run(spark, small).count() > 0
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == clashing.columns, name
    assert corpus_pipeline.encode(spark, docs, small).count() == docs.count()


def test_empty_documents(spark, small, empty):
    docs = empty
    for _name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert docs.collect() == []
