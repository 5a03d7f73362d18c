import random
from collections import Counter, defaultdict

from riskengine.llm import linedup


def brute(rows, least=50):
    """Kept texts of (doc_id, text): every run is looked up in all that stands before it."""
    last = (1 << 63) - 1
    kinds = sorted({(last if i is None else i, t) for i, t in rows if t is not None}, key=lambda x: x[0])
    filled = {k: [(n, line, len(line.split())) for n, line in enumerate(k[1].split("\n")) if line.split()] for k in kinds}
    first = {}
    places = defaultdict(list)
    order = {k: n for n, k in enumerate(sorted(kinds, key=lambda k: k[0]))}
    for k in kinds:
        lines = filled[k]
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(x[2] for x in lines[a:b]) >= least:
                    places[tuple(x[1] for x in lines[a:b])].append((order[k], a, k))
    gone = defaultdict(set)
    for run, found in places.items():
        first[run] = min(found, key=lambda f: f[:2])
        for o, a, k in found:
            if o != first[run][0] or a >= first[run][1] + len(run):
                gone[k] |= {filled[k][n][0] for n in range(a, a + len(run))}
    out = []
    for i, t in rows:
        k = (last if i is None else i, t)
        out.append((i, t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[k]), len(filled.get(k, [])), len(gone[k])))
    return Counter(out)


def run(df):
    return Counter((r.row.doc_id, r.text, r.n_lines, r.n_deleted) for r in linedup.delete_repeated_runs(df).collect())


def test_matches_brute_force(spark):
    rng = random.Random(8)
    lines = [" ".join(rng.choice("abcdef") for _ in range(rng.choice([1, 4, 9, 20, 60]))) for _ in range(25)]
    rows = [(i, "\n".join(rng.choice(lines + ["", "  "]) for _ in range(rng.randint(0, 30)))) for i in range(70)]
    rows += [(70, None), (71, ""), (72, rows[5][1]), (73, "\n".join([lines[0]] * 40)), (73, "\n".join([lines[0]] * 40))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, want = run(df), brute(rows)
    assert got == want
    assert sum(x[3] for x in got) > 100


def test_fixture_and_clashing_names(docs, clashing):
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id is not null").collect()]
    assert run(docs.where("doc_id is not null")) == brute(rows)
    out = linedup.delete_repeated_runs(clashing)
    assert out.select("row.*").columns == clashing.columns
    assert {r.row.gone for r in out.collect()} == {"own gone"}


def test_first_copy_stays_and_short_lines_stay(spark):
    p = " ".join(f"w{k}" for k in range(51))
    df = spark.createDataFrame([(2, f"b\n{p}"), (1, f"a\n{p}\nc"), (3, "b"), (4, "b")], "doc_id long, text string")
    got = {r.row.doc_id: r.text for r in linedup.delete_repeated_runs(df).collect()}
    assert got == {1: f"a\n{p}\nc", 2: "b", 3: "b", 4: "b"}


def test_empty_table(empty):
    assert linedup.delete_repeated_runs(empty).collect() == []
