import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with copies, near copies, nulls, blanks, short and long texts, ties and repeated rows."""
    rng = random.Random(3)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(60)]
    base = words(rng, 200)
    texts += [base, base, base.upper(), base + " tail", base.replace(base.split()[50], "other"), "\n".join([base, base])]
    passage = words(rng, 60)
    texts += [f"{words(rng, 20)}\n{passage}\n{words(rng, 9)}" for _ in range(5)]
    texts += [None, "", "   \t\n", "one", "one", "one two three four", "One TWO three four", "é" * 9, "x" * 30000, words(rng, 6000)]
    rows = [(i, t, "en", f"src{i % 4}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[4], None, "src1", 5), (None, "unnamed words stand here now", None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same with more columns, named like those that the operators use inside."""
    from pyspark.sql import functions as F

    names = "rep th ord row gone _gone size ratio bin edge s source_size target copies component_id kept _text route bucket held_out score url part".split()
    return docs.withColumns({n: F.lit(f"own {n}") for n in names})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
