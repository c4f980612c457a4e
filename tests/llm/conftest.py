import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.9)) % vocabulary}" for _ in range(n))


def corpus(seed=3, n=160):
    """Documents with exact and near copies, shared passages, nulls, empty, very short and very long texts."""
    rng = random.Random(seed)
    passage = sentence(rng, 70, 5000)
    texts = []
    for i in range(n):
        kind = i % 16
        if kind == 0 and texts:
            texts.append(rng.choice([t for t in texts if t]))
        elif kind in (1, 2) and len(texts) > 20:
            ws = rng.choice([t for t in texts if t and len(t) > 200] or ["a b c d e f"]).split(" ")
            for _ in range(rng.randint(1, 3)):
                ws[rng.randrange(len(ws))] = "changed"
            texts.append("  ".join(ws) if kind == 1 else " ".join(ws))
        elif kind == 3:
            texts.append(rng.choice([None, "", "  \n\t ", "one", "Two words", "three little WORDS", "İstanbul ſ K é"]))
        elif kind == 4:
            texts.append(passage + " " + sentence(rng, rng.randint(100, 200), 5000))
        else:
            texts.append("\n".join(sentence(rng, rng.randint(1, 60), 5000).capitalize() for _ in range(rng.randint(1, 6))))
    texts.append(sentence(rng, 30_000, 3000))
    texts.append("x" * 60_000 + " " + "ab " * 5000)
    texts += [texts[5]] * 40
    big = sentence(rng, 150, 5000).split(" ")
    for i in range(40):  # a large group of near copies
        ws = list(big)
        ws[(7 * i) % len(ws)] = f"edit{i}"
        texts.append(" ".join(ws))
    langs, sources = ["en", "de", None], ["a", "b", "c", "hot", "hot", None, "é"]
    return [(i, t, langs[i % 3], sources[rng.randrange(7)], len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_docs(spark, rows):
    """Repeated rows, an id with two texts, rows without id, and extra columns named like helper columns."""
    some = [(*r, "x", 1, "y", True) for r in rows[:40]]
    some += [some[5], some[5], (7, "another text for seven " * 20, "en", "a", 460, "x", 1, "y", True)]
    some += [(None, rows[9][1], "en", "a", 5, "x", 1, "y", True), (None, None, None, None, None, None, None, None, None)]
    names = ["row", "h", "size", "again"]
    kinds = [T.StringType(), T.LongType(), T.StringType(), T.BooleanType()]
    return spark.createDataFrame(some, T.StructType([*DOCS.fields, *[T.StructField(n, k) for n, k in zip(names, kinds)]]))
