import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def edge_rows(seed=3, n=40):
    """Null and empty texts, white space alone, exact and near copies, shared passages, one long text, null id and source."""
    g = random.Random(seed)
    vocab = ["".join(g.choice("abcdeé") for _ in range(g.randint(1, 6))) for _ in range(120)]
    say = lambda k: " ".join(g.choice(vocab) for _ in range(k))
    passage = say(60)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two three"), (4, "One Two three"), (5, "one two three four five")]
    base = say(120)
    rows += [(10, base), (11, base), (13, base.upper()), (12, " ".join(base.split()[:-6] + say(6).split())),
             (14, " ".join(base.split()[8:])), (15, base + "\n" + passage), (16, passage + " " + base)]
    lines = [say(5) for _ in range(9)]
    rows += [(20, "\n".join(lines)), (21, "\n".join([say(4), *lines[2:8], say(3)])), (22, "\n".join(lines[:3])), (23, "\n".join(lines[:4] * 3))]
    rows += [(30, say(4000)), (31, "x" * 400), (32, "x" * 99), (33, "ab " * 200), (-7, base + " x"), (None, say(30) + " " + passage)]
    rows += [(100 + i, say(g.randint(1, 80)) + (" " + passage if g.random() < 0.2 else "")) for i in range(n)]
    return [(i, t, "en", None if k % 7 == 3 else f"s{k % 3}", None) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
