import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choices(VOCAB, k=n))


def corpus(seed=1, n=60):
    """Random documents with near copies, exact copies, shared passages and edge cases."""
    rng = random.Random(seed)
    shared = [prose(rng, 40) for _ in range(3)]
    texts = []
    for i in range(n):
        t = prose(rng, rng.choice([1, 2, 5, 30, 80, 200]))
        kind = i % 6
        if kind == 1:
            t = t + "\n" + rng.choice(shared) + "\t" + prose(rng, 10)
        elif kind == 2 and texts:
            t = rng.choice([x for x in texts if x] or [t])
        elif kind == 3 and texts:
            words = rng.choice([x for x in texts if x] or [t]).split(" ")
            if len(words) > 1:
                words[rng.randrange(len(words))] = "changed"
            t = " ".join(words)
        elif kind == 4:
            t = (t + " ") * 3
        texts.append(t)
    texts += [None, "", "   ", "\n", "one", "a a a a a a a a a a a a a a a a a a a a", "é" * 300, prose(rng, 5000)]
    rows = [(i, t, "en", rng.choice(["a", "b", None]), len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[5])  # a repeated row
    rows.append((None, prose(rng, 50), None, None, None))
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(4).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(docs):
    """The corpus with columns named like those that operators add."""
    from pyspark.sql import functions as F

    for c in ("id", "range", "halo", "key", "size", "taken", "score", "predicted", "held_out", "bands", "sketch", "component",
              "length", "group", "chunk", "stats", "place", "target", "cut", "bucket", "order_key", "kind", "data", "message"):
        docs = docs.withColumn(c, F.lit("clash"))
    return docs
