import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def prose(rng, n, vocabulary=4000):
    return " ".join("w%d" % rng.randrange(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Ids and texts with copies, near copies, shared passages, and every odd case."""
    rng = random.Random(5)
    texts = [None, "", "   \n\t ", "one", "one", "One", "a b", "aa " * 400, "x" * 3000, "é" * 150 + " " + "é" * 150, " a\u0085b c"]
    base = [prose(rng, rng.choice([5, 30, 90, 300])) for _ in range(25)]
    passage = prose(rng, 70)
    for t in base:
        w = t.split()
        texts += [t, t.upper() if rng.random() < 0.3 else t]
        for _ in range(3):
            v = list(w)
            for _ in range(max(1, len(v) // rng.choice([10, 25, 60]))):
                v[rng.randrange(len(v))] = "z%d" % rng.randrange(99)
            texts.append(" ".join(v))
        texts.append(" ".join(w[: len(w) // 2]) + " " + passage + " " + " ".join(w[len(w) // 2:]))
    texts += [passage, passage + " end", prose(rng, 15000, 300)]
    texts += [" ".join(texts[40].split()[:-1] + [f"tail{k}"]) for k in range(60)]  # one large group of near copies
    ids = list(range(0, 3 * len(texts), 3))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, "k", 2, "p", 3.0) for i, t in corpus]
    names = "doc_id long, text string, lang string, source string, n_chars long, doc int, key string, _drop int, component string, score double"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
