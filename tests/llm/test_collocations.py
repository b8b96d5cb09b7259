import random
import re
from collections import Counter, defaultdict

import pytest

from limelight.llm import collocations

UPPER = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def grams(rows, longest):
    out = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", "".join(UPPER.get(c, c) for c in text or "")):
            w = re.findall(r"[^ \t]+", piece)
            for m in range(1, longest + 1):
                out[lang or "und"].update(" ".join(w[i:i + m]) for i in range(len(w) - m + 1))
    return out


def brute(rows, longest, least, top):
    out = []
    for lang, f in grams(rows, longest).items():
        n = sum(c for p, c in f.items() if " " not in p)
        some = {p: a for p, a in f.items() if " " in p and a >= least}
        scored = []
        for p, a in some.items():
            if any(f" {p} " in f" {q} " and p != q and 100 * b >= 50 * a for q, b in some.items()):
                continue
            w = p.split(" ")
            score, k = min((1000000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w)))
            scored.append((-score, -a, p.encode(), p, f[" ".join(w[:k])], f[" ".join(w[k:])]))
        out += [(lang, r, p, -a, left, right, n, -s) for r, (s, a, _, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def text(rng, n, size):
    words = [rng.choice(["Néé", "a", "b c", "zz "])] + [f"w{k}" for k in range(size)]
    return "".join(rng.choice(words) + rng.choice([" "] * 12 + ["  ", "\t", ". ", "\n", ", ", ";"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [(rng.choice(["en", "de", None, "und"]), text(rng, rng.choice([0, 1, 2, 3, 40, 200]), rng.choice([2, 6, 30]))) for _ in range(150)]
    out += [("en", None), (None, ""), ("de", " .,;\t\n"), ("en", text(rng, 20_000, 40)), ("en", "A b! " * 500), ("fr", "same same same same " * 400)]
    return out + out[:30]


def run(spark, rows, least, longest, top, **kw):
    docs = spark.createDataFrame([(i, t, g, 1.0, "x") for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, f double, phrase string")
    return sorted(map(tuple, collocations.op13(docs.repartition(3), longest, least, top, **kw).collect()))


@pytest.mark.parametrize("kw", [{}, {"share": 64, "lowered": 3}, {"share": 1, "lowered": 1}, {"filter_bits": 64}, {"share": 10**6, "filter_bits": 4096}])
def test_against_brute_force(spark, rows, kw):
    assert run(spark, rows, 10, 3, 2000, **kw) == brute(rows, 3, 10, 2000)


@pytest.mark.parametrize("longest, least, top", [(2, 3, 7), (5, 4, 50), (4, 2, 1)])
def test_other_lengths(spark, rows, longest, least, top):
    assert run(spark, rows, least, longest, top) == brute(rows, longest, least, top)


def test_border_failures_start_further_passes(spark, rows):
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")
    everything, few = (collocations.frequent_phrases(docs, share=s, lowered=1) for s in (1, 10**9))
    assert everything[1] == 1  # the whole corpus was the sample: nothing fails
    assert few[1] == 3  # nothing was proposed: words, then pairs, then triples
    assert sorted(map(tuple, everything[0].collect())) == sorted(map(tuple, few[0].collect()))


def test_products_beyond_64_bits(spark):
    f = spark.createDataFrame([("x", 1, b"a", 9 * 10**12), ("x", 1, b"b", 8 * 10**12), ("x", 2, b"a b", 7 * 10**12)], "lang string, size int, phrase binary, f long")
    (row,) = collocations.collocations(f).collect()
    assert row.score == 1000000 * (7 * 10**12) ** 2 // (72 * 10**24)


def test_empty_table(no_documents):
    assert collocations.op13(no_documents).collect() == []
