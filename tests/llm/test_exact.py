import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from limelight.llm import exact


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for norm, ids in groups.items():
        top = max(ids, key=lambda i: (i is not None, i or 0))
        digest, left = hashlib.sha256(norm.encode()).hexdigest(), 1
        for i in sorted(ids, key=str):
            out.append((i, top, len(ids), i == top and left > 0, digest))
            left -= i == top
    return sorted(out, key=str)


@pytest.mark.parametrize("shift", [0, 1, 7, 40])
def test_golomb_round_trip(shift):
    rng = np.random.default_rng(shift)
    for gaps in (np.zeros(0), np.zeros(5), rng.integers(0, 2 ** (shift + 4), 300)):
        gaps = gaps.astype(np.uint64)
        unary, rest = exact.golomb(gaps, shift)
        assert (exact.ungolomb(unary, rest, len(gaps), shift) == gaps).all()


def test_against_brute_force(documents, corpus):
    got = sorted(map(tuple, exact.op12(documents).collect()), key=str)
    assert got == brute(corpus)


ODD = [(1, "A"), (1, "a"), (None, "a"), (None, "b"), (None, "B"), (2, None), (3, ""), (4, "É"), (5, "é"), (6, "x" * 300_000), (7, "X" * 300_000), (8, "b ")]


def test_ties_nulls_repeated_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, exact.op12(docs).collect()), key=str) == brute(ODD)


@pytest.mark.parametrize("weak", ["digest", "fingerprint", "both"])
def test_texts_decide_not_hashes(spark, documents, corpus, weak):
    few = lambda c: F.pmod(F.length(c), F.lit(3))
    kw = {}
    if weak != "fingerprint":
        kw["digest"] = lambda c: few(c).cast("string").cast("binary")
    if weak != "digest":
        kw["fingerprint"] = lambda c: few(c).cast("long")
    for docs, rows in ((documents, corpus), (spark.createDataFrame(ODD, "doc_id long, text string"), ODD)):
        got = sorted((tuple(r)[:4] for r in exact.exact_duplicates(docs, **kw).collect()), key=str)
        assert got == sorted((r[:4] for r in brute(rows)), key=str)


def test_many_owners_and_a_hot_text(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"text {rng.randrange(4000)}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact.exact_duplicates(docs, owner_rows=64).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted((r[:4] for r in brute(rows)), key=str)


def test_empty_table(no_documents):
    assert exact.op12(no_documents).collect() == []


def test_rows_that_stay(spark):
    rows = [(i, t, "own") for i, t in ODD]
    docs = spark.createDataFrame(rows, "doc_id int, text string, digest string")
    out = exact.drop_duplicates(docs)
    assert out.schema == docs.schema
    want = sorted(((r[0], r[4]) for r in brute(ODD) if r[3]), key=str)
    assert sorted(((r[0], hashlib.sha256(lower(r[1]).encode()).hexdigest()) for r in out.collect()), key=str) == want
