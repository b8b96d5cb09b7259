"""Near-duplicates and repeated passages against brute force."""

import random

import brute
import numpy as np
import pytest

from limelight.llm import common, graph, neardup, substring, suffixes
from limelight.llm import phrases as P


@pytest.mark.parametrize("n, short, growth", [(2, 8, 8), (5, 2, 4)])
def test_near_duplicates(documents, corpus, n, short, growth, monkeypatch):
    monkeypatch.setattr(neardup, "SHORT", short)  # also with many rounds of hubs
    monkeypatch.setattr(neardup, "GROWTH", growth)
    got = {r.doc_id: tuple(r)[:4] for r in neardup.near_duplicates(documents, n, 80).collect()}
    assert got == brute.near_duplicates(corpus, n, 80)


def test_near_duplicates_odd_rows(spark, no_documents):
    assert neardup.op1(no_documents).collect() == []
    same = "a b c d e f g h"
    rows = [(None, same), (None, None), (4, same), (4, same), (9, same), (9, "other words here"), (12, "other words here")]
    got = sorted((tuple(r) for r in neardup.op1(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, 7, None, True), (None, 0, None, True), (4, 7, 4, True), (4, 7, 4, True), (9, 7, 4, False),
                          (9, 2, 4, False), (12, 2, 4, False)], key=str)


def thue_morse(n):
    return "".join("ab"[bin(k).count("1") & 1] for k in range(n)), "".join("ba"[bin(k).count("1") & 1] for k in range(n))


def test_two_texts_of_one_id_link_each(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "xy")
    rows = [(5, a), (5, b), (7, a + " more"), (8, b + " more"), (9, "else")]
    got = neardup.op1(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(5, 5, True), (5, 5, True), (7, 5, False), (8, 5, False), (9, 9, True)]


def test_words_that_cancel_in_a_polynomial(spark):
    one, other = thue_morse(1024)
    common = "q r s t"
    got = neardup.op1(spark.createDataFrame([(1, f"{one} {common}"), (2, f"{other} {common}")], "doc_id long, text string")).collect()
    assert all(r.kept for r in got)
    shared = " ".join(f"w{k}" for k in range(19))
    rows = [(1, f"{shared} {one}"), (2, f"{shared} {other}")]
    got = {r.doc_id: tuple(r) for r in substring.op3(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.repeated_words(rows)


def test_word_hashes():
    rng = random.Random(8)
    words = {bytes(rng.choice(b"ab") for _ in range(rng.choice([1, 7, 8, 9, 16, 17, 511, 512, 513, 3000]))) for _ in range(3000)}
    words |= {w.encode() for w in thue_morse(1024)} | {b"\0" * k for k in range(1, 20)}
    words = sorted(words)
    data = np.frombuffer(b" ".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size + 1) - size - 1
    h = common.word_hashes(data, start, start + size)
    assert len(set(h.tolist())) == len(words)
    alone = [common.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert h.tolist() == [int(x) for x in alone]


def test_one_document_of_each_group_stays(spark, no_documents):
    text = " ".join(f"word{k}" for k in range(30))
    rows = [(4, text, 1), (4, text, 2), (4, "quite other words in here", 3), (9, text, 4), (None, text, 5), (None, text, 6), (11, "", 7), (11, None, 8), (12, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, node int").repartition(2)
    out = neardup.keep_one(docs)
    assert out.schema == docs.schema
    assert sorted(((r.doc_id for r in out.collect())), key=str) == [11, 12, 4, None, None]
    assert neardup.keep_one(no_documents).collect() == []


def test_match_threshold_loses_no_pair_at_the_wanted_similarity():
    rng = np.random.default_rng(3)
    t = neardup.match_threshold(neardup.K, 0.8)
    assert (rng.binomial(neardup.K, 0.8, 200_000) < t).mean() < 1e-4


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 440)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.union_find({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if k in got} and all(want[k] == k for k in set(want) - set(got))


def test_substring(documents, corpus):
    got = {r.doc_id: tuple(r) for r in substring.op3(documents).collect()}
    assert got == brute.repeated_words(corpus)


@pytest.mark.parametrize("crowd", [1000, 1, 4])
def test_suffixes(documents, corpus, monkeypatch, crowd):
    monkeypatch.setattr(P, "CROWD", crowd)  # also with anchors that are looked at window by window
    got = {r.doc_id: tuple(r) for r in suffixes.op4(documents).collect()}
    assert got == brute.repeated_bytes(corpus)


def test_repeats_odd_rows(spark, no_documents):
    assert substring.op3(no_documents).collect() == [] and suffixes.op4(no_documents).collect() == []
    text = " ".join(f"word{k}" for k in range(60))
    rows = spark.createDataFrame([(None, text), (1, text), (1, text), (2, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring.op3(rows).collect()) == [
        ("1", 60, 60), ("1", 60, 60), ("2", 0, 0), ("None", 60, 0)]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.op4(rows).collect()) == [
        ("1", len(text), len(text), 1), ("1", len(text), len(text), 1), ("2", 0, 0, 0), ("None", len(text), len(text), 1)]


def test_column_wise_prefixes():
    rng = random.Random(2)
    for _ in range(30):
        core = bytes(rng.choice(b"ab") for _ in range(12))
        strings, place, group = [], [], []
        for _ in range(rng.randrange(1, 9)):
            left = bytes(rng.choice(b"ab") for _ in range(rng.randrange(10)))
            strings.append(left + core + bytes(rng.choice(b"ab") for _ in range(rng.randrange(10))))
            place.append(len(left))
            group.append(rng.randrange(2))
        count = np.array([len(s) - 11 for s in strings])
        got = suffixes.repeats(strings, np.array(group), np.array(place), count, 12)
        for i, s in enumerate(strings):
            want = [any(j != i and group[j] == group[i] and 0 <= at - place[i] + place[j]
                        and strings[j][at - place[i] + place[j]:][:12] == s[at:at + 12] for j in range(len(strings))) for at in range(count[i])]
            assert list(got[i]) == want


def test_phrases_cover_every_window():
    rng = np.random.default_rng(4)
    code = rng.integers(0, 4, 500).astype(np.uint64)
    bounds = np.array([0, 100, 100, 119, 500])
    row, start, count, *_ = P.phrases(code, bounds, 20, 5)
    seen = [(int(r), int(s) + k) for r, s, c in zip(row, start, count) for k in range(c)]
    assert seen == [(r, s) for r in range(4) for s in range(bounds[r + 1] - bounds[r] - 19)]
