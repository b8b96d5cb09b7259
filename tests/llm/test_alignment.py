import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from limelight.llm import alignment

SP = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
BPE = Tokenizer.from_file(path("byte_bpe_50k.json"))
BPE.encode_special_tokens = True


def byte_alphabet():
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(rest)}


BYTE = byte_alphabet()


def tokens(text):
    if not text:
        return [], []
    a = [(i, bytes(BYTE[c] for c in BPE.id_to_token(i))) for i in BPE.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in SP.encode(text):
        p = SP.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    return (a, b) if all(b"".join(t for _, t in x) == want for x in (a, b)) else ([], [])


def spans(side):
    at, out = 0, []
    for i, raw in side:
        out.append((at, at + len(raw), i))
        at += len(raw)
    return out


def brute(rows):
    links, groups, count = [], [], Counter()
    for _, text in rows:
        a, b = map(spans, tokens(text))
        links.append([(i, j) for lo, hi, i in a for l2, h2, j in b if lo < h2 and l2 < hi])
        count.update(links[-1])
        cuts = sorted({hi for _, hi, _ in a} & {hi for _, hi, _ in b})
        text_of = lambda side, lo, hi: ",".join(str(i) for s, e, i in side if lo <= s and e <= hi)
        groups.append((len(a), len(b), ";".join(f"{text_of(a, lo, hi)}|{text_of(b, lo, hi)}" for lo, hi in zip([0, *cuts], cuts)), len(cuts)))
    most = defaultdict(int)
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return sorted(((i, na, nb, ng, len(ls), sum(count[p] == most[p[1]] for p in ls), sum(count[p] for p in ls),
                    hashlib.sha256(g.encode()).hexdigest() if na else "") for (i, _), (na, nb, g, ng), ls in zip(rows, groups, links)), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["the", "Über", "straße", "naïve", "日本語", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "\U0001f600", "x" * 40, "don't", "1234567", "▁", "á", "ﬁ", " ", "\x00", "\x7f"]
    out = [(0, None), (1, ""), (2, " "), (3, "  two  blanks "), (4, "\ttab\nline\r\n"), (5, "the"), (6, "the"), (None, "the cat"), (None, None), (7, "　wide"), (8, "▁"), (8, "again")]
    for k in range(60):
        out.append((10 + k, "".join(rng.choice(words) + rng.choice([" ", " ", "", "  ", "\n", ". "]) for _ in range(rng.choice([1, 3, 10, 60])))))
    plain = ["the", "cat", "sat", "Unbelievably", "internationalisation", "on", "12", "mats,", "größer"]
    out += [(100 + k, " ".join(rng.choice(plain) for _ in range(rng.choice([5, 50, 400])))) for k in range(30)]
    return out


@pytest.fixture(scope="module")
def expected(rows):
    return brute(rows)


@pytest.mark.parametrize("kw", [{}, {"piece": 1}, {"piece": 7}, {"block": 50}])
def test_against_brute_force(spark, rows, expected, kw):
    docs = spark.createDataFrame([(i, t, 1, "g") for i, t in rows], "doc_id long, text string, row int, groups string").repartition(3)
    assert sorted(map(tuple, alignment.op11(docs, **kw).collect()), key=str) == expected
    assert any(r[1] for r in expected) and any(not r[1] for r in expected)


def test_long_text(spark):
    rng = random.Random(4)
    text = " ".join(rng.choice(["interest", "rate", "naïve", "fjord", "Quetzal", "1999"]) for _ in range(60_000))
    (row,) = alignment.op11(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()
    a, b = tokens(text)
    ends = [set(np.cumsum([len(r) for _, r in side]).tolist()) for side in (a, b)]
    assert (row.n_a, row.n_b, row.n_groups, row.n_links) == (len(a), len(b), len(ends[0] & ends[1]), len(ends[0] | ends[1]))


@pytest.mark.parametrize("piece", [1, 2, 3, 10, 1000])
def test_pieces_join_to_the_whole_merge(piece):
    rng = np.random.default_rng(piece)
    for _ in range(50):
        total = int(rng.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rng.random(total - 1) < p) + 1, total) for p in rng.random(2))
        i, j, ends, both = alignment.merge(a, b, piece)
        want = sorted({*a.tolist(), *b.tolist()})
        assert ends.tolist() == want
        assert i.tolist() == [int((a < e).sum()) for e in want] and j.tolist() == [int((b < e).sum()) for e in want]
        assert both.tolist() == [e in a and e in b for e in want]


def test_cuts_have_equal_work():
    a, b = np.arange(1, 100_001), np.array([5, 99_990, 100_000])
    at = np.arange(0, 100_003, 1000)
    i = alignment.crossings(a, b, at)
    assert (np.diff(at) == 1000).all() and (np.diff(i) >= 997).all()


def test_empty_table(no_documents):
    assert alignment.op11(no_documents).collect() == []
