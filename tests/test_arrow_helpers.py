"""Arrow kernels behind the name-folding UDFs, on sliced and empty batches."""

import pyarrow as pa

from limelight.functions.text import fold_targets_arrow, target_counts_arrow

TOK, CANON = "mbapp", "kylian mbappe"


def batch():
    full = pa.array([["zz"], ["kylian mbappe", "mbappé", "other", "x!", "x", None], [], None, ["josé", "jose", "b", "!!"]],
                    pa.list_(pa.string()))
    return full.slice(1, 4)


def test_fold_on_a_slice():
    assert fold_targets_arrow(batch(), TOK, CANON).to_pylist() == [
        [CANON, CANON, "other", "x", "x"], [], None, ["jose", "jose", "b"]]


def test_counts_on_a_slice():
    assert target_counts_arrow(batch(), TOK, CANON).to_pylist() == [
        {"mentions": 2, "max_mentions": 2}, {"mentions": 0, "max_mentions": 0},
        {"mentions": 0, "max_mentions": 0}, {"mentions": 0, "max_mentions": 2}]


def test_empty_batch():
    empty = batch().slice(0, 0)
    assert fold_targets_arrow(empty, TOK, CANON).to_pylist() == []
    assert target_counts_arrow(empty, TOK, CANON).to_pylist() == []
