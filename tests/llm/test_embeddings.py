import numpy as np

from brute import union_find
from limelight.llm import embeddings


def _brute(rows, cosine):
    ok = {}
    for k, (i, v, label) in enumerate(rows):
        if i is not None and v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            ok[k] = np.array(v, np.float32).astype(float)
    links = [(a, b) for a in ok for b in ok if a != b and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b])
             and ok[a] @ ok[b] / np.sqrt(ok[a] @ ok[a]) / np.sqrt(ok[b] @ ok[b]) >= cosine]
    part = union_find(range(len(rows)), links)
    low = {}
    for k, r in part.items():
        if rows[k][0] is not None:
            low[r] = min(low.get(r, rows[k][0]), rows[k][0])
    count = [sum(a == k for a, _ in links) for k in range(len(rows))]
    return [(i, count[k], None if i is None else low[part[k]], i is None or low[part[k]] == i) for k, (i, _, _) in enumerate(rows)]


def test_links_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)  # so that crowded cells are dealt over tiles and salts
    rng = np.random.default_rng(9)
    rows, centre = [], rng.normal(size=(12, 64))
    for k in range(400):
        v = centre[k % 12] + rng.normal(size=64) * rng.choice([0.05, 0.25, 0.4, 2.0])
        rows.append((k, [float(x) for x in np.float32(v)], k % 12 % 3))
    rows += [(1000 + k, rows[0][1], 0) for k in range(40)] + [(2000, [2 * x for x in rows[0][1]], 0)]
    rows += [(3000, None, 0), (3001, [0.0] * 64, 0), (3002, [float("nan")] + [1.0] * 63, 0), (3003, rows[0][1], None), (3004, [], 0),
             (3005, [None] + [1.0] * 63, 0), (None, rows[0][1], 0), (3006, rows[0][1][:8], 0), (3007, rows[0][1][:8], 0), (3008, [1.0], 1), (3009, [2.0], 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, links int")
    got = sorted((tuple(r) for r in embeddings.op6(df).collect()), key=str)
    assert got == sorted(_brute(rows, 0.93), key=str)


def test_no_rows(spark):
    assert embeddings.op6(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
