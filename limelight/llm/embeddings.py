"""Embedding near-duplicates: a subspace pigeonhole join.

For unit vectors, cosine >= c means a squared distance of at most 2 - 2c. After a
fixed rotation the coordinates are split into blocks of about eight; block j of
q_j of d coordinates gets the budget (2 - 2c) q_j / d. The budgets sum to the
whole, so a near pair keeps within the budget of at least one block. Each block
is a range join: vectors are posted to a grid over the block's first three
coordinates, and probe the later cells that their budget's radius touches. Pairs
within a block's budget are candidates; each is verified exactly, in double
precision on the given vectors, in the first block whose budget it keeps, so
that no pair counts twice.

Equal vectors collapse to one representative with a count. A crowded cell is
dealt over tiles of about ``TILE`` vectors, and its probes over salts; a task holds
one tile and streams the probes past it. Only counts per vector and a spanning
forest of the links leave a task, never the pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, as do rows of null label or null vec_id (component
null); vectors of different length are never compared; equal rows, also of one
vec_id, are vectors of their own that link with each other; other columns play no
part; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C
from limelight.llm.graph import components

TILE = 1024
WIDTH = 8
SLACK = 1e-9  # candidates may be a rounding error farther than the budget; verification is exact


@lru_cache(maxsize=16)
def frame(dim: int, cosine: float):
    """Rotation, blocks of coordinates, and their budgets, for vectors of ``dim`` components."""
    turn = np.linalg.qr(np.random.Generator(np.random.PCG64(dim)).normal(size=(dim, dim)))[0]
    blocks = np.array_split(np.arange(dim), max(1, dim // WIDTH))
    total = 2 - 2 * cosine
    return turn, blocks, [total * len(b) / dim + SLACK for b in blocks]


def matrix(col: pa.Array) -> list[np.ndarray | None]:
    """The vectors of a list column in double precision; None where nothing can be compared."""
    out = []
    for v in col:
        a = None
        if v.is_valid and len(v.values):
            a = np.array(v.values.to_numpy(zero_copy_only=False), float) + 0.0
            a = a if np.isfinite(a).all() and a.any() else None
        out.append(a)
    return out


def _rows(batches):
    import hashlib

    for b in batches:
        vectors = matrix(b.column("embedding"))
        yield pa.record_batch(
            [b.column("vec_id"), b.column("label"), pa.array([None if v is None else len(v) for v in vectors], pa.int32()),
             pa.array([None if v is None else hashlib.md5(v.tobytes()).digest() for v in vectors], pa.binary()),
             pa.array([None if v is None else v.tobytes() for v in vectors], pa.binary())],
            names=["vec_id", "label", "dim", "print", "raw"])


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw)).reshape(len(raw), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _postings(cosine: float):
    """(rep, label, dim, block, cell, probe): the vector's own cell in every block, and the later cells in reach."""
    steps = [s for s in product((-1, 0, 1), repeat=3) if s >= (0, 0, 0)]

    def run(batches):
        for b in batches:
            dims = np.asarray(b.column("dim"))
            for dim in np.unique(dims):
                pick = np.flatnonzero(dims == dim)
                part = b.take(pa.array(pick))
                x = _unit(part.column("raw").to_pylist())
                turn, blocks, budgets = frame(int(dim), cosine)
                x = x @ turn
                for j, (block, budget) in enumerate(zip(blocks, budgets)):
                    width = 2 * np.sqrt(budget)
                    y = np.zeros((len(x), 3))
                    y[:, : min(3, len(block))] = x[:, block[:3]]
                    cell = np.floor(y / width).astype(np.int64)
                    below, above = y - cell * width, (cell + 1) * width - y
                    for step in steps:
                        gap = sum((below[:, i] if s < 0 else above[:, i]) ** 2 for i, s in enumerate(step) if s)
                        near = np.flatnonzero(np.broadcast_to(gap <= budget, len(x)))
                        c = cell[near] + np.array(step)
                        code = ((c[:, 0] + 2**18) << 40) + ((c[:, 1] + 2**18) << 20) + c[:, 2] + 2**18
                        n = len(near)
                        yield pa.record_batch(
                            [part.column("rep").take(pa.array(near)), part.column("label").take(pa.array(near)), pa.array(np.full(n, dim, np.int32)),
                             pa.array(np.full(n, j, np.int32)), pa.array(code), pa.array(np.full(n, step != (0, 0, 0)))],
                            names=["rep", "label", "dim", "block", "cell", "probe"])

    return run


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of the component of each of n nodes, for edges (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _meet(cosine: float):
    """Counts (rep, links) and forest edges (rep, other) from rows sorted by group, members before probes."""

    def pairs(block, dim, mine, theirs, same):
        turn, blocks, budgets = frame(dim, cosine)
        (ids, copies, x), (ids2, copies2, x2) = mine, theirs
        r, r2 = x @ turn, x2 @ turn
        y, y2 = r[:, blocks[block]], r2[:, blocks[block]]
        near = (y**2).sum(1)[:, None] + (y2**2).sum(1)[None] - 2 * y @ y2.T <= budgets[block] + SLACK
        i, j = np.nonzero(np.triu(near, 1) if same else near)
        for lo in range(0, len(i), 200_000):  # verify in bounded steps
            a, b = i[lo:lo + 200_000], j[lo:lo + 200_000]
            ok = np.einsum("ij,ij->i", x[a], x2[b]) >= cosine
            for earlier in range(block):
                gap = ((r[a][:, blocks[earlier]] - r2[b][:, blocks[earlier]]) ** 2).sum(1)
                ok &= gap > budgets[earlier]
            yield a[ok], b[ok]

    def report(block, dim, mine, theirs, same):
        found = list(pairs(block, dim, mine, theirs, same))
        a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, int) for k in (0, 1))
        if not len(a):
            return None
        n = len(mine[0])
        ids = np.concatenate([mine[0], theirs[0]])
        shift = 0 if same else n
        links = np.bincount(a, weights=theirs[1][b], minlength=len(ids))
        links += np.bincount(b + shift, weights=mine[1][a], minlength=len(ids))
        root = _forest(a, b + shift, len(ids))
        at = np.flatnonzero(links)
        return pa.record_batch([pa.array(ids[at]), pa.array(links[at].astype(np.int64)), pa.array(ids[root[at]])], names=["rep", "links", "other"])

    def run(batches):
        group, members, waiting = None, [], []

        def load(rows):
            return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float), _unit([r[2] for r in rows])

        def flush():
            if members and waiting:
                out = report(group[1], group[4], load(members), load(waiting), False)
                waiting.clear()
                return out
            waiting.clear()

        for b in batches:
            keys = zip(*(b.column(c).to_pylist() for c in ("label", "block", "cell", "tile", "dim", "salt")))
            for key, probe, row in zip(keys, b.column("probe").to_pylist(), zip(*(b.column(c).to_pylist() for c in ("rep", "copies", "raw")))):
                if key != group:
                    if (out := flush()) is not None:
                        yield out
                    if group is not None and not closed and len(members) > 1 and group[5] == 0:
                        if (out := report(group[1], group[4], load(members), load(members), True)) is not None:
                            yield out
                    group, members, closed = key, [], False
                if not probe:
                    members.append(row)
                    continue
                if not closed:  # the members are complete: pairs among them, once
                    closed = True
                    if len(members) > 1 and group[5] == 0:
                        if (out := report(group[1], group[4], load(members), load(members), True)) is not None:
                            yield out
                if members:
                    waiting.append(row)
                    if len(waiting) >= TILE and (out := flush()) is not None:
                        yield out
        if (out := flush()) is not None:
            yield out
        if group is not None and not closed and len(members) > 1 and group[5] == 0:
            if (out := report(group[1], group[4], load(members), load(members), True)) is not None:
                yield out

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = C.cut(vectors.select(C.long_ids("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
                 .mapInArrow(_rows, "vec_id long, label long, dim int, print binary, raw binary"))
    real = rows.where("vec_id is not null and label is not null and print is not null")
    groups = C.cut(real.groupBy("label", "dim", "print").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("raw").alias("raw")))
    posts = C.cut(groups.select("rep", "label", "dim", "raw").mapInArrow(
        _postings(cosine), "rep long, label long, dim int, block int, cell long, probe boolean"))
    cell = ["label", "dim", "block", "cell"]
    share = lambda n, size: F.ceil(F.greatest(n, F.lit(1)) / size).cast("int")
    crowd = (posts.groupBy(*cell).agg(F.count_if(~F.col("probe")).alias("m"), F.count_if("probe").alias("p")).where("m > 0")
             .select(*cell, share(F.col("m"), TILE).alias("tiles"), share(F.col("p") + F.col("m"), 16 * TILE).alias("salts")))
    dealt = posts.join(crowd, cell)
    tile, salt = F.pmod(F.xxhash64("rep"), "tiles").cast("int"), F.pmod(F.xxhash64("rep", F.lit(1)), "salts").cast("int")
    all_tiles, all_salts = F.sequence(F.lit(0), F.col("tiles") - 1), F.sequence(F.lit(0), F.col("salts") - 1)
    keys = [*cell, "rep"]
    members = dealt.where(~F.col("probe")).select(*keys, F.lit(False).alias("probe"), tile.alias("tile"), F.explode(all_salts).alias("salt"))
    probes = dealt.where("probe").select(*keys, "probe", F.explode(all_tiles).alias("tile"), salt.alias("salt"))
    # within a cell of several tiles, a member probes the later tiles
    later = dealt.where(~F.col("probe") & (F.col("tiles") > 1)).select(
        *keys, F.lit(True).alias("probe"), F.explode(F.filter(all_tiles, lambda t: t > tile)).alias("tile"), salt.alias("salt"))
    group = ["label", "block", "cell", "tile", "dim", "salt"]
    full = members.unionAll(probes).unionAll(later).join(groups.select("rep", "copies", "raw"), "rep")
    met = C.cut(full.repartition(*group).sortWithinPartitions(*group, "probe").mapInArrow(_meet(cosine), "rep long, links long, other long"))
    counted = met.groupBy("rep").agg(F.sum("links").alias("links"))
    found = components(met.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    named = (groups.drop("raw").join(counted, "rep", "left").join(found, F.col("rep") == F.col("node"), "left")
             .select(F.col("label").alias("_label"), F.col("dim").alias("_dim"), F.col("print").alias("_print"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
             .where((F.col("links") > 0)))
    same = (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim")) & (F.col("print") == F.col("_print")) & F.col("vec_id").isNotNull()
    out = rows.drop("raw").join(named, same, "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op6(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)


SQL = """
WITH RECURSIVE ok AS (
  SELECT row_number() OVER () AS r, CAST(vec_id AS BIGINT) AS vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
good AS (SELECT r, vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM ok
         WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.r <> b.r
         WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.93),
reach AS (SELECT vec_id AS node, vec_id AS low FROM ok UNION SELECT link.a AS node, reach.low FROM reach JOIN link ON link.b = reach.node)
SELECT o.vec_id, coalesce(l.n, 0) AS n_links, c.low AS component_id, c.low = o.vec_id AS kept
FROM ok o JOIN (SELECT node, min(low) AS low FROM reach GROUP BY node) c ON c.node = o.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = o.vec_id
"""
