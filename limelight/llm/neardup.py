"""MinHash near-duplicate detection: a signature-coordinate inverted join.

1. Every whole text becomes its set of word shingles, a 128-bit fingerprint of
   the set and a MinHash signature of ``k`` coordinates. Equal sets collapse to one
   node (a map-side combined aggregate).
2. Nodes are posted under their (coordinate, value) pairs. Two signatures that
   agree in at least ``t`` coordinates share a pair among the first k - t + 1 of
   each in a common order, so only that prefix is posted, the rarest pairs first;
   pairs that only one node has fill prefix places and need no list. Texts like
   nothing else leave the join here.
3. Lists are merged in rounds. A round takes some members of each list as hubs (all of a
   short list) and meets them with the members of other components: agreeing
   coordinates are counted on the low byte of each (packed eight to a long; values that
   agree have equal bytes), and pairs with at least ``t`` are confirmed on the full
   sets and linked. Then the merge skips: a hub has met all that it could newly link
   to and leaves its list; members of one component are never met; a list of one
   component is done. After the first round, what is left of the long lists is posted
   anew under the rarest shingles of the full sets, among these members: texts as near
   as wanted share one in the first fifth of that order, and the places where they share
   it bound their overlap, so members that the bound parts are not met (texts that merely
   share a frequent line, and copies of one text that are each altered in other places).
   Where one component holds most of a list, hubs are its members,
   so a round costs hubs times the members outside it, which become few: a group of
   copies costs about a comparison a member, not one a pair. Hubs are the members
   that share most with others (of a group of copies, its original), and there are
   GROWTH times more of them each round. No link between components is lost on the
   way: of each pair that shares a list and is not joined yet, the first to
   leave met the other.
4. Links are contracted to components, named by their smallest doc_id.

``t`` is the largest threshold that a pair of exactly the wanted similarity
misses with probability below 2e-5.

Defined cases: lower case means A-Z; texts with fewer words than a shingle have
their whole sequence as the one shingle; null, empty and wordless texts have an
empty set and link with nothing; rows of one doc_id count as linked, whatever their
texts, and each of their sets links on its own; a null doc_id is its own
component (null) and kept; other columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limelight.llm import common as C
from limelight.llm.graph import components

K = 40
BROADCAST_IDS = 2_000_000
SHORT, GROWTH = 32, 32  # members of a list that is compared as a whole; factor of the number of hubs from round to round
MISS = 2e-5
_rng = np.random.Generator(np.random.PCG64(41))
MULTIPLY = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 2**63, 256, dtype=np.uint64)


def match_threshold(k: int, similarity: float, miss: float = MISS) -> int:
    """Largest t with P(Binomial(k, similarity) < t) <= miss."""
    total, t = 0.0, 0
    while True:
        total += comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if total > miss:
            return max(t, 1)
        t += 1


def shingle_sets(col: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, sorted within rows, and the n+1 bounds of the rows."""
    data, off = C.text_buffer(col)
    data = C.lower_ascii(data)
    start, end, row = C.words(data, off)
    h = C.word_hashes(data, start, end)
    sh, at = C.shingle_hashes(h, row, n)
    rows = row[at]
    bounds = C.row_bounds(row, len(col))
    count = np.diff(bounds)
    for size in range(1, n):  # whole sequences of short texts
        short = np.flatnonzero(count == size)
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for j in range(size):
                whole = whole * C.STEP + h[bounds[short] + j]
            sh, rows = np.concatenate([sh, C.mix(whole + np.uint64(size))]), np.concatenate([rows, short])
    order = np.lexsort((sh, rows))
    sh, rows = sh[order], rows[order]
    if len(sh):
        new = np.append(True, (sh[1:] != sh[:-1]) | (rows[1:] != rows[:-1]))
        sh, rows = sh[new], rows[new]
    return sh, C.row_bounds(rows, len(col))


def _longs(k: int) -> int:
    """How many longs hold a byte for each of k coordinates."""
    return -(-k // 8)


def _list_of(rows: np.ndarray) -> pa.ListArray:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, width * len(rows) + 1, width), pa.int32()), pa.array(rows.ravel()))


def _signatures(n: int, k: int):
    def run(batches):
        for p in C.pieces(batches):
            sh, at = shingle_sets(p.column("text"), n)
            size = np.diff(at)
            full = np.flatnonzero(size)
            heads = at[:-1][full]
            sig = np.zeros((p.num_rows, k), np.int32)
            prints = _prints(sh, at, p.num_rows)
            if len(full):
                for c in range(k):
                    least = np.minimum.reduceat(sh * MULTIPLY[c] + ADD[c], heads)
                    sig[full, c] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
            low = np.zeros((p.num_rows, _longs(k) * 8), np.uint8)
            low[:, :k] = sig.astype(np.uint8)
            yield pa.record_batch(
                [p.column("doc_id"), pa.array(size, pa.int64()), pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)),
                 _list_of(sig), _list_of(low.view(np.int64))],
                names=["doc_id", "n_shingles", "f1", "f2", "sig", "low"])

    return run


def _prints(sh: np.ndarray, at: np.ndarray, n_rows: int) -> np.ndarray:
    """128-bit fingerprint of each row's set, as two sums over its shingles."""
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((2, n_rows), np.uint64)
    if len(full):
        out[0, full] = np.add.reduceat(sh, at[:-1][full])
        out[1, full] = np.add.reduceat(C.mix(sh ^ C.BASE), at[:-1][full])
    return out


def _sets(n: int):
    def run(batches):
        for p in C.pieces(batches):
            sh, at = shingle_sets(p.column("text"), n)
            f = _prints(sh, at, p.num_rows)
            yield pa.record_batch([p.column("doc_id"), pa.array(f[0].view(np.int64)), pa.array(f[1].view(np.int64)),
                                   pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sh.view(np.int64)))],
                                  names=["_id", "_f1", "_f2", "shingles"])

    return run


def _postings(nodes: DataFrame, k: int, t: int) -> DataFrame:
    """(list, node, n, w): the prefix of every signature, without values that only one has; w: how much a node shares."""
    token = nodes.select("node", "n_shingles", F.posexplode("sig").alias("c", "v")).select(
        "node", "n_shingles", F.shiftleft(F.col("c").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(0xFFFFFFFF)).alias("list"))
    often = token.groupBy("list").agg(F.count("*").alias("f")).where("f > 1")
    shared = token.join(often, "list").groupBy("node", "n_shingles").agg(
        F.sort_array(F.collect_list(F.struct("f", "list"))).alias("s"), F.sum("f").alias("w"))  # at most k a row
    room = F.lit(1 - t) + F.size("s")  # places left by the k - size(s) values that are nobody else's and come first
    return (shared.where(room > 0).select("node", F.col("n_shingles").alias("n"), "w", F.explode(F.slice("s", F.lit(1), room)).alias("x"))
            .select("x.list", "node", "n", "w", F.col("n").alias("most")))


def _differing(x, y):
    """How many of the eight bytes of two longs differ."""
    bits = x.bitwiseXOR(y)
    for step in (4, 2, 1):  # every byte's bits are gathered in its lowest
        bits = bits.bitwiseOR(F.shiftrightunsigned(bits, step))
    return F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101)))


def _agreeing(pairs: DataFrame, nodes: DataFrame, k: int, t: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in the low byte of at least ``t`` coordinates."""
    longs = range(_longs(k))
    left = nodes.select(F.col("node").alias("a"), *[F.col("low")[c].alias(f"x{c}") for c in longs])
    right = nodes.select(F.col("node").alias("b"), *[F.col("low")[c].alias(f"y{c}") for c in longs])
    differing = sum((_differing(F.col(f"x{c}"), F.col(f"y{c}")) for c in longs), F.lit(0))
    return pairs.join(left, "a").join(right, "b").where(k - differing >= t).select("a", "b")


def _sets_of(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, n: int, small: bool) -> DataFrame:
    """(node, shingles) of the nodes in ``pairs``, from the text of the document that each is named by."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = ids.join(nodes.select("node", "rep", "f1", "f2"), "node")
    held = F.broadcast(wanted) if small else wanted
    found = texts.join(held.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi").mapInArrow(
        _sets(n), "_id long, _f1 long, _f2 long, shingles array<bigint>")
    mine = (F.col("_id") == F.col("rep")) & (F.col("_f1") == F.col("f1")) & (F.col("_f2") == F.col("f2"))
    return found.join(held, mine).select("node", "shingles").dropDuplicates(["node"])


def _confirm(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, n: int, percent: int, small: bool) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    sets = _sets_of(texts, nodes, pairs, n, small)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b"))


def _with_part(df: DataFrame, parts: DataFrame) -> DataFrame:
    """Adds ``part``, the component of ``node`` (itself where it has no link yet)."""
    part = parts.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    return (df.join(part, F.col("node") == F.col("_node"), "left")
            .withColumn("part", F.coalesce("_component", "node")).drop("_node", "_component"))


def _sizes(lists: DataFrame) -> DataFrame:
    """Per list of several components: its size, its largest component, and whether that has most members."""
    return (lists.groupBy("list", "part").agg(F.count("*").alias("m"), F.max("w").alias("w"))
            .groupBy("list").agg(F.sum("m").alias("size"), F.count("*").alias("parts"), F.max(F.struct("m", "w", "part")).alias("top"))
            .where("parts > 1").select(F.col("list").alias("_list"), "size", F.col("top.part").alias("core"), (2 * F.col("top.m") > F.col("size")).alias("held")))


def _with_hubs(lists: DataFrame, sizes: DataFrame, hubs_a_list: int) -> DataFrame:
    """The members of lists of several components, with ``hub``: is it a hub of this round?"""
    alive = lists.join(sizes, F.col("list") == F.col("_list")).drop("_list")
    slot = F.pmod(F.xxhash64("node"), F.lit(hubs_a_list))
    best = (alive.where((F.col("size") > SHORT) & (~F.col("held") | (F.col("part") == F.col("core"))))
            .groupBy(F.col("list").alias("_list"), slot.alias("_slot")).agg(F.max(F.struct("w", (-F.col("node")).alias("node"))).alias("x"))
            .select("_list", (-F.col("x.node")).alias("_node")))
    return (alive.join(best, (F.col("list") == F.col("_list")) & (F.col("node") == F.col("_node")), "left")
            .select("list", "node", "n", "w", "most", "part", ((F.col("size") <= SHORT) | F.col("_node").isNotNull()).alias("hub")))


def _rare(crowd: DataFrame, texts: DataFrame, nodes: DataFrame, n: int, percent: int, rounds: C.Rounds) -> DataFrame:
    """The lists (list, node, n, w, most, part) of the nodes of ``crowd`` by the rarest shingles of their full sets.

    Shingles stand in one order, rarest among these nodes first. If the first one that two sets share has
    ``most`` shingles from there on in each, they share no more than the smaller ``most``; places where that
    cannot reach the similarity are left out. Shingles that one node alone has fill places and need no list."""
    ids = rounds.cut(crowd.groupBy("node").agg(F.max("w").alias("w"), F.first("part").alias("part")))
    sets = _sets_of(texts, nodes, ids.select(F.col("node").alias("a"), F.col("node").alias("b")), n, ids.count() <= BROADCAST_IDS)
    each = rounds.cut(sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")))
    often = each.groupBy(F.col("shingle").alias("_shingle")).agg(F.count("*").alias("f")).where("f > 1")
    shared = (each.join(often, F.col("shingle") == F.col("_shingle")).groupBy("node", "n")
              .agg(F.sort_array(F.collect_list(F.struct("f", "shingle"))).alias("s")))  # at most the set of one text
    held = F.size("s")  # the n - held shingles of its own come first
    room = F.floor(F.col("n") - F.lit(percent) * F.col("n") / 100).cast("int") + 1 - (F.col("n") - held)
    placed = shared.where(room > 0).select("node", F.col("n").cast("long").alias("n"), held.alias("held"), F.posexplode(F.slice("s", F.lit(1), room)).alias("place", "x"))
    return (placed.select("node", "n", F.col("x.shingle").alias("list"), (F.col("held") - F.col("place")).cast("long").alias("most"))
            .where(100 * F.col("most") >= percent * F.col("n")).join(ids, "node").select("list", "node", "n", "w", "most", "part"))


def _refined(named: DataFrame, sizes: DataFrame, texts: DataFrame, nodes: DataFrame, n: int, percent: int, rounds: C.Rounds) -> DataFrame:
    """The short lists as they are; the members of long ones under their rarest shingles instead."""
    long_ = sizes.where(F.col("size") > SHORT).select(F.col("_list").alias("_long"))
    marked = rounds.cut(named.join(long_, F.col("list") == F.col("_long"), "left"))
    short, crowd = marked.where("_long is null").drop("_long"), marked.where("_long is not null")
    if crowd.isEmpty():
        return short
    return rounds.cut(short.unionByName(_rare(crowd, texts, nodes, n, percent, rounds)))


def links(texts: DataFrame, nodes: DataFrame, n: int, percent: int, k: int) -> DataFrame:
    """(node, component) of all nodes that have a link."""
    t = match_threshold(k, percent / 100)
    parts = texts.sparkSession.createDataFrame([], "node long, component long")
    lists, hubs_a_list = _postings(nodes, k, t), 1
    rounds = C.Rounds(texts.sparkSession)
    while True:
        named = rounds.cut(_with_part(lists, parts))
        rounds.keep(named, parts)  # the round before has been read
        sizes = rounds.cut(_sizes(named))  # written: so the join with it can split a list that very many nodes are in
        if sizes.isEmpty():
            return parts
        if hubs_a_list == GROWTH:  # once, when the first hubs have met their lists
            named = _refined(named, sizes, texts, nodes, n, percent, rounds)
            sizes = rounds.cut(_sizes(named))
        now = rounds.cut(_with_hubs(named, sizes, hubs_a_list))
        hub = now.where("hub").select(F.col("list").alias("_list"), F.col("node").alias("b"), F.col("part").alias("pb"), F.col("n").alias("nb"), F.col("most").alias("mb"))
        overlap = F.least("most", "mb")
        near = 100 * overlap >= percent * (F.col("n") + F.col("nb") - overlap)
        met = now.join(hub, F.col("list") == F.col("_list")).where((F.col("part") != F.col("pb")) & near)
        pairs = met.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
        close = rounds.cut(_agreeing(pairs, nodes, k, t))
        found = close.count()
        if found:
            linked = rounds.cut(_confirm(close, texts, nodes, n, percent, 2 * found <= BROADCAST_IDS))
            if not linked.isEmpty():
                parts = rounds.cut(components(linked.unionAll(parts.select(F.col("node").alias("a"), F.col("component").alias("b")))))
        lists, hubs_a_list = now.where("not hub").select("list", "node", "n", "w", "most"), hubs_a_list * GROWTH


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept."""
    texts = docs.select(C.long_ids(), "text")
    rows = C.cut(texts.mapInArrow(_signatures(n, k), "doc_id long, n_shingles long, f1 long, f2 long, sig array<int>, low array<bigint>"))
    real = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    print_ = ["n_shingles", "f1", "f2"]
    nodes = C.cut(real.groupBy(*print_).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig"), F.first("low").alias("low"))
                  .withColumn("node", F.monotonically_increasing_id()))
    parts = links(texts, nodes, n, percent, k)
    again = real.groupBy("doc_id").agg(F.count("*").alias("times")).where("times > 1").select("doc_id")  # ids given twice
    owners = (real.join(again, "doc_id", "left_semi").join(nodes.select(*print_, "node"), print_).select("doc_id", "node").distinct())
    first = owners.groupBy("doc_id").agg(F.min("node").alias("b"))
    several = C.cut(owners.join(first, "doc_id").where(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b"))
    if not several.isEmpty():
        parts = C.cut(components(several.unionAll(parts.select(F.col("node").alias("a"), F.col("component").alias("b")))))
    part = _with_part(nodes.select("node", "rep", "copies", *print_), parts)
    name = part.groupBy(F.col("part").alias("_part")).agg(F.min("rep").alias("component"))
    named = (part.join(name, F.col("part") == F.col("_part")).where((F.col("copies") > 1) | (F.col("component") != F.col("rep")))
             .select(*[F.col(c).alias(f"_{c}") for c in print_], "component"))
    same = (F.col("n_shingles") == F.col("_n_shingles")) & (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")) & F.col("doc_id").isNotNull()
    out = rows.drop("sig", "low").join(named, same, "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-duplicates of a smaller doc_id; columns unchanged.

    Of several rows of one doc_id (one group by definition) the first by hash and text stays.
    Rows of null id link with nothing and all stay."""
    found = C.cut(near_duplicates(docs, n, percent).select(F.col("doc_id").alias("_id"), "kept").where("_id is not null"))
    drop = found.where("not kept").select(F.col("_id").alias("_drop")).distinct()
    again = found.groupBy(F.col("_id").alias("_again")).agg(F.count("*").alias("n")).where("n > 1").select("_again")
    own = F.col("doc_id").cast("long")
    left = docs.withColumn("_own", own).join(drop, F.col("_own") == F.col("_drop"), "left_anti")
    order = Window.partitionBy("_own").orderBy(F.xxhash64("text"), "text")
    repeated = left.join(again, F.col("_own") == F.col("_again"), "left_semi").withColumn("_place", F.row_number().over(order))
    once = left.join(again, F.col("_own") == F.col("_again"), "left_anti")
    return once.unionAll(repeated.where("_place = 1").drop("_place")).drop("_own")


def op1(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, n=2, percent=80)
