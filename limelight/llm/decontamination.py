"""Benchmark decontamination: a prefix-filtered containment join, DataFrame functions only.

A window (``size`` consecutive words of an item, or a whole shorter item) is
contained in a document when all its words stand there in order. Containment
must be total, so the necessary prefix of a window, its words ordered by rarity
in the corpus, is its rarest word alone. Document words are joined with those
words; a hit at place p for a word at place k of a window of n words must
satisfy 0 <= p - k (positional bound) and p - k + n <= words of the document
(length bound), and then the n words there are compared exactly.

The windows are broadcast in blocks of at most ``block`` rows, however many the
benchmark has; documents are only scanned, never shuffled by word.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
Splitting goes by the same classes with A-Z among the word characters, which
gives the same words before lower-casing.

Defined cases: null and empty texts have no words; null or wordless items have
no windows; items with equal windows all count; repeated documents (rows of
one doc_id) are one document whose counts come from every row; a null doc_id is
one document; empty tables give no rows or no hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C

# The word pattern, and the letters that are lower-cased.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text):
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _lower(text):
    return F.translate(text, UPPER, LOWER)


def windows(items: DataFrame, size: int) -> DataFrame:
    """win (words), items (ids as strings), one row per distinct window."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), _words(_lower(F.col("text"))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return (rows.select("item_id", "w", F.explode(starts).alias("at"))
            .select(F.slice("w", F.col("at"), size).alias("win"), "item_id")
            .distinct())


def _by_word(wins: DataFrame) -> DataFrame:
    return wins.select("win", F.posexplode("win").alias("k", "word"))


def rarest_words(wins: DataFrame, docs: DataFrame, block: int) -> DataFrame:
    """win, its rarest word in the corpus (ties: the smaller word), and the word's first place k in it."""
    vocabulary = C.cut(_by_word(wins).select("word").distinct())
    parts = max(1, -(-vocabulary.count() // block))
    spread = vocabulary.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)))
    counts = None
    for part in range(parts):
        some = F.broadcast(spread.where(F.col("part") == part).select("word"))  # about ``block`` rows
        seen = (docs.select(F.explode(_words(F.col("text"))).alias("raw")).select(_lower("raw").alias("word"))
                .join(some, "word").groupBy("word").agg(F.count("*").alias("n")))
        counts = seen if counts is None else counts.unionAll(seen)
    # one row per word of the benchmark: at most ``block`` rows if there is one part
    ranked = _by_word(wins.select("win").distinct()).join(F.broadcast(counts) if parts == 1 else counts, "word", "left").fillna(0, ["n"])
    best = ranked.groupBy("win").agg(F.min(F.struct("n", "word", "k")).alias("best"))
    return best.where("best.n > 0").select("win", "best.word", "best.k")  # a word that never occurs rules its windows out


def occurrences(docs: DataFrame, prefix: DataFrame, block: int) -> DataFrame:
    """doc_id, copy, win, start (0-based) of every exact occurrence of a window."""
    prefix = C.cut(prefix)
    parts = max(1, -(-prefix.count() // block))
    spread = prefix.withColumn("part", F.pmod(F.xxhash64("win"), F.lit(parts)))
    found = None
    for part in range(parts):
        some = F.broadcast(spread.where(F.col("part") == part).select(F.col("word").alias("_word"), "win", "k"))  # about ``block`` rows
        hits = (docs.select("doc_id", "copy", _words(F.col("text")).alias("w"))
                .select("doc_id", "copy", "w", F.posexplode("w").alias("p", "raw"))
                .join(some, _lower("raw") == F.col("_word"))
                .withColumn("start", F.col("p") - F.col("k"))
                .where((F.col("start") >= 0) & (F.col("start") + F.size("win") <= F.size("w")))
                .where(F.expr("translate(array_join(slice(w, start + 1, size(win)), ' '), "
                              f"'{UPPER}', '{LOWER}') = array_join(win, ' ')"))
                .select("doc_id", "copy", "win", "start"))
        found = hits if found is None else found.unionAll(hits)
    return found


def contaminated(docs: DataFrame, items: DataFrame, size: int = 10, block: int = 50_000) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = docs.select(C.long_ids(), F.monotonically_increasing_id().alias("copy"), "text")
    wins = C.cut(windows(items, size))
    found = C.cut(occurrences(rows, rarest_words(wins, rows, block), block))
    covered = (found.select("doc_id", "copy", "start", F.size("win").alias("n")).distinct()
               .select("doc_id", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("place"), "copy")
               .distinct().groupBy("doc_id").agg(F.count("*").alias("n_hit")))
    # windows of one item are many; ids go through distinct before any list is made
    named = (found.select("doc_id", "win").distinct().join(wins, "win").select("doc_id", "item_id").distinct()
             .groupBy("doc_id").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("ids")))
    base = rows.groupBy("doc_id").agg(F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))).cast("long").alias("n_words"))
    hit = covered.join(named, covered.doc_id.eqNullSafe(named.doc_id)).select(covered.doc_id.alias("_doc"), "n_hit", "n_items", "ids")
    return (base.join(hit, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10, block: int = 50_000) -> DataFrame:
    """The rows of ``docs`` without the documents that hold a benchmark window; columns unchanged."""
    rows = docs.select(C.long_ids(), F.monotonically_increasing_id().alias("copy"), "text")
    found = C.cut(occurrences(rows, rarest_words(windows(items, size), rows, block), block).select(F.col("doc_id").alias("_doc")).distinct())
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["_doc"]), "left_anti")


op9 = contaminated

SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
       FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM d, (SELECT DISTINCT n FROM bw) AS sizes, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS t(s)),
hit AS (SELECT DISTINCT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places p USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
