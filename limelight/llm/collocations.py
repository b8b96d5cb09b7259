"""Phrase collocations by Toivonen's mining: a sample proposes, full passes count and close the border.

1. A sample of the documents (a fixed share, chosen by a hash of the text) proposes
   words and phrases shorter than the longest, by a lowered threshold.
2. A full pass counts, exactly and over all documents, every word and every phrase whose
   two next shorter parts are proposed: the proposals themselves and their negative
   border. Other phrases cannot be frequent, unless a counted one shows that the
   proposals lack a part.
3. Frequent phrases that were not proposed are border failures. They are added to the
   proposals, and a further pass counts the phrases this newly admits (and only
   these); passes go on until none fails. A phrase is as rare as its rarest part, so
   the result is all frequent phrases with exact counts, whatever the sample held.

Proposals are kept as a Bloom filter of bounded size (at most MOST_BITS, 16 MB), which is
all that is sent to the tasks. It has no false negatives; a false positive only makes a pass
count some phrases more, so results do not depend on its size. Whether a phrase is
admitted by a pass depends on the phrase alone, so it is counted in one pass, wholly.

Counting inside a task works on word numbers of a block of text (an exact dictionary,
no hashes); blocks emit each distinct phrase once, and counts are added before and
after the shuffle. So a phrase with any number of occurrences is one row a block.

Defined cases: lower case means A-Z; texts are cut into pieces at .,;:!? and line breaks,
pieces into words at blanks and tabs; null text: none; null lang: ``und``; all counts are
per language; repeated rows count each; ties by phrase in UTF-8 byte order; an empty
table gives no rows; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limelight.llm import common as C

BLOCK_BYTES = 2_000_000
LEAST_BITS, MOST_BITS, BITS_EACH = 2**20, 2**27, 16
PROBES = 2
CUT = np.zeros(256, bool)
CUT[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
GAP = CUT.copy()
GAP[[9, 32]] = True
BLANK = np.zeros(256, bool)
BLANK[32] = True


class Filter:
    """A Bloom filter over 64-bit hashes: ``bits`` bits, PROBES of them for each hash."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def probes(self, h: np.ndarray):
        for _ in range(PROBES):
            yield h & self.mask
            h = C.mix(h + C.STEP)

    def holds(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in self.probes(h):
            out &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))).astype(np.uint8) & 1 == 1
        return out


class Sent:
    """A filter whose bits a task reads from a broadcast."""

    def __init__(self, words):
        self.words = words

    def holds(self, h: np.ndarray) -> np.ndarray:
        return Filter(self.words.value).holds(h)


def chain(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Hash of a phrase one word longer, from the phrase's hash and the hash of that word."""
    return C.mix(h * C.STEP + more)


def blocks(batches, size: int = BLOCK_BYTES):
    """Batches joined or cut to about ``size`` bytes of text (or one longer text)."""
    held, total = [], 0
    for b in batches:
        for p in C.pieces([b]):
            held.append(p)
            total += pc.sum(pc.binary_length(p.column("text"))).as_py() or 0
            if total >= size:
                yield pa.Table.from_batches(held).combine_chunks()
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Block:
    """The words of a block of documents: numbers from an exact dictionary, hashes, and where they stand."""

    def __init__(self, lang: pa.ChunkedArray, text: pa.ChunkedArray):
        data, off = C.text_buffer(text.combine_chunks())
        data = C.lower_ascii(data)
        start, end, row = C.words(data, off, GAP)
        size = end - start
        flat = data[~GAP[data]]
        ends = np.append(0, np.cumsum(size)).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
        coded = column.dictionary_encode()
        self.vocabulary = coded.dictionary
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        langs = pc.fill_null(lang.combine_chunks().cast(pa.string()), "und").dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
        cuts = np.cumsum(CUT[data])
        self.piece = np.stack([row, cuts[start] if len(start) else start])
        word_hash, lang_hash = hashes(self.vocabulary), hashes(self.langs)
        self.h = chain(lang_hash[self.lang], word_hash[self.word]) if len(start) else np.zeros(0, np.uint64)
        self.next = word_hash[self.word] if len(start) else self.h

    def together(self, n: int) -> np.ndarray:
        """For each word but the last n - 1: is it, with the n - 1 that follow, in one piece?"""
        last = len(self.word) - n + 1
        return (self.piece[:, :last] == self.piece[:, n - 1:]).all(0) if last > 0 else np.zeros(0, bool)


def hashes(values: pa.Array) -> np.ndarray:
    data, off = C.text_buffer(values.cast(pa.large_binary()))
    return C.word_hashes(data, off[:-1], off[1:])


COUNTED = "lang string, size int, phrase binary, f long"


def _count(longest: int, new: Filter | Sent | None, old: Filter | Sent | None):
    """Counts of the phrases that ``new`` (None: any) admits and ``old`` (None: no filter yet) does not.

    Without ``old`` all words are counted; size 0 with an empty phrase is their number."""

    def held(f, h: np.ndarray, without: bool) -> np.ndarray:
        return np.full(len(h), without) if f is None else f.holds(h)

    def phrases(b: Block):
        code = b.lang * len(b.vocabulary) + b.word
        if old is None:
            yield 0, b.lang, np.arange(len(code))
            yield 1, code, np.arange(len(code))
        h, prefix = b.h, code
        inside = [held(f, h, k == 0) for k, f in enumerate((new, old))]
        for n in range(2, longest + 1):
            live = b.together(n)
            last = len(live)
            if not last:
                return
            now, before = (x[:last] & x[1:last + 1] for x in inside)
            fresh = np.flatnonzero(live & now & ~before)
            where = fresh if n == longest else np.arange(last)
            number = prefix[where] if n == 2 else np.unique(prefix[where], return_inverse=True)[1]  # small numbers again: no overflow
            prefix = number * len(b.vocabulary) + b.word[where + n - 1]
            yield n, prefix if n == longest else prefix[fresh], fresh
            if n < longest:
                h = chain(h[:last], b.next[n - 1:])
                inside = [held(f, h, k == 0) & live for k, f in enumerate((new, old))]

    def emit(b: Block, n: int, code: np.ndarray, at: np.ndarray):
        _, first, count = np.unique(code, return_index=True, return_counts=True)
        at = at[first]
        if not len(at):
            return None
        words = [b.vocabulary.take(pa.array(b.word[at + j])) for j in range(n)]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if n else pa.array([b""] * len(at), pa.large_binary())
        return pa.record_batch([b.langs.take(pa.array(b.lang[at])), pa.array(np.full(len(at), n, np.int32)), phrase.cast(pa.binary()),
                                pa.array(count.astype(np.int64))], names=["lang", "size", "phrase", "f"])

    def run(batches):
        for t in blocks(batches):
            b = Block(t.column("lang"), t.column("text"))
            for n, code, at in phrases(b):
                out = emit(b, n, code, at)
                for lo in range(0, out.num_rows if out else 0, 50_000):
                    yield out.slice(lo, 50_000)

    return run


def _added(texts: DataFrame, run) -> DataFrame:
    return texts.mapInArrow(run, COUNTED).groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def _hashed(longest: int, known: Filter | None):
    """Slots and masks in the filter of phrases shorter than the longest that it does not hold yet."""

    def run(batches):
        for b in batches:
            phrases = b.column("phrase").cast(pa.large_binary())
            data, off = C.text_buffer(phrases)
            start, end, row = C.words(data, off, BLANK)
            w, lang = C.word_hashes(data, start, end), hashes(b.column("lang").cast(pa.string()))
            heads, size = np.searchsorted(row, np.arange(b.num_rows)), np.bincount(row, minlength=b.num_rows)
            h = lang
            for j in range(longest - 1):
                here = np.flatnonzero(size > j)
                h[here] = chain(h[here], w[heads[here] + j])
            h = h[(size >= 1) & (size < longest)]
            h = h[~known.holds(h)]
            for p in known.probes(h):
                yield pa.record_batch([pa.array((p >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))],
                                      names=["slot", "mask"])

    return run


def _grow(known: Filter, proposed: DataFrame, longest: int) -> Filter:
    """The filter with the phrases of ``proposed`` too. At most one row for each 64 bits of the filter comes to the driver."""
    slots = proposed.select("lang", "phrase").mapInArrow(_hashed(longest, known), "slot long, mask long")
    got = slots.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    if not got.num_rows:
        return known
    words = known.words.copy()
    words[got.column("slot").to_numpy()] |= got.column("mask").to_numpy().view(np.uint64)
    return Filter(words)


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 8, lowered: int = 2,
                     filter_bits: int | None = None) -> tuple[DataFrame, int]:
    """(lang, size, phrase, f) of all phrases of up to ``longest`` words with f >= ``least``, and the number of full passes.

    Size 0 has the number of words of the language. One document in ``share`` makes the
    sample, in which ``lowered`` occurrences propose a phrase; both only decide how many
    phrases and passes are needed. The filter has ``filter_bits`` bits, a power of two; where
    that is unset, BITS_EACH for each proposal, within LEAST_BITS and MOST_BITS."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    if longest > 1:
        proposed = C.cut(_added(sample, _count(longest - 1, None, None)).where((F.col("f") >= lowered) & (F.col("size") > 0)))
        bits = filter_bits or min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * proposed.count()).bit_length()))
        new, old = _grow(Filter(np.zeros(max(1, bits // 64), np.uint64)), proposed, longest), None
    else:
        new, old = Filter(np.zeros(1, np.uint64)), None
    found, passes = None, 0
    while True:
        sent = [None if f is None else Sent(spark.sparkContext.broadcast(f.words)) for f in (new, old)]
        counted = C.cut(_added(texts, _count(longest, *sent)).where((F.col("f") >= least) | (F.col("size") == 0)))
        found, passes = counted if found is None else found.unionAll(counted), passes + 1
        grown = _grow(new, counted.where((F.col("size") > 0) & (F.col("size") < longest)), longest) if longest > 1 else new
        if grown is new:
            return found, passes
        new, old = grown, new


def _decimal(name: str):
    return F.col(name).cast("decimal(15,0)")  # counts below 10**15: every product below fits 38 digits


def collocations(frequent: DataFrame, longest: int = 3, cover: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases of two words or more, scored by their worst cut.

    A phrase whose words stand in a longer frequent one with at least ``cover`` percent of
    its count is dropped. Only the next longer ones are looked at: what a longer one
    covers, the phrase between the two covers too."""
    phrases = frequent.where("size > 0").withColumn("w", F.split(F.col("phrase").cast("string"), " ", -1))

    def part(first, length):
        return F.array_join(F.slice("w", first, length), " ").cast("binary")

    size = F.col("size")
    longer = (phrases.where(size > 2).select("lang", "f", F.explode(F.array(part(F.lit(1), size - 1), part(F.lit(2), size - 1))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    left = (phrases.where(size > 1).join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.lit(100) * _decimal("longer") < F.lit(cover) * _decimal("f"))))
    k = F.col("k")
    sides = F.array(F.struct(F.lit(True).alias("head"), part(F.lit(1), k).alias("part")),
                    F.struct(F.lit(False).alias("head"), part(k + 1, size - k).alias("part")))
    cuts = (left.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
            .select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(sides).alias("s")))
    counts = phrases.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias("_f"))
    parts = cuts.join(counts, (F.col("lang") == F.col("_lang")) & (F.col("s.part") == F.col("_part")))
    both = parts.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("s.head"), F.col("_f"))).alias("l"), F.max(F.when(~F.col("s.head"), F.col("_f"))).alias("r"))
    square = F.lit(1_000_000).cast("decimal(7,0)") * (_decimal("a") * _decimal("a"))
    scored = both.withColumn("num", square).withColumn("den", _decimal("l") * _decimal("r")).withColumn("score", F.expr("num div den"))
    return (scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
            .select("lang", "phrase", "a", "x.l", "x.r", "x.score"))


def best(found: DataFrame, top: int, salts: int = 64) -> DataFrame:
    """The first ``top`` of each language with their rank; shares of a language are cut to ``top`` first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
    cut = found.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top).drop("rank")
    return cut.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def op13(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, **kw) -> DataFrame:
    frequent, _ = frequent_phrases(docs, longest, least, **kw)
    total = frequent.where("size = 0").select("lang", F.col("f").alias("n"))
    return best(collocations(frequent, longest), top).join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
runs AS (SELECT lang, row_number() OVER () AS run, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, run, generate_subscripts(w, 1) AS i, unnest(w) AS w1 FROM runs),
ahead AS (SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY run ORDER BY i)),
f1 AS (SELECT lang, w1 AS p, count(*) AS f FROM ahead GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
longer AS (SELECT lang, w1, w2, max(f) AS longer FROM (
  SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
two AS (SELECT f2.* FROM f2 LEFT JOIN longer USING (lang, w1, w2) WHERE longer IS NULL OR 100 * longer < 50 * f),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM two c JOIN f1 l ON l.lang = c.lang AND l.p = c.w1 JOIN f1 r ON r.lang = c.lang AND r.p = c.w2
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, l.f, r.f
  FROM f3 c JOIN f1 l ON l.lang = c.lang AND l.p = c.w1 JOIN f2 r ON r.lang = c.lang AND r.w1 = c.w2 AND r.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, l.f, r.f
  FROM f3 c JOIN f2 l ON l.lang = c.lang AND l.w1 = c.w1 AND l.w2 = c.w2 JOIN f1 r ON r.lang = c.lang AND r.p = c.w3),
ranked AS (
  SELECT lang, phrase, a, l, r, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY (1000000::HUGEINT * a * a) // (l::HUGEINT * r), k) = 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM numbered JOIN n USING (lang) WHERE rank <= 2000
"""
