"""Secret scan with inferred credential grammars.

1. Three base patterns (assign, access, hex) label credentials in every whole
   text; candidates (long tokens with letters and digits) are collected beside
   them.
2. From a bounded sample of the labelled credentials of each kind a prefix tree
   over character classes is built, and statistically compatible states are
   merged (Hoeffding test on final and transition frequencies, red-blue order)
   into a probabilistic automaton.
3. Every candidate is scored by its log-likelihood per symbol under each
   automaton; those as likely as the credentials of the sample become further
   spans of kind ``format``.

Defined cases: null and empty texts have no spans; repeated rows are scanned
each; without labelled credentials there are no automata and only base spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "format"]

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True
_TOKEN_BYTE = np.zeros(256, bool)
_TOKEN_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of every base match; code points, end exclusive."""
    out = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """Tokens that may be credentials: 20+ characters with a letter and two digits."""
    return [("format", m.start(), m.end(), m[0]) for m in CANDIDATE.finditer(text)
            if sum(c.isdigit() for c in m[0]) >= 2 and re.search("[A-Za-z]", m[0])]


def _suspects(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows in which any pattern could match: a byte test with no false negatives."""
    hit, digits = np.zeros((2, len(off) - 1), bool)
    at = lambda pos: np.searchsorted(off, pos, "right") - 1
    hit[at(np.flatnonzero((data == ord(":")) | (data == ord("="))))] = True
    hit[at(np.flatnonzero((data[:-1] == ord("K")) & (data[1:] == ord("I"))))] = True
    start, end, row = C.words(data, off, ~_HEX_BYTE)
    hit[row[end - start >= LEAST["hex"]]] = True
    digits[at(np.flatnonzero((data >= 48) & (data <= 57)))] = True
    start, end, row = C.words(data, off, ~_TOKEN_BYTE)
    row = row[end - start >= 20]
    hit[row[digits[row]]] = True
    return hit


def _scan(batches: Iterator[pa.RecordBatch], also: list[str]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
    for p in C.pieces(batches):
        col = p.column("text")
        data, off = C.text_buffer(col)
        base, more = [[]] * p.num_rows, [[]] * p.num_rows
        for i in np.flatnonzero(_suspects(data, off)):
            text = col[int(i)].as_py()
            if text:
                base[i] = [dict(zip(("kind", "start", "end", "value"), s)) for s in base_spans(text)]
                more[i] = [dict(zip(("kind", "start", "end", "value"), s)) for s in candidates(text)]
        yield pa.record_batch([p.column(a) for a in also] + [pa.array(base, kind), pa.array(more, kind)], names=[*also, "base", "more"])


SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and candidate spans of every row."""
    return docs.select(C.long_ids(), "text").mapInArrow(
        lambda b: _scan(b, ["doc_id"]), f"doc_id long, base {SPANS}, more {SPANS}")


# --- grammar inference -------------------------------------------------------------


def symbols(value: str) -> str:
    """Character classes: a-f, g-z, A-F, G-Z, digit; other characters stand for themselves."""
    return "".join("0" if c.isdigit() else ("a" if c <= "f" else "g") if "a" <= c <= "z"
                   else ("A" if c <= "F" else "G") if "A" <= c <= "Z" else c for c in value)


class Automaton:
    """A probabilistic automaton: per state how often it was reached, ended in, and left by each symbol."""

    def __init__(self, strings: list[str], alpha: float = 0.05, weight: int = 10):
        self.reach, self.ends, self.next, self.uses = [0], [0], [{}], [{}]
        for s in strings:
            at = 0
            self.reach[0] += 1
            for c in s:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.reach)
                    self.reach.append(0)
                    self.ends.append(0)
                    self.next.append({})
                    self.uses.append({})
                self.uses[at][c] = self.uses[at].get(c, 0) + 1
                at = self.next[at][c]
                self.reach[at] += 1
            self.ends[at] += 1
        self.log_alpha = math.log(2 / alpha)
        self._merge(weight)
        self.kinds = sorted({c for s in strings for c in s})

    def _differ(self, f1, n1, f2, n2) -> bool:
        bound = math.sqrt(0.5 * self.log_alpha) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
        return abs(f1 / n1 - f2 / n2) > bound

    def _compatible(self, red: int, blue: int) -> bool:
        todo = [(red, blue)]
        while todo:
            a, b = todo.pop()
            n1, n2 = self.reach[a], self.reach[b]
            if not n1 or not n2:
                continue
            if self._differ(self.ends[a], n1, self.ends[b], n2):
                return False
            for c in self.uses[a].keys() | self.uses[b].keys():
                if self._differ(self.uses[a].get(c, 0), n1, self.uses[b].get(c, 0), n2):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, red: int, blue: int) -> None:
        """Add the tree below ``blue`` to ``red``; a blue state is still the root of a tree."""
        todo = [(red, blue)]
        while todo:
            a, b = todo.pop()
            self.reach[a] += self.reach[b]
            self.ends[a] += self.ends[b]
            for c, n in self.uses[b].items():
                self.uses[a][c] = self.uses[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge(self, weight: int) -> None:
        """States reached fewer than ``weight`` times carry no evidence and join the first compatible red state."""
        red = [0]
        while True:
            done = set(red)
            blue = [(-self.reach[t], q, c) for q in red for c, t in self.next[q].items() if t not in done]
            if not blue:
                break
            _, q, c = min(blue)
            b = self.next[q][c]
            target = next((r for r in red if self._compatible(r, b)), None)
            if target is None and self.reach[b] < weight:
                target = red[-1]
            if target is None:
                red.append(b)
            else:
                self.next[q][c] = target
                self._fold(target, b)
        self.states = red

    def log_likelihood(self, s: str) -> float:
        """Mean natural log-probability per symbol (and the end), with add-one-half smoothing."""
        if not self.reach[0]:
            return -math.inf
        at, total, size = 0, 0.0, len(self.kinds) + 2
        for c in s:
            n = self.reach[at]
            total += math.log((self.uses[at].get(c, 0) + 0.5) / (n + 0.5 * size))
            at = self.next[at].get(c, at)
        total += math.log((self.ends[at] + 0.5) / (self.reach[at] + 0.5 * size))
        return total / (len(s) + 1)


def infer(labelled: DataFrame, max_strings: int = 400, tail: float = 0.02, slack: float = 0.25) -> dict[str, tuple[Automaton, float]]:
    """Automaton and acceptance level of each kind, from at most ``max_strings`` distinct credentials a kind.

    The level is the ``tail`` quantile of the sample's own scores less ``slack``.
    """
    found = {}
    distinct = C.cut(labelled.select("kind", "value").where(F.length("value") >= 16).distinct())
    for kind in ("assign", "access", "hex"):
        rows = (distinct.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(max_strings).collect())
        strings = [symbols(r["value"]) for r in rows]
        if len(strings) >= 5:
            machine = Automaton(strings)
            found[kind] = (machine, float(np.quantile([machine.log_likelihood(s) for s in strings], tail)) - slack)
    return found


def shaped_like(value: str, grammars: dict[str, tuple[Automaton, float]]) -> bool:
    """Whether a candidate, as written or in lower case, is as likely as the credentials of some kind."""
    forms = {symbols(value), symbols(value.lower())}
    return any(m.log_likelihood(s) >= level for m, level in grammars.values() for s in forms)


def _spans(base: list, more: list, grammars) -> tuple[str, str, list[int]]:
    said = lambda s: f"{s['kind']}:{s['start']}:{s['end']}"
    covered = [(s["start"], s["end"]) for s in base]
    extra = [s for s in more if not any(a < s["end"] and s["start"] < b for a, b in covered) and shaped_like(s["value"], grammars)]
    every = sorted(base + extra, key=lambda s: (s["start"], KINDS.index(s["kind"])))
    counts = [sum(s["kind"] == k for s in base) for k in KINDS[:3]] + [len(extra)]
    return hashlib.sha256(",".join(map(said, base)).encode()).hexdigest(), ",".join(map(said, every)), counts


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans, all spans, of every row."""
    scanned = C.cut(scan(docs))
    grammars = infer(scanned.select(F.explode("base").alias("s")).select("s.kind", "s.value"))

    def run(batches):
        for b in batches:
            out = [_spans(x, y, grammars) for x, y in zip(b.column("base").to_pylist(), b.column("more").to_pylist())]
            counts = np.array([o[2] for o in out], np.int64).reshape(-1, 4)
            yield pa.record_batch([b.column("doc_id"), *(pa.array(counts[:, i]) for i in range(4)),
                                   pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string())],
                                  names=["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"])

    return scanned.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string")


def op5(docs: DataFrame) -> DataFrame:
    return find_secrets(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format")


def mask(docs: DataFrame, token: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every found secret replaced in ``text``; other columns unchanged.

    ``n_chars``, where present and not null, follows the new text. The texts are
    scanned again with the grammars of the whole table, so nothing is joined by id.
    """
    labelled = C.cut(scan(docs).select(F.explode("base").alias("s")).select("s.kind", "s.value").distinct())
    grammars = infer(labelled)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for p in C.pieces(batches):
            data, off = C.text_buffer(p.column(at))
            texts = p.column(at).to_pylist()
            changed = {}
            for i in np.flatnonzero(_suspects(data, off)):
                text = texts[i]
                if not text:
                    continue
                base = [dict(zip(("kind", "start", "end", "value"), s)) for s in base_spans(text)]
                more = [dict(zip(("kind", "start", "end", "value"), s)) for s in candidates(text)]
                _, spans, _ = _spans(base, more, grammars)
                if spans:
                    changed[i] = _masked(text, spans, token)
            if changed:
                cols = list(p.columns)
                cols[at] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], p.schema.field(at).type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    old = p.column(k).to_pylist()
                    cols[k] = pa.array([len(changed[i]) if i in changed and v is not None else v for i, v in enumerate(old)], p.schema.field(k).type)
                p = pa.record_batch(cols, schema=p.schema)
            yield p

    return docs.mapInArrow(run, docs.schema)


def _masked(text: str, spans: str, token: str) -> str:
    out, at = [], 0
    for lo, hi in sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in spans.split(","))):
        if hi <= at:
            continue
        if lo >= at:
            out += [text[at:lo], token]
        at = hi
    return "".join(out) + text[at:]
