"""PII: surrogate generation.

Entities (e-mail addresses, phone numbers, IPv4 addresses, payment cards,
national ids of the form 000-00-0000, IBANs, and the given names and surnames of
persons introduced by a title) are found in every whole text and replaced by
surrogates that depend on a secret key and the entity alone:

* type: a card stays a card (a valid check digit stays valid), octets stay in
  0..255, an e-mail address keeps its top-level domain;
* format: separators, digit counts, upper and lower case and length classes stay;
* script: letters are replaced by letters of the same script;
* gender: given names after a gendered title get a name of that gender's form;
* coreference: one entity has one surrogate in all texts, and the parts of a name
  map one by one, so "Ms Anna Berg" and a later "Berg" stay the same person;
* distinctness: all distinct entities of the corpus are grouped by surrogate;
  where two meet, or a surrogate is itself an entity of the corpus, all but the
  smallest take their next surrogate (``attempt``), until no collision is left.

A format may have fewer surrogates than the corpus has entities of it (10,000 IPv4
addresses of four one-digit octets, 196 e-mail addresses of two consonants under a
top-level domain). So what has met collisions in ``ROUNDS`` attempts gives up the
exact length, and more of it after every further ``ROUNDS``: octets take any length,
then further octets follow; the local part of an e-mail address, and the last group of
a number or of a name in a script without syllables, get one more character each time.
Separators, script and case stay. Every space grows without end, so the attempts end.

Only texts with entities are written and joined with the surrogates; all others
pass through.

Defined cases: null texts stay null and empty texts empty, with no entities;
repeated rows are treated alike; a null doc_id is allowed; an empty table gives no
rows; other columns play no part. A surrogate depends on the key, the entity and,
where it collides, the other entities of the corpus.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C

# Titles that introduce a person, by gender.
FEMALE = ("Mrs", "Ms", "Miss", "Madame", "Mme", "Frau", "Señora", "Sra", "Госпожа")
MALE = ("Mr", "Mister", "Monsieur", "Herr", "Señor", "Sr", "Господин")
NEUTRAL = ("Dr", "Prof", "Professor")
TITLE = {**dict.fromkeys(FEMALE, "f"), **dict.fromkeys(MALE, "m"), **dict.fromkeys(NEUTRAL, "n")}

_NAME = r"[^\W\d_]+(?:[-'][^\W\d_]+)*"
PATTERNS = [
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}\b")),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b")),
    ("card", re.compile(r"(?<![\w.-])\d(?:[\x20-]?\d){12,18}(?![\w-])")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.])(?:\+\d{1,3}[\x20.-]?(?:\(\d{1,4}\)[\x20.-]?)?\d{2,4}(?:[\x20.-]?\d{2,4}){1,4}"
                         r"|\(\d{3}\)[\x20.-]?\d{3}[\x20.-]?\d{4}|\d{3}[\x20.-]\d{3}[\x20.-]\d{4}|\d{3}-\d{4})(?![\w-])")),
    ("person", re.compile(r"\b(" + "|".join(sorted(TITLE, key=len, reverse=True)) + r")\b\.?\x20(" + _NAME + r")(?:\x20(" + _NAME + "))?")),
]
_MARKS = np.zeros(256, bool)
_MARKS[list(b"0123456789@")] = True
# The patterns take the decimal digits of every script.
_TITLE_OR_DIGIT = re.compile(r"\b(?:" + "|".join(sorted(TITLE, key=len, reverse=True)) + r")\b\.?\x20|\d")


# Fixed value: attempts within one length before a surrogate may grow.
ROUNDS = 8


def _capital(word: str | None) -> bool:
    return bool(word) and word[0].isupper()


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, value) of the entities of a text in order; the patterns take precedence in their order."""
    taken: list[tuple[int, int, str, str]] = []
    free = lambda a, b: not any(a < y and x < b for x, y, _, _ in taken)
    names: dict[str, str] = {}
    for kind, pattern in PATTERNS:
        for m in pattern.finditer(text):
            if kind != "person":
                if free(m.start(), m.end()) and (kind != "card" or 13 <= sum(c.isdigit() for c in m[0]) <= 19):
                    taken.append((m.start(), m.end(), kind, m[0]))
                continue
            parts = [k for k in (2, 3) if _capital(m[k])]
            if parts[:1] != [2]:
                continue
            gender = TITLE[m[1]]
            for k in parts:
                part = "surname" if k == parts[-1] else f"given_{gender}"
                a, b = m.span(k)
                if free(a, b):
                    taken.append((a, b, part, m[k]))
                names.setdefault(m[k], part)
    for name, part in names.items():  # later mentions of a person by one name
        for m in re.finditer(rf"(?<!\w){re.escape(name)}(?!\w)", text):
            if free(*m.span()):
                taken.append((m.start(), m.end(), part, name))
    return sorted(taken)


class _Stream:
    """Key-dependent choices for one entity: HMAC-SHA256 blocks read as numbers."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed, self.key, self.n, self.held = f"{kind}\0{value}\0{attempt}".encode(), key, 0, b""

    def below(self, n: int) -> int:
        if len(self.held) < 4:
            self.held += hmac.new(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.n += 1
        out, self.held = int.from_bytes(self.held[:4], "big") % n, self.held[4:]
        return out


# Syllable parts of made-up names by script; the last letters mark the gender's form.
SOUNDS = {
    "LATIN": ("bdfgklmnprstvz", "aeiou", {"f": "a", "m": "n", "n": "e", "s": "r"}),
    "CYRILLIC": ("бвгдзклмнпрст", "аеиоу", {"f": "а", "m": "н", "n": "е", "s": "в"}),
    "GREEK": ("βγδζκλμνπρστ", "αειου", {"f": "α", "m": "ς", "n": "ι", "s": "ς"}),
}


def script(c: str) -> str:
    return unicodedata.name(c, "").split(" ")[0]


def _letter(c: str, s: _Stream) -> str:
    """A letter of the same script, case and sound class; for other scripts one of the same code block."""
    consonants, vowels, _ = SOUNDS.get(script(c), ("", "", None))
    if consonants:
        pool = vowels if unicodedata.normalize("NFD", c.lower())[0] in vowels else consonants
        out = pool[s.below(len(pool))]
        return out.upper() if c.isupper() else out
    base = ord(c) & ~0x3F
    pool = [chr(x) for x in range(base, base + 64) if chr(x).isalpha()] or [c]
    return pool[s.below(len(pool))]


def _shape(value: str, s: _Stream) -> str:
    return "".join(str(s.below(10)) if c.isdigit() else _letter(c, s) if c.isalpha() else c for c in value)


def _longer(value: str, by: int) -> str:
    """``value`` with its last letter or digit written ``by`` times more (a consonant if it has none)."""
    at = next((i for i in range(len(value), 0, -1) if value[i - 1].isdigit() or value[i - 1].isalpha()), 0)
    return value[:at] + value[at - 1] * by + value[at:] if at else value + "k" * by


def _name(value: str, form: str, s: _Stream, attempt: int) -> str:
    kind = script(value[0])
    if kind not in SOUNDS:
        return _shape(_longer(value, attempt // ROUNDS), s)
    consonants, vowels, ends = SOUNDS[kind]
    out = "".join(consonants[s.below(len(consonants))] + vowels[s.below(len(vowels))] for _ in range(max(2, len(value) // 2) + attempt // 4))
    out += consonants[s.below(len(consonants))] if form == "f" else ""
    out += ends[form]
    return out.upper() if value.isupper() and len(value) > 1 else out.capitalize()


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def surrogate(kind: str, value: str, attempt: int, key: bytes) -> str:
    s = _Stream(key, kind, value, attempt)
    wider = attempt // ROUNDS
    if kind == "email":
        host, dot, top = value.rpartition(".")
        local, at, host = host.partition("@")
        return _shape(_longer(local, wider) + at + host, s) + dot + top
    if kind == "ip":
        ranges = {1: (0, 10), 2: (10, 100), 3: (100, 256)}
        octets = [ranges[len(o)] for o in value.split(".")] if not wider else [(0, 256)] * (3 + wider)
        return ".".join(str(lo + s.below(hi - lo)) for lo, hi in octets)
    if kind == "surname" or kind.startswith("given_"):
        return _name(value, "s" if kind == "surname" else kind[-1], s, attempt)
    valid = kind == "card" and luhn(re.sub(r"\D", "", value))
    value = _longer(value, wider)
    if valid:
        out = _shape(value, s)
        return next(x for x in (out[:-1] + str(d) for d in range(10)) if luhn(re.sub(r"\D", "", x)))
    if kind == "phone" and value.startswith("+"):
        code = re.match(r"\+\d{1,3}(?=\D|$)|\+\d", value)[0]
        return code + _shape(value[len(code):], s)
    if kind == "iban":
        return value[:2] + _shape(value[2:], s)
    return _shape(value, s)


MENTIONS = "array<struct<start:int,end:int,type:string,value:string>>"


def _suspects(data: np.ndarray, off: np.ndarray, texts: pa.Array) -> list[int]:
    """Rows with a digit of any script, an @ or a title before a word; nothing else can hold an entity."""
    hit = np.zeros(len(off) - 1, bool)
    hit[np.searchsorted(off, np.flatnonzero(_MARKS[data]), "right") - 1] = True
    return [i for i in range(len(hit)) if texts[i].is_valid and (hit[i] or _TITLE_OR_DIGIT.search(texts[i].as_py()))]


def _found(with_entities: bool):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("type", pa.string()), ("value", pa.string())]))

    def run(batches):
        for p in C.pieces(batches):
            col = p.column("text")
            data, off = C.text_buffer(col)
            found = {}
            for i in _suspects(data, off, col):
                spans = entities(col[i].as_py())
                if spans:
                    found[i] = [dict(zip(("start", "end", "type", "value"), s)) for s in spans]
            rows = np.array(sorted(found) if with_entities else [i for i in range(p.num_rows) if i not in found], np.int64)
            if len(rows):
                take = pa.array(rows)
                cols = [p.column("doc_id").take(take), p.column("row").take(take), col.take(take)]
                if with_entities:
                    cols.append(pa.array([found[i] for i in rows], kind))
                yield pa.record_batch(cols, names=["doc_id", "row", "text", "mentions"][: len(cols)])

    return run


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """(type, value, surrogate) of every distinct entity, surrogates distinct within a type and no entity themselves."""

    def make(attempt):
        def run(batches):
            for b in batches:
                kinds, values = b.column("type").to_pylist(), b.column("value").to_pylist()
                made = [surrogate(k, v, attempt, key) for k, v in zip(kinds, values)]
                yield pa.record_batch([b.column("type"), b.column("value"), pa.array(made, pa.string())], names=["type", "value", "surrogate"])

        return run

    # a name's forms share one space of surrogates, so that no two persons meet
    space = F.when(F.col("type").startswith("given_"), "given").otherwise(F.col("type"))
    todo = C.cut(found.select("type", "value").distinct())
    real = todo.select(space.alias("space"), F.col("value").alias("surrogate")).distinct()
    done, attempt = None, 0
    while True:
        made = todo.mapInArrow(make(attempt), "type string, value string, surrogate string")
        tried = C.cut(made.withColumn("space", space))
        first = tried.groupBy("space", "surrogate").agg(F.min(F.struct("type", "value")).alias("winner"))
        free = first.join(real, ["space", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done, ["space", "surrogate"], "left_anti")
        won = C.cut(free.select("winner.type", "winner.value", "surrogate", "space"))
        done = won if done is None else done.unionAll(won)
        todo = C.cut(todo.join(won, ["type", "value"], "left_anti"))
        if todo.isEmpty():
            return done.select("type", "value", "surrogate")
        attempt += 1


def _replace(batches):
    for b in batches:
        out = []
        for doc, text, mentions in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "mentions"))):
            parts, at, spans = [], 0, []
            for m in sorted(mentions, key=lambda m: m["start"]):
                parts += [text[at:m["start"]], m["surrogate"]]
                at = m["end"]
                spans.append(f"{m['type']}:{m['start']}:{m['end']}")
            out.append((doc, len(spans), ",".join(spans), "".join(parts) + text[at:]))
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.string())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)], names=["doc_id", "n_entities", "entities", "text"])


def replace_entities(docs: DataFrame, key: bytes = b"surrogate-key") -> DataFrame:
    """Per row: doc_id, n_entities, entities (type:start:end of the given text, comma-joined), text with surrogates."""
    rows = docs.select(C.long_ids(), F.monotonically_increasing_id().alias("row"), "text")
    found = C.cut(rows.mapInArrow(_found(True), f"doc_id long, row long, text string, mentions {MENTIONS}"))
    each = found.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    named = each.join(assign(each, key), ["type", "value"])
    lists = named.groupBy("row").agg(F.collect_list(F.struct("start", "end", "type", "surrogate")).alias("mentions"))  # of one text
    changed = found.drop("mentions").join(lists, "row").select("doc_id", "text", "mentions").mapInArrow(
        _replace, "doc_id long, n_entities int, entities string, text string")
    same = rows.mapInArrow(_found(False), "doc_id long, row long, text string").select(
        "doc_id", F.lit(0).alias("n_entities"), F.lit("").alias("entities"), "text")
    return changed.unionAll(same)


op2 = replace_entities
