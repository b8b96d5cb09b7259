r"""Chat formatting by event-sourced reconstruction.

A log holds events (conv_id, turn, seq, kind, role, text):
``start`` opens or reopens a message (a regeneration drops what it held),
``delta`` appends streamed text, ``edit`` replaces the text, ``delete`` drops the
message. Events are partitioned by conversation, sorted by (turn, seq) and
folded in one streaming pass that holds one message at a time, so a
conversation of any length costs the memory of its largest message.

Template: ``### role: text</turn>\n`` per message. Inside texts and roles
``\`` becomes ``\\``, ``###`` becomes ``\h``, ``</turn>`` becomes ``\e``; in roles ``:``
becomes ``\c``. Unescaping left to right restores every text exactly. The loss mask
covers the escaped texts of assistant messages.

Defined cases: null text and null role count as empty; rows that share
(conv_id, turn) are messages of their own, in order of role and a hash of the
text; an event repeated with the same seq is applied once; null turns come first;
rows of null conv_id form one conversation; an empty log gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limelight.llm import common as C

CLOSE = "</turn>\n"
_BACK = {"\\": "\\", "h": "###", "e": "</turn>", "c": ":"}


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("###", "\\h").replace("</turn>", "\\e")


def unescape(text: str) -> str:
    parts = text.split("\\")
    out, i = [parts[0]], 1
    while i < len(parts):
        if parts[i]:
            out += [_BACK[parts[i][0]], parts[i][1:]]
            i += 1
        else:  # an escaped backslash; what follows it is plain
            out += ["\\", parts[i + 1]]
            i += 2
    return "".join(out)


def render(role: str, text: str) -> str:
    return f"### {escape(role).replace(':', chr(92) + 'c')}: {escape(text)}{CLOSE}"


def read_piece(piece: str) -> tuple[str, str, tuple[int, int]]:
    """Role, text, and the span of the escaped text, of one rendered message."""
    mark = piece.index(": ")
    span = mark + 2, len(piece) - len(CLOSE)
    return unescape(piece[4:mark]), unescape(piece[span[0]:span[1]]), span


def events_of(conversations: DataFrame, width: int = 400) -> DataFrame:
    """The event log of finished rows: a start, then deltas of ``width`` characters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), text.alias("text"))
    slots = F.sequence(F.lit(0), F.ceil(F.length("text") / width).cast("int"))
    # tells rows of one (conv_id, turn) apart and orders them: role, hash of the text, place in the input
    part = F.concat("role", F.lit("\0"), F.hex(F.xxhash64("text")), F.lit("\0"), F.lpad(F.hex("_row"), 16, "0"))
    return rows.withColumn("_row", F.monotonically_increasing_id()).select("*", F.explode(slots).alias("seq")).select(
        "conv_id", "turn", "role", part.alias("part"), "seq",
        F.when(F.col("seq") == 0, "start").otherwise("delta").alias("kind"),
        F.when(F.col("seq") == 0, "").otherwise(F.substring("text", (F.col("seq") - 1) * width + 1, F.lit(width))).alias("text"))


EVENT = "conv_id long, turn long, role string, text string"


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text), in order within each task's partition.

    ``events`` has conv_id, turn, seq, kind, role, text; ``part`` tells messages of one turn apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, role, held, live, out, size = None, None, "", [], False, [], 0
        for b in batches:
            cols = [b.column(n).to_pylist() for n in ("conv_id", "turn", "part", "seq", "kind", "role", "text")]
            for conv, turn, part, seq, kind, who, text in zip(*cols):
                if (conv, turn, part) != key:
                    if live:
                        out.append((key[0], key[1], role, "".join(held)))
                        size += len(out[-1][3])
                    key, role, held, live = (conv, turn, part), who, [], False
                elif seq == last:
                    continue
                last = seq
                if kind == "start":
                    role, held, live = who, [], True
                elif kind == "delta":
                    held.append(text or "")
                    live = True
                elif kind == "edit":
                    held, live = [text or ""], True
                elif kind == "delete":
                    held, live = [], False
            if size > C.CHUNK_BYTES:
                yield _messages(out)
                out, size = [], 0
        if live:
            out.append((key[0], key[1], role, "".join(held)))
        if out:
            yield _messages(out)

    log = events.select(
        "conv_id", "turn", "part", "seq", "kind", F.coalesce("role", F.lit("")).alias("role"), "text")
    sorted_log = log.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part", "seq")
    return sorted_log.mapInArrow(run, EVENT)


def _messages(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=["conv_id", "turn", "role", "text"])


def digest(messages: DataFrame) -> DataFrame:
    """Render the messages, read them back from the output, and digest each conversation.

    ``messages`` must be ordered by conversation within partitions, as ``fold`` leaves them.
    """

    def run(batches):
        key, state, started = None, None, False
        for b in batches:
            out = []
            for conv, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if not started or conv != key:
                    if started:
                        out.append((key, *_closed(state)))
                    key, started = conv, True
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                piece = render(role, text)
                who, said, _ = read_piece(piece)
                state[0] += 1
                state[1].update(f"{who}\n{said}\n".encode())
                if who == "assistant":
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(piece)
            if out:
                yield _digests(out)
        if started:
            yield _digests([(key, *_closed(state))])

    return messages.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _closed(s: list) -> tuple:
    return s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]


def _digests(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def formatted(messages: DataFrame) -> DataFrame:
    """The rendered pieces: conv_id, turn, piece, and the loss span inside it (null where there is no loss)."""

    def run(batches):
        for b in batches:
            out = []
            for conv, turn, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text"))):
                piece = render(role, text)
                _, _, (lo, hi) = read_piece(piece)
                out.append((conv, turn, piece, *((lo, hi) if role == "assistant" else (None, None))))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                      names=["conv_id", "turn", "piece", "loss_start", "loss_end"])

    return messages.mapInArrow(run, "conv_id long, turn long, piece string, loss_start long, loss_end long")


PROBE = r"\### Assistant: </turn> ok"


def op8(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return digest(fold(events_of(rows.unionByName(probe))))


# The same result in DuckDB. formatted_chars counts 4 + role + 2 + escaped text + 8 a message.
SQL = r"""
WITH c AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
