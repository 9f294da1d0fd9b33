"""Chat formatting from event logs: events are folded into final messages, which are rendered with a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.stored import stored

# The marks of the template.
OPEN, ROLE, END_ROLE, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"

_MARK = re.compile(r"(\\*)(</?s>|\[/?INST\])")
_ESCAPED = re.compile(r"\\(\\*)(</?s>|\[/?INST\])")
# a mark of the template never stands behind a backslash, one inside a text always does
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\]\n(.*?)\n</s>", re.DOTALL)
#: Kinds of events, in the order in which those of one sequence number apply.
_KINDS = ["message", "regenerate", "edit", "delta"]


def escape(text: str) -> str:
    """Puts a backslash before every mark in a text, and before backslashes that stand before one."""
    return _MARK.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def fold_messages(events: DataFrame, conversation: str = "conversation", target: str = "target", sequence: str = "seq") -> DataFrame:
    """Final state of each message: conversation, target, role, text, begun and reset (sequence numbers).

    ``events`` has, besides the named columns, kind, role and text.  In order of sequence, then
    kind, role and text, a `message` begins its target anew with a text, a `delta` adds to the
    text, an `edit` replaces it, and a `regenerate` empties it, and withdraws the later messages
    begun so far (reset tells when).  Other kinds are an error.  Equal events are one event
    delivered again.  A null text is empty, a null role leaves the role as it is.

    Messages are folded by tasks of their own, so that a long conversation is spread out.
    """
    rank = F.array_position(F.array(*map(F.lit, _KINDS)), F.col("kind")).cast("int") - 1
    known = F.coalesce(F.when(rank >= 0, rank), F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null")))).cast("int"))
    plain = events.select(
        F.col(conversation).alias("conversation"),
        F.col(target).alias("target"),
        F.col(sequence).cast("bigint").alias("seq"),
        known.alias("rank"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["conversation", "target", "seq", "rank", "role", "text"]
    ordered = plain.repartition("conversation", "target").sortWithinPartitions(*order)
    kinds = {f.name: f.dataType.simpleString() for f in plain.schema.fields}

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[i]) for i in range(6)], names=["conversation", "target", "role", "text", "begun", "reset"])

        types: list[pa.DataType] = []
        key, role, parts, begun, reset, before = None, None, [], None, None, None
        for batch in batches:
            types = [batch.schema.field("conversation").type, batch.schema.field("target").type, pa.string(), pa.string(), pa.int64(), pa.int64()]
            rows = []
            columns = (batch.column(n).to_pylist() for n in order)
            for event in zip(*columns, strict=True):
                if event == before:
                    continue
                before = event
                conversation, target, seq, kind, said_by, text = event
                if key != (conversation, target):
                    if key is not None:
                        rows.append((*key, role, "".join(parts), begun, reset))
                    key, role, parts, begun, reset = (conversation, target), None, [], seq, None
                role = role if said_by is None else said_by
                if _KINDS[kind] == "message":
                    parts, begun = [text], seq
                elif _KINDS[kind] == "regenerate":
                    parts, reset = [], seq
                elif _KINDS[kind] == "edit":
                    parts = [text]
                else:
                    parts.append(text)
            yield done(rows)
        if key is not None:
            yield done([(*key, role, "".join(parts), begun, reset)])

    return ordered.mapInArrow(fold, f"conversation {kinds['conversation']}, target {kinds['target']}, role string, text string, begun bigint, reset bigint")



def render(messages: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """One row per conversation: conversation, n_turns, formatted, and loss (array of start, stop in code points).

    Messages follow each other by target; those begun before an earlier one was reset are left
    out.  The loss covers the texts of ``learned_role`` as they stand in the output, escaped.
    A null role is rendered as an empty one.  Rows without conversation are one conversation.
    """
    order = ["conversation", "target"]
    ordered = messages.repartition("conversation").sortWithinPartitions(*order)
    kind = messages.schema["conversation"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        held: list[tuple] = []
        now: list = []
        size, turns, loss, parts, latest = 0, 0, [], [], None
        for batch in batches:
            held = []
            of = batch.schema.field("conversation").type
            names = ("conversation", "role", "text", "begun", "reset")
            for conversation, role, text, begun, reset in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if now != [conversation]:
                    if now:
                        held.append((now[0], turns, "".join(parts), loss))
                    now, size, turns, loss, parts, latest = [conversation], 0, 0, [], [], None
                alive = latest is None or (begun is not None and begun > latest)
                if reset is not None and alive:
                    latest = reset if latest is None else max(latest, reset)
                if not alive:
                    continue
                head = f"{OPEN}{ROLE} {escape(role or '')} {END_ROLE}\n"
                body = escape(text or "")
                tail = f"\n{CLOSE}"
                if role == learned_role:
                    loss.append({"start": size + len(head), "stop": size + len(head) + len(body)})
                size += len(head) + len(body) + len(tail)
                parts += [head, body, tail]
                turns += 1
            yield _batch(held, of, spans)
        if now:
            yield _batch([(now[0], turns, "".join(parts), loss)], of, spans)

    return ordered.mapInArrow(write, f"conversation {kind}, n_turns bigint, formatted string, loss array<struct<start:bigint,stop:bigint>>")


def _batch(rows: list[tuple], of: pa.DataType, spans: pa.DataType) -> pa.RecordBatch:
    kinds = [of, pa.int64(), pa.string(), spans]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["conversation", "n_turns", "formatted", "loss"])


def format_events(events: DataFrame, learned_role: str = "assistant", **columns: str) -> DataFrame:
    """Folds an event log and renders its conversations; see :func:`fold_messages` and :func:`render`."""
    return render(stored(fold_messages(events, **columns), "messages"), learned_role)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a rendered conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests of what the output says: conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    turns_sha256 is over role, line feed, text, line feed of each turn; loss_chars and loss_sha256 are over
    all text under the loss mask, unescaped.
    """
    kind = rendered.schema["conversation"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for formatted, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                turns = parse(formatted)
                learned = "".join(unescape(formatted[x["start"] : x["stop"]]) for x in loss)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, learned)]
                rows.append((len(turns), digests[0], len(learned), digests[1], len(formatted)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            names = ["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column("conversation"), *arrays], names=names)

    kinds = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return rendered.select("conversation", "formatted", "loss").mapInArrow(read, f"conversation {kind}, {kinds}")
