"""Chat formatting by event-sourced reconstruction.

A log holds events of conversations: a message opens, deltas stream in, an edit replaces what the
message says, a regeneration empties it and takes back every message opened after it. The log is
dealt by conversation and message, sorted by sequence and folded to one row per message; these
rows, few beside the events, are dealt by conversation, sorted and folded to final conversations,
which are rendered with a template. Control strings inside texts are escaped reversibly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, DELTA, EDIT, REGENERATE = "open", "delta", "edit", "regenerate"
# Fixed values of the template.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_MESSAGES = "conv_id long, first_seq long, message string, reset_seq long, role string, text string"
_FORMATTED = "conv_id long, n_turns long, formatted string, loss_spans array<struct<start:long,end:long>>"


def escape(text: str) -> str:
    """Put a backslash into every ``<|`` (and one more into ``<\\|``), so that no control string is left."""
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def render(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (code points, end exclusive) of the texts to learn."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN_START}{_role(role)}\n", escape(text)
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        tail = f"{TURN_END}\n"
        parts += [head, body, tail]
        at += len(head) + len(body) + len(tail)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation; raises if it is not one."""
    turns, at = [], 0
    while at < len(formatted):
        stop = formatted.find(f"{TURN_END}\n", at)
        if not formatted.startswith(TURN_START, at) or stop < 0:
            raise ValueError("not a formatted conversation")
        role, _, body = formatted[at + len(TURN_START) : stop].partition("\n")
        turns.append((_unrole(role), unescape(body)))
        at = stop + len(TURN_END) + 1
    return turns


def _record_batch(rows: list[tuple], names: tuple[str, ...], types: tuple):
    import pyarrow as pa

    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=list(names))


def _fold_messages(batches: Iterator) -> Iterator:
    """Events sorted by (conversation, message, sequence) to one row per message."""
    import pyarrow as pa

    names = ("conv_id", "first_seq", "message", "reset_seq", "role", "text")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
    key, first, reset, role, parts = None, None, None, None, []
    for batch in batches:
        done = []
        cols = (batch[c].to_pylist() for c in ("conv_id", "message", "seq", "kind", "role", "text"))
        for conv, message, seq, kind, who, text in zip(*cols):
            if key != (conv, message):
                if key is not None:
                    done.append((key[0], first, key[1], reset, role, "".join(parts)))
                key, first, reset, role, parts = (conv, message), seq, None, None, []
            if kind == OPEN:
                role = who
            elif kind == REGENERATE:
                parts, reset = [], seq
            elif kind == EDIT:
                parts = [text or ""]
            else:
                parts.append(text or "")
        yield _record_batch(done, names, types)
    if key is not None:
        yield _record_batch([(key[0], first, key[1], reset, role, "".join(parts))], names, types)


def _fold_conversations(batches: Iterator) -> Iterator:
    """Messages sorted by (conversation, opening) to one rendered row per conversation."""
    import pyarrow as pa

    names = ("conv_id", "n_turns", "formatted", "loss_spans")
    types = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    def final(conv, turns):
        formatted, spans = render(turns)
        return conv, len(turns), formatted, [{"start": a, "end": b} for a, b in spans]

    begun, conv, turns = False, None, []
    # Of the messages before: up to where regenerations take back, and the same with those opened just now.
    cleared, at, now = None, None, None
    for batch in batches:
        done = []
        cols = (batch[c].to_pylist() for c in ("conv_id", "first_seq", "reset_seq", "role", "text"))
        for c, first, reset, role, text in zip(*cols):
            if not begun or c != conv:
                if begun:
                    done.append(final(conv, turns))
                begun, conv, turns = True, c, []
                cleared, at, now = None, first, None
            if first != at:
                cleared, at = now, first
            if cleared is not None and first is not None and first < cleared:
                continue  # opened after an earlier message and before that was generated anew: taken back
            turns.append((role or "", text or ""))
            if reset is not None:
                now = reset if now is None else max(now, reset)
        yield _record_batch(done, names, types)
    if begun:
        yield _record_batch([final(conv, turns)], names, types)


def format_conversations(events: DataFrame) -> DataFrame:
    """Final conversations of an event log, rendered: conv_id, n_turns, formatted, loss_spans.

    ``events``: conv_id long, seq long (order within the conversation), message string (which
    message), kind string (open, delta, edit, regenerate), role string (of open), text string (of
    delta and edit). Equal sequence numbers fall back on the message, then on kind and text. Null
    role or text is the empty string; null conv_id is a conversation of its own; a message without
    an open event has the empty role. No events give no rows. Extra columns are ignored.

    One message's events meet in one task, and then one conversation's messages, as a rendered
    conversation is one value. A conversation with very many events is folded message by message
    first, in different tasks.
    """
    e = events.select("conv_id", "seq", F.coalesce("message", F.lit("")).alias("message"), "kind", "role", "text")
    e = e.repartition("conv_id", "message").sortWithinPartitions("conv_id", "message", "seq", F.col("kind").desc(), "text")
    messages = e.mapInArrow(_fold_messages, _MESSAGES)
    m = messages.repartition("conv_id").sortWithinPartitions("conv_id", "first_seq", "message")
    return m.mapInArrow(_fold_conversations, _FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the rendered text alone: conv_id, turns (role, text) and the learned text."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        turn = pa.struct([("role", pa.string()), ("text", pa.string())])
        for batch in batches:
            out = []
            for conv, text, spans in zip(*(batch[c].to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
                learned = "".join([unescape(text[s["start"] : s["end"]]) for s in spans])
                out.append((conv, [{"role": r, "text": t} for r, t in parse(text)], learned, len(text)))
            yield _record_batch(
                out, ("conv_id", "turns", "learned", "formatted_chars"), (pa.int64(), pa.list_(turn), pa.string(), pa.int64())
            )

    schema = "conv_id long, turns array<struct<role:string,text:string>>, learned string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(rows, schema)
