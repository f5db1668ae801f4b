"""Chat formatting, with every turn's span found by rendering prefixes.

A template is a black box from messages to text. The turns of a conversation are rendered one prefix after another;
what a rendering adds to the one before is the new turn's span, and rendering the turn once more without its text
shows where the text lies in it. A template whose rendering doesn't begin with the one before rewrites history: the
conversation is flagged and its final rendering stands without spans.

Every prefix is rendered whole, whatever the number of turns, which takes time with its square. A template may declare, by
an attribute `appends` that is true, that a turn's text doesn't depend on other turns; then each turn is rendered alone, and the
parts put together are held against the rendering of the whole once. If they differ, prefixes are rendered as for any other.

Defined cases: null roles and texts are empty, and texts of any length whole; rows of one turn number follow each other by role,
then text, repeated rows too; null turn numbers come first; rows whose conversation is null form one; an empty table gives an
empty result; ids of any type pass as they are; columns beside the four are not read, whatever their names. A conversation is
one output row, so it is held whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Messages = list[tuple[str, str]]
#: Characters of control strings and what stands for them inside texts and roles.
_ESCAPES = {"\\": "\\\\", "<": "\\l", "#": "\\h", ":": "\\c", "\n": "\\n"}
_PLAIN = {v[1]: k for k, v in _ESCAPES.items()}


def escape(text: str, which: str = "\\<#") -> str:
    return re.sub("[" + re.escape(which) + "]", lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text)


_TURN = re.compile(r"### ([^:]*): ([^<]*)</turn>\n")


def parse(formatted: str) -> Messages:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _shared(a: str, b: str, start: int) -> int:
    """How far two texts agree that are known to do so up to start: by halving, as whole slices compare fast."""
    low, high = start, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _text_span(before: str, after: str, without: str) -> tuple[int, int]:
    """Where in `after` the last turn's text lies, given the rendering without that text."""
    start = _shared(after, without, len(before) if after.startswith(before) and without.startswith(before) else 0)
    return start, start + len(after) - len(without)


def _alone(messages: Messages, template: Callable[[Messages], str]) -> tuple[str, list] | None:
    """(text, spans) from each turn rendered alone, or None if they don't make up the whole."""
    parts, spans, at = [], [], 0
    for role, text in messages:
        own = template([(role, text)])
        a, b = _text_span("", own, template([(role, "")]))
        spans.append(((at, at + len(own)), (at + a, at + b)))
        parts.append(own)
        at += len(own)
    whole = "".join(parts)
    return (whole, spans) if whole == template(messages) else None


def render(messages: Messages) -> str:
    """The template: `### role: text</turn>` and a newline for each turn, with control strings inside escaped."""
    return "".join(f"### {escape(role, chr(92) + '<#:' + chr(10))}: {escape(text)}</turn>\n" for role, text in messages)


def locate(messages: Messages, template: Callable[[Messages], str] = render) -> tuple[str, list, bool]:
    """(formatted text, for each turn (turn span, text span), whether the template rewrites history)."""
    if getattr(template, "appends", False) and (found := _alone(messages, template)):
        return *found, False
    text, spans, rewritten = "", [], False
    for k, (role, _) in enumerate(messages):
        after = template(messages[: k + 1])
        rewritten |= not after.startswith(text)
        spans.append(((len(text), len(after)), _text_span(text, after, template([*messages[:k], (role, "")]))))
        text = after
    return text, spans, rewritten


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def format_conversations(conversations: DataFrame, template: Callable[[Messages], str] = render, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> conv_id, formatted, turn_spans, loss_spans (code points, end exclusive),
    rewrites_history. Conversations stream through the tasks in order; one at a time is held."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select("conv_id", "turn", text("role"), text("text"))
    schema = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string("formatted string, turn_spans array<array<long>>, loss_spans array<array<long>>, rewrites_history boolean").fields])

    def made(conv, messages):
        formatted, spans, rewritten = locate(messages, template)
        loss = [] if rewritten else [list(t) for (_, t), (role, _) in zip(spans, messages, strict=True) if role in loss_roles]
        return conv, formatted, [] if rewritten else [list(t) for t, _ in spans], loss, rewritten

    def as_batch(out):
        kinds = [None, pa.string(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.list_(pa.int64())), pa.bool_()]
        ids = pa.concat_arrays([x[0] for x in out])
        return pa.RecordBatch.from_arrays([ids, *[pa.array([x[k] for x in out], kinds[k]) for k in range(1, 5)]], names=schema.names)

    def stream(batches):
        own, messages, out, size = None, [], [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, (role, body) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if own is None or ids[i] != own[0]:
                    if messages:
                        out.append(made(own[1], messages))
                        size, messages = size + len(out[-1][1]), []
                        if size > 1 << 22:
                            yield as_batch(out)
                            out, size = [], 0
                    own = ids[i], batch.column(0).slice(i, 1)
                messages.append((role, body))
        if messages:
            out.append(made(own[1], messages))
        if out:
            yield as_batch(out)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(stream, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """What can be read from formatted conversations alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def read(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, loss in zip(texts, spans, strict=True):
            turns = parse(text)
            masked = "".join(unescape(text[a:b]) for a, b in loss)
            rows.append((len(turns), _digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(masked), _digest(masked), len(text)))
        return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", read("formatted", "loss_spans").alias("r"), "rewrites_history").select("conv_id", "r.*", "rewrites_history")
