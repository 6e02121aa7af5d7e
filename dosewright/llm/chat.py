"""Chat formatting with a template that is only known by what it renders.

A turn's span is found by rendering the turns before it and then one turn more:
what the second output has beyond the first is the turn. If the second does not
begin with the first, the template rewrites its history, and the row says so.
Where the turn's text lies inside its span is found by rendering two probes in its
place: what they have in common before and behind is not text. No knowledge of the template is used, so any function of turns will do.

Conversations are read in order of their turns as a stream. The turns rendered
before a turn are the whole conversation so far, under any template, so a task holds one
conversation and its work grows with the square of the turns. Only where a caller asks for
it (``whole=False``) is a template declared by :func:`append_only` rendered on from the
last ``CONTEXT`` turns, which bounds the work of a turn; the declaration is then
checked against renderings of the whole at doubling numbers of turns. The query never does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.llm.common import record_batch, short_batches

Render = Callable[[list[tuple[str, str]]], str]

CONTEXT = 4
LEARNT_ROLE = "assistant"
#: They differ in their first and in their last character.
PROBES = ("probe", "other")

TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
_ESCAPED = re.compile(r"\\(.)", re.S)
_WRITTEN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)


def escape(text: str) -> str:
    """``text`` without any control string; :func:`unescape` restores it."""
    if "\\" not in text and "<|" not in text:
        return text
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def append_only(render: Render) -> Render:
    """Declares that what a turn adds depends on no turn but itself and the ``CONTEXT`` before it, and nothing is rewritten."""
    render.append_only = True
    return render


@append_only
def template(turns: list[tuple[str, str]]) -> str:
    """The library's own template."""
    return "".join(f"{TURN}{escape(role)}{BODY}{escape(text)}{END}" for role, text in turns)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of what :func:`template` wrote."""
    return [(unescape(role), unescape(text)) for role, text in _WRITTEN.findall(formatted)]


def _common(a: str, b: str) -> int:
    """Characters that two strings have in common from the start."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


class Prefixes:
    """Turn after turn of one conversation under a template; with ``whole`` a declaration does not count."""

    def __init__(self, render: Render, whole: bool = False):
        self.render = render
        self.declared = not whole and getattr(render, "append_only", False)
        self.turns: list[tuple[str, str]] = []
        self.before = render([])
        self.so_far: list[tuple[str, str]] = []
        self.written = [self.before]

    def add(self, role: str, text: str, locate: bool) -> tuple[str, int, int, bool]:
        """(what the turn adds, start and end of its text therein, history rewritten).

        Start and end are -1 if not asked for, or if the text is not in one stretch.
        """
        turns = [*self.turns, (role, text)]
        after = self.render(turns)
        kept = len(self.before)
        rewritten = not after.startswith(self.before)
        if rewritten:
            kept = _common(self.before, after)
        start = end = -1
        if locate:
            one, two = (self.render([*self.turns, (role, probe)]) for probe in PROBES)
            if one[:kept] == two[:kept] == after[:kept]:
                added, one, two = after[kept:], one[kept:], two[kept:]
                head = _common(one, two)
                tail = _common(one[head:][::-1], two[head:][::-1])
                if (
                    one[head : len(one) - tail] == PROBES[0]
                    and added[:head] == one[:head]
                    and head + tail <= len(added)
                    and added.endswith(one[len(one) - tail :])
                ):
                    start, end = head, len(added) - tail
        if self.declared:
            rewritten |= self._denied(role, text, after[kept:])
        if self.declared and len(turns) > CONTEXT:
            self.turns = turns[-CONTEXT:]
            self.before = self.render(self.turns)
        else:
            self.turns, self.before = turns, after
        return after[kept:], start, end, rewritten

    def _denied(self, role: str, text: str, added: str) -> bool:
        """Whether the whole, rendered at a doubling number of turns, is not what the turns added."""
        self.so_far.append((role, text))
        self.written.append(added)
        n = len(self.so_far)
        if n & (n - 1) and n != CONTEXT + 1:
            return False
        return self.render(self.so_far) != "".join(self.written)


_SPAN = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("number", pa.int64()),
        ("role", pa.string()),
        ("formatted", pa.string()),
        ("text_start", pa.int64()),
        ("text_end", pa.int64()),
        ("learnt", pa.bool_()),
        ("rewritten", pa.bool_()),
    ]
)
_SPAN_DDL = (
    "conv_id long, number long, role string, formatted string, text_start long, text_end long, "
    "learnt boolean, rewritten boolean"
)


def _formatter(render: Render, learnt_role: str, whole: bool = True):
    """Batches of ordered turns to batches of what they add."""

    def run(batches):
        current, prefixes, number = object(), None, 0
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))
            for conv_id, role, text in rows:
                if prefixes is None or conv_id != current:
                    current, prefixes, number = conv_id, Prefixes(render, whole), 0
                role, text = role or "", text or ""
                learnt = role == learnt_role
                added, start, end, rewritten = prefixes.add(role, text, learnt)
                out.append((conv_id, number, role, added, start, end, learnt, rewritten))
                number += 1
            if out:
                yield record_batch(_SPAN, *zip(*out))

    return run


def _ordered(conversations: DataFrame) -> DataFrame:
    turns = short_batches(conversations).select("conv_id", "turn", "role", "text").repartition("conv_id")
    return turns.sortWithinPartitions("conv_id", "turn", "role", "text")


def formatted_turns(
    conversations: DataFrame, render: Render = template, learnt_role: str = LEARNT_ROLE, whole: bool = True
) -> DataFrame:
    """One row a turn, in order within a partition: what it adds to the output, and where its text lies.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text``; null roles
    and texts are empty. Turns of equal number follow each other by role and text;
    repeated rows are turns of their own; null turns come first. Rows without a
    ``conv_id`` are one conversation. ``learnt`` marks the turns under the loss
    mask: those of ``learnt_role``. Other columns are ignored. Every prefix is rendered
    whole; without ``whole`` declared templates go on from the last turns.
    """
    return _ordered(conversations).mapInArrow(_formatter(render, learnt_role, whole), _SPAN_DDL)


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("rewritten", pa.bool_()),
    ]
)


class _Running:
    """What is added up over one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.n, self.chars, self.loss, self.rewritten = conv_id, 0, 0, 0, False
        self.all, self.under = hashlib.sha256(), hashlib.sha256()

    def row(self):
        return (
            self.conv_id, self.n, self.all.hexdigest(), self.loss, self.under.hexdigest(), self.chars, self.rewritten,
        )


def _digested(batches):
    """Rows of formatted turns to one row a conversation."""
    now = None
    for batch in batches:
        out = []
        names = ("conv_id", "formatted", "text_start", "text_end", "learnt", "rewritten")
        for conv_id, formatted, start, end, learnt, rewritten in zip(*(batch.column(c).to_pylist() for c in names)):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    out.append(now.row())
                now = _Running(conv_id)
            now.chars += len(formatted)
            now.rewritten |= rewritten
            for role, text in read_back(formatted):
                now.n += 1
                now.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if learnt:
                if start < 0:
                    raise ValueError(f"the template does not hold the text of conversation {conv_id} in one stretch")
                text = unescape(formatted[start:end])
                now.loss += len(text)
                now.under.update(text.encode("utf-8", "surrogatepass"))
        if out:
            yield record_batch(_DIGEST, *zip(*out))
    if now is not None:
        yield record_batch(_DIGEST, *zip(now.row()))


def digests(conversations: DataFrame, learnt_role: str = LEARNT_ROLE) -> DataFrame:
    """One row a conversation, read back from what :func:`formatted_turns` makes with the own template.

    Digests of turns and of the text under the loss mask go over a conversation
    from beginning to end, so one task reads it, as a stream. Formatting and
    reading back are one step, so that a task needs one Python worker.
    """
    form = _formatter(template, learnt_role)

    def run(batches):
        return _digested(form(batches))

    return _ordered(conversations).mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, rewritten boolean",
    )


def with_trial(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -1, whose texts look like control strings of other templates."""
    text = "</s>[INST] ok [/INST]"
    trial = conversations.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(trial)
