"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. Prefixes of a
conversation are rendered one after the other. What a longer prefix adds to a shorter one is the
new turn's span; where the longer output does not begin with the shorter one, the template has
rewritten history, and the turn is marked. Within a span the text's place is found by rendering
the turn once more with a text that occurs nowhere else. The texts of trained roles are the loss
spans; only their characters count.

A conversation is rendered whole up to ``RUN_TURNS`` turns: every prefix from its first turn, so a
template that changes anything before is found however far back it looks. Prefixes of ever longer
conversations would cost the square of their length in one task. They are therefore dealt to runs of
``RUN_TURNS`` turn numbers, and a run starts from the last turn of the run before. Its last turn is rendered
from the start of the run and from its predecessor alone, and marked if that differs. What a template
does with turns more than a run back is not seen.

``marked_turns`` is the production template. It escapes its own control strings within roles and
texts with a backslash; ``read_turn`` reads a span back.

Null roles and texts are empty. Turns are ordered by turn number (null first), then role and text;
repeated rows are repeated turns. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: turns whose prefixes are rendered together
RUN_TURNS = 1024
TRAINED = ("assistant",)

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): (.*)</turn>\n\Z", re.S)
#: a text that no conversation holds: characters that Unicode leaves without meaning
PROBE = "\ufdd0\ufdd1\ufdd0"


def marked_turns(turns: Turns) -> str:
    """``### role: text</turn>`` and a line feed per turn."""
    return "".join(f"### {_ROLE_CONTROL.sub(_escape, role)}: {_CONTROL.sub(_escape, text)}</turn>\n"
                   for role, text in turns)


def _escape(found: re.Match) -> str:
    return "\\" + found[0]


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turn(span: str) -> tuple[str, str]:
    """Role and text of one rendered turn."""
    found = _TURN.match(span)
    if not found:
        raise ValueError(f"not a rendered turn: {span[:60]!r}")
    return unescaped(found[1]), unescaped(found[2])


def added(template: Template, before: str, turns: Turns) -> tuple[str, bool]:
    """What the last turn adds to ``before``, and whether that is all that changed."""
    after = template(turns)
    if after.startswith(before):
        return after[len(before):], True
    same = next((k for k, (a, b) in enumerate(zip(before, after)) if a != b), min(len(before), len(after)))
    return after[same:], False


def text_place(template: Template, before: str, turns: Turns, span: str) -> tuple[int, int] | None:
    """Where the last turn's text stands in its span, or None if that can't be told."""
    role, _ = turns[-1]
    shown, _ = added(template, before, [*turns[:-1], (role, PROBE)])
    if shown.count(PROBE) != 1:
        return None
    head, tail = shown.split(PROBE)
    if len(head) + len(tail) > len(span) or not (span.startswith(head) and span.endswith(tail)):
        return None
    return len(head), len(span) - len(tail)


def run_spans(template: Template, context: Turns, turns: Turns, trained: tuple[str, ...] = TRAINED
              ) -> Iterator[tuple[str, int, int, bool]]:
    """(span, loss start, loss end, appended) for the turns of one run; -1 without a loss."""
    prefix = list(context)
    before = template(prefix) if prefix else ""
    for k, turn in enumerate(turns):
        nearest = prefix[-1:]
        prefix.append(turn)
        span, appended = added(template, before, prefix)
        if k == len(turns) - 1 and nearest and len(prefix) > 2:
            near, _ = added(template, template(nearest), [*nearest, turn])
            appended = appended and near == span
        place = text_place(template, before, prefix, span) if turn[0] in trained else None
        appended = appended and (place is not None or turn[0] not in trained)
        before += span if appended else ""
        before = before if appended else template(prefix)
        yield span, *(place or (-1, -1)), appended


def formatted(conversations: DataFrame, template: Template = marked_turns,
              trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """Per turn: conv_id, run, place in the run, role, span, loss_start, loss_end, appended.

    The spans of a conversation by run and place are its formatted text. ``appended`` is false
    where the template changed earlier output or looked further back than one turn.
    """
    out = ("conv_id long, run long, place int, role string, span string, loss_start long, "
           "loss_end long, appended boolean")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, context, turns = None, [], []

        def finished() -> pa.RecordBatch:
            spans = list(run_spans(template, context[-1:], turns, trained))
            n = len(spans)
            columns = [[key[0]] * n, [key[1]] * n, range(n), [t[0] for t in turns],
                       *([s[k] for s in spans] for k in range(4))]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(),
                     pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              ["conv_id", "run", "place", "role", "span",
                                               "loss_start", "loss_end", "appended"])

        for batch in batches:
            for conv_id, run, is_context, role, text in zip(*(
                    batch.column(n).to_pylist() for n in ("conv_id", "run", "is_context", "role", "text"))):
                if (conv_id, run) != key:
                    if turns:
                        yield finished()
                    key, context, turns = (conv_id, run), [], []
                (context if is_context else turns).append((role, text))
        if turns:
            yield finished()

    number = F.coalesce(F.col("turn").cast("long"), F.lit(-1).cast("long"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), number.alias("number"),
        F.floor(number / RUN_TURNS).cast("long").alias("run"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # the last turn of a run is also what the next run starts from
    context = rows.filter(F.pmod("number", F.lit(RUN_TURNS)) == RUN_TURNS - 1).withColumn(
        "run", F.col("run") + 1)
    dealt = (rows.withColumn("is_context", F.lit(False))
             .unionByName(context.withColumn("is_context", F.lit(True))))
    return (dealt.repartition("conv_id", "run")
            .sortWithinPartitions("conv_id", "run", F.desc("is_context"), "number", "role", "text")
            .select("conv_id", "run", "is_context", "role", "text").mapInArrow(render, out))


def read_back(spans: DataFrame, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """Digests per conversation, read from the output of ``marked_turns``.

    A digest of a whole conversation is a sequential computation; a task streams its sorted
    turns and keeps two digests and three counts.
    """
    out = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, rows = None, []

        def finished() -> None:
            rows.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        for batch in batches:
            rows.clear()
            for conv_id, span, start, end in zip(*(
                    batch.column(n).to_pylist() for n in ("conv_id", "span", "loss_start", "loss_end"))):
                if state is None or state[0] != conv_id:
                    if state:
                        finished()
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_turn(span)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[5] += len(span)
                if start >= 0:
                    loss = unescaped(span[start:end])
                    state[3] += len(loss)
                    state[4].update(loss.encode())
            if rows:
                yield _columns(rows)
        rows.clear()
        if state:
            finished()
            yield _columns(rows)

    return (spans.select("conv_id", "run", "place", "span", "loss_start", "loss_end")
            .repartition("conv_id").sortWithinPartitions("conv_id", "run", "place")
            .select("conv_id", "span", "loss_start", "loss_end").mapInArrow(read, out))


def _columns(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
        ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
