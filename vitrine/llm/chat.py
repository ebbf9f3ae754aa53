"""Chat formatting by incremental black-box rendering.

``render`` is any function from a list of ``(role, text)`` turns to one string; nothing else is known of it.
Successive prefixes of a conversation are rendered and consecutive outputs compared: what a prefix adds is the
new turn's span; an output that does not begin with the one before shows a template that rewrites history, and
the conversation is flagged from that turn on.  Where a turn's text lies inside its span is found by rendering
the same prefix with two one-letter texts: their common beginning and end are the turn's marks.

Turns are numbered by their place in the conversation (whatever gaps or repeats the turn numbers have) and cut into
chunks of ``CHUNK`` turns.  A chunk's prefixes are rendered after the whole earlier conversation, so a template may
depend on, or rewrite, anything before; the work of a conversation grows with the square of its length, as that of
rendering every prefix does, and is spread over its chunks.  ``digests`` streams over the sorted chunks of a
conversation and holds one chunk at a time.

A conversation's text is its chunks' texts in turn.  Where history was rewritten, no span of the conversation holds in
the end, so all of its spans (and its loss) are empty, however it is cut into chunks.  ``rewritten`` is not negative from
the chunk on in which that happened; the last chunk's text then is that of the whole conversation, which takes the
place of those before, and chunks between have what was rendered up to their end or nothing.

The template of this module marks turns and escapes: a backslash goes before every backslash, ``<``, ``[`` and
``]`` of a role or text, so no control string can occur inside one, and ``read_back`` returns every turn.

Defined results.  Turns are ordered by turn number (null first), then role, then text; repeated rows are turns
of their own.  Null role or text: empty.  A null ``conv_id`` is a conversation like any other.  Empty table: no
rows.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]

CHUNK = 64
LEARNED_ROLE = "assistant"

_SPECIAL = re.compile(r"[\\<\[\]]")
_BODY = r"((?:\\.|[^\\<\[\]])*)"
_TURN = re.compile(rf"(?s)<s>\[INST\] {_BODY} \[/INST\]|<s>\[ROLE {_BODY}\] {_BODY} \[/ROLE\]| {_BODY} </s>")


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text)


def instruction_template(turns: list[Turn]) -> str:
    """Users between instruction marks, assistants up to an end mark, other roles named."""
    out = []
    for role, text in turns:
        body = escape(text)
        out.append(f"<s>[INST] {body} [/INST]" if role == "user" else f" {body} </s>" if role == "assistant"
                   else f"<s>[ROLE {escape(role)}] {body} [/ROLE]")
    return "".join(out)


def read_back(formatted: str) -> list[Turn]:
    """The turns of a string that ``instruction_template`` made."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        user, role, other, answer = m.groups()
        turns.append(("user", unescape(user)) if user is not None else (unescape(role), unescape(other)) if role is not None
                     else ("assistant", unescape(answer)))
        at = m.end()
    return turns


def _common(a: str, b: str) -> int:
    """Length of the common beginning of two strings, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def locate(render: Render, turns: list[Turn], before: list[Turn] = ()) -> tuple[str, list[tuple[int, int, int, int]], int]:
    """``(text, spans, rewritten)`` of ``turns`` rendered after ``before``.

    Spans are ``(start, end, text start, text end)`` per turn; ``rewritten`` is the first turn whose rendering
    changed what came earlier (-1: none).  If there is one, ``text`` is the whole rendering and all spans are empty.
    """
    before = list(before)
    base = previous = render(before)
    spans, rewritten = [], -1
    for i in range(len(turns)):
        output = render(before + turns[: i + 1])
        if not output.startswith(previous):
            return render(before + turns), [(0, 0, 0, 0)] * len(turns), i
        a, b = (render(before + turns[:i] + [(turns[i][0], probe)]) for probe in "ab")
        head, tail = _common(a, b), _common(a[::-1], b[::-1])
        spans.append(tuple(x - len(base) for x in (len(previous), len(output), head, len(output) - tail)))
        previous = output
    return previous[len(base):], spans, rewritten


def _chunks(conversations: DataFrame, chunk: int) -> DataFrame:
    """``(conv_id, chunk, chunks, roles, texts)``: turns numbered by place (counts of turn ranges, so no conversation
    meets in one task) and packed, with the number of the conversation's chunks."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("range", F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-(1 << 63))))
    every = Window.partitionBy("conv_id")
    earlier = every.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
              .select(F.col("conv_id").alias("__conv"), F.col("range").alias("__range"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
                      F.sum("n").over(every).alias("total")))
    within = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "text")
    placed = (rows.withColumn("n", F.row_number().over(within) - 1)
              .join(starts, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("range") == F.col("__range")))
              .withColumn("place", F.col("start") + F.col("n")).withColumn("chunk", F.floor(F.col("place") / chunk)))
    packed = placed.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"),
                                                    F.ceil(F.max("total") / chunk).alias("chunks"))
    return packed.select("conv_id", "chunk", "chunks", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))


def formatted(conversations: DataFrame, render: Render = instruction_template, learned_role: str = LEARNED_ROLE, chunk: int = CHUNK) -> DataFrame:
    """``(conv_id, chunk, text, roles, starts, ends, learned, rewritten)`` for every chunk of a conversation.

    ``starts`` and ``ends`` bound every turn's own text in ``text``; ``learned`` marks the turns under the loss mask.
    """
    rows = _chunks(conversations, chunk).withColumn("target", F.explode(F.sequence(F.col("chunk"), F.col("chunks") - 1)))
    rows = rows.select("conv_id", "target", "chunk", "chunks", "roles", "texts").repartition("conv_id", "target").sortWithinPartitions("conv_id", "target", "chunk")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))
        for (conv, number), group in groupby(each(), key=lambda r: r[:2]):
            before: list[Turn] = []
            turns: list[Turn] = []
            for _, _, _, chunks, roles, texts in group:
                before += turns
                turns = list(zip(roles, texts))
            text, spans, rewritten = locate(render, turns, before)
            whole = render(before + turns) if before and number == chunks - 1 else None
            types = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.int32(), pa.string())
            values = (conv, number, text, [r for r, _ in turns], [s[2] for s in spans], [s[3] for s in spans],
                      [r == learned_role for r, _ in turns], rewritten, whole)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)],
                                             names=["conv_id", "chunk", "text", "roles", "starts", "ends", "learned", "rewritten", "whole"])
    found = rows.mapInArrow(run, "conv_id long, chunk long, text string, roles array<string>, starts array<int>, ends array<int>, "
                                 "learned array<boolean>, rewritten int, whole string")
    first = F.min(F.when(F.col("rewritten") >= 0, F.col("chunk"))).over(Window.partitionBy("conv_id"))
    after = F.coalesce(F.col("chunk") > F.col("first"), F.lit(False))
    none = F.transform("starts", lambda x: F.lit(0))
    return found.withColumn("first", first).select(
        "conv_id", "chunk", F.when(after, F.coalesce("whole", F.lit(""))).otherwise(F.col("text")).alias("text"), "roles",
        *[F.when(F.col("first").isNotNull(), none).otherwise(F.col(c)).alias(c) for c in ("starts", "ends")],
        "learned", F.when(after, 0).otherwise(F.col("rewritten")).alias("rewritten"))


def digests(chunks: DataFrame) -> DataFrame:
    """Per conversation: what is read back from the formatted chunks, as digests."""
    rows = chunks.select("conv_id", "text", "starts", "ends", "learned", "rewritten", "chunk").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))
        out: list[tuple] = []
        for conv, group in groupby(each(), key=lambda r: r[0]):
            n, size, loss_size, rewritten = 0, 0, 0, False
            every, loss = hashlib.sha256(), hashlib.sha256()
            for _, text, starts, ends, learned, changed, _ in group:
                if changed >= 0 and text:  # takes the place of what came before
                    n, size, every = 0, 0, hashlib.sha256()
                for role, own in read_back(text):
                    every.update(f"{role}\n{own}\n".encode())
                    n += 1
                size += len(text)
                rewritten |= changed >= 0
                for a, b, counts in zip(starts, ends, learned):
                    if counts:
                        own = unescape(text[a:b])
                        loss.update(own.encode())
                        loss_size += len(own)
            out.append((conv, n, every.hexdigest(), loss_size, loss.hexdigest(), size, rewritten))
            if len(out) == 1000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[
            "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"])
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                "formatted_chars long, rewrites_history boolean")
