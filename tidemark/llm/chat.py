"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A state is a role and whether the line begins a turn.  A line shows a speaker
marker (or none), how it ends and begins, and its length.  Start, transition
and emission tables are counted from labelled lines.  The lines of a
conversation are numbered without gaps (counts per sorted range, then offsets)
and cut by that number into blocks of a fixed number of rows: each block gives,
for every state before it, the best way through it; a pass over the blocks in order and one in reverse settle the
states at their edges, and the lines inside follow.  This is the Viterbi path
of the whole conversation, with one block in memory at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import stored, table

ROLES = ("system", "user", "assistant")
#: Words of speaker markers (fixed values).
MARKERS = {
    "system": "system sys instruction instructions context".split(),
    "user": "user human customer question q prompter".split(),
    "assistant": "assistant ai bot agent answer a model".split(),
}
#: Lines in a block.
SPAN = 256
#: Characters of a text by which ranges of lines are cut; equal texts that are no longer are dealt over ranges.
HEAD = 64

_CLASS = {w: i + 1 for i, r in enumerate(ROLES) for w in MARKERS[r]}
_MARKER = re.compile(r"\s*[\[<(*#|]{0,4}\s*([A-Za-z]{1,12})\s*(?:[\])*|]{1,3}\s*:?|>{1,2}|:[*]{0,2})(?:\s+|$)")
_SIZES = (5, 3, 4, 3)  # values of each feature
N = 2 * len(ROLES)  # state 2r begins a turn of role r, 2r + 1 goes on with it


def features(line: str) -> tuple[int, int, int, int]:
    """Marker (none, the three roles, another word), ending, length, beginning."""
    m = _MARKER.match(line)
    marker = 0 if not m else _CLASS.get(m[1].lower(), 4)
    bare = line.strip()
    ending = 1 if bare.endswith("?") else 2 if bare.endswith((".", "!", ":")) else 0
    length = 0 if not bare else 1 if len(bare) < 40 else 2 if len(bare) < 160 else 3
    beginning = 0 if bare[:1].isupper() else 1 if bare[:1].islower() else 2
    return marker, ending, length, beginning


def unmarked(line: str) -> str:
    m = _MARKER.match(line)
    return line[m.end():] if m and m[1].lower() in _CLASS else line


class Model:
    """Logarithms of the tables, from counts with one added to each possible cell."""

    def __init__(self, counts: dict[tuple[str, int, int], int]):
        start = np.array([1.0 + counts.get(("start", s, 0), 0) for s in range(N)])
        start[1::2] = 1e-9  # a conversation begins with a turn
        move = np.array([[1.0 + counts.get(("move", s, t), 0) for t in range(N)] for s in range(N)])
        for r in range(len(ROLES)):
            for q in range(len(ROLES)):
                if q != r:
                    move[2 * r:2 * r + 2, 2 * q + 1] = 1e-9  # a turn goes on in its own role
        self.start, self.move = np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True))
        self.show = []
        for f, size in enumerate(_SIZES):
            c = np.array([[1.0 + counts.get((f"show{f}", s, v), 0) for v in range(size)] for s in range(N)])
            self.show.append(np.log(c / c.sum(1, keepdims=True)))

    def scores(self, lines: list[str]) -> np.ndarray:
        seen = np.array([features(x) for x in lines])
        return sum(table[:, seen[:, f]].T for f, table in enumerate(self.show))

    def through(self, e: np.ndarray) -> np.ndarray:
        """Best score of a way through a block's lines from each state before it to each state at its end."""
        best = self.move + e[0]
        for x in e[1:]:
            best = (best[:, :, None] + self.move).max(1) + x
        return best

    def path(self, e: np.ndarray, before: int, end: int) -> list[int]:
        """States of a block's lines; ``before`` -1 for a conversation's first block."""
        best, back = (self.start if before < 0 else self.move[before]) + e[0], []
        for x in e[1:]:
            way = best[:, None] + self.move
            back.append(way.argmax(0))
            best = way.max(0) + x
        out = [end]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first ``keys`` columns."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != key and held:
                yield key, held
                held = []
            key = row[:keys]
            held.append(row[keys:])
    if held:
        yield key, held


def _sorted(lines: DataFrame, *more: str) -> DataFrame:
    """Lines in the order of conversation, number (null last), text, ``more``: ranges in the order of the
    partitions, each sorted.  Equal rows can be dealt over ranges, so no key needs to fit into one."""
    rows = lines.select("conv", "line", F.coalesce("text", F.lit("")).alias("text"), *more)
    deal = F.when(F.char_length("text") <= HEAD, F.struct(*more, F.rand(1).alias("by")))  # null, so last: a longer text
    rows = rows.withColumn("head", F.substring("text", 1, HEAD)).withColumn("deal", deal)
    line = F.asc_nulls_last("line")
    ranged = rows.repartitionByRange(F.asc("conv"), line, F.asc("head"), F.asc_nulls_last("deal")).drop("head", "deal")
    return ranged.sortWithinPartitions("conv", line, "text", *more)


def _blocks(lines: DataFrame, span: int) -> DataFrame:
    """``(conv, block, number, line, text)``: lines numbered from 0 without gaps in each conversation, ``span`` to a block."""
    rows = stored(_sorted(lines).withColumn("at", F.monotonically_increasing_id()), "chat-lines")
    part = F.shiftright("at", 33)  # the partition's place; the lower bits count its rows
    sizes = rows.groupBy("conv", part.alias("part")).agg(F.min("at").alias("low"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low")
    sizes = stored(sizes.select(F.col("conv").alias("c"), F.col("part").alias("p"), shift.alias("shift")), "chat-ranges")
    rows = rows.withColumn("part", part).join(sizes, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    number = F.col("at") + F.col("shift")
    return rows.select("conv", F.floor(number / F.lit(span)).cast("long").alias("block"), number.alias("number"), "line", "text")


def train(lines: DataFrame, span: int = SPAN) -> Model:
    """Counts from labelled lines: ``conv``, ``line``, ``text``, ``role``, ``first`` (the line begins a turn).

    All lines and all moves are counted, whatever ``span``; what returns is one
    row for each cell of the tables and the first and last line's state of
    each range.  Lines of other roles are not counted.
    """
    known = lines.filter(F.col("role").isin(*ROLES))
    conv = lines.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        counts: Counter = Counter()
        kind, now, state, first = None, None, None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for c, _, text, role, begins in zip(*(x.to_pylist() for x in batch.columns)):
                last, state = state, 2 * ROLES.index(role) + (0 if begins else 1)
                if last is None:
                    first = (c, state)  # what stands before it is another range's
                elif c == now:
                    counts["move", last, state] += 1
                else:
                    counts["start", state, 0] += 1
                for f, v in enumerate(features(text)):
                    counts[f"show{f}", state, v] += 1
                now = c
        if first is None:
            return
        edges = [("first", part, first[1], 0, first[0]), ("last", part, state, 0, now)]
        columns = zip(*edges, *((*k, n, None) for k, n in counts.items()))
        types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), kind]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], ["kind", "i", "j", "n", "conv"])

    found = stored(_sorted(known, "role", "first").mapInArrow(run, f"kind string, i int, j int, n long, conv {conv}"), "cells")
    edge = F.col("kind").isin("first", "last")
    cells = found.filter(~edge).groupBy("kind", "i", "j").agg(F.sum("n").alias("n"))
    counts: Counter = Counter({(r["kind"], r["i"], r["j"]): r["n"] for r in cells.collect()})
    before = None
    for r in sorted(found.filter(edge).collect(), key=lambda r: (r["i"], r["kind"])):
        if r["kind"] == "last":
            before = r
        elif before is not None and before["conv"] == r["conv"]:
            counts["move", before["j"], r["j"]] += 1
        else:
            counts["start", r["j"], 0] += 1
    return Model(counts)


def _edges(found: DataFrame, conv: str, model: Model) -> DataFrame:
    """``(conv, block, before, end)``: the states at the edges of every block on the best path."""
    def ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Best scores of arriving in each state before each block, in order."""
        for batch in _converted(batches, lambda: _Ahead(model), ["conv", "block", "way", "arrive"]):
            yield batch

    def behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """States at the edges, from the last block backwards."""
        for batch in _converted(batches, lambda: _Behind(model), ["conv", "block", "before", "end"]):
            yield batch

    forward = (found.repartition("conv").sortWithinPartitions("conv", "block")
               .mapInArrow(ahead, f"conv {conv}, block long, way array<double>, arrive array<double>"))
    return (stored(forward, "arrivals").repartition("conv").sortWithinPartitions("conv", F.desc("block"))
            .mapInArrow(behind, f"conv {conv}, block long, before int, end int"))


def _converted(batches, make: Callable, names: list[str]) -> Iterator[pa.RecordBatch]:
    step = make()
    for batch in batches:
        rows = [step(*row) for row in zip(*(c.to_pylist() for c in batch.columns))]
        columns = list(zip(*rows)) or [()] * len(names)
        kinds = {"way": pa.list_(pa.float64()), "arrive": pa.list_(pa.float64()), "block": pa.int64(), "before": pa.int32(), "end": pa.int32()}
        yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field(0).type if n == "conv" else kinds[n]) for n, c in zip(names, columns)], names)


class _Ahead:
    def __init__(self, model: Model):
        self.model, self.conv, self.best = model, object(), None

    def __call__(self, conv, block, way, opening):
        if conv != self.conv:
            self.conv, arrive, self.best = conv, [], np.array(opening)
        else:
            arrive = self.best.tolist()
            self.best = (self.best[:, None] + np.array(way).reshape(N, N)).max(0)
        self.best = self.best - self.best.max()  # only differences matter
        return conv, block, way if arrive else opening, arrive


class _Behind:
    def __init__(self, model: Model):
        self.conv, self.end = object(), None

    def __call__(self, conv, block, way, arrive):
        if not arrive:  # the first block: its way is the score of each end
            end = self.end if conv == self.conv else int(np.argmax(way))
            self.conv = object()
            return conv, block, -1, end
        way = np.array(way).reshape(N, N) + np.array(arrive)[:, None]
        end = self.end if conv == self.conv else int(way.max(0).argmax())
        before = int(way[:, end].argmax())
        self.conv, self.end = conv, before
        return conv, block, before, end


def parse(lines: DataFrame, model: Model, span: int = SPAN) -> DataFrame:
    """``(conv, block, line, text, role, first)`` of every line: the role and whether a turn begins.

    ``lines``: ``conv`` (a conversation's id, null is one of its own),
    ``line`` (its number or anything with an order, null last), ``text`` (null:
    empty).  Ties in number are read in the order of their texts; repeated lines
    stay.  ``span``: lines that go into one block, the most that a task holds.
    """
    conv = lines.schema["conv"].dataType.simpleString()
    blocks = _blocks(lines, span)
    in_order = blocks.select("conv", "block", "text", "number").repartition("conv", "block").sortWithinPartitions("conv", "block", "number")

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        def typed():
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                yield b
        for (c, block), rows in _groups(typed(), 2):
            e = model.scores([r[0] for r in rows])
            opening = model.start + e[0]
            for x in e[1:]:
                opening = (opening[:, None] + model.move).max(0) + x
            yield pa.RecordBatch.from_arrays([pa.array([c], kind), pa.array([block], pa.int64()), pa.array([model.through(e).ravel().tolist()], pa.list_(pa.float64())),
                                              pa.array([opening.tolist()], pa.list_(pa.float64()))], ["conv", "block", "way", "opening"])

    found = stored(in_order.mapInArrow(ways, f"conv {conv}, block long, way array<double>, opening array<double>"), "ways")
    edges = _edges(found, conv, model)
    joined = blocks.join(edges.withColumnsRenamed({"conv": "c", "block": "b"}), F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    joined = joined.select("conv", "block", "before", "end", "line", "text", "number").repartition("conv", "block").sortWithinPartitions(
        "conv", "block", "number")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = []
        def typed():
            for b in batches:
                kinds[:] = [b.schema.field(0).type, b.schema.field(4).type]
                yield b
        for (c, block, before, end), rows in _groups(typed(), 4):
            states = model.path(model.scores([r[1] for r in rows]), before, end)
            n = len(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array([c] * n, kinds[0]), pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array([r[0] for r in rows], kinds[1]),
                pa.array([r[1] for r in rows], pa.string()), pa.array([ROLES[s // 2] for s in states], pa.string()), pa.array([s % 2 == 0 for s in states], pa.bool_()),
            ], ["conv", "block", "place", "line", "text", "role", "first"])

    number = lines.schema["line"].dataType.simpleString()
    return joined.mapInArrow(settle, f"conv {conv}, block long, place long, line {number}, text string, role string, first boolean")


@F.pandas_udf(T.StringType())
def unmark(text: pd.Series) -> pd.Series:
    return text.map(unmarked)


def turns(parsed: DataFrame) -> DataFrame:
    """``(conv, turn, role, n_lines, rendered)``: a row for each turn, markers off, between its role's tags.

    Turns are numbered from 0 by counting beginnings block by block, so no
    conversation is gathered; only the lines of one turn come together.
    """
    parsed = stored(parsed, "parsed")
    sizes = parsed.groupBy("conv", "block").agg(F.sum(F.col("first").cast("long")).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    sizes = sizes.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv", "block").orderBy("place")
    counted = parsed.withColumn("own", F.sum(F.col("first").cast("long")).over(inside))
    counted = counted.join(sizes, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    plain = F.when(F.col("first"), unmark("text")).otherwise(F.col("text"))
    turn = (counted.groupBy("conv", (F.col("before") + F.col("own") - 1).alias("turn"))
            .agg(F.max("role").alias("role"), F.count("*").alias("n_lines"),
                 F.array_sort(F.collect_list(F.struct("block", "place", plain.alias("t")))).alias("l")))
    text = F.array_join(F.transform("l", lambda x: x["t"]), "\n")
    return turn.select("conv", "turn", "role", "n_lines", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), text, F.lit("\n<|end|>\n")).alias("rendered"))


def transcripts(conversations: DataFrame) -> DataFrame:
    """Labelled transcript lines of a table of turns, as plain chat logs have them.

    A conversation writes its speakers in one of six ways; one turn in six has
    no marker.  A line's number is its turn's (null last) and its place there.
    Repeated rows are one turn.
    """
    styles = (("System", "User", "Assistant", ": "), ("SYSTEM", "HUMAN", "AI", ": "), ("[system]", "[user]", "[assistant]", " "),
              ("Context", "Q", "A", ": "), ("### Instruction", "### Human", "### Assistant", ": "), ("sys", "customer", "agent", "> "))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(styles)))
    names = F.array(*[F.array(*map(F.lit, s[:3])) for s in styles])
    after = F.array(*[F.lit(s[3]) for s in styles])
    place = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int")
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(6)) == 0) | (place == 0)
    marker = F.when(F.coalesce(bare, F.lit(True)), "").otherwise(
        F.concat(F.element_at(F.element_at(names, (style + 1).cast("int")), F.greatest(place, F.lit(1))), F.element_at(after, (style + 1).cast("int"))))
    rows = conversations.select("conv_id", "turn", "role", "text").distinct()
    rows = rows.withColumn("marker", marker).select("*", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("k", "t"))
    first = F.col("k") == 0
    return rows.select(F.col("conv_id").alias("conv"), F.struct(F.col("turn").isNull().alias("unnumbered"), "turn", "k").alias("line"),
                       F.when(first, F.concat("marker", "t")).otherwise(F.col("t")).alias("text"), "role", first.alias("first"))


def op9(spark, sf_dir: str) -> DataFrame:
    """All conversations, written as transcripts, parsed and rendered turn by turn; the model counts three ids in four."""
    lines = stored(transcripts(table(spark, sf_dir, "conversations")), "transcripts")
    learned = lines.filter(F.crc32(F.coalesce(F.col("conv").cast("string"), F.lit("")).cast("binary")) % 4 != 2)
    found = turns(parse(lines.select("conv", "line", "text"), train(learned)))
    return found.withColumnRenamed("conv", "conv_id")
