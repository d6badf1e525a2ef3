"""Phrase collocations from weighted acyclic automata of word sequences.

Phrases are counted length after length.  A phrase is common only if its
beginning and its end, one word shorter, are, so a pass reads whole texts and
looks at those sequences alone whose two parts are in a bitmap of the common
shorter ones.  The bitmap has a fixed size; two parts that share a bit only
let a sequence through that the exact count drops.  A shard's sequences become
a weighted automaton, split by prefix range (a hash of the first two words, so
that one common word does not fill a range); a range's automata are united and
their counts summed.  Parts are counted by walking the united automata: first
parts lie on a phrase's own path, last parts are asked from the range of their
own first words.

Words are 64-bit names of (language, word); the count of all words checks that
no two share a name and takes another seed if they do, so counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import automata
from tidemark.llm.common import (MULT, STEP_BYTES, blocks, mix, prefix_hash, ranges, released, small_batches, span_hash, stored, table,
                                 text_buffers, text_or_empty)

#: Bits of the bitmap of common parts (4 MB).
BITS = 1 << 25
#: A shard's automaton is sent on when it has this many arcs.
ARCS = 3 << 18
#: Words of the corpus for each prefix range.
RANGE_WORDS = 1 << 17

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Words:
    """The words of a block of texts: names, places in the lower-cased bytes, and whether one follows on the last in its piece."""

    def __init__(self, texts: pa.Array, langs: list[str], seed: int):
        data, offsets = text_buffers(texts)
        self.data = _LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        has = np.diff(offsets) > 0
        first[offsets[:-1][has]] |= inside[offsets[:-1][has]]
        last[offsets[1:][has] - 1] |= inside[offsets[1:][has] - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        breaks = np.cumsum(kind == 2, dtype=np.int64)
        self.follows = np.zeros(len(self.start), bool)
        self.follows[1:] = (self.doc[1:] == self.doc[:-1]) & (breaks[self.start[1:]] == breaks[self.end[:-1] - 1])
        names = {x: i for i, x in enumerate(sorted(set(langs)))}
        joined = np.frombuffer("".join(names).encode(), np.uint8)
        ends = np.cumsum([0] + [len(x.encode()) for x in names])
        of = mix(span_hash(prefix_hash(joined), ends[:-1], ends[1:]) + np.uint64(seed))
        self.lang = np.array([names[x] for x in langs], np.int64)
        self.langs = list(names)
        self.key = mix(span_hash(prefix_hash(self.data), self.start, self.end) + of[self.lang[self.doc]]) if len(self.doc) else np.zeros(0, np.uint64)


def _longer(name: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Names of sequences one word longer."""
    return mix(name * np.uint64(MULT) + key)


def _source(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(text_or_empty(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))


def count_words(source: DataFrame, seed: int) -> DataFrame:
    """``(key, lang, word, f)`` of every word of every language."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, 0, STEP_BYTES):
                w = _Words(part.column(0), part.column(1).to_pylist(), seed)
                key, at, n = np.unique(w.key, return_index=True, return_counts=True)
                length = w.end[at] - w.start[at]
                ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                word = pa.StringArray.from_buffers(len(key), pa.py_buffer(ends.tobytes()),
                                                   pa.py_buffer(w.data[ranges(w.start[at], length)].tobytes()))
                lang = pa.array(w.langs, pa.string()).take(pa.array(w.lang[w.doc[at]], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), lang, word, pa.array(n)], ["key", "lang", "word", "f"])

    found = source.mapInArrow(run, "key long, lang string, word string, f long")
    return found.groupBy("key", "lang", "word").agg(F.sum("f").alias("f"))


def _bitmap(names: DataFrame) -> np.ndarray:
    """The fixed-size bitmap of a table of names: bits are set in tasks, at most ``BITS / 2**15`` pieces of 4 KB come back."""
    place = names.select((F.col("key").bitwiseAND(F.lit(BITS - 1))).alias("p"))
    pieces = place.groupBy(F.shiftright("p", 15).alias("piece")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(32767))).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in pieces.collect():
        out[r["piece"] * 4096:(r["piece"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _has(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    p = names & np.uint64(8 * len(bits) - 1)
    return (bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _range(first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    return _longer(mix(first), second) % np.uint64(n)


def _united(parts: DataFrame, least: int) -> DataFrame:
    """One automaton for each range, ``(range, a)``, from rows of the same columns; counts below ``least`` are cut.

    A range's rows come one after another and are united as they come, so the
    memory of a task is that of one range's distinct sequences.
    """
    arcs = ARCS

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0

        def out():
            rest = automata.pruned(automata.union(held), least)
            if len(rest[-1][0]):
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([automata.dump(rest)], pa.binary())], ["range", "a"])

        for batch in batches:
            for r, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if r != now:
                    if held:
                        yield from out()
                    now, held, size = r, [], 0
                held.append(automata.load(data.as_py()))
                size += sum(len(x[0]) for x in held[-1])
                if len(held) > 1 and size > 2 * sum(len(x[0]) for x in held[0]) + arcs // 4:
                    held = [automata.union(held)]
                    size = sum(len(x[0]) for x in held[0])
        if held:
            yield from out()

    return parts.repartition("range").sortWithinPartitions("range").mapInArrow(run, "range int, a binary")


def count_phrases(source: DataFrame, length: int, parts: np.ndarray, n_ranges: int, least: int, seed: int) -> DataFrame:
    """``(range, a)``: automata of the sequences of ``length`` words counted ``least`` times or more."""
    bits, arcs = source.sparkSession.sparkContext.broadcast(parts), ARCS

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held, size = [], 0
        for batch in batches:
            for part in blocks(batch, 0, STEP_BYTES):
                w = _Words(part.column(0), part.column(1).to_pylist(), seed)
                m = len(w.key) - length + 1
                if m <= 0:
                    continue
                name, ok = w.key, np.ones(len(w.key), bool)
                for k in range(1, length - 1):  # names of the parts, one word shorter
                    ok = ok[:-1] & w.follows[k:]
                    name = _longer(name[:-1], w.key[k:])
                ok &= _has(bits.value, name)
                at = np.flatnonzero(ok[:m] & ok[1:m + 1] & w.follows[length - 1:])
                if not len(at):
                    continue
                columns = [w.key[at + k] for k in range(length)]
                held.append(automata.build([_range(columns[0], columns[1], n_ranges), *columns]))
                size += sum(len(x[0]) for x in held[-1])
                if size > 2 * arcs:
                    held = [automata.union(held)]
                    size = sum(len(x[0]) for x in held[0])
                    if size > arcs:
                        yield held[0]
                        held, size = [], 0
        if held:
            yield automata.union(held)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in shards(batches):
            pieces = automata.split(whole)
            for k in range(0, len(pieces), 256):
                some = pieces[k:k + 256]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in some], pa.int32()),
                                                  pa.array([automata.dump(p) for _, p in some], pa.binary())], ["range", "a"])

    return _united(source.mapInArrow(run, "range int, a binary"), least)


def _names(counted: DataFrame) -> DataFrame:
    """``key``: the names of the deepest sequences of stored automata."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                levels = automata.load(data.as_py())
                path = automata.paths(levels, len(levels) - 1)
                name = path[:, 1]
                for k in range(2, path.shape[1]):
                    name = _longer(name, path[:, k])
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64))], ["key"])

    return counted.select("a").mapInArrow(run, "key long")


_CANDIDATE = "id long, words array<long>, a long, firsts array<long>, suffix array<int>, dropped boolean"


def _candidates(whole: DataFrame, n_ranges: int) -> DataFrame:
    """Every phrase with its count, those of its first parts of two words or more, the ranges of its last parts,
    and whether a phrase one word longer at the end is as frequent.  ``id`` is the range and the state's place."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                levels = automata.load(data.as_py())
                before = np.zeros(0, np.int64)
                offset, rows = 0, []
                for d in range(2, len(levels)):
                    source, _, weight = levels[d]
                    path = automata.paths(levels, d)[:, 1:]
                    longer = np.zeros(len(weight), np.int64)
                    if d + 1 < len(levels):
                        np.maximum.at(longer, levels[d + 1][0], levels[d + 1][2])
                    firsts = np.zeros((len(weight), 0), np.int64) if d == 2 else np.column_stack([before[source], levels[d - 1][2][source]])
                    before = firsts
                    suffix = np.column_stack([np.zeros((len(weight), 0), np.int64)] + [
                        _range(path[:, k], path[:, k + 1], n_ranges).astype(np.int64)[:, None] for k in range(1, d - 1)])
                    ids = (r << 32) + offset + np.arange(len(weight))
                    offset += len(weight)
                    rows.append(pd.DataFrame({
                        "id": ids, "words": list(path.view(np.int64)), "a": weight, "firsts": list(firsts),
                        "suffix": list(suffix.astype(np.int32)), "dropped": longer >= weight}))
                if rows:
                    frame = pd.concat(rows, ignore_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(frame["id"], pa.int64()), pa.array(frame["words"].tolist(), pa.list_(pa.int64())), pa.array(frame["a"], pa.int64()),
                         pa.array(frame["firsts"].tolist(), pa.list_(pa.int64())), pa.array(frame["suffix"].tolist(), pa.list_(pa.int32())),
                         pa.array(frame["dropped"], pa.bool_())], ["id", "words", "a", "firsts", "suffix", "dropped"])

    return whole.mapInArrow(run, _CANDIDATE)


def _last_parts(whole: DataFrame, asked: DataFrame) -> DataFrame:
    """``(id, k, f)``: the count of each asked sequence, and with ``k`` 0 the phrases that a phrase one word longer at
    the beginning equals in count.  Requests and a range's automaton meet in one group and are read side by side."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"id": pd.Series(dtype="int64"), "k": pd.Series(dtype="int32"), "f": pd.Series(dtype="int64")})]
        if len(left) and len(right):
            r = int(left["range"].iloc[0])
            levels = automata.load(left["a"].iloc[0])
            offset = np.cumsum([0, 0, 0] + [len(x[0]) for x in levels[2:]])
            for size, rows in right.groupby(right["words"].map(len)):
                words = np.array(rows["words"].tolist(), np.int64).view(np.uint64)
                state = automata.read(levels, [np.full(len(rows), r, np.uint64), *words.T])
                count = levels[size][2][state]
                out.append(pd.DataFrame({"id": rows["id"].to_numpy(), "k": rows["k"].to_numpy(np.int32), "f": count}))
                equal = (rows["k"].to_numpy() == 1) & (rows["a"].to_numpy() >= count)
                gone = np.unique(state[equal])
                out.append(pd.DataFrame({"id": (r << 32) + offset[size] + gone, "k": np.zeros(len(gone), np.int32), "f": np.ones(len(gone), np.int64)}))
        return pd.concat(out, ignore_index=True)

    return whole.groupBy("range").cogroup(asked.groupBy("range")).applyInPandas(run, "id long, k int, f long")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of 2 to ``longest`` words.

    A-Z are lower-cased; pieces end at ``. , ; : ! ?`` and line ends, words at
    blanks and tabs.  ``a`` counts a phrase, ``l`` and ``r`` the parts of its
    weakest cut, ``n`` the words of the language; ``score`` is
    ``floor(1000 a n / (l r))``, in whole numbers.  Phrases counted fewer than
    ``least`` times are left out, and those inside a longer one just as
    frequent.  Order: score, ``a`` (both descending), phrase in UTF-8.

    A null text is empty, a null language ``und`` (one language with a given
    ``und``).  Repeated rows count each; ids and further columns are not read.
    Empty tables, or texts without words, give no rows.
    """
    source = _source(docs, text, lang)
    with small_batches(docs.sparkSession):
        seed = 0
        while True:
            words = stored(count_words(source, seed), "words")
            if not words.groupBy("key").count().filter("count > 1").head(1):
                break
            seed += 1
        totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
        common = words.filter(F.col("f") >= least)
        n = words.agg(F.sum("f")).head()[0] or 0
        n_ranges = max(16, n // RANGE_WORDS)
        counted, bits = None, _bitmap(common)
        for length in range(2, longest + 1):
            level = stored(count_phrases(source, length, bits, n_ranges, least, seed), "phrases")
            counted = level if counted is None else counted.unionByName(level)
            bits = _bitmap(_names(level))
            if not bits.any():
                break
        whole = stored(_united(counted, least), "automata")
        found = stored(_candidates(whole, n_ranges), "candidates")
    asked = (found.filter(F.size("words") > 2).select("id", "a", "words", F.posexplode("suffix").alias("p", "range"))
             .select("id", "a", "range", (F.col("p") + 1).alias("k"), F.expr("slice(words, p + 2, size(words) - p - 1)").alias("words")))
    of = _last_parts(whole, asked).groupBy("id").agg(
        F.max(F.col("k") == 0).alias("inside"), *[F.max(F.when(F.col("k") == k, F.col("f"))).alias(f"f{k}") for k in range(1, longest - 1)])
    kept = found.join(of, "id", "left").filter(~F.col("dropped") & ~F.coalesce("inside", F.lit(False)))
    spelt = (kept.select("*", F.posexplode("words").alias("p", "key")).join(common, "key").groupBy("id").agg(
        F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("p", "word", F.col("f").alias("fw")))).alias("w"),
        *[F.first(c).alias(c) for c in ("a", "firsts", *[f"f{k}" for k in range(1, longest - 1)])]))
    size = F.size("w")
    # counts of the first and the last part by cut: single words from their own table, the others from the automata
    left = F.concat(F.array(F.col("w")[0]["fw"]), F.col("firsts"))
    right = F.concat(F.slice(F.array(*[F.col(f"f{k}") for k in range(1, longest - 1)]), 1, size - 2) if longest > 2 else F.array().cast("array<long>"),
                     F.array(F.element_at("w", -1)["fw"]))
    number = lambda c: c.cast("decimal(16,0)")  # noqa: E731  (a product of two and 1000 has 37 digits at most: exact)
    cuts = F.transform(F.arrays_zip(left.alias("l"), right.alias("r")), lambda x: F.struct(x["l"].alias("l"), x["r"].alias("r")))
    scored = spelt.join(totals, "lang").withColumn("cut", F.explode(F.transform(cuts, lambda x, i: F.struct(i.alias("k"), x["l"].alias("l"), x["r"].alias("r")))))
    scored = scored.select("id", "lang", "a", "n", F.expr("concat_ws(' ', transform(w, x -> x.word))").alias("phrase"), "cut.*")
    top_of, below = number(F.col("a")) * number(F.col("n")) * F.lit(1000).cast("decimal(4,0)"), number(F.col("l")) * number(F.col("r"))
    scored = scored.withColumns({"x": top_of, "y": below}).withColumn("score", F.expr("x div y"))
    best = scored.groupBy("id", "lang", "a", "n", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    order = Window.partitionBy("lang").orderBy(F.col("m.score").desc(), F.col("a").desc(), F.col("phrase"))
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "m.l", "m.r", "n", "m.score"))


def op11(spark, sf_dir: str) -> DataFrame:
    """The collocations of all documents."""
    return collocations(table(spark, sf_dir, "documents"))
