"""Removal of repeated byte strings with two-stage sorted suffix arrays.

A string of ``length`` bytes that starts in two places is found in four steps:

1. Every start of such a string is owned by one place near it: the smallest
   hash (the last of equals) among the short pieces inside the string.  Equal
   strings have equal owners, so only starts with the same owner hash can be
   equal.  One row is made for each owner, with the hash of its context, the
   bytes of all strings that it owns.
2. Owners seen once fall away.  Equal contexts are repeated throughout.
3. Different contexts of one owner hash are brought together and their
   suffixes sorted: those smaller than their successors directly, the rest
   induced by scans over the first-byte buckets.  Neighbours in the order
   with a common prefix of ``length`` are repeated.
4. The marked starts go back to their texts, which lose every covered byte.

Texts are told apart by a 64-bit hash and their length; equal texts have equal
results, so copies need no identity of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (BLOCK_BYTES, MULT, MULT2, STEP_BYTES, blocks, discard, prefix_hash, ranges, released, runs, span_hash, stored, table,
                                 text_buffers, text_or_empty)

#: Bytes of contexts that one suffix array holds; more contexts of other owners go to the next one.
ARRAY_BYTES = 2 << 20
#: Owner hashes with more different contexts than this compare named windows instead of one array.
HOT_CONTEXTS = 2048
#: Rows of one owner hash held at a time.
HELD = 8192


def _places(n: int) -> type:
    """The smallest kind of number for places among ``n`` values."""
    return np.int32 if n < 1 << 31 else np.int64


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, ordered by at least their first ``depth`` bytes.

    ``text``: values 0 to 256.  Suffixes smaller than their successors are
    sorted directly; a left-to-right scan over the buckets of first values then
    puts every other suffix behind those it follows in order.
    """
    n = len(text)
    place = _places(n)
    if not n:
        return np.zeros(0, place)
    text = text.astype(np.int16, copy=False)
    ext = np.append(text, np.int16(-1))
    # the type of a run of equal values is decided by the value behind it
    change = np.flatnonzero(ext[1:] != ext[:-1])
    smaller = np.repeat(ext[change + 1] > ext[change], np.diff(change, prepend=-1))
    del ext, change
    order = _sort_directly(text, np.flatnonzero(smaller).astype(place), depth)
    del smaller
    by_first = np.searchsorted(text[order], np.arange(258))
    large: list[list[np.ndarray]] = [[] for _ in range(257)]
    large[text[n - 1]].append(np.array([n - 1], place))  # the last suffix follows the empty one
    out = []
    for c in range(257):
        own = large[c]
        front = np.concatenate(own) if own else np.zeros(0, place)
        own = [front]
        while len(front):  # suffixes of the same bucket that follow those found so far
            front = front[front > 0] - 1
            front = front[text[front] == c]
            own.append(front)
        entries = np.concatenate([*own, order[by_first[c]:by_first[c + 1]]])
        out.append(entries)
        before = entries[entries > 0] - 1
        first = text[before]
        before, first = before[first > c], first[first > c]
        if len(before):
            by = np.argsort(first, kind="stable")
            before, first = before[by], first[by]
            cut = np.flatnonzero(np.diff(first)) + 1
            for piece, value in zip(np.split(before, cut), first[np.concatenate(([0], cut))].tolist()):
                large[value].append(piece)
        large[c] = []
    return np.concatenate(out)


def _words(text: np.ndarray) -> np.ndarray:
    """At every place seven values as one number, 9 bits each; zeros behind the end."""
    padded = np.concatenate([text, np.zeros(7, text.dtype)]).astype(np.uint16)
    out = np.zeros(len(text), np.uint64)
    for k in range(7):
        out <<= np.uint64(9)
        out |= padded[k:k + len(text)]
    return out


def _sort_directly(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Order the given suffixes by their first ``depth`` values: seven at a time, ties only."""
    if not len(starts):
        return starts
    word = _words(np.append(text, text.dtype.type(0)))
    last = len(text)
    order = starts[np.argsort(word[starts], kind="stable")]
    key = word[order]
    at, level = np.arange(len(order), dtype=starts.dtype), 7
    group = np.cumsum(np.concatenate(([True], key[1:] != key[:-1])), dtype=starts.dtype)
    while level < depth:
        tied = np.zeros(len(group), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at, group = at[tied], group[tied]
        if not len(at):
            break
        key = word[np.minimum(order[at] + level, last)]
        by = np.lexsort((key, group))
        order[at] = order[at][by]
        key, group = key[by], group[by]
        group = np.cumsum(np.concatenate(([True], (key[1:] != key[:-1]) | (group[1:] != group[:-1]))), dtype=starts.dtype)
        level += 7
    return order


def repeated_starts(contexts: list[np.ndarray], length: int) -> np.ndarray:
    """Which starts in the concatenated contexts begin a string of ``length`` bytes that begins elsewhere too.

    A context without its last ``length - 1`` bytes is its starts; the result
    has one flag for each byte.
    """
    sizes = np.array([len(c) for c in contexts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(sizes), np.int16)
    inside = np.ones(len(text), bool)
    inside[begin + sizes] = False
    text[inside] = np.concatenate(contexts).astype(np.int16) + 1  # 0 closes each context
    start = np.zeros(len(text), bool)
    start[ranges(begin, np.maximum(sizes - length + 1, 0))] = True
    order = suffix_array(text, length)
    order = order[start[order]]
    del start
    # adjacent common prefixes, seven values at a time
    word = _words(text)
    same = np.ones(max(len(order) - 1, 0), bool)
    steps = [*range(0, length - 6, 7), max(length - 7, 0)] if length >= 7 else []
    for k in steps:
        live = np.flatnonzero(same)
        same[live] = word[order[live] + k] == word[order[live + 1] + k]
    for k in range(length if length < 7 else 0):
        same &= text[order[:-1] + k] == text[order[1:] + k]
    found = np.zeros(len(text), bool)
    found[order[:-1][same]] = True
    found[order[1:][same]] = True
    return found[inside]


def owners(data: np.ndarray, offsets: np.ndarray, length: int, piece: int) -> tuple[np.ndarray, ...]:
    """``(row, first start, starts, owner hash, context hash)`` of every owner in a block of texts."""
    nothing = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    n, width = len(data), length - piece + 1
    if n < length:
        return nothing
    prefix = prefix_hash(data)
    at = np.arange(n - piece + 1)
    name = span_hash(prefix, at, at + piece)
    # smallest value of every window, later places first among equals: prefix and suffix minima of blocks of one width
    bits = max(1, int(n).bit_length())
    value = (name >> np.uint64(bits) << np.uint64(bits)) | (np.uint64((1 << bits) - 1) - at.astype(np.uint64))
    m = -(-len(value) // width) * width
    grid = np.full(m, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[:len(value)] = value
    total = len(value) - width + 1
    del at, value  # arrays of the block's size go as soon as they are used
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    del grid
    least = np.minimum(behind[:total], ahead[width - 1:width - 1 + total])
    del ahead, behind
    place = (np.uint64((1 << bits) - 1) - (least & np.uint64((1 << bits) - 1))).astype(np.int64)
    # starts whose string stays inside its text
    sizes = np.diff(offsets)
    valid = ranges(offsets[:-1], np.maximum(sizes - length + 1, 0))
    if not len(valid):
        return nothing
    row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
    place = place[valid]
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]))))
    count = np.diff(np.append(first, len(valid)))
    start = valid[first]
    return row[first], start - offsets[row[first]], count, name[place[first]], span_hash(prefix, start, start + count + length - 1)


def _parts(batch: pa.RecordBatch, text: int, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """Blocks of a batch; a text over the block size comes in overlapping parts with their place in it."""
    for part in blocks(batch, text, STEP_BYTES):
        data, offsets = text_buffers(part.column(text))
        if part.num_rows == 1 and len(data) > 2 * BLOCK_BYTES:
            for base in range(0, len(data), BLOCK_BYTES):
                piece = data[base:base + BLOCK_BYTES + length - 1]
                yield part, piece, np.array([0, len(piece)]), base
        else:
            yield part, data, offsets, 0


def _find_owners(texts: DataFrame, length: int, piece: int) -> DataFrame:
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets, base in _parts(batch, 1, length):
                row, start, count, name, context = owners(data, offsets, length, piece)
                sizes = part.column(2).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(context.view(np.int64)), part.column(0).take(pa.array(row)), sizes,
                     pa.array(start + base, pa.int32()), pa.array(count, pa.int32())], ["owner", "context", "h", "n", "start", "count"])

    return texts.select("__tm_h", "__tm_text", "__tm_n").mapInArrow(run, "owner long, context long, h long, n int, start int, count int")


def _classify(rows: DataFrame) -> DataFrame:
    """Rows of step 2, sorted by (owner, context) in each task, with ``kind``: 0 a context that is repeated
    throughout, 1 a context to be sorted, 2 one of a hot owner; ``many``: it stands for repeated ones."""
    def chunk(rows: np.ndarray, split: bool) -> pa.RecordBatch:
        owner, context = rows[0], rows[1]
        new_o = np.concatenate(([True], owner[1:] != owner[:-1]))
        new_c = new_o | np.concatenate(([True], context[1:] != context[:-1]))
        of_o, of_c = np.cumsum(new_o) - 1, np.cumsum(new_c) - 1
        m = np.bincount(of_c)[of_c]  # rows of the context
        d = np.bincount(of_o[new_c])[of_o]  # contexts of the owner
        full = np.flatnonzero(m > 1)
        need = np.flatnonzero(new_c & ((d > 1) | split))
        hot = (d[need] > HOT_CONTEXTS) | split
        keep = np.concatenate([full, need])
        kind = np.concatenate([np.zeros(len(full), np.int32), np.where(hot, 2, 1).astype(np.int32)])
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(rows[k][keep], t) for k, t in enumerate(types)), pa.array(kind), pa.array(m[keep] > 1)],
            ["owner", "context", "h", "n", "start", "count", "kind", "many"])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, split = None, False
        for batch in batches:
            rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            if not rows.shape[1]:
                continue
            if split and rows[0, 0] != rows[0, -1]:  # the rest of an owner that was begun before
                k = int(np.flatnonzero(rows[0] != rows[0, 0])[0])
                yield chunk(rows[:, :k], True)
                rows, split = rows[:, k:], False
            cut = int(np.flatnonzero(rows[0] == rows[0, -1])[0])
            if cut:
                yield chunk(rows[:, :cut], False)
                rows = rows[:, cut:]
            if rows.shape[1] > HELD:  # one owner: all contexts but the last go on as hot
                k = int(np.flatnonzero(rows[1] == rows[1, -1])[0])
                if k:
                    yield chunk(rows[:, :k], True)
                    rows, split = rows[:, k:], True
                if rows.shape[1] > HELD:  # one context: two of its rows say that it is repeated
                    full = chunk(rows, False)
                    yield full.filter(pa.array(full.column(6).to_numpy() == 0))
                    rows = rows[:, :2]
            held = rows
        if held is not None and held.shape[1]:
            yield chunk(held, split)

    return rows.mapInArrow(run, "owner long, context long, h long, n int, start int, count int, kind int, many boolean")


def _cut_contexts(joined: DataFrame, length: int) -> DataFrame:
    """The bytes of every wanted context; for hot owners the 128-bit names of its strings instead."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, 2, STEP_BYTES):
                data, offsets = text_buffers(part.column(2))
                out: list[list] = [[] for _ in range(9)]
                for i in range(part.num_rows):
                    own = data[offsets[i]:offsets[i + 1]]
                    for w in part.column(3)[i].as_py():
                        a, b = w["start"], w["start"] + w["count"] + length - 1
                        sums = None
                        if w["kind"] == 2:
                            at = np.arange(w["count"])
                            sums = [span_hash(prefix_hash(own[a:b], base), at, at + length, base).view(np.int64) for base in (MULT, MULT2)]
                        row = (w["owner"], part.column(0)[i].as_py(), part.column(1)[i].as_py(), a, w["count"], w["many"],
                               own[a:b].tobytes() if sums is None else None, *(sums if sums else (None, None)))
                        for k, x in enumerate(row):
                            out[k].append(x)
                longs = pa.list_(pa.int64())
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), longs, longs]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)],
                                                 ["owner", "h", "n", "start", "count", "many", "bytes", "one", "two"])

    return joined.mapInArrow(run, "owner long, h long, n int, start int, count int, many boolean, bytes binary, one array<long>, two array<long>")


def _sort_contexts(rows: DataFrame, length: int) -> DataFrame:
    """Starts found by the suffix arrays: ``(h, n, start, count)``.  Rows come sorted by owner, then place."""
    def search(held: list[tuple]) -> pa.RecordBatch:
        marks: list[list[int]] = [[], [], [], []]
        if held:
            found = repeated_starts([np.frombuffer(x[5], np.uint8) for x in held], length)
            at = 0
            for _, h, n, start, many, raw in held:
                if not many:
                    for a, b in zip(*(x.tolist() for x in runs(found[at:at + len(raw)]))):
                        for k, x in enumerate((h, n, start + a, b - a)):
                            marks[k].append(x)
                at += len(raw)
        return pa.RecordBatch.from_arrays([pa.array(marks[0], pa.int64()), *(pa.array(x, pa.int32()) for x in marks[1:])], ["h", "n", "start", "count"])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                owner, place = row[0], row[:4]
                if place == last:
                    continue  # the same place, brought by a row that is given twice
                if size >= ARRAY_BYTES and owner != last[0]:
                    yield search(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
                last = place
        yield search(held)

    return rows.select("owner", "h", "n", "start", "many", "bytes").mapInArrow(run, "h long, n int, start int, count int")


def mark(texts: DataFrame, length: int, piece: int) -> DataFrame:
    """``(h, n, marks)`` of texts with repeated strings; marks: array of distinct (start, count)."""
    rows = _find_owners(texts, length, piece).repartition("owner").sortWithinPartitions("owner", "context")
    kinds = stored(_classify(rows), "contexts")
    full = kinds.filter("kind = 0").select("h", "n", "start", "count")
    wanted = kinds.filter("kind > 0").groupBy("h", "n").agg(F.collect_list(F.struct("owner", "start", "count", "kind", "many")).alias("wanted"))
    one = texts.groupBy(F.col("__tm_h").alias("h"), F.col("__tm_n").alias("n")).agg(F.min("__tm_id").alias("least"))
    wanted = wanted.join(one, ["h", "n"])
    source = texts.join(wanted, (F.col("__tm_h") == F.col("h")) & (F.col("__tm_n") == F.col("n")) & F.col("__tm_id").eqNullSafe(F.col("least")))
    cut = stored(_cut_contexts(source.select("h", "n", "__tm_text", "wanted"), length), "cut-contexts")
    sorted_in = cut.filter("bytes is not null").repartition("owner").sortWithinPartitions("owner", "h", "n", "start")
    # strings of hot owners, by name
    names = (cut.filter("one is not null").dropDuplicates(["owner", "h", "n", "start"])
             .select("h", "n", "start", "many", F.posexplode(F.arrays_zip("one", "two")).alias("k", "name"))
             .select("h", "n", (F.col("start") + F.col("k")).alias("start"), "many", "name.one", "name.two"))
    twice = names.groupBy("one", "two").agg(F.count("*").alias("rows"), F.max("many").alias("any")).filter("rows > 1 or any").select("one", "two")
    hot = names.filter("not many").join(twice, ["one", "two"]).select("h", "n", "start", F.lit(1).alias("count"))
    # copies of a text bring the same marks; once each they are bounded by the text, however many copies there are
    found = full.unionByName(_sort_contexts(sorted_in, length)).unionByName(hot).distinct()
    marks = stored(found.groupBy("h", "n").agg(F.collect_list(F.struct("start", "count")).alias("marks")), "marks")
    discard(kinds, cut)
    return marks


def remove(docs: DataFrame, text: str = "text", length: int = 200, piece: int = 50, id: str = "doc_id") -> DataFrame:
    """``docs`` with ``__tm_bytes``, ``__tm_removed``, ``__tm_spans``, ``__tm_sha256`` of the kept bytes, and
    ``__tm_kept``, the kept bytes as text (a character that lost some of its bytes goes).

    Every byte covered by a string of ``length`` bytes that starts anywhere
    else goes; strings never cross texts and are judged on the input.  Null
    and empty texts have no bytes and keep nothing; repeated rows lose all
    they have in strings of that length.  An empty table gives an empty one.
    """
    names = docs.columns
    kind = docs.schema.simpleString()[7:-1]
    keyed = docs.withColumn("__tm_text", text_or_empty(text))
    keyed = keyed.withColumns({"__tm_h": F.xxhash64("__tm_text"), "__tm_n": F.octet_length("__tm_text"), "__tm_id": F.col(id)})
    found = mark(keyed.select("__tm_id", "__tm_h", "__tm_n", "__tm_text"), length, piece)
    found = found.withColumnsRenamed({"h": "__tm_h2", "n": "__tm_n2", "marks": "__tm_marks"})
    joined = keyed.join(found, (F.col("__tm_h") == F.col("__tm_h2")) & (F.col("__tm_n") == F.col("__tm_n2")), "left")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(names)
        for batch in batches:
            for part in blocks(batch, k, STEP_BYTES):
                data, offsets = text_buffers(part.column(k))
                marks = part.column(k + 1)
                size, gone, spans, digest, kept = [], [], [], [], []
                for i in range(part.num_rows):
                    own = data[offsets[i]:offsets[i + 1]]
                    covered = np.zeros(len(own) + 1, np.int32)
                    if marks[i].is_valid:
                        pairs = marks[i].values.flatten()
                        a, c = pairs[0].to_numpy(), pairs[1].to_numpy()
                        np.add.at(covered, a, 1)
                        np.add.at(covered, a + c + length - 1, -1)
                    out = np.cumsum(covered)[:-1] > 0
                    left = own[~out].tobytes()
                    size.append(len(own))
                    gone.append(int(out.sum()))
                    spans.append(len(runs(out)[0]))
                    digest.append(hashlib.sha256(left).hexdigest())
                    kept.append(left.decode("utf-8", "ignore"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(j) for j in range(k)), *(pa.array(x, pa.int64()) for x in (size, gone, spans)),
                     pa.array(digest, pa.string()), pa.array(kept, pa.string())],
                    [*names, "__tm_bytes", "__tm_removed", "__tm_spans", "__tm_sha256", "__tm_kept"])

    return joined.select(*names, "__tm_text", "__tm_marks").mapInArrow(
        run, kind + ", __tm_bytes long, __tm_removed long, __tm_spans long, __tm_sha256 string, __tm_kept string")


def op4(spark, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated strings of 200 bytes."""
    out = remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__tm_bytes").alias("n_bytes"), F.col("__tm_removed").alias("n_removed"),
                      F.col("__tm_spans").alias("n_spans"), F.col("__tm_sha256").alias("kept_sha256"))
