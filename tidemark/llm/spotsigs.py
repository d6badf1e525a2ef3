"""Document fingerprints from spot signatures.

A spot is an occurrence of a common word (an anchor); its signature is the
anchor with the chain of content words that follow it, every ``DISTANCE``-th
of them, ``CHAIN`` long.  A text's fingerprint is the set of its signatures.
Fingerprints are compared by Jaccard; in a join, sets are partitioned by their
size, so that only neighbouring partitions can hold a match, and a comparison
ends as soon as sizes rule it out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import blocks, mix, prefix_hash, span_hash, stored, table, text_buffers, text_or_empty

#: Content words in a chain, and how far apart they stand among the content words.
CHAIN, DISTANCE = 3, 1
#: Common words of English, German, French and Spanish (fixed values, lower case).
ANCHORS = (
    "a an and are as at be been but by can do for from had has have he her his if in into is it its may no not of on "
    "one or she so than that the their them then there these they this to was we were which who will with would you "
    "als am auch auf aus bei bis das dem den der des die ein eine einem einen einer es für hat ich im ist mit nach "
    "nicht noch oder sich sie sind so über um und von war was wie wird zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus "
    "pour qui que sa se ses son sur un une vous "
    "al como con del el ella ellos esta este fue ha hay las lo los más muy o para pero por su sus también tiene y ya"
).split()
#: Documents in one range of the order in which the next document is looked up.
RANGE_ROWS = 4096

_WORD = np.zeros(256, bool)
_WORD[128:] = True
for _first, _last in ("09", "AZ", "az"):
    _WORD[ord(_first):ord(_last) + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word: ASCII letters (A-Z lowered), digits and all bytes of other characters."""
    data = _LOWER[data]
    solid = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    end[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return span_hash(prefix_hash(data), starts, ends), np.searchsorted(offsets, starts, side="right") - 1


def _anchor_names(anchors) -> np.ndarray:
    words = [w.encode() for w in anchors]
    offsets = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    return np.unique(_words(np.frombuffer(b"".join(words), np.uint8), offsets)[0])


def signatures(column: pa.Array, anchors: np.ndarray, chain: int = CHAIN, distance: int = DISTANCE) -> list[np.ndarray]:
    """The fingerprint of every text of a column without nulls: sorted distinct 32-bit names of its signatures.

    A text with words but no whole chain has one signature, its words in
    order; a text without words has one of its bytes; an empty text has none.
    """
    data, offsets = text_buffers(column)
    n = len(column)
    name, row = _words(data, offsets)
    spot = np.zeros(len(name), bool)
    if len(name):
        spot = anchors[np.minimum(np.searchsorted(anchors, name), len(anchors) - 1)] == name
    content = np.flatnonzero(~spot)
    at = np.flatnonzero(spot)
    first = np.searchsorted(content, at)
    reach = first + (chain - 1) * distance
    ok = reach < len(content)
    at, first, reach = at[ok], first[ok], reach[ok]
    ok = row[content[reach]] == row[at]
    at, first = at[ok], first[ok]
    h = mix(name[at])
    for k in range(chain):
        h = mix(h + name[content[first + k * distance]])
    of = row[at]
    bare = np.flatnonzero((np.bincount(of, minlength=n) == 0) & (np.diff(offsets) > 0))
    if len(bare):
        counts, sums = np.bincount(row, minlength=n)[bare], np.zeros(n, np.uint64)
        order = np.arange(len(row)) - np.searchsorted(row, row)
        np.add.at(sums, row, mix(name + mix(order)))
        whole = span_hash(prefix_hash(data), offsets[bare], offsets[bare + 1])
        h, of = np.concatenate([h, mix(np.where(counts > 0, sums[bare], whole))]), np.concatenate([of, bare])
    both = np.unique(of.astype(np.uint64) << np.uint64(32) | h >> np.uint64(32))
    cut = np.searchsorted(both, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    names = both.astype(np.uint32)
    return [names[cut[i]:cut[i + 1]] for i in range(n)]


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two fingerprints; 0 without counting if their sizes rule out ``least``.  Two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    small, large = sorted((len(a), len(b)))
    if not small or small < least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def printed(fingerprint: np.ndarray) -> str:
    """Eight hexadecimal digits for each signature, in order."""
    return fingerprint.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, text: str = "text", anchors=tuple(ANCHORS)) -> DataFrame:
    """``docs`` with ``__tm_signatures``, the sorted distinct signatures of each whole text (null: empty).  Map-only."""
    names, known = docs.columns, _anchor_names(anchors)
    source = docs.withColumn("__tm_text", text_or_empty(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(names)
        for batch in batches:
            for part in blocks(batch, k):
                got = [x.astype(np.int64) for x in signatures(part.column(k), known)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(k)), pa.array(got, pa.list_(pa.int64()))], [*names, "__tm_signatures"])

    return source.mapInArrow(run, docs.schema.simpleString()[7:-1] + ", __tm_signatures array<long>")


def near_pairs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """``(a, b, likeness)`` of the distinct fingerprints with Jaccard >= ``least``; a and b are the smallest ids that have them.

    Sizes are cut into partitions so wide that a match lies in the same one or
    the next.  Within them, sets meet through their rarest signatures, as few
    of them as a match must share one of.  Empty fingerprints match nothing.
    """
    prints = fingerprints(docs.select(F.col(id).alias("id"), F.col(text).alias("text"))).select("id", F.col("__tm_signatures").alias("s"))
    sets = stored(prints.filter(F.size("s") > 0).groupBy("s").agg(F.min("id").alias("id")).withColumn("n", F.size("s")), "prints")
    each = sets.select("id", "n", F.explode("s").alias("x"))
    often = each.groupBy("x").agg(F.count("*").alias("rows"))
    order = Window.partitionBy("id").orderBy("rows", "x")
    part = lambda n: F.floor(F.log(n.cast("double")) / F.lit(-float(np.log(least))) + 1e-9)
    entries = (each.join(often, "x").withColumn("k", F.row_number().over(order))
               .filter(F.col("k") <= F.col("n") - F.ceil(F.col("n") * least) + 1).withColumn("part", part(F.col("n"))))
    near = entries.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    x, y = near.alias("x"), entries.alias("y")
    pairs = x.join(y, (F.col("x.x") == F.col("y.x")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.n") >= F.col("y.n") * least)
                   & ((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id")))))
    pairs = pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    named = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("p")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("q")), "b")
    score = F.size(F.array_intersect("p", "q")) / F.size(F.array_union("p", "q"))
    return named.select("a", "b", score.alias("likeness")).filter(F.col("likeness") >= least)


def edited(docs: DataFrame, id: str = "doc_id", text: str = "text", anchors=tuple(ANCHORS)) -> DataFrame:
    """Fingerprints of all documents and of their edited texts.

    Documents stand in descending order of ``id`` (nulls last, then by a hash
    of the text); the next of the last is the first.  The edited text has its
    last floor(n / 2) code points replaced by the first as many, or all, of
    the next document's.  Columns: id, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint`` (hexadecimal), ``near_edited``,
    ``near_next``.

    Texts move once, into ranges of the order; the first document of each
    range is also sent to the range before it, so each range knows its last
    document's next.
    """
    limit = (1 << 63) - 1
    rows = docs.select(F.col(id).cast("long").alias("id"), text_or_empty(text).alias("text"))
    rows = rows.withColumns({"o": F.coalesce(F.bitwise_not(F.col("id")), F.lit(limit)), "h": F.xxhash64("text")})
    n = rows.count()
    if not n:
        return rows.select(F.col("id").alias(id), F.lit(0).cast("long").alias("n_chars"), *(F.lit("").alias(c) for c in (
            "edited_sha256", "fingerprint", "edited_fingerprint")), F.lit(0.0).alias("near_edited"), F.lit(0.0).alias("near_next"))
    ranges = -(-n // RANGE_ROWS)
    cuts = rows.agg(F.percentile_approx("o", [i / ranges for i in range(1, ranges)] or [0.5], 100 * ranges + 10_000)).head()[0] if ranges > 1 else []
    bounds, repeats = np.unique(np.array(cuts, np.int64), return_counts=True)

    @F.pandas_udf(T.LongType())
    def place(o: pd.Series, h: pd.Series) -> pd.Series:
        o, h = o.to_numpy(), h.to_numpy()
        at = np.searchsorted(bounds, o)  # an id that fills several ranges is spread over them by its texts' hashes
        base = np.concatenate(([0], np.cumsum(repeats)))[at]
        on = (at < len(bounds)) & (o == bounds[np.minimum(at, len(bounds) - 1)]) if len(bounds) else np.zeros(len(o), bool)
        more = repeats[np.minimum(at, len(bounds) - 1)] if len(bounds) else np.ones(len(o), np.int64)
        part = np.minimum(((h.astype(np.float64) / 2**64 + 0.5) * more).astype(np.int64), more - 1)
        return pd.Series(base + np.where(on, part, 0))

    rows = rows.withColumn("range", place("o", "h"))
    firsts = sorted((r["range"], r["f"]["o"], r["f"]["h"]) for r in rows.groupBy("range").agg(F.min(F.struct("o", "h")).alias("f")).collect())  # a row for each range
    after = [(o, h, firsts[k - 1][0]) for k, (_, o, h) in enumerate(firsts)]
    sent = docs.sparkSession.createDataFrame(after, "o long, h long, range long")
    closing = rows.drop("range").join(F.broadcast(sent), ["o", "h"]).withColumn("closing", F.lit(True))
    every = rows.withColumn("closing", F.lit(False)).unionByName(closing)
    # a closing document stands behind all others of its range
    every = every.select("range", "closing", "id", "text", "o", "h").repartition(max(ranges, 1), "range").sortWithinPartitions("range", "closing", "o", "h")
    known = _anchor_names(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for part in blocks(batch.select([0, 1, 2, 3]), 3):
                new = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(),
                               signatures(part.column(3), known)))
                line = ([held] if held else []) + new
                now = [(a, b) for a, b in zip(line, line[1:]) if not a[1] and a[0] == b[0]]
                changed = []
                for a, b in now:
                    k = len(a[3]) // 2
                    changed.append(a[3][:len(a[3]) - k] + b[3][:k])
                prints = signatures(pa.array(changed, pa.string()), known)
                held = line[-1]
                yield pa.RecordBatch.from_arrays([
                    pa.array([a[2] for a, _ in now], pa.int64()), pa.array([len(a[3]) for a, _ in now], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array([printed(a[4]) for a, _ in now], pa.string()), pa.array([printed(p) for p in prints], pa.string()),
                    pa.array([likeness(a[4], p) for (a, _), p in zip(now, prints)], pa.float64()),
                    pa.array([likeness(a[4], b[4]) for a, b in now], pa.float64()),
                ], [id, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return every.mapInArrow(run, f"`{id}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op10(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited(table(spark, sf_dir, "documents"))
