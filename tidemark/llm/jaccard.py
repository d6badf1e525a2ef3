"""n-gram Jaccard join by a size-aware heavy-light method.

Small sets: every subset of the sizes that a link needs is enumerated; two
sets that share such a subset are linked, nothing is left to verify.  Large
sets: inverted lists of their rarest shingles are scanned for pairs, which are
verified on the whole sets.  The boundary between the two is the size with the
smallest estimated cost over the table's size histogram.

Sets with equal shingles are one vertex from the start.  Shingles count as
rare or frequent by a bounded table of heavy hitters; it only sets the order
in which a set's shingles are indexed, so any table gives the same links.  A
list longer than ``SHORT`` is first compared along itself and with a few hubs;
afterwards only its pairs across components are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import STEP_BYTES, blocks, discard, mix, prefix_hash, ranges, released, span_hash, stored, table, text_buffers, text_or_empty
from tidemark.llm.graph import components

#: Bits of the map of rows whose texts are verified (4 MB).
BITMAP = 1 << 25
#: Lists up to this length have all their pairs verified at once.
SHORT = 16
#: A long list has one hub for so many rows, and at most so many hubs: its rows are compared with them first.
BLOCK, HUBS = 64, 16
#: Rows of one list held at a time.
HELD = 4096
#: Entries of the heavy-hitter table (16 bytes each), and how many one task may propose.
HEAVY, HEAVY_PER_TASK = 1 << 17, 8192
#: Shingles that a task of the survey holds before it counts them; counting takes about 50 bytes each.
SURVEYED = 1_000_000
#: Least and most bits of a set's parity, as powers of two.
PARITY = (9, 17)
#: Set sizes for which enumerating subsets is considered.
SMALL_MOST = 40

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word (run of bytes that are no white space, A-Z lowered) of a block of texts."""
    data = _LOWER[data]
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return span_hash(prefix_hash(data), starts, ends), np.searchsorted(offsets, starts, side="right") - 1


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle, repeats included, rows ascending.  A row with fewer words has them all as one."""
    name, row = words(data, offsets)
    n = len(offsets) - 1
    count = np.bincount(row, minlength=n)
    out_h, out_r = [], []
    if len(name) >= size:
        h = np.full(len(name) - size + 1, size, np.uint64)
        for k in range(size):
            h = mix(h + name[k:k + len(h)])
        ok = row[:len(h)] == row[size - 1:]
        out_h.append(h[ok])
        out_r.append(row[:len(h)][ok])
    first = np.cumsum(count) - count
    for k in range(1, size):
        few = np.flatnonzero(count == k)
        h = np.full(len(few), k, np.uint64)
        for j in range(k):
            h = mix(h + name[first[few] + j])
        out_h.append(h)
        out_r.append(few)
    h, r = np.concatenate(out_h), np.concatenate(out_r)
    by = np.argsort(r, kind="stable")
    return h[by], r[by]


def sets(data: np.ndarray, offsets: np.ndarray, size: int, heat: np.ndarray | None = None,
         heavy: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every row: hashes in order of (heat, hash) and bounds of each row's part."""
    h, r = shingles(data, offsets, size)
    if heavy is not None and len(heavy):
        at = np.minimum(np.searchsorted(heavy, h), len(heavy) - 1)
        by = np.lexsort((h, np.where(heavy[at] == h, heat[at], 0), r))
    else:
        by = np.lexsort((h, r))
    h, r = h[by], r[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[new], r[new]
    return h, np.searchsorted(r, np.arange(len(offsets)))


class Threshold:
    """``per_cent * union <= 100 * intersection`` and what follows from it for sizes."""

    def __init__(self, per_cent: int):
        self.t = per_cent

    def overlap(self, a, b):
        """Smallest intersection that links sets of these sizes."""
        return -(-self.t * (a + b) // (100 + self.t))

    def least(self, n):
        """Smallest size that can link with ``n``."""
        return -(-self.t * n // 100)

    def probe(self, n):
        """Rarest shingles of a set of which a linked smaller set shares one."""
        return n - self.least(n) + 1

    def index(self, n):
        """Rarest shingles of a set of which a linked larger or equal set shares one."""
        return n - self.overlap(n, n) + 1

    def partners(self, n: int, below: int) -> range:
        return range(self.least(n), min(below - 1, 100 * n // self.t) + 1)

    def subset_sizes(self, n: int, below: int) -> list[int]:
        """Sizes of the common subsets by which a set of size ``n`` links with sets smaller than ``below``."""
        return sorted({int(self.overlap(n, b)) for b in self.partners(n, below)})


def boundary(histogram: dict[int, int], rule: Threshold) -> int:
    """Sets smaller than the result are enumerated.  Costs in rows made: each subset one; each index entry one, and
    its share of verification as much again as the set has shingles per index entry."""
    def small(n: int, below: int) -> int:
        return sum(comb(n, c) for c in rule.subset_sizes(n, below) if c <= n)

    def large(n: int) -> int:
        return int(rule.probe(n)) + n

    best, cost = 1, None
    for x in range(1, SMALL_MOST + 1):
        light = sum(c * small(n, x) for n, c in histogram.items() if 0 < n < x)
        heavy = sum(c * large(n) for n, c in histogram.items() if n >= rule.least(x))
        if cost is None or light + heavy < cost:
            best, cost = x, light + heavy
    return best


def _survey(docs: DataFrame, size: int) -> tuple[dict[int, int], np.ndarray, np.ndarray]:
    """Histogram of small set sizes, and the heavy hitters among shingles: sorted hashes and their counts."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        histogram = np.zeros(SMALL_MOST * 2, np.int64)
        seen, held = [], 0
        names, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def settle(names, counts, seen):
            every, n = np.concatenate([names, *seen]), np.concatenate([counts, np.ones(sum(map(len, seen)), np.int64)])
            kinds, which = np.unique(every, return_inverse=True)
            total = np.bincount(which, n, len(kinds)).astype(np.int64)
            often = total > 2
            return kinds[often], total[often]

        for batch in batches:
            for part in blocks(batch, 0, STEP_BYTES):
                h, at = sets(*text_buffers(part.column(0)), size)
                n = np.diff(at)
                histogram += np.bincount(n[n < len(histogram)], minlength=len(histogram))
                seen.append(h)
                held += len(h)
                if held > SURVEYED:
                    names, counts = settle(names, counts, seen)
                    seen, held = [], 0
        names, counts = settle(names, counts, seen)
        top = np.argsort(-counts, kind="stable")[:HEAVY_PER_TASK]
        sizes = np.flatnonzero(histogram)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.zeros(len(sizes), bool), np.ones(len(top), bool)])),
            pa.array(np.concatenate([sizes, names[top].view(np.int64)])), pa.array(np.concatenate([histogram[sizes], counts[top]])),
        ], ["hit", "name", "n"])

    found = stored(docs.select("__tm_text").mapInArrow(run, "hit boolean, name long, n long").groupBy("hit", "name").agg(F.sum("n").alias("n")), "survey")
    histogram = {r["name"]: r["n"] for r in found.filter(~F.col("hit")).collect()}
    top = found.filter("hit").orderBy(F.desc("n"), "name").limit(HEAVY).toPandas()
    order = np.argsort(names := top["name"].to_numpy(np.int64).view(np.uint64))
    return histogram, names[order], top["n"].to_numpy(np.int64)[order]


def _subset_keys(h: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Names of all subsets of the given sizes of a small set, with their sizes."""
    n, spread = len(h), mix(h)
    whole = spread.sum(dtype=np.uint64)
    names, of = [], []
    for c in sizes:
        if c <= n:
            out = np.array(list(combinations(range(n), n - c)), np.int64).reshape(comb(n, c), n - c)
            names.append(mix(whole - spread[out].sum(1, dtype=np.uint64) + np.uint64(c)))
            of.append(np.full(len(out), c))
    return (np.concatenate(names), np.concatenate(of)) if names else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def parities(h: np.ndarray, at: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """For each given row whether an odd number of its shingles falls on each of its bits, as 64-bit words.

    Shingles of both sets cancel out, so two sets differ in at least as many
    shingles as their parities differ in bits.  A set has about two to four
    bits for each shingle; a bit is the low end of a hash, so the two halves of
    a parity, added, are the parity of half the width.
    """
    n = at[rows + 1] - at[rows]
    width = 1 << np.clip(np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64) + 1, *PARITY)
    out: list = [None] * len(rows)
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        step = max(1, (1 << 21) // w)
        for c in range(0, len(own), step):
            some = own[c:c + step]
            bit = (mix(h[ranges(at[rows[some]], n[some])] + np.uint64(77)) & np.uint64(w - 1)).astype(np.int64)
            odd = np.bincount(np.repeat(np.arange(len(some)), n[some]) * w + bit, minlength=len(some) * w) & 1
            for i, words in zip(some.tolist(), np.packbits(odd.astype(np.uint8).reshape(len(some), w), axis=1).view(np.int64)):
                out[i] = words
    return out


def halved(words: np.ndarray, size: int) -> np.ndarray:
    """Parities (last axis) brought down to ``size`` words."""
    while words.shape[-1] > size:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def _profile(docs: DataFrame, rule: Threshold, size: int, below: int, heavy, heat) -> DataFrame:
    """One row per document: its set's size, 128-bit signature, index entries and subset keys."""
    shared = docs.sparkSession.sparkContext.broadcast((heavy, heat))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, heat = shared.value
        for batch in batches:
            for part in blocks(batch, 2, STEP_BYTES):
                h, at = sets(*text_buffers(part.column(2)), size, heat, heavy)
                n = np.diff(at)
                full = np.flatnonzero(n)
                one, two = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(full):
                    one[full] = np.add.reduceat(mix(h + np.uint64(1)), at[full])
                    two[full] = np.add.reduceat(mix(h ^ np.uint64(0xABCDEF12345)), at[full])
                tokens, keys, cs = [], [], []
                for i in range(len(n)):
                    m = int(n[i])
                    tokens.append(h[at[i]:at[i] + rule.probe(m)].view(np.int64) if m >= rule.least(below) else np.zeros(0, np.int64))
                    k, c = _subset_keys(h[at[i]:at[i + 1]], rule.subset_sizes(m, below)) if 0 < m < below else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                    keys.append(k.view(np.int64))
                    cs.append(c)
                big = np.flatnonzero(n >= max(1, rule.least(below)))
                parity: list = [None] * len(n)
                for i, bits in zip(big.tolist(), parities(h, at, big)):
                    parity[i] = bits
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                    pa.array(tokens, longs), pa.array(keys, longs), pa.array(cs, longs), pa.array(parity, longs),
                ], ["id", "text_hash", "n", "s1", "s2", "tokens", "keys", "sizes", "parity"])

    return docs.select("__tm_id", "__tm_hash", "__tm_text").mapInArrow(
        run, "id long, text_hash long, n long, s1 long, s2 long, tokens array<long>, keys array<long>, sizes array<long>, parity array<long>")


def _possible(rule: Threshold, nx, px, ny, py):
    """Whether sets (x the smaller) that meet at these places of their orders can still be linked."""
    room = np.minimum(px, py) + 1 + np.minimum(nx - px, ny - py) - 1
    return (px < rule.index(nx)) & (rule.least(ny) <= nx) & (room >= rule.overlap(nx, ny))


def _scan(lists: DataFrame, rule: Threshold) -> DataFrame:
    """Pairs to verify from inverted lists, and the rows of long lists.

    ``lists``: token, n, place, vid.  Result: token (null for a pair), n,
    place, a, b; a long list's row has its vid in ``a``.
    """
    def chunk(t, n, p, v, more: bool):
        """One run of rows, whole lists; with ``more`` the only list goes on."""
        new = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        length = np.diff(np.append(new, len(t)))
        of = np.repeat(np.arange(len(new)), length)
        long = (length > SHORT)[of] | more
        left, right = [], []
        for d in range(1, SHORT):
            i = np.flatnonzero(~long[:-d] & (of[d:] == of[:-d])) if len(t) > d else np.zeros(0, np.int64)
            if not len(i):
                break
            left.append(i)
            right.append(i + d)
        # a long list: every row with a few members that hashes choose, the same ones in most lists of a group
        rows = np.flatnonzero(long)
        by = rows[np.lexsort((mix(v[rows].view(np.uint64)), of[rows]))]
        place = np.arange(len(by)) - np.searchsorted(of[by], of[by])
        wanted = np.clip(length // BLOCK, 1, HUBS)
        hubs = by[place < wanted[of[by]]]
        first = np.searchsorted(of[rows], of[hubs])
        reach = np.searchsorted(of[rows], of[hubs], side="right") - first
        other, hub = rows[ranges(first, reach)], np.repeat(hubs, reach)
        left += [np.minimum(other, hub), rows[1:] - 1]
        right += [np.maximum(other, hub), rows[1:]]
        left[-1], right[-1] = left[-1][of[left[-1]] == of[right[-1]]], right[-1][of[left[-1]] == of[right[-1]]]
        i, j = np.concatenate(left), np.concatenate(right)
        ok = (i != j) & _possible(rule, n[i], p[i], n[j], p[j])
        i, j = i[ok], j[ok]
        pair = np.unique(np.stack([v[i], v[j]], 1), axis=0) if len(i) else np.zeros((0, 2), np.int64)
        keep = np.flatnonzero(long)
        nothing = pa.nulls(len(pair), pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([nothing, pa.array(t[keep])]), pa.concat_arrays([nothing, pa.array(n[keep])]), pa.concat_arrays([nothing, pa.array(p[keep])]),
            pa.array(np.concatenate([pair[:, 0], v[keep]])), pa.concat_arrays([pa.array(pair[:, 1]), pa.nulls(len(keep), pa.int64())]),
        ], ["token", "n", "place", "a", "b"])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, going = None, False
        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            if not rows.shape[1]:
                continue
            cut = int(np.flatnonzero(rows[0] == rows[0, -1])[0])  # the last list may go on
            if cut:
                last = rows[0, 0] if going else None
                if going:  # the rest of a list that was begun before
                    k = int(np.searchsorted(rows[0], last, side="right"))
                    yield chunk(*rows[:, :k], True)
                    if k < cut:
                        yield chunk(*rows[:, k:cut], False)
                else:
                    yield chunk(*rows[:, :cut], False)
                held, going = rows[:, cut:], False
            else:
                held = rows
            if held.shape[1] > HELD:
                yield chunk(*held, True)
                held, going = held[:, -1:], True
        if held is not None and held.shape[1]:
            yield chunk(*held, going)

    return lists.select("token", "n", "place", "vid").mapInArrow(run, "token long, n long, place long, a long, b long")


def _verify(pairs: DataFrame, texts: DataFrame, rule: Threshold, size: int) -> DataFrame:
    """The pairs ``(a, b)`` of vertices that are linked, compared on their whole sets.

    Every pair brings b's text to a's; rows stream by in the order (a, a's own
    text first), so one set is held at a time however many partners it has.
    """
    members = pairs.select("a", F.col("b").alias("vid")).unionByName(pairs.select("a", F.col("a").alias("vid")).distinct())
    rows = (members.join(texts, "vid").select("a", (F.col("vid") != F.col("a")).alias("other"), "vid", "text")
            .repartition("a").sortWithinPartitions("a", "other"))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in blocks(batch, 3, STEP_BYTES):
                h, at = sets(*text_buffers(part.column(3)), size)
                a, other, v = (part.column(k).to_numpy(zero_copy_only=False) for k in range(3))
                linked = []
                for i in range(len(a)):
                    mine = h[at[i]:at[i + 1]]
                    if not other[i]:
                        own, base = a[i], mine.copy()
                    elif own == a[i] and len(base):
                        place = np.minimum(np.searchsorted(base, mine), len(base) - 1)
                        both = int((base[place] == mine).sum())
                        if 100 * both >= rule.t * (len(base) + len(mine) - both):
                            linked.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(a[linked], pa.int64()), pa.array(v[linked], pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _texts(whole: DataFrame, met: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(vid, text)`` of the vertices that stand in a pair, one text for each.

    Rows that are in no pair fall away by a bitmap of fixed size before the
    texts are moved; two rows that share a bit only let one more through to
    the join.
    """
    asked = pairs.select(F.col("a").alias("vid")).unionByName(pairs.select(F.col("b").alias("vid"))).distinct()
    wanted = stored(met.select("vid", F.col("id").alias("__tm_id"), F.col("text_hash").alias("__tm_hash")).join(asked, "vid"), "wanted")
    place = F.xxhash64("__tm_id", "__tm_hash").bitwiseAND(F.lit(BITMAP - 1))
    pieces = wanted.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("piece")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(32767))).alias("bits"))
    bits = np.zeros(BITMAP // 8, np.uint8)
    for r in pieces.collect():  # at most BITMAP / 2**15 pieces of 4 KB
        bits[r["piece"] * 4096:(r["piece"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = whole.sparkSession.sparkContext.broadcast(bits)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(3).to_numpy()
            yield batch.filter(pa.array((shared.value[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool))).select([0, 1, 2])

    names = ["__tm_id", "__tm_hash", "__tm_text"]
    some = whole.filter(F.col("__tm_id").isNotNull()).select(*names, place.alias("p")).mapInArrow(run, "__tm_id long, __tm_hash long, __tm_text string")
    found = some.join(wanted, ["__tm_id", "__tm_hash"]).dropDuplicates(["__tm_id", "__tm_hash"])  # keys of the join: no further shuffle
    found = stored(found.select("vid", F.col("__tm_text").alias("text")), "texts")
    discard(wanted)
    return found


def _plausible(pairs: DataFrame, met: DataFrame, rule: Threshold) -> DataFrame:
    """Pairs whose parities differ in no more bits than linked sets of these sizes may differ in shingles."""
    of = lambda side: met.select(F.col("vid").alias(side), F.col("n").alias(f"n_{side}"), F.col("parity").alias(f"p_{side}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "p_a", "p_b")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            differ = np.zeros(len(n), np.int64)
            for i in range(len(n)):
                x, y = (batch.column(k)[i].values.to_numpy().view(np.uint64) for k in (4, 5))
                size = min(len(x), len(y))
                differ[i] = np.bitwise_count(halved(x, size) ^ halved(y, size)).sum()
            good = pa.array(np.flatnonzero(differ <= n + m - 2 * rule.overlap(n, m)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(good), batch.column(1).take(good)], ["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def _across(rows: DataFrame, rule: Threshold) -> DataFrame:
    """Pairs of long lists, between components, that are still plausible; each pair once.

    ``rows``: token, one, two (the pair of blocks of a list that meet in this
    group), block, vid, n, place, component, tokens (of the vertex in these
    lists), parity, places (of the tokens), sorted by the first three.  A pair counts only in the list of the smallest token
    through which the two can meet.
    """
    def pairs(token: int, one: int, two: int, t: pa.Table) -> pa.RecordBatch:
        block, vid, n, place, component = (t.column(k).to_numpy() for k in range(3, 8))
        token_lists, bits = t.column(8).combine_chunks(), t.column(9).combine_chunks()
        words, ends = bits.flatten().to_numpy().view(np.uint64), bits.offsets.to_numpy()
        ends = ends - ends[0]
        size = np.diff(ends)
        by_size = {}  # for each width the parities of the rows that have it or twice as much, and where they stand
        for k in np.unique(size).tolist():
            at = np.flatnonzero((size == k) | (size == 2 * k))
            by_size[k] = (np.stack([halved(words[ends[i]:ends[i + 1]], k) for i in at]), np.searchsorted(at, np.arange(len(vid))))
        flat, sizes = token_lists.flatten().to_numpy(), np.diff(token_lists.offsets.to_numpy())
        earlier = flat < token
        kinds, which, often = np.unique(flat[earlier], return_inverse=True, return_counts=True)
        shared = often[which] > 1  # only tokens of two rows or more can be common
        kept, column = np.unique(which[shared], return_inverse=True)
        of = np.repeat(np.arange(len(vid)), sizes)
        at = t.column(10).combine_chunks().flatten().to_numpy()[earlier][shared]
        row = of[earlier][shared]
        larger, smaller = np.zeros((len(vid), len(kept)), np.float32), np.zeros((len(vid), len(kept)), np.float32)
        larger[row, column] = 1
        smaller[row, column] = at < rule.index(n)[row]  # of the smaller set only these entries count, here as in the lists
        found = []
        for c in range(0, len(vid), 256):
            own = slice(c, c + 256)
            first = (n[own, None] < n) | ((n[own, None] == n) & (vid[own, None] < vid))
            ok = first & (component[own, None] != component) & _possible(rule, n[own, None], place[own, None], n, place)
            ok &= (smaller[own] @ larger.T) == 0
            if one != two:
                ok &= block[own, None] != block
            i, j = np.nonzero(ok)
            i += c
            for d in range(0, len(i), 1 << 16):
                x, y = i[d:d + (1 << 16)], j[d:d + (1 << 16)]
                differ, least = np.zeros(len(x), np.int64), np.minimum(size[x], size[y])
                for k, (word, where) in by_size.items():
                    some = np.flatnonzero(least == k)
                    for e in range(0, len(some), max(1, (1 << 20) // k)):
                        z = some[e:e + max(1, (1 << 20) // k)]
                        differ[z] = np.bitwise_count(word[where[x[z]]] ^ word[where[y[z]]]).sum(1)
                good = differ <= n[x] + n[y] - 2 * rule.overlap(n[x], n[y])
                found.append(np.stack([vid[x[good]], vid[y[good]]]))
        every = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(every[0], pa.int64()), pa.array(every[1], pa.int64())], ["a", "b"])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            cut = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cut, cut[1:]):
                now = tuple(int(x) for x in keys[:, a])
                if now != key and held:
                    yield pairs(*key, pa.Table.from_batches(held))
                    held = []
                key = now
                held.append(batch.slice(a, b - a))
        if held:
            yield pairs(*key, pa.Table.from_batches(held))

    return rows.mapInArrow(run, "a long, b long")


def _overlap_column(rule: Threshold, a: Column, b: Column) -> Column:
    return F.ceil(rule.t * (a + b) / F.lit(100 + rule.t))


def join(docs: DataFrame, text: str = "text", id: str = "doc_id", size: int = 4, per_cent: int = 85) -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row of ``docs``.

    Words are runs of bytes other than space and 09-0D, A-Z lowered; a set is
    the distinct ``size``-word shingles, or the whole text if it has fewer
    words.  Two rows are linked when 100 * intersection >= per_cent * union;
    ``component_id`` is the smallest id reachable by links.  Null, empty and
    blank texts have an empty set and are linked with nothing.  Rows of one id
    are one vertex; rows with a null id are linked with nothing and have a
    null component.  Further columns are not read.
    """
    spark = docs.sparkSession
    rule = Threshold(per_cent)
    whole = docs.select(F.col(id).cast("long").alias("__tm_id"), text_or_empty(text).alias("__tm_text"))
    whole = whole.withColumn("__tm_hash", F.xxhash64("__tm_text"))
    histogram, heavy, heat = _survey(whole, size)
    below = boundary(histogram, rule)
    profile = stored(_profile(whole, rule, size, below, heavy, heat), "profiles")

    # one vertex for each distinct set; copies fall away before the shuffle
    same = Window.partitionBy("s1", "s2", "n").orderBy("id", "text_hash")
    vertices = (profile.filter((F.col("n") > 0) & F.col("id").isNotNull())
                .withColumn("k", F.row_number().over(same)).filter("k = 1").drop("k"))
    vertices = stored(vertices.withColumn("vid", F.monotonically_increasing_id()), "vertices")
    members = stored(profile.select("id", "n", "s1", "s2").join(vertices.select("s1", "s2", "n", "vid"), ["s1", "s2", "n"], "left")
                     .select("id", "n", F.when(F.col("id").isNotNull(), F.col("vid")).alias("vid")), "members")
    names_of = stored(vertices.select("vid", "id"), "vertex-ids")
    discard(profile)

    # small sets: the smallest set with a subset links with all that need no more than it
    keys = (vertices.filter(F.size("keys") > 0)
            .select("vid", "n", F.explode(F.arrays_zip("keys", "sizes")).alias("k"))
            .select("vid", "n", F.col("k.keys").alias("key"), F.col("k.sizes").alias("c")))
    least = keys.groupBy("key", "c").agg(F.min(F.struct("n", "vid")).alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    light = (keys.join(least, ["key", "c"]).filter(F.col("vid") != F.col("first.vid"))
             .filter(_overlap_column(rule, F.col("n"), F.col("first.n")) <= F.col("c"))
             .select(F.col("first.vid").alias("a"), F.col("vid").alias("b")))
    light = stored(light, "light-links")

    # large sets: scan the lists of their rarest shingles
    lists = vertices.filter(F.size("tokens") > 0).select("vid", "n", F.posexplode("tokens").alias("place", "token"))
    lists = lists.withColumn("place", F.col("place").cast("long")).repartition("token").sortWithinPartitions("token", "n", "vid")
    scanned = stored(_scan(lists, rule), "candidates")
    pairs = scanned.filter("token is null").select("a", "b").distinct()
    wanted = scanned.select(F.col("a").alias("vid")).unionByName(scanned.filter("token is null").select(F.col("b").alias("vid"))).distinct()
    met = stored(vertices.join(wanted, "vid").select("vid", "n", "id", "text_hash", "tokens", "parity"), "met")
    discard(vertices)
    pairs = stored(_plausible(pairs, met, rule), "pairs")
    texts = _texts(whole, met, pairs)
    edges = stored(_verify(pairs, texts, rule, size).unionByName(light), "links")
    discard(pairs, light, texts)
    known = components(edges)
    discard(edges)

    # long lists: what is in one component by now needs no more; the rest is compared across components
    rows = scanned.filter("token is not null").select("token", "n", "place", F.col("a").alias("vid")).distinct()
    marked = rows.join(known.withColumnRenamed("id", "vid"), "vid", "left")
    marked = stored(marked.withColumn("component", F.coalesce("component", "vid")), "long-lists")
    discard(scanned)
    mixed = marked.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows")).filter("lo < hi")
    mixed = mixed.select("token", F.ceil(F.col("rows") / F.lit(HELD // 2)).cast("long").alias("blocks"))
    left = marked.join(mixed, "token").withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks")))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "token", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "vid", "place", "component")
    # of a vertex's entries only those in these lists matter there
    own = marked.join(mixed, "token").groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("own"))
    own = own.select("vid", F.col("own.place").alias("places"), F.col("own.token").alias("tokens"))
    left = (left.join(met.select("vid", "n", "parity").join(own, "vid"), "vid")
            .select("token", "one", "two", "block", "vid", "n", "place", "component", "tokens", "parity", "places")
            .repartition("token", "one", "two").sortWithinPartitions("token", "one", "two"))
    across = stored(_across(left, rule), "pairs")
    discard(marked)
    texts = _texts(whole, met, across)
    discard(met)
    more = stored(_verify(across, texts, rule, size), "links")
    discard(across, texts)

    # rows of one id are one vertex; the components found before go on as stars, not as links
    spread = members.filter("vid is not null").groupBy("id").agg(F.min("vid").alias("a"), F.max("vid").alias("z")).filter("a < z")
    same_id = members.join(spread, "id").filter("vid > a").select("a", F.col("vid").alias("b"))
    found = components(known.toDF("a", "b").unionByName(more).unionByName(same_id)).withColumnRenamed("id", "vid")
    discard(more)
    named = names_of.join(found, "vid")
    names = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(names, "component").select("vid", "component_id")
    first = names_of.select("vid", F.col("id").alias("first_id")).join(named, "vid", "left")
    first = first.select("vid", F.coalesce("component_id", "first_id").alias("component_id"))
    return (members.join(first, "vid", "left")
            .select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))


def op8(spark, sf_dir: str) -> DataFrame:
    """All documents, 4-word shingles, Jaccard 0.85."""
    return join(table(spark, sf_dir, "documents"))
