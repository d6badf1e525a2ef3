"""Hard negatives by coordinate pruning of inner-product searches.

Vectors are dealt into blocks sorted by label and falling length, and a block
into buckets of one label.  A bucket keeps its largest length and, for every
coordinate of the scaled vectors, the sorted list of values.  An anchor that
needs a product of at least ``t`` needs a cosine of ``t / (|anchor| longest)``
in a bucket; with that cosine a coordinate of a vector must lie in a range
around the anchor's own.  The ranges of the anchor's largest coordinates are
looked up in the sorted lists, the smallest list is cut by the other ranges,
and what is left is multiplied exactly in whole numbers.  The needed product
rises as results are found, and a bucket that cannot reach it is skipped.

Anchors and vectors meet block by block.  A group returns the best rows of its
block for each anchor, the best of all blocks are taken by rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

#: Vectors in a block and anchors in a group (about: blocks are ranges by sampled bounds).
BLOCK, ANCHORS = 8192, 2048
#: Vectors in a bucket, and coordinates of an anchor that are looked at.
BUCKET, FOCUS = 1024, 4
#: Floats hold whole numbers exactly below this.
EXACT = 1 << 53
#: Below every product, and the number that stands for a null id, after every other.
NO_PRODUCT, NO_ID = -(1 << 62), (1 << 63) - 1


class Bucket:
    """Vectors of one label with their sorted coordinate lists."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rid: np.ndarray, label: int):
        self.x, self.ids, self.rid, self.label = x, ids, rid, label
        length = np.sqrt(np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64)))
        self.longest = float(length.max())
        scaled = x / np.where(length > 0, length, 1)[:, None]
        self.lists = np.argsort(scaled, axis=0)
        self.values = np.take_along_axis(scaled, self.lists, axis=0)
        self.scaled = scaled
        self.whole = np.arange(len(x))
        self.floats = x.astype(np.float64) if self.longest * self.longest < EXACT else None

    def candidates(self, anchor: np.ndarray, length: float, focus: np.ndarray, least: float) -> np.ndarray:
        """Places of the vectors that may reach the product ``least`` with an anchor of this length."""
        if not least > 0:
            return self.whole
        reach = length * self.longest
        if reach == 0:
            return self.whole[:0]
        cosine = least / reach * (1 - 1e-9) - 1e-9
        if cosine > 1:
            return self.whole[:0]
        if cosine <= 0:
            return self.whole
        own = anchor[focus] / length
        spread = sqrt(1 - cosine * cosine) * np.sqrt(np.maximum(0, 1 - own * own))
        # within the angle of the cosine around the anchor's own angle; past a pole the range is open
        low = np.where(-own >= cosine, -np.inf, own * cosine - spread - 1e-9)
        high = np.where(own >= cosine, np.inf, own * cosine + spread + 1e-9)
        # a zero vector is in no list by its angle, and reaches no positive product
        spans = [(np.searchsorted(self.values[:, f], a, "left"), np.searchsorted(self.values[:, f], b, "right")) for f, a, b in zip(focus, low, high)]
        k = int(np.argmin([b - a for a, b in spans]))
        rows = self.lists[spans[k][0]:spans[k][1], focus[k]]
        for j, f in enumerate(focus):
            if j != k and len(rows) and spans[j][1] - spans[j][0] < len(self.whole):
                v = self.scaled[rows, f]
                rows = rows[(v >= low[j]) & (v <= high[j])]
        return rows

    def products(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact whole products: by floats while every product is below 2**53, else by 64-bit integers."""
        if self.floats is not None and float(anchor @ anchor) * self.longest**2 < float(EXACT) ** 2:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.x[rows] @ anchor


def _matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.tolist(), np.int64).reshape(len(values), len(values.iloc[0]) if len(values) else 0)


def _buckets(rows: pd.DataFrame, most: int) -> list[Bucket]:
    """The buckets of a block: runs of one label in falling length."""
    rows = rows.sort_values(["label", "norm"], ascending=[True, False], ignore_index=True)
    out = []
    for label, part in rows.groupby("label", sort=True):
        for a in range(0, len(part), most):
            p = part.iloc[a:a + most]
            out.append(Bucket(_matrix(p["v"]), p["vec_id"].to_numpy(np.int64), p["rid"].to_numpy(np.int64), int(label)))
    return out


def _first(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    if len(score) > 4 * n + 16:  # all that reach the n-th score, then sort only those
        edge = np.partition(score, len(score) - n)[len(score) - n]
        near = np.flatnonzero(score >= edge)
        return near[np.lexsort((ids[near], -score[near]))[:n]]
    return np.lexsort((ids, -score))[:n]


def _anchors(rows: pd.DataFrame) -> Iterator[tuple]:
    v = _matrix(rows["v"])
    length = np.sqrt(np.einsum("ij,ij->i", v.astype(np.float64), v.astype(np.float64)))
    focus = np.argsort(-np.abs(v), axis=1)[:, :FOCUS]
    for i, r in enumerate(rows.itertuples(index=False)):
        yield r, v[i], float(length[i]), focus[i]


def nearest_same(anchors: pd.DataFrame, block: pd.DataFrame, n: int, bucket: int = BUCKET) -> pd.DataFrame:
    """``(rid, other, vec_id, score)``: each anchor's ``n`` best other vectors of its label in a block."""
    out = {"rid": [], "other": [], "vec_id": [], "score": []}
    buckets = _buckets(block, bucket)
    for r, v, length, focus in _anchors(anchors):
        score, ids, rid = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in buckets:
            if b.label != r.label:
                continue
            least = int(score[n - 1]) if len(score) >= n else NO_PRODUCT
            rows = b.candidates(v, length, focus, least)
            rows = rows[b.rid[rows] != r.rid]
            s = b.products(v, rows)
            rows, s = rows[s >= least], s[s >= least]
            score, ids, rid = np.append(score, s), np.append(ids, b.ids[rows]), np.append(rid, b.rid[rows])
            best = _first(score, ids, n)
            score, ids, rid = score[best], ids[best], rid[best]
        out["rid"] += [r.rid] * len(score)
        out["other"] += rid.tolist()
        out["vec_id"] += ids.tolist()
        out["score"] += score.tolist()
    return pd.DataFrame(out).astype({"rid": "int64", "other": "int64", "vec_id": "int64", "score": "int64"})


def negatives_within(anchors: pd.DataFrame, block: pd.DataFrame, n: int, low: int, high: int, bucket: int = BUCKET) -> pd.DataFrame:
    """``(rid, positive, negative_id, negative_score)``: for each positive of an anchor the first ``n`` vectors of other
    labels whose score is between ``low`` and ``high`` hundredths of the positive's."""
    out = {"rid": [], "positive": [], "negative_id": [], "negative_score": []}
    buckets = _buckets(block, bucket)
    for r, v, length, focus in _anchors(anchors):
        bounds = [(-(-low * s // 100), high * s // 100) for s in map(int, r.scores)]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in bounds]
        least = [a if a <= z else None for a, z in bounds]  # a negative positive score leaves no range
        for b in buckets:
            live = [x for x in least if x is not None]
            if b.label == r.label or not live:
                continue
            rows = b.candidates(v, length, focus, min(live))
            s, ids = b.products(v, rows), b.ids[rows]
            for k, (a, z) in enumerate(bounds):
                if least[k] is None:
                    continue
                ok = (s >= least[k]) & (s <= z)
                if ok.any():
                    score, of = np.append(found[k][0], s[ok]), np.append(found[k][1], ids[ok])
                    best = _first(score, of, n)
                    found[k] = score[best], of[best]
                    if len(best) == n:
                        least[k] = max(least[k], int(score[best[-1]]))
        for k, (score, ids) in enumerate(found):
            out["rid"] += [r.rid] * len(score)
            out["positive"] += [k] * len(score)
            out["negative_id"] += ids.tolist()
            out["negative_score"] += score.tolist()
    return pd.DataFrame(out).astype({"rid": "int64", "positive": "int32", "negative_id": "int64", "negative_score": "int64"})


def whole_vectors(rows: DataFrame, id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, label, v, size, norm)``: components as ``floor(256 x)``; rows that take no part are left out."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(e, lambda x: F.floor(x.cast("double") * 256))
    norm = F.aggregate(F.transform(e, lambda x: F.floor(x.cast("double") * 256).cast("double")), F.lit(0.0), lambda a, x: a + x * x)
    good = rows.filter(F.col(label).isNotNull() & e.isNotNull() & finite)
    return (good.select(F.col(id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), scaled.alias("v"), F.size(e).alias("size"), norm.alias("norm"))
            .filter(F.col("norm") < float(1 << 62)))


def hard_negatives(rows: DataFrame, is_anchor, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` as from ``whole_vectors``; ``is_anchor`` picks the anchors by a
    condition on its columns.  An anchor's positives are its best other rows
    of the same label; for each the best rows of other labels with
    ``low * positive <= 100 * negative <= high * positive``.  Higher scores
    come first, ties by smaller id, a null id last
    (2**63 - 1 counts as null).

    Rows of equal id are rows of their own, each may be an anchor; a row is
    never its own positive.  Vectors are compared with those of their own
    size; an empty one has score 0 with another.  Vectors whose squared length
    passes 2**62 take no part, so every score fits in 64 bits.  An empty table,
    one label, or anchors without positives give no rows.
    """
    named = rows.withColumn("anchor", F.coalesce(is_anchor, F.lit(False))).withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID)))
    kept = stored(named.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    n = kept.count()
    blocks = max(1, -(-n // BLOCK))
    # by label, then falling length; the row number last, so that equal vectors spread too
    kept = stored(kept.repartitionByRange(blocks, "label", F.col("norm").desc(), "rid").withColumn("block", F.spark_partition_id()), "blocks")
    anchors = stored(kept.filter("anchor").select("rid", F.col("vec_id").alias("anchor_id"), "label", "size", "v"), "anchors")
    groups = max(1, -(-anchors.count() // ANCHORS))
    dealt = anchors.withColumn("deal", F.pmod(F.xxhash64("rid"), F.lit(groups)).cast("int"))
    sent = kept.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select("block", "size", "deal", "rid", "vec_id", "label", "norm", "v")
    # columns of their own, so that both sides of a group are told apart
    held = kept.groupBy("block", "size", "label").count().select(*[F.col(c).alias(c) for c in ("block", "size", "label")])
    key, bucket = ["block", "size", "deal"], BUCKET

    def same(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return nearest_same(left, right, n_positives, bucket)

    def others(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return negatives_within(left, right, n_negatives, low, high, bucket)

    met = dealt.join(held, ["size", "label"]).groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(
        same, "rid long, other long, vec_id long, score long")
    order = Window.partitionBy("rid").orderBy(F.col("score").desc(), F.col("vec_id"), "other")
    best = met.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n_positives)
    lists = best.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("p"))
    asked = stored(dealt.join(lists, "rid").withColumn("scores", F.col("p.score")), "positives")
    elsewhere = held.groupBy("block", "size").agg(F.min("label").alias("one"), F.max("label").alias("two"))
    reached = asked.join(elsewhere, "size").filter((F.col("one") != F.col("label")) | (F.col("two") != F.col("label")))
    found = reached.select(*key, "rid", "label", "v", "scores").groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(
        others, "rid long, positive int, negative_id long, negative_score long")
    order = Window.partitionBy("rid", "positive").orderBy(F.col("negative_score").desc(), F.col("negative_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
    p, no_id = F.get("p", F.col("positive")), F.lit(NO_ID)
    return ranked.join(asked.select("rid", "anchor_id", "p"), "rid").select(
        F.nullif("anchor_id", no_id).alias("anchor_id"), F.nullif(p["vec_id"], no_id).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.nullif("negative_id", no_id).alias("negative_id"), p["score"].alias("positive_score"), "negative_score")


def op13(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of the embeddings."""
    rows = whole_vectors(table(spark, sf_dir, "embeddings"))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", shifted), F.col("vec_id") % 50 == 0)
