"""Embedding near-duplicates by collision-counting projections.

Vectors are projected on many random directions.  Along each projection a
query's window of fixed width holds the vectors that collide with it; sorted
values give the window as a range of ranks.  A pair that collides in enough
projections is verified by its cosine in double precision.  How many are
enough follows from the binomial law: a pair exactly at the threshold reaches
the count with probability ``recall``, closer pairs more often.

Equal vectors are one vertex with a weight.  Vertices are dealt into blocks,
and each pair of blocks is one group of bounded size, whose result is one row
for each linked vertex (weight of its links, smallest vertex of its local
component), never a list of pairs.
"""

from __future__ import annotations

from math import ceil, comb, erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.graph import components

#: Projections, half a window's width in units of the distance at the threshold, and the recall there.
PROJECTIONS, WIDTH, RECALL = 24, 1.5, 0.999
#: Vertices in a block; a group holds two blocks.
BLOCK = 4096
#: Queries counted side by side, and pairs verified at once.
QUERIES, PAIRS = 128, 1 << 15


def calibrated_count(projections: int = PROJECTIONS, width: float = WIDTH, recall: float = RECALL) -> int:
    """Largest count that a pair at the threshold distance reaches with probability ``recall`` or more.

    The difference of two projected unit vectors is normal with their distance
    as deviation, so a window of ``width`` deviations holds it with a fixed
    probability, independently in each projection.
    """
    p = erf(width / sqrt(2))
    tail = 0.0
    for count in range(projections, 0, -1):
        tail += comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if tail >= recall:
            return count
    return 0


def unit_rows(values: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in values])
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the classes of linked places; a class is named by its smallest place."""
    while True:
        la, lb = labels[a], labels[b]
        if (la == lb).all():
            return labels
        low = np.minimum(la, lb)
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while (labels[labels] != labels).any():
            labels = labels[labels]


def linked_in(x: np.ndarray, y: np.ndarray | None, threshold: float, seed: int = 7):
    """Pairs ``(query, row)`` of unit rows with cosine at or over the threshold, chunk by chunk.

    ``y`` None: pairs inside ``x``, each once with query < row.
    """
    inside, y = y is None, x if y is None else y
    axes = np.random.default_rng(seed).standard_normal((x.shape[1], PROJECTIONS))
    half = WIDTH * sqrt(2 - 2 * threshold)
    enough = calibrated_count()
    px, py = x @ axes, y @ axes
    order = np.argsort(py, axis=0)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(y))[:, None], axis=0)
    kind = np.uint16 if len(y) < 1 << 16 else np.uint32
    rank = np.ascontiguousarray(rank.T.astype(kind))
    sorted_y = np.take_along_axis(py, order, axis=0)
    low = np.stack([np.searchsorted(sorted_y[:, k], px[:, k] - half, "left") for k in range(PROJECTIONS)]).astype(kind)
    high = np.stack([np.searchsorted(sorted_y[:, k], px[:, k] + half, "right") for k in range(PROJECTIONS)]).astype(kind)
    for q in range(0, len(x), QUERIES):
        first = q + 1 if inside else 0
        if first >= len(y):
            break
        count = np.zeros((min(QUERIES, len(x) - q), len(y) - first), np.uint8)
        for k in range(PROJECTIONS):
            lo, hi = low[k, q:q + QUERIES, None], high[k, q:q + QUERIES, None]
            count += (rank[k, first:] - lo) < (hi - lo)  # ranks below the window wrap around to large numbers
        a, b = np.nonzero(count >= enough)
        a, b = a + q, b + first
        if inside:
            a, b = a[a < b], b[a < b]
        for c in range(0, len(a), PAIRS):
            i, j = a[c:c + PAIRS], b[c:c + PAIRS]
            ok = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
            if ok.any():
                yield i[ok], j[ok]


def near_duplicates(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row.

    ``n_links``: other rows with cosine >= ``threshold``; ``component_id``: the
    smallest id reachable by links; ``kept``: it is the row's own.  Rows whose
    vector is null, empty, zero, or holds a null, NaN or infinity are linked
    with nothing, nor are vectors of different lengths.  Rows of equal id are
    vectors of their own.  Further columns are not read.

    Counting compares all blocks with one another, so its work grows with the
    square of the number of distinct vectors; its memory does not grow.
    """
    e = F.col(embedding)
    good = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    rows = vectors.select(F.col(id).alias("id"), e.alias("e"), F.coalesce(good, F.lit(False)).alias("good"))
    rows = rows.withColumns({"h1": F.xxhash64("e"), "h2": F.xxhash64(F.lit("second"), "e")})
    vertices = (rows.filter("good").groupBy("h1", "h2").agg(F.first("e").alias("e"), F.count("*").alias("weight"), F.min("id").alias("first_id")))
    vertices = stored(vertices.withColumns({"vid": F.monotonically_increasing_id(), "size": F.size("e")}), "vectors")
    counts = {r["size"]: ceil(r["count"] / BLOCK) for r in vertices.groupBy("size").count().collect()}  # a row for each length
    if not counts:
        return vectors.select(id, F.lit(0).cast("long").alias("n_links"), F.col(id).alias("component_id"), F.lit(True).alias("kept"))
    blocks = F.create_map(*[F.lit(v) for pair in counts.items() for v in pair])
    dealt = (vertices.withColumn("blocks", F.element_at(blocks, F.col("size")))
             .withColumn("block", F.pmod(F.xxhash64("vid"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("size", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "vid", "weight", "e"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = int(pdf["one"].iloc[0]), int(pdf["two"].iloc[0])
        pdf = pdf.sort_values(["block", "vid"], ignore_index=True)
        x, weight, vid = unit_rows(pdf["e"].tolist()), pdf["weight"].to_numpy(), pdf["vid"].to_numpy()
        cut = int((pdf["block"] == one).sum())
        links, labels = np.zeros(len(x), np.int64), np.arange(len(x))
        pairs = linked_in(x, None, threshold) if one == two else linked_in(x[:cut], x[cut:], threshold)
        for a, b in pairs:
            b = b if one == two else b + cut
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            labels = _labels(labels, a, b)
        at = np.flatnonzero(links)
        return pd.DataFrame({"vid": vid[at], "links": links[at], "root": vid[labels[at]]})

    found = stored(dealt.groupBy("size", "one", "two").applyInPandas(compare, "vid long, links long, root long"), "links")
    links = found.groupBy("vid").agg(F.sum("links").alias("links"))
    together = components(found.select("vid", "root"), "vid", "root").withColumnRenamed("id", "vid")
    names = (vertices.select("vid", "first_id").join(together, "vid").groupBy("component").agg(F.min("first_id").alias("component_id")))
    named = together.join(names, "component").select("vid", "component_id")
    of = (vertices.select("h1", "h2", "vid", "weight", "first_id").join(links, "vid", "left").join(named, "vid", "left")
          .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                  F.coalesce("component_id", "first_id").alias("component_id")))
    joined = rows.select("id", "h1", "h2", "good").join(of, ["h1", "h2"], "left")
    component = F.when(F.col("good"), F.col("component_id")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias(id), F.when(F.col("good"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op1(spark, sf_dir: str) -> DataFrame:
    """All embeddings at cosine 0.9."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
