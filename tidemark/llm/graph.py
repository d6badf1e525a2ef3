"""Connected components of an edge table, as joins and aggregations over stored rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored


def _nearest(edges: DataFrame) -> DataFrame:
    """Each ``(u, v)`` with the smallest of u and all its v's."""
    least = edges.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    return edges.join(least, "u")


def _pairs(*pairs: tuple[Column, Column]) -> Column:
    """Rows ``(u, v)``, one for each of the given pairs, from one reading of a row."""
    return F.inline(F.array(*(F.struct(u.alias("u"), v.alias("v")) for u, v in pairs)))


def _mark(edges: DataFrame):
    """Number and checksum of a table's edges: equal before and after a round that changed nothing."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every id with an edge; ``component`` is the smallest id reachable.

    Alternates two steps until nothing changes: every vertex hands its larger
    neighbours to the smallest vertex it knows, then its smaller ones too.
    Edges become stars around the smallest ids in a few rounds, whatever the
    size of a component.  Each round is a written table, deleted after the next;
    groups are only aggregated or joined, never gathered.  Loops and null ends are ignored.

    A round's plan reads each step's edges once to group and once to join: each
    exchange of a plan costs the driver a thread, events and, if it is broadcast,
    its table.  Edges that are stars already take one round.
    """
    u, v, m = F.col("u"), F.col("v"), F.col("m")
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter(u != v)
    now = stored(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while True:
        near = _nearest(now.select(_pairs((u, v), (v, u))))
        large = near.filter(v > u).select(v.alias("u"), m.alias("v"))
        small = _nearest(large).select(_pairs((v, m), (u, m))).filter(u != v).distinct()
        last, now = now, stored(small, "edges")
        discard(last)
        said = _mark(now)
        if mark == said:
            break
        mark = said
    ends = now.select("v").distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        ends.select(F.col("v").alias("id"), F.col("v").alias("component")))
