"""Distributed Isolation Forest (I-1 ... I-11, X-4).

Algorithm as published (Liu, Ting, Zhou 2008): every tree is grown on a
subsample of psi rows (default 256) to height ceil(log2 psi); a row's anomaly
score is ``2 ** (-E[h(x)] / c(psi))`` with ``c(n) = 2 H(n-1) - 2 (n-1) / n``,
so scores lie in (0, 1] and higher means more anomalous.

How it runs on Spark:

* Sampling is driven by draws named by (seed, tree, row key), never by row
  order or partitioning, so the same data gives the same forest on any cluster:
  every tree takes the ``psi`` rows with its smallest draws, at every table size.
* Each tree is grown level by level in one ``applyInPandas`` group of psi rows:
  groups are bounded by psi, whatever the data size.
* The forest has at most ``n_trees * (2 psi - 1)`` nodes (about 100k for the
  defaults), a proven bound, so it is broadcast to ``mapInArrow`` scorers
  that walk all trees with vectorised numpy over Arrow batches.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import FEATURES

NODE_SCHEMA = T.StructType(
    [
        T.StructField("tree", T.IntegerType(), False),
        T.StructField("node", T.IntegerType(), False),
        T.StructField("feature", T.IntegerType(), False),  # -1 marks a leaf
        T.StructField("split", T.DoubleType(), False),
        T.StructField("left", T.IntegerType(), False),
        T.StructField("right", T.IntegerType(), False),
        T.StructField("size", T.LongType(), False),
        T.StructField("depth", T.IntegerType(), False),
    ]
)

EULER_GAMMA = 0.5772156649015329


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): mean path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb
    return out


@dataclass
class IForestModel:
    nodes: DataFrame
    features: list[str]
    n_trees: int
    psi: int
    seed: int
    n_train: int
    offset: float = 0.5  # rows scoring above it are class -1 (anomaly)
    contamination: str | float = "auto"
    version: str = "1"
    digits: int | None = None
    meta: dict = field(default_factory=dict)
    _forest_bc: object = field(default=None, init=False, repr=False, compare=False)
    _nodes_pd: object = field(default=None, init=False, repr=False, compare=False)

    def forest_broadcast(self, spark: SparkSession):
        """The flattened forest, collected and broadcast once per model, reused by every
        scoring call (a stream scoring each micro-batch does not pile up broadcasts)."""
        if self._forest_bc is None:
            pdf = self._nodes_pd if self._nodes_pd is not None else self.nodes.toPandas()
            forest = _Forest(pdf, self.n_trees, self.psi)
            self._forest_bc = spark.sparkContext.broadcast(forest)
        return self._forest_bc

    def release(self) -> None:
        """Drop the broadcast forest from the executors and the driver."""
        if self._forest_bc is not None:
            self._forest_bc.destroy()
            self._forest_bc = None

    def metadata(self) -> dict:
        return {
            "feature_names": list(self.features),
            "model_type": "IsolationForest",
            "version": self.version,
            "training_samples": int(self.n_train),
            "n_estimators": int(self.n_trees),
            "max_samples": int(self.psi),
            "random_state": int(self.seed),
            "contamination": self.contamination,
            "offset": float(self.offset),
            "digits": self.digits,
        }


def hash_number(*parts: Column | str, digits: int = 12) -> Column:
    """The first hexadecimal ``digits`` of the MD5 of the parts joined by ``|``, as a number: the same in any engine."""
    text = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *text).cast("binary")), 1, digits), 16, 10).cast("bigint")


#: Modulus of the sampling draws, a prime (fixed value).
_PRIME = (1 << 31) - 1


def _multipliers(seed: int, tree: int) -> tuple[int, int]:
    """The two numbers of a tree's draw ``(a key + b) mod p``."""
    number = lambda name: int(hashlib.md5(f"{seed}|{tree}|{name}".encode()).hexdigest()[:12], 16)
    return number("a") % (_PRIME - 1) + 1, number("b") % _PRIME


def _draw(key: Column, a: Column, b: Column) -> Column:
    """A tree's draw for a row, in [0, 1): whole-number arithmetic that any engine repeats."""
    return F.pmod(a * F.pmod(key, F.lit(_PRIME)) + b, F.lit(_PRIME)) / F.lit(float(_PRIME))


def _uniform(seed: Column, tree: Column, key: Column) -> Column:
    """The draw of ``tree`` for the row with this key, in [0, 1)."""
    return _draw(key, F.pmod(hash_number(seed, tree, F.lit("a")), F.lit(_PRIME - 1)) + 1, F.pmod(hash_number(seed, tree, F.lit("b")), F.lit(_PRIME)))


def _rounded(x: Column, digits: int | None) -> Column:
    """Values to ``digits`` decimals, so that sums taken in another order give the same vector; ``None`` leaves them."""
    if digits is None:
        return x
    scale = F.lit(float(10**digits))
    return F.transform(x, lambda v: F.round(v * scale) / scale)


def _vector(features: Sequence[str], default: float) -> Column:
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float(default))) for c in features])


def _node_fraction(seed: int, tree: int, node: int, name: str) -> float:
    """The draw of a node, in [0, 1): MD5 digits, as ``hash_number`` takes them."""
    return int(hashlib.md5(f"{seed}|{tree}|{node}|{name}".encode()).hexdigest()[:12], 16) / float(1 << 48)


def grow_tree(x: np.ndarray, tree: int, max_depth: int, seed: int) -> list[tuple]:
    """Rows ``(node, feature, split, size, depth)`` of the tree grown on the rows of ``x``, level by level.

    A level takes the minimum and maximum of every feature in each of its
    nodes, draws a feature among those with a spread and a split in it, and
    sends the node's rows left (``x < split``) or right.  Draws are named by
    (seed, tree, node); nodes are numbered in heap order (children of ``i``:
    ``2i + 1`` and ``2i + 2``).
    """
    out, node = [], np.zeros(len(x), np.int64)
    for depth in range(max_depth + 1):
        if not len(x):
            break
        order = np.argsort(node, kind="stable")
        x, node = x[order], node[order]
        names, first, size = np.unique(node, return_index=True, return_counts=True)
        low, high = np.minimum.reduceat(x, first), np.maximum.reduceat(x, first)
        feature, split = np.full(len(names), -1), np.zeros(len(names))
        for i, name in enumerate(names.tolist() if depth < max_depth else []):
            spread = np.flatnonzero(high[i] > low[i])
            if len(spread):
                f = int(spread[int(_node_fraction(seed, tree, name, "feature") * len(spread))])
                a, z = float(low[i, f]), float(high[i, f])
                p = a + _node_fraction(seed, tree, name, "split") * (z - a)
                feature[i], split[i] = f, p if a < p <= z else (a + z) / 2.0
        out += zip(names.tolist(), feature.tolist(), split.tolist(), size.tolist(), [depth] * len(names))
        at = np.repeat(np.arange(len(names)), size)
        inner = feature[at] >= 0
        x, node, at = x[inner], node[inner], at[inner]
        node = 2 * node + np.where(x[np.arange(len(x)), feature[at]] < split[at], 1, 2)
    return out


def _sample(df: DataFrame, key: Column, n: int, n_trees: int, psi: int, seed: int) -> DataFrame:
    """Rows ``(tree, u, x)`` of the training subsamples: of each tree the ``psi`` rows with the smallest hash of
    (seed, tree, key).

    One rule for every size.  A row's hashes for all trees are made in place and
    only those below a threshold become rows, about four times what is needed;
    should a tree have fewer than ``psi``, the threshold is raised.  The sample
    depends neither on the threshold nor on the partitioning.
    """
    share = min(1.0, 4.0 * psi / max(n, 1))
    # one literal, not a column object for each number
    numbers = F.expr("array(" + ", ".join(
        "named_struct('tree', {}, 'a', {}L, 'b', {}L)".format(t, *_multipliers(seed, t)) for t in range(n_trees)) + ")")
    while True:
        limit = F.lit(share)
        some = F.filter(numbers, lambda m: _draw(F.col("_k"), m["a"], m["b"]) < limit)  # most draws make no object
        below = F.transform(some, lambda m: F.struct(m["tree"].alias("tree"), _draw(F.col("_k"), m["a"], m["b"]).alias("u")))
        rows = df.select(key.alias("_k"), "x").select("_k", "x", F.explode(below).alias("h")).select("_k", "x", "h.tree", "h.u")
        rn = F.row_number().over(Window.partitionBy("tree").orderBy("u", "_k", "x"))
        sample = rows.withColumn("_rn", rn).filter(F.col("_rn") <= psi).select("tree", "u", "x")
        # bounded (n_trees * psi rows): written once to the shared checkpoint dir, then reused
        sample = sample.checkpoint(eager=True)
        if share >= 1.0 or sample.count() == n_trees * psi:
            return sample
        share = min(1.0, 4.0 * share)


def fit_iforest(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    n_trees: int = 200,
    psi: int = 256,
    seed: int = 42,
    contamination: str | float = "auto",
    key_cols: Sequence[str] | None = None,
    default: float = 0.0,
    version: str = "1",
    digits: int | None = None,
) -> IForestModel:
    """Train an Isolation Forest on ``df`` (I-1, I-2).  Labels, if any, are ignored.

    ``contamination='auto'`` puts the class boundary at score 0.5; a number
    ``c`` puts it at the ``1 - c`` quantile of the training scores.  ``digits``
    rounds every vector, here and when scoring, to that many decimals.

    Draws are made of MD5 digits and whole-number arithmetic, so the same rows
    give the same forest on any cluster and in any engine.
    """
    from tidemark.session import checkpoint_dir, scratch_path

    checkpoint_dir(df.sparkSession)  # the bounded sample is checkpointed to the shared folder
    features = list(features)
    key = hash_number(*(key_cols or features), digits=15)
    # The projected vectors are read up to three times (count, sample, contamination
    # scores): written once, so a lost executor costs a re-read and no executor memory is held.
    path = scratch_path(df.sparkSession, "training-vectors")
    data = df.select(key.alias("_key"), _rounded(_vector(features, default), digits).alias("x"))
    data.write.parquet(path)
    data = df.sparkSession.read.schema(data.schema).parquet(path)
    n = data.count()
    if n == 0:
        raise ValueError("cannot fit an isolation forest on an empty frame")
    psi_eff = int(min(psi, n))
    max_depth = int(math.ceil(math.log2(max(psi_eff, 2))))
    sample = _sample(data, F.col("_key"), n, n_trees, psi_eff, seed)
    n_feat = len(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.array(pdf["x"].tolist(), dtype=np.float64).reshape(-1, n_feat)
        out = pd.DataFrame(grow_tree(x, tree, max_depth, seed), columns=["node", "feature", "split", "size", "depth"])
        inner = out["feature"] >= 0
        out["left"], out["right"], out["tree"] = (2 * out["node"] + 1).where(inner, -1), (2 * out["node"] + 2).where(inner, -1), tree
        kinds = {f.name: {"integer": "int32", "double": "float64", "long": "int64"}[f.dataType.typeName()] for f in NODE_SCHEMA}
        return out[list(kinds)].astype(kinds)

    nodes = sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    # Materialise the (bounded) node table once so scoring and saving reuse it.
    nodes_pd = nodes.toPandas()
    nodes = df.sparkSession.createDataFrame(nodes_pd, NODE_SCHEMA)
    model = IForestModel(nodes=nodes, features=features, n_trees=n_trees, psi=psi_eff, seed=seed, n_train=n,
                         contamination=contamination, version=version, digits=digits)
    model._nodes_pd = nodes_pd  # the bounded node table is already on the driver: score from it
    if contamination == "auto":
        model.offset = 0.5
    else:
        c = float(contamination)
        scores = scratch_path(df.sparkSession, "training-scores")
        score(data.select("x"), model, vector_col="x").select("anomaly_score").write.parquet(scores)
        model.offset = nearest_rank(df.sparkSession.read.schema("anomaly_score double").parquet(scores), "anomaly_score", 1.0 - c, n)
    return model


#: Equal parts of [0, 1] in which scores are counted to find a quantile.
SCORE_PARTS = 1 << 16


def nearest_rank(df: DataFrame, col: str, p: float, n: int) -> float:
    """The value of rank ``ceil(p n)`` among the ``n`` values of ``col``, all in [0, 1].

    Exact at any size, without all values in one task: they are counted in
    ``SCORE_PARTS`` parts, and only the part that holds the rank is put in
    order, one row for each different value in it.
    """
    rank = min(n, max(1, math.ceil(p * n)))
    part = F.floor(F.col(col) * SCORE_PARTS)
    before = 0
    for at, count in sorted(tuple(r) for r in df.groupBy(part.alias("part")).count().collect()):
        if before + count >= rank:
            break
        before += count
    upto = F.sum("count").over(Window.orderBy(col).rowsBetween(Window.unboundedPreceding, 0))
    values = df.filter(part == at).groupBy(col).count().withColumn("_upto", upto)
    return float(values.filter(F.col("_upto") >= rank - before).agg(F.min(col)).first()[0])


class _Forest:
    """A forest laid out as complete binary trees of its height (heap order).

    Node ``i`` of a tree has children ``2i+1`` and ``2i+2``; a leaf above the
    last level is copied to every last-level slot below it.  Walking a batch
    is ``height`` rounds of ``i = 2i + 2 - (x[feature[i]] < split[i])``: three
    gathers and integer arithmetic per round, no branches, no child tables.
    A NaN value goes right, as ``x < split`` is false.
    """

    def __init__(self, pdf: pd.DataFrame, n_trees: int, psi: int):
        pdf = pdf.sort_values(["tree", "node"]).reset_index(drop=True)
        tree = pdf["tree"].to_numpy().astype(np.intp)
        node = pdf["node"].to_numpy().astype(np.intp)
        feat = pdf["feature"].to_numpy()
        depth = pdf["depth"].to_numpy().astype(np.intp)
        height = int(depth.max()) if len(pdf) else 0
        width = 2 ** (height + 1) - 1
        n_leaf = 2 ** height
        # heap position of every node, assigned level by level from the roots
        pos = np.zeros((n_trees, int(node.max()) + 1 if len(pdf) else 1), dtype=np.intp)
        left = pdf["left"].to_numpy().astype(np.intp)
        right = pdf["right"].to_numpy().astype(np.intp)
        for d in range(height):
            inner = (depth == d) & (feat >= 0)
            p = pos[tree[inner], node[inner]]
            pos[tree[inner], left[inner]] = 2 * p + 1
            pos[tree[inner], right[inner]] = 2 * p + 2
        hp = pos[tree, node]
        self.feature = np.zeros((n_trees, width), dtype=np.intp)
        self.split = np.full((n_trees, width), np.inf)
        inner = feat >= 0
        self.feature[tree[inner], hp[inner]] = feat[inner]
        self.split[tree[inner], hp[inner]] = pdf["split"].to_numpy()[inner]
        # a leaf at depth d owns the 2^(height-d) last-level slots below it
        lf = ~inner
        span = 2 ** (height - depth[lf])
        start = (hp[lf] + 1) * span - n_leaf
        # to 40 binary digits: the sum over the trees is then exact in any order
        value = np.round((depth[lf] + average_path_length(pdf["size"].to_numpy()[lf])) * 2.0**40) / 2.0**40
        offs = np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span)
        self.leaf_path = np.zeros((n_trees, n_leaf))
        self.leaf_path[np.repeat(tree[lf], span), np.repeat(start, span) + offs] = np.repeat(value, span)
        self.feature = self.feature.ravel()
        self.split = self.split.ravel()
        self.leaf_path = self.leaf_path.ravel()
        self.height = height
        self.width = width
        self.n_leaf = n_leaf
        self.n_trees = n_trees
        self.c_psi = float(average_path_length(np.array([psi]))[0])

    def score(self, x: np.ndarray, chunk: int | None = None) -> np.ndarray:
        m, d = x.shape
        # about 50k (row, tree) cells per round keeps the working arrays in cache
        chunk = chunk or max(16, 50_000 // max(self.n_trees, 1))
        out = np.empty(m)
        for lo in range(0, m, chunk):
            out[lo:lo + chunk] = self._score(np.ascontiguousarray(x[lo:lo + chunk], dtype=np.float64), d)
        return out

    def _score(self, x: np.ndarray, d: int) -> np.ndarray:
        m = x.shape[0]
        flat = x.ravel()
        row_base = (np.arange(m, dtype=np.intp) * d)[:, None]
        tree_base = (np.arange(self.n_trees, dtype=np.intp) * self.width)[None, :]
        idx = np.zeros((m, self.n_trees), dtype=np.intp)
        for _ in range(self.height):
            g = idx + tree_base
            go_left = flat[row_base + self.feature[g]] < self.split[g]
            idx = 2 * idx + 2 - go_left
        leaf = idx - (self.n_leaf - 1) + (np.arange(self.n_trees, dtype=np.intp) * self.n_leaf)[None, :]
        mean_path = self.leaf_path[leaf].mean(axis=1)
        return np.power(2.0, -mean_path / self.c_psi) if self.c_psi > 0 else np.ones(m)


def score(
    df: DataFrame,
    model: IForestModel,
    default: float = 0.0,
    out_col: str = "anomaly_score",
    vector_col: str | None = None,
) -> DataFrame:
    """Append the anomaly score in (0, 1] (I-3, X-4).

    The forest is collected once per model (its size is bounded by
    ``n_trees * (2 psi - 1)`` nodes) and broadcast; every task scores its Arrow
    batches with numpy.
    """
    spark = df.sparkSession
    bc = model.forest_broadcast(spark)
    n_feat = len(model.features)
    tmp = "_iforest_x"
    base = df.drop(out_col) if out_col in df.columns else df
    src = base.withColumn(tmp, _rounded(F.col(vector_col) if vector_col else _vector(model.features, default), model.digits))
    schema = T.StructType(base.schema.fields + [T.StructField(out_col, T.DoubleType())])
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = bc.value
        for batch in batches:
            x = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n_feat)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(f.score(x), pa.float64())], [*names, out_col])

    # the other columns pass as they came: NaN stays NaN, in arrays too
    return src.select(*names, tmp).mapInArrow(run, schema)


def decide(df: DataFrame, threshold: float = 3.0, col: str = "anomaly_score") -> DataFrame:
    """``is_anomaly = score >= threshold``; the boundary counts as anomalous (I-4)."""
    return df.withColumn("is_anomaly", F.col(col) >= F.lit(float(threshold))).withColumn(
        "threshold", F.lit(float(threshold)))


def predict_class(df: DataFrame, model: IForestModel, col: str = "anomaly_score") -> DataFrame:
    """Class output: 1 normal, -1 anomaly (score above the model's offset) (I-5)."""
    return df.withColumn("prediction", F.when(F.col(col) > F.lit(model.offset), F.lit(-1)).otherwise(F.lit(1)))


def mean_score(scored: DataFrame, col: str = "anomaly_score") -> DataFrame:
    """Mean anomaly score over a scored set (A-11)."""
    return scored.agg(F.avg(col).alias("mean_anomaly_score"), F.count(F.lit(1)).alias("rows"))


def vector_validity(vec: Column, n: int) -> Column:
    """Error text for a bad instance vector (wrong length, NaN, infinite), NULL when valid (I-7, I-8)."""
    bad_value = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return (
        F.when(vec.isNull(), F.lit("missing instance"))
        .when(F.size(vec) != F.lit(n), F.concat(F.lit(f"expected {n} features, got "), F.size(vec).cast("string")))
        .when(bad_value, F.lit("non-finite feature value"))
    )


def score_vectors(df: DataFrame, model: IForestModel, vector_col: str = "instance",
                  threshold: float = 3.0) -> DataFrame:
    """Score raw 13-element instance arrays (I-8); invalid ones get score 0.0,
    ``is_anomaly`` false and an ``error`` instead of failing the batch (I-7)."""
    n = len(model.features)
    checked = df.withColumn("error", vector_validity(F.col(vector_col), n))
    safe_vec = F.when(F.col("error").isNull(), F.col(vector_col)).otherwise(
        F.array_repeat(F.lit(0.0), n))
    scored = score(checked.withColumn("_vec", safe_vec), model, vector_col="_vec").drop("_vec")
    ok = F.col("error").isNull()
    scored = scored.withColumn("anomaly_score", F.when(ok, F.col("anomaly_score")).otherwise(F.lit(0.0)))
    out = decide(scored, threshold).withColumn("is_anomaly", ok & F.col("is_anomaly"))
    return predict_class(out, model).withColumn(
        "prediction", F.when(ok, F.col("prediction")).otherwise(F.lit(None).cast("int")))


def predict_from_features(values: DataFrame, ids: DataFrame, model: IForestModel, threshold: float = 3.0,
                          default: float = 0.0) -> DataFrame:
    """Prediction rows for requested ids from stored feature values (I-6, M-8 + I-3 + I-4):
    ``pool_id, score, is_anomaly, threshold, features_used, features_missing, error``."""
    from tidemark.operators.lookup import read_features

    feats = read_features(values, ids, model.features, default=default)
    vec = F.array(*[F.col(c) for c in model.features])
    scored = score_vectors(feats.withColumn("instance", vec), model, "instance", threshold)
    return scored.select(
        "pool_id",
        F.col("anomaly_score").alias("score"),
        "is_anomaly",
        "threshold",
        "features_used",
        "features_missing",
        "error",
    )


def synthetic_features(spark: SparkSession, n: int = 1000, seed: int = 42,
                       features: Sequence[str] = FEATURES) -> DataFrame:
    """Synthetic training frame (I-10): gaussians; money columns |x|*1e6, count int(|x|)*100,
    hour uniform 0-23, weekday uniform 1-7 (the SQL ``DAYOFWEEK`` range)."""
    f = list(features)
    cols = []
    for i, name in enumerate(f):
        g = F.randn(seed + i)
        if i < 3:
            e = F.abs(g) * F.lit(1_000_000.0)
        elif i == 3:
            e = (F.floor(F.abs(g)) * 100).cast("bigint")
        elif i == len(f) - 2:
            e = F.floor(F.rand(seed + i) * 24).cast("bigint")
        elif i == len(f) - 1:
            e = (F.floor(F.rand(seed + i) * 7) + 1).cast("bigint")
        else:
            e = g
        cols.append(e.alias(name))
    return spark.range(n).select(F.col("id"), *cols)


# ---- persistence (I-11) ------------------------------------------------------------

def save_model(model: IForestModel, path: str, aliases: Sequence[str] = ("latest",)) -> None:
    """Node table partitioned by version, a metadata row and an alias table."""
    spark = model.nodes.sparkSession
    root = path.rstrip("/")
    model.nodes.withColumn("version", F.lit(model.version)).write.mode("overwrite").partitionBy(
        "version").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/nodes")
    meta = spark.createDataFrame([(model.version, json.dumps(model.metadata()))], "version string, metadata string")
    meta.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{root}/metadata")
    for a in aliases:
        set_alias(spark, root, a, model.version)


def set_alias(spark: SparkSession, path: str, alias: str, version: str) -> None:
    """Point ``alias`` at ``version``; each assignment is a row stamped with its time."""
    import datetime as _dt

    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(alias, version, now)], "alias string, version string, set_at timestamp_ntz").write.mode(
        "append").parquet(f"{path.rstrip('/')}/aliases")


def load_model(spark: SparkSession, path: str, version: str = "latest") -> IForestModel:
    """Load by version or alias (``latest``, ``production``); the newest assignment of an alias wins."""
    root = path.rstrip("/")
    aliases = spark.read.parquet(f"{root}/aliases")
    hit = aliases.filter(F.col("alias") == version).orderBy(F.col("set_at").desc()).select("version").first()
    ver = hit["version"] if hit else version
    meta_row = spark.read.schema("metadata string, version string").parquet(f"{root}/metadata").filter(F.col("version") == ver).first()
    if meta_row is None:
        raise FileNotFoundError(f"model version {ver!r} not found under {root}")
    meta = json.loads(meta_row["metadata"])
    nodes_pd = spark.read.parquet(f"{root}/nodes").filter(F.col("version") == ver).drop("version").toPandas()
    model = IForestModel(nodes=spark.createDataFrame(nodes_pd, NODE_SCHEMA), features=meta["feature_names"],
                         n_trees=meta["n_estimators"], psi=meta["max_samples"], seed=meta["random_state"],
                         n_train=meta["training_samples"], offset=meta["offset"],
                         contamination=meta["contamination"], version=ver, digits=meta.get("digits"), meta=meta)
    model._nodes_pd = nodes_pd
    return model
