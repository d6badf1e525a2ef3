import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators.iforest import (
    average_path_length,
    decide,
    fit_iforest,
    load_model,
    mean_score,
    predict_class,
    predict_from_features,
    save_model,
    score,
    score_vectors,
    set_alias,
    synthetic_features,
)
from tidemark.schemas import FEATURES


def _outlier_frame(spark):
    rng = np.random.default_rng(42)
    normal = rng.normal(size=(500, 2))
    far = np.array([[8, 8], [-8, 8], [8, -8], [-8, -8], [10, 0]], dtype=float)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(np.vstack([normal, far]))]
    return spark.createDataFrame(rows, "id long, a double, b double")


def test_average_path_length():
    assert average_path_length(np.array([1.0]))[0] == 0.0
    assert average_path_length(np.array([2.0]))[0] == 1.0
    assert math.isclose(average_path_length(np.array([256.0]))[0], 10.244770920116851, rel_tol=1e-9)


def test_outliers_rank_on_top_and_scores_in_range(spark):
    df = _outlier_frame(spark)
    model = fit_iforest(df, features=["a", "b"], n_trees=100, key_cols=["id"])
    scored = score(df, model).orderBy(F.col("anomaly_score").desc()).collect()
    assert {r.id for r in scored[:5]} == {500, 501, 502, 503, 504}
    assert all(0.0 < r.anomaly_score <= 1.0 for r in scored)
    assert mean_score(score(df, model)).first().rows == 505


def test_forest_independent_of_partitioning(spark):
    df = _outlier_frame(spark)
    m1 = fit_iforest(df.repartition(1), features=["a", "b"], n_trees=20, key_cols=["id"])
    m2 = fit_iforest(df.repartition(7), features=["a", "b"], n_trees=20, key_cols=["id"])
    n1 = sorted(m1.nodes.collect())
    n2 = sorted(m2.nodes.collect())
    assert n1 == n2


def test_one_sampling_rule_below_and_above_the_need(spark):
    """Of each tree the psi rows with its smallest hashes, whether the table has fewer or more than trees * psi rows."""
    from tidemark.operators.iforest import _sample, _uniform

    for n in (50, 900, 6000):  # 10 trees * 64 rows = 640
        df = spark.range(n).select(F.xxhash64("id").alias("_key"), F.array(F.col("id").cast("double")).alias("x"))
        psi = min(64, n)
        got = {(r.tree, r.x[0]) for r in _sample(df, F.col("_key"), n, 10, psi, 42).collect()}
        every = df.select("x", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("t"), "_key").select("x", "t", _uniform(F.lit(42), F.col("t"), F.col("_key")).alias("u"))
        want = set()
        for t in range(10):
            rows = sorted((r.u, r.x[0]) for r in every.filter(F.col("t") == t).collect())
            want |= {(t, x) for _, x in rows[:psi]}
        assert got == want


def test_saving_a_version_again_replaces_its_metadata(spark, tmp_shared):
    df = _outlier_frame(spark)
    for trees in (5, 7):
        save_model(fit_iforest(df, features=["a", "b"], n_trees=trees, key_cols=["id"], version="9"), tmp_shared)
    assert load_model(spark, tmp_shared, "9").n_trees == 7
    assert spark.read.parquet(f"{tmp_shared}/metadata").count() == 1


def test_threshold_boundary_and_classes(spark):
    df = spark.createDataFrame([(3.0,), (2.99,)], "anomaly_score double")
    got = [r.is_anomaly for r in decide(df, 3.0).collect()]
    assert got == [True, False]


def test_contamination_quantile(spark):
    df = _outlier_frame(spark)
    model = fit_iforest(df, features=["a", "b"], n_trees=50, key_cols=["id"], contamination=0.1)
    pred = predict_class(score(df, model), model)
    share = pred.filter(F.col("prediction") == -1).count() / 505
    assert 0.07 < share < 0.13


def test_vectors_errors_and_partial_features(spark):
    syn = synthetic_features(spark, 1000, seed=42)
    model = fit_iforest(syn, n_trees=50, key_cols=["id"], contamination=0.1)
    vec = [1000000.0, 5000000.0, 5000000.0, 100.0, 0.1, -0.05, 900000.0, 950000.0, 50000.0, 0.2, 0.5, 14.0, 3.0]
    inst = spark.createDataFrame([(0, vec), (1, vec[:5]), (2, [float("nan")] * 13)], "k int, instance array<double>")
    out = {r.k: r for r in score_vectors(inst, model).collect()}
    assert out[0].error is None and 0 < out[0].anomaly_score <= 1 and out[0].prediction in (1, -1)
    assert out[1].anomaly_score == 0.0 and not out[1].is_anomaly and "expected 13" in out[1].error
    assert out[2].error == "non-finite feature value"
    values = spark.createDataFrame([("p", __import__("datetime").datetime(2024, 1, 1), 100.0, 5000.0)],
                                   "entity_id string, feature_timestamp timestamp_ntz, volume_usd double, "
                                   "tvl_usd double")
    for c in FEATURES[2:]:
        values = values.withColumn(c, F.lit(None).cast("double"))
    ids = spark.createDataFrame([("p",)], "pool_id string")
    r = predict_from_features(values, ids, model).first()
    assert (r.features_used, r.features_missing, r.threshold) == (2, 11, 3.0)
    assert r.is_anomaly is False  # default threshold 3.0 never fires on (0, 1] scores


def test_save_load_alias(spark, tmp_shared):
    df = _outlier_frame(spark)
    m = fit_iforest(df, features=["a", "b"], n_trees=10, key_cols=["id"], version="1")
    save_model(m, tmp_shared, aliases=("latest",))
    set_alias(spark, tmp_shared, "production", "1")
    back = load_model(spark, tmp_shared, "production")
    assert back.features == ["a", "b"] and back.n_trees == 10
    a = [r.anomaly_score for r in score(df, m).orderBy("id").collect()]
    b = [r.anomaly_score for r in score(df, back).orderBy("id").collect()]
    assert a == b


def test_scores_equal_a_brute_force_walk_of_the_node_table(spark):
    """Per row and tree, follow left/right by ``x[feature] < split`` from the root, add
    ``depth + c(size)`` at the leaf, and compare ``2 ** (-mean / c(psi))`` with ``score``."""
    df = _outlier_frame(spark)
    model = fit_iforest(df, features=["a", "b"], n_trees=25, psi=64, key_cols=["id"])
    nodes = {(r.tree, r.node): r for r in model.nodes.collect()}
    c_psi = average_path_length(np.array([float(model.psi)]))[0]

    def walk(x):
        total = 0.0
        for t in range(model.n_trees):
            n = nodes[(t, 0)]
            while n.feature >= 0:
                n = nodes[(t, n.left if x[n.feature] < n.split else n.right)]
            total += n.depth + average_path_length(np.array([float(n.size)]))[0]
        return 2.0 ** (-(total / model.n_trees) / c_psi)

    got = {r.id: r.anomaly_score for r in score(df, model).collect()}
    for r in df.collect():
        assert math.isclose(got[r.id], walk([r.a, r.b]), rel_tol=1e-12)


def test_alias_reassignment_newest_wins(spark, tmp_shared):
    df = _outlier_frame(spark)
    for v in ("1", "2"):
        save_model(fit_iforest(df, features=["a", "b"], n_trees=5, key_cols=["id"], version=v), tmp_shared,
                   aliases=("latest",))
    set_alias(spark, tmp_shared, "production", "2")
    set_alias(spark, tmp_shared, "production", "1")  # roll back
    assert load_model(spark, tmp_shared, "latest").version == "2"
    assert load_model(spark, tmp_shared, "production").version == "1"
    assert load_model(spark, tmp_shared, "2").version == "2"


def test_quantile_by_counted_parts_is_the_nearest_rank(spark):
    """Ties, one value, and a part with many values; no aggregate holds all values in one task."""
    import inspect
    import math

    from tidemark.operators import iforest

    lists = [[0.5] * 7, [i / 1000 for i in range(1, 1001)], [0.25, 0.25, 1.0], [0.5 + i * 1e-9 for i in range(50)] + [0.1]]
    for values in lists:
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        for p in (0.0, 0.1, 0.5, 0.9, 1.0):
            want = sorted(values)[max(1, math.ceil(p * len(values))) - 1]
            assert iforest.nearest_rank(df, "v", p, len(values)) == want
    assert "percentile_approx(" not in inspect.getsource(iforest.fit_iforest)
