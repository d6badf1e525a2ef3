import numpy as np

from tidemark.llm import vectors as V

NAN, INF = float("nan"), float("inf")


def brute(rows, threshold=0.9):
    ids, es = [r[0] for r in rows], [r[1] for r in rows]
    ok = [e is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e) for e in es]
    link = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(es[i]) == len(es[j]):
                a, b = np.array(es[i], float), np.array(es[j], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    link[i].add(j)
                    link[j].add(i)
    out = []
    for i in link:
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min(ids[j] for j in seen) if len(seen) > 1 else ids[i]
        out.append((ids[i], len(link[i]), least, ids[i] == least))
    return sorted(out, key=str)


def test_links_and_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 40)  # several blocks
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 16))
    rows = [(k, (base[k % 30] + rng.normal(scale=rng.choice([0.05, 0.3, 2.0]), size=16)).astype(np.float32).tolist()) for k in range(120)]
    rows += [(200 + k, rows[3][1]) for k in range(25)]  # copies
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [NAN] * 16), (304, [INF] + [1.0] * 15), (305, [None] + [1.0] * 15), (306, [1.0, 2.0]), (307, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS n_links", "2 AS h1")
    got = sorted((tuple(r) for r in V.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert V.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_calibrated_count_reaches_its_recall():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * side  # pairs at the threshold
    axes = rng.normal(size=(64, V.PROJECTIONS))
    hits = (np.abs((a - b) @ axes) <= V.WIDTH * np.sqrt(0.2)).sum(1)
    assert (hits >= V.calibrated_count()).mean() >= 0.995
    assert V.calibrated_count(24, 1.5, 0.999) > V.calibrated_count(24, 0.5, 0.999)
