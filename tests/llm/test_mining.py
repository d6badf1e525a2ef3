"""Collocations, toxicity and hard negatives against brute force, with nulls, empty and long texts, ties, copies and clashing columns."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF001, words
from tidemark.llm import automata as A
from tidemark.llm import collocations as C
from tidemark.llm import negatives as N
from tidemark.llm import recurrent as R
from tidemark.llm import toxicity as T
from tidemark.llm.common import small_batches, text_buffers

NAN, INF = float("nan"), float("inf")


# --- automata --------------------------------------------------------------------------------


def _counts(levels):
    out = {}
    for d, (_, _, weight) in enumerate(levels):
        for path, w in zip(A.paths(levels, d).tolist(), weight.tolist()):
            if w:
                out[tuple(path)] = w
    return out


def test_automata_count_unite_split_prune_and_read():
    r = np.random.default_rng(2)
    parts, want = [], Counter()
    for length in (2, 3, 3, 4):
        rows = r.integers(0, 5, (200, length)).astype(np.uint64)
        parts.append(A.load(A.dump(A.build(list(rows.T)))))
        want.update(map(tuple, rows.tolist()))
    whole = A.union(parts)
    assert _counts(whole) == want
    assert all((np.diff(s) >= 0).all() for s, _, _ in whole)
    again = {}
    for first, part in A.split(whole):
        got = _counts(A.load(A.dump(part)))
        assert all(k[0] == first for k in got)
        again |= got
    assert again == want
    assert _counts(A.pruned(whole, 10)) == {k: v for k, v in want.items() if v >= 10}
    for length in (2, 3):
        asked = r.integers(0, 6, (100, length)).astype(np.uint64)
        state = A.read(whole, list(asked.T))
        found = [0 if s < 0 else int(whole[length - 1][2][s]) for s in state]
        assert found == [want.get(tuple(q), 0) for q in asked.tolist()]


def test_automata_are_narrow_and_exact():
    """16 bytes an arc, and still sums beyond 32 bits, and places times labels beyond them."""
    r = np.random.default_rng(3)
    n = 50_000
    columns = [r.permutation(n).astype(np.uint64), r.permutation(n).astype(np.uint64)]
    part = A.build(columns)
    whole = A.union([part, part, A.build([c[:9] for c in columns])])
    for levels in (part, whole):
        assert sum(x.nbytes for level in levels for x in level) <= 16 * sum(len(level[0]) for level in levels)
    assert whole[1][2].sum() == 2 * n + 9 and (A.read(whole, columns) >= 0).all()
    much = A.build([c[:3] for c in columns], np.full(3, (1 << 31) - 1))
    assert set(_counts(A.load(A.dump(A.union([much, much, much])))).values()) == {3 * ((1 << 31) - 1)}


# --- collocations ----------------------------------------------------------------------------


def brute_collocations(rows, least, top, longest=5):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    key = lang, tuple(w[i:i + m])
                    f[key] = f.get(key, 0) + 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, p), a in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if 100 * a >= 100 * cand[lang, p[i:i + m]]:
                    gone.add((lang, p[i:i + m]))
    out = []
    for lang in n:
        found = []
        for (of, p), a in cand.items():
            if of == lang and (of, p) not in gone:
                cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def _mined(df, **kw):
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in C.collocations(df, **kw).select(cols).collect())


def corpus():
    r = random.Random(4)
    some = "the of a and red Fox dog jumps ñandú 猫 x".split()
    rows = []
    for i in range(150):
        text = "".join(r.choice(some) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "! "]) for _ in range(60))
        rows.append((text, r.choice(["en", "fr", None])))
    rows += [("New York City Hall stands here. The End", "en")] * 40 + [("one two three four five six seven", "und")] * 30
    rows += [(None, "en"), ("", "en"), (" .,\t", "xx"), (None, None), ("Solo", ""), ("a b " * 3000, "fr")]
    return rows


def test_collocations_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "ARCS", 200)  # shards are sent on early, ranges united in steps
    monkeypatch.setattr(C, "RANGE_WORDS", 500)
    rows = corpus()
    df = spark.createDataFrame([(i, *x, 1, 2) for i, x in enumerate(rows)], "doc_id long, text string, lang string, key int, f int").repartition(5)
    assert _mined(df, least=20, top=25) == brute_collocations(rows, 20, 25)


def test_collocations_with_a_full_bitmap_and_of_two_words(spark, monkeypatch):
    monkeypatch.setattr(C, "BITS", 1 << 15)
    rows = corpus()[:60]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert _mined(df, least=3, top=500) == brute_collocations(rows, 3, 500)
    assert _mined(df, least=3, top=500, longest=2) == brute_collocations(rows, 3, 500, 2)


def test_tasks_of_collocations_hold_little_memory(spark, monkeypatch):
    """A block of texts is small, and so are the automata of a shard; every Python step gives back what it freed."""
    import tracemalloc

    from pyspark.sql.classic.dataframe import DataFrame

    steps, plain = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda df, run, *a, **b: steps.append(run) or plain(df, run, *a, **b))
    none = spark.createDataFrame([], "text string, lang string")
    C.count_words(none, 0)
    C.count_phrases(none, 2, np.full(1 << 12, 255, np.uint8), 16, 100, 0)
    words_of, shards_of, _ = steps
    r = np.random.default_rng(5)
    texts = [" ".join(map(str, x)) for x in r.integers(10_000, 12_000, (900, 2_000)).tolist()]  # 10.8 MB
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k:k + 300]), pa.array(["en"] * 300)], ["text", "lang"]) for k in range(0, 900, 300)]
    for step, most in ((words_of, 90e6), (shards_of, 130e6)):
        tracemalloc.start()
        found = sum(out.num_rows for out in step(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found and peak < most, peak
    assert _mined(spark.createDataFrame([("a b c a b c", "en")], "text string, lang string"), least=2)
    assert len(steps) >= 10 and all(hasattr(step, "__wrapped__") for step in steps)


def test_arrow_batches_of_collocations_are_bound(spark, monkeypatch):
    name, seen, plain = "spark.sql.execution.arrow.maxBytesPerBatch", [], C.stored
    before = spark.conf.get(name)
    monkeypatch.setattr(C, "stored", lambda df, called: seen.append(spark.conf.get(name)) or plain(df, called))
    rows = corpus()[:60]
    assert _mined(spark.createDataFrame(rows, "text string, lang string"), least=3, top=500) == brute_collocations(rows, 3, 500)
    assert len(seen) >= 4 and all(int(x.rstrip("b")) <= 4 << 20 for x in seen)
    assert spark.conf.get(name) == before
    sizes = spark.range(1, numPartitions=1).selectExpr("explode(sequence(1, 9000)) i").selectExpr("repeat('x', 1000) t")
    size_of = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
    with small_batches(spark, 1 << 20):
        assert max(r["n"] for r in sizes.mapInArrow(size_of, "n long").collect()) < 2 << 20
    assert spark.conf.get(name) == before


def test_collocations_of_nothing(spark):
    schema = "text string, lang string"
    assert _mined(spark.createDataFrame([], schema)) == []
    assert _mined(spark.createDataFrame([(None, None), ("", "en"), ("...", None), ("one two", "en")], schema)) == []


def test_products_beyond_64_bits_are_exact(spark):
    row = spark.range(1).select(F.lit(9_000_000_000_001).alias("a"), F.lit(12_345_678_901_234).alias("n"))
    got = row.select((F.col("a").cast("decimal(16,0)") * F.col("n").cast("decimal(16,0)") * F.lit(1000).cast("decimal(4,0)")).alias("x")).head()["x"]
    assert int(got) == 1000 * 9_000_000_000_001 * 12_345_678_901_234


# --- toxicity --------------------------------------------------------------------------------


def test_gradients_equal_differences():
    r = np.random.default_rng(0)
    data, offsets = text_buffers(pa.array(["you are an idiot and a fool", "the cat sat on the mat " * 12, "", "nice day over there"]))
    t, label = R.tokens(data, offsets), np.array([1, 0, 0, 1.0])
    m = {k: v.astype(np.float64) for k, v in R.new_model().items()}
    m["known"][:] = 1
    for k in ("word", "char", "cf", "cb", "a"):
        m[k] = r.standard_normal(m[k].shape) * 0.3
    placed = R.windows(t.count)

    def loss():
        best = np.full(len(label), -np.inf)
        np.maximum.at(best, placed[0], R.logits(m, t))
        return np.mean(np.logaddexp(0, np.where(label > 0, -best, best)))

    g, _ = R._gradients(m, t, np.arange(4), label, *placed)
    for k in ("b", "v", "A", "a", "Uf", "Ub", "Wf", "Wb", "cf", "cb"):
        at = np.unravel_index(int(np.abs(g[k]).argmax()), m[k].shape)
        old = m[k][at]
        m[k][at] = old + 1e-3
        up = loss()
        m[k][at] = old - 1e-3
        slope = (up - loss()) / 2e-3
        m[k][at] = old
        assert slope == pytest.approx(float(np.asarray(g[k])[at]), rel=0.1, abs=1e-4), k


def _toxic_rows():
    r = random.Random(3)
    rows = []
    for i in range(240):
        w = words(i, r.randint(5, 120)).split()
        bad = i % 3 == 0
        if bad:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["vilebad", "nastyone", "rottenx"]))
        rows.append((i, " ".join(w), int(bad)))
    return rows


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows = _toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "null id"), (900, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(900, 1, 1), (None, 1, 1), (5, 0, None), (6, 0, 7)],
                                   "doc_id long, quality int, toxic int")
    allowed = ~T.held_out()
    return T.fit(docs, labels, allowed), docs, labels, allowed


def test_toxicity_of_texts_not_learned(spark, toxic_model):
    model, docs, labels, allowed = toxic_model
    assert T.fit(docs.repartition(7), labels.repartition(3), allowed) == model
    rows = {i: y for i, _, y in _toxic_rows()}
    got = {r["doc_id"]: r["__tm_score"] for r in T.score(docs.filter(T.held_out()), model).collect()}
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in got) and len(got) > 50
    assert np.mean([(got[i] >= 0.7) == (rows[i] == 1) for i in got]) > 0.95


def test_toxicity_of_odd_and_very_long_texts(spark, toxic_model):
    model = toxic_model[0]
    clean = " ".join(words(7, 30) for _ in range(900))
    long = clean + " vilebad nastyone rottenx vilebad " + clean
    rows = [(1, None), (2, ""), (3, " .,"), (None, "vilebad"), (5, clean), (6, long), (6, long), (7, "x" * 9000), (8, "日本 ü")]
    df = spark.createDataFrame([(i, t, 3, "z") for i, t in rows], "doc_id long, text string, score int, model string").repartition(2)
    whole = sorted((repr(r["doc_id"]), r["text"] or "", r["score"], round(r["__tm_score"], 4)) for r in T.score(df, model).collect())
    parts = sorted((repr(r["doc_id"]), r["text"] or "", r["score"], round(r["__tm_score"], 4)) for r in T.score(df, model, most=3000).collect())
    assert whole == parts and len(whole) == len(rows) and all(0 <= x[3] <= 1 for x in whole)
    found = {x[1]: x[3] for x in whole}
    assert found[long] >= 0.7 > found[""]
    assert T.score(df.limit(0), model).count() == 0


def test_every_token_is_in_a_window_and_pieces_of_a_long_text_have_its_windows():
    for n in (0, 1, 47, 48, 49, 84, 85, 400):
        doc, first, size = R.windows(np.array([n, 5]))
        own = doc == 0
        assert set().union(*(range(a, a + s) for a, s in zip(first[own], size[own]))) == set(range(n))
        assert (first[own] % R.STEP == 0).all() and (size[own] <= R.WINDOW).all()
    m = R.new_model()
    r = np.random.default_rng(1)
    m["char"] = r.standard_normal(m["char"].shape).astype(np.float32)
    data, offsets = text_buffers(pa.array([words(5, 2000)]))
    assert T._long(m, data, 500) == pytest.approx(float(R.scores(m, R.tokens(data, offsets))[0]), abs=1e-6)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["__tm_score"] < 0.7 for r in T.score(docs, T.fit(docs, none, F.lit(True))).collect()] == [True]


def test_op12_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = T.op12(spark, SF001).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.7) for r in got)


# --- hard negatives --------------------------------------------------------------------------


def brute_negatives(rows, n_pos=5, n_neg=3):
    key = lambda i: (1 << 63) - 1 if i is None else i
    ok = [(i, lab, [int(np.floor(256 * x)) for x in e]) for i, e, lab in rows
          if lab is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    ok = [(i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, e) for i, lab, e in ok if sum(float(x) ** 2 for x in e) < 2**62]
    out = []
    for a, (ai, al, ae) in enumerate(ok):
        if ai is None or ai % 50:
            continue
        s = [(-sum(x * y for x, y in zip(ae, e)), key(i), lab == al) for b, (i, lab, e) in enumerate(ok) if b != a and len(e) == len(ae)]
        for ps, pi, _ in sorted(x for x in s if x[2])[:n_pos]:
            good = sorted((ns, ni) for ns, ni, same in s if not same and 50 * -ps <= 100 * -ns <= 95 * -ps)[:n_neg]
            out += [(ai, pi, k, ni, -ps, -ns) for k, (ns, ni) in enumerate(good, 1)]
    return sorted(out)


def _found(df, monkeypatch=None):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = N.whole_vectors(df).withColumn("label", shifted)
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple((1 << 63) - 1 if x is None else x for x in r) for r in N.hard_negatives(rows, F.col("vec_id") % 50 == 0).select(cols).collect())


def vectors():
    r = np.random.default_rng(5)
    centre = r.normal(size=(10, 12))
    rows = []
    for i in range(900):
        lab = int(r.integers(10)) if i % 3 else 4
        e = centre[lab] * r.uniform(0.5, 2) + r.normal(scale=0.6, size=12)
        rows.append((i, e.astype(np.float32).tolist(), lab))
    rows += [(2000 + i, rows[50][1], rows[50][2]) for i in range(40)]  # copies of an anchor under its label
    rows += [(3000 + i, rows[100][1], 1) for i in range(40)] + [(150, rows[150][1], rows[150][2]), (150, rows[7][1], 2)]
    rows += [(None, rows[200][1], rows[200][2]), (None, rows[201][1], 3), (4000, [0.0] * 12, 4), (4050, [], 1), (4051, [], 1), (4052, [], 2)]
    rows += [(5000, None, 1), (5050, [NAN] * 12, 1), (5100, [INF] + [1.0] * 11, 1), (5150, [None] + [1.0] * 11, 1), (5200, rows[0][1], None)]
    rows += [(5250, [1e9] * 12, 1), (5300, [3e38] * 12, 2), (5350, [1.0, 2.0], 6), (5351, [2.0, 1.0], 6), (5352, [1.0, 1.0], 7), (5400, [-x for x in rows[3][1]], 9)]
    return rows


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    for name, size in (("BLOCK", 150), ("ANCHORS", 7), ("BUCKET", 16)):
        monkeypatch.setattr(N, name, size)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS rid", "2 AS block", "3 AS norm").repartition(3)
    assert _found(df) == brute_negatives(rows)


def test_hard_negatives_of_little(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert _found(spark.createDataFrame([], schema)) == []
    assert _found(spark.createDataFrame([(50, [1.0], 1), (51, [1.0], 1)], schema)) == []
    assert _found(spark.createDataFrame([(50, [1.0], 1), (52, [0.7], 2)], schema)) == []
    assert _found(spark.createDataFrame([(50, [1.0], 1), (51, [1.0], 1), (52, [0.7], 2)], schema)) == [(50, 51, 1, 52, 65536, 256 * 179)]


def test_coordinate_ranges_lose_nothing():
    r = np.random.default_rng(9)
    for spread in (0.05, 0.3, 1.0):
        base = r.normal(size=16)
        x = (256 * (base + r.normal(scale=spread, size=(400, 16))) * r.uniform(0.2, 3, (400, 1))).astype(np.int64)
        x[:3] = 0
        b = N.Bucket(x, np.arange(400), np.arange(400), 1)
        cut = 0
        for a in x[3:40]:
            length, focus = float(np.sqrt((a * a).sum())), np.argsort(-np.abs(a))[:N.FOCUS]
            s = x @ a
            for least in (int(s.max()), int(np.percentile(s, 95)), 1, 0, -5):
                got = b.candidates(a, length, focus, least)
                assert set(np.flatnonzero(s >= least)) <= set(got.tolist())
                cut += 400 - len(got)
        assert cut
