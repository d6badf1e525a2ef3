"""Operators on documents against brute force, with nulls, empty and long texts, ties, copies and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF001, words
from tidemark.llm import jaccard, language, packing, pieces, pii, sharding, spotsigs, suffixes

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"


def path(name):
    import public_tokenizers

    return public_tokenizers.path(name)


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "a b c"), (6, "日本語 текст ß 😀"), (7, words(1, 3000)), (8, words(2, 60)), (9, words(2, 60)),
       (9, words(2, 60)), (10, "x" * 700), (11, "1234 5678 " * 50), (None, words(4, 80)), (None, None)]


# --- sentencepiece ---------------------------------------------------------------------------


def test_pieces_equal_the_library(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path(PIECES))
    odd = ODD + [(20 + i, t) for i, t in enumerate(["  a", "a  b", "▁x", "a▁", "<s> </s> <0x0A>", "\x00", " " * 50, "a" * 3000, "é è", "== ==", "\r\n"])]
    out = pieces.encode_decode(docs(odd, "ids n_tokens"), path(PIECES)).collect()
    assert len(out) == len(odd) and all(r["same"] for r in out)
    want = Counter((i, tuple(e := sp.encode(t or "", add_bos=True, add_eos=True)), sp.decode(e)) for i, t in odd)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in out) == want
    for r in out:
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_pieces_random_texts_both_agendas():
    import random

    m, r = pieces.model(path(PIECES)), random.Random(7)
    letters = list("abcdefgh  tion ingé漢\n\t▁<>0xAsß'=-")
    texts = ["".join(r.choices(letters, k=r.randint(0, 120))) for _ in range(400)]
    import pyarrow as pa

    want = m.library.encode(texts, add_bos=True, add_eos=True)
    assert [x.tolist() for x in m.encode(pa.array(texts))] == want
    for n in (2, 30):  # all segments by the heap, then nearly all by the arrays
        old, pieces.ARRAY_SYMBOLS = pieces.ARRAY_SYMBOLS, n
        try:
            assert [x.tolist() for x in m.encode(pa.array(texts))] == want
        finally:
            pieces.ARRAY_SYMBOLS = old


# --- packing -----------------------------------------------------------------------------------


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path(BYTES))
    odd = ODD + [(30, "<|endoftext|> inside"), (31, "á ª ² İ")]
    out = packing.pack(docs(odd, "length start"), path(BYTES)).collect()
    assert len({r["sequence_id"] for r in out}) == len(out)
    assert all(r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and 1 <= r["length"] <= 1024 for r in out)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in out)
    want = Counter()
    for i, text in odd:
        ids, at = [*t.encode(text or "", add_special_tokens=False).ids, 0], 0
        for n in packing.cut(len(ids), 1024):
            want[i, at, n, tuple(ids[at:at + n]), len(ids)] += 1
            at += n
        assert at == len(ids)
    assert Counter((r["doc_id"], r["start"], r["length"], tuple(r["ids"]), r["doc_tokens"]) for r in out) == want
    assert packing.pack(docs([]), path(BYTES)).collect() == []


def test_cut_is_the_binary_form():
    assert packing.cut(3000, 1024) == [1024, 1024, 512, 256, 128, 32, 16, 8]
    with pytest.raises(ValueError):
        packing.pack(None, "", most=1000)


# --- repeated bytes ------------------------------------------------------------------------------


def brute_repeats(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def repeats_rows():
    a, b, p = words(11, 90), words(12, 90), words(13, 60)
    rows = ODD + [(40, a + p + b), (41, words(14, 30) + p), (42, p[:199]), (43, p[:200]), (44, a[:300] + "é" + a[:300]), (45, "ab" * 400)]
    return rows + [(50 + k, words(60 + k, 25) + " " + p + " " + words(90 + k, 25)) for k in range(30)]


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_bytes_equal_brute_force(spark, docs, monkeypatch, hot):
    if hot:  # every owner with several contexts takes the way of hot owners
        monkeypatch.setattr(suffixes, "HOT_CONTEXTS", 2)
        monkeypatch.setattr(suffixes, "HELD", 6)
    rows = repeats_rows()
    out = suffixes.remove(docs(rows, "h n owner start")).collect()
    want = Counter((i, *x) for (i, _), x in zip(rows, brute_repeats([t for _, t in rows])))
    assert Counter((r["doc_id"], r["__tm_bytes"], r["__tm_removed"], r["__tm_spans"], r["__tm_sha256"]) for r in out) == want
    assert out[0].asDict().keys() >= {"h", "n", "owner", "start", "lang"}


def test_long_text_in_parts(spark, docs, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 1000)
    rows = [(1, words(1, 900)), (2, words(2, 100) + words(1, 900)[1200:2600])]
    out = suffixes.remove(docs(rows)).collect()
    want = sorted((i, *x) for (i, _), x in zip(rows, brute_repeats([t for _, t in rows])))
    assert sorted((r["doc_id"], r["__tm_bytes"], r["__tm_removed"], r["__tm_spans"], r["__tm_sha256"]) for r in out) == want


def test_marks_of_a_text_do_not_grow_with_its_copies(spark, docs):
    """One text far more often than ``HELD``: its marks are each start once, and every copy loses all its bytes."""
    copied, n = words(5, 60), suffixes.HELD + 1000
    df = docs([(0, words(6, 60))]).unionByName(docs([(1, copied)]).withColumn("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long")))))
    texts = df.select(F.col("doc_id").alias("__tm_id"), F.xxhash64("text").alias("__tm_h"), F.octet_length("text").alias("__tm_n"), F.col("text").alias("__tm_text"))
    marks = suffixes.mark(texts, 200, 50).collect()
    assert len(marks) == 1 and sum(m["count"] for m in marks[0]["marks"]) == len(copied) - 199
    got = suffixes.remove(df).groupBy("__tm_bytes", "__tm_removed").count().collect()
    assert {tuple(r) for r in got} == {(len(copied), len(copied), n), (len(words(6, 60)), 0, 1)}


def test_two_stage_sort_orders_all_suffixes():
    import random

    r = random.Random(2)
    for _ in range(150):
        n = r.randint(1, 60)
        a = np.array(r.choices(range(r.choice([2, 4, 257])), k=n))
        assert suffixes.suffix_array(a, 60).tolist() == sorted(range(n), key=lambda i: a[i:].tolist())
    assert suffixes.remove is not None


def test_suffix_arrays_hold_little_memory():
    """Places and values are narrow: sorting takes less than 50 bytes for each byte of the contexts."""
    import tracemalloc

    base = np.random.default_rng(1).integers(97, 110, 200_000).astype(np.uint8)
    contexts = [base[a:a + 300] for a in np.random.default_rng(2).integers(0, len(base) - 300, 1800).tolist()]
    tracemalloc.start()
    found = suffixes.repeated_starts(contexts, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 540_000 and found.any() and peak < 50 * len(found)


def test_no_repeats_in_an_empty_table(spark, docs):
    assert suffixes.remove(docs([])).collect() == []


# --- Jaccard join --------------------------------------------------------------------------------


def shingle_sets(texts, size):
    out = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        out.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    return out


def brute_join(rows, size, per_cent):
    sets = shingle_sets([t for _, t in rows], size)
    by_id: dict = {}
    link = {i: set() for i in range(len(rows))}
    for i, (x, _) in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if x is not None and rows[j][0] is not None and sets[i] and sets[j] and (
                    x == rows[j][0] or 100 * both >= per_cent * (len(sets[i]) + len(sets[j]) - both)):
                link[i].add(j)
                link[j].add(i)
        by_id.setdefault(x, []).append(i)
    out = []
    for i, (x, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((x, len(sets[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return Counter(out)


def near_rows():
    import random

    r = random.Random(4)
    rows = list(ODD)
    for g in range(12):  # groups of near copies of many sizes, chains among them
        base = words(100 + g, r.choice([5, 8, 14, 18, 25, 60, 200])).split()
        for k in range(8):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                w[r.randrange(len(w))] = f"edit{r.randrange(50)}"
            rows.append((1000 + 10 * g + k, " ".join(w if k % 3 else w[:-1])))
    passage = words(999, 120)
    return rows + [(3000 + k, passage + " " + words(500 + k, 40)) for k in range(15)]


@pytest.mark.parametrize(("size", "per_cent", "short"), [(4, 85, 16), (4, 85, 2), (5, 80, 2)])
def test_join_equals_brute_force(spark, docs, monkeypatch, size, per_cent, short):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", 3 if short == 2 else 64)
    monkeypatch.setattr(jaccard, "HELD", 8 if short == 2 else 4096)
    rows = near_rows()
    got = jaccard.join(docs(rows, "vid n token component"), size=size, per_cent=per_cent)
    assert Counter(tuple(r) for r in got.collect()) == brute_join(rows, size, per_cent)


@pytest.mark.parametrize("below", [1, 14, 22])
def test_any_boundary_gives_the_same_links(spark, docs, monkeypatch, below):
    monkeypatch.setattr(jaccard, "boundary", lambda histogram, rule: below)
    rows = [(i, t) for i, t in near_rows() if i is None or i < 3000]
    assert Counter(tuple(r) for r in jaccard.join(docs(rows)).collect()) == brute_join(rows, 4, 85)


def test_boundary_is_where_subsets_cost_less_than_lists():
    rule = jaccard.Threshold(85)
    assert 2 <= jaccard.boundary({5: 100, 12: 100, 30: 100}, rule) <= 30
    assert jaccard.join is not None and rule.overlap(13, 13) == 12 and rule.index(100) <= rule.probe(100)


def test_join_of_an_empty_table(spark, docs):
    assert jaccard.join(docs([])).collect() == []


# --- fingerprints ----------------------------------------------------------------------------------


@pytest.mark.parametrize("range_rows", [4, 4096])
def test_edited_texts_and_likeness(spark, docs, monkeypatch, range_rows):
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", range_rows)
    rows = [(i, t) for i, t in ODD if i not in (9, None)] + [(60 + k, words(70 + k, 50)) for k in range(20)] + [(None, "last of all")]
    out = {r["doc_id"]: r for r in spotsigs.edited(docs(rows, "h o range closing")).collect()}
    order = sorted((x for x in rows if x[0] is not None), key=lambda x: -x[0]) + [x for x in rows if x[0] is None]
    names = spotsigs._anchor_names(spotsigs.ANCHORS)
    import pyarrow as pa

    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        k = len(t) // 2
        e = t[:len(t) - k] + u[:k]
        own, changed, following = spotsigs.signatures(pa.array([t, e, u]), names)
        r = out[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert r["fingerprint"] == spotsigs.printed(own) and r["edited_fingerprint"] == spotsigs.printed(changed)
        a, b, c = (set(x.tolist()) for x in (own, changed, following))
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert r["near_next"] == pytest.approx(len(a & c) / len(a | c) if a | c else 1.0)


def test_equal_texts_have_equal_fingerprints_and_repeated_rows_stay(spark, docs):
    out = spotsigs.edited(docs([(5, "the cat sat on the mat"), (5, "the cat sat on the mat"), (4, "the cat sat on the mat")])).collect()
    assert len(out) == 3 and len({r["fingerprint"] for r in out}) == 1 and all(r["near_next"] == 1.0 for r in out)
    assert spotsigs.edited(docs([])).collect() == []


def test_spot_pairs_equal_brute_force(spark, docs):
    rows = [(i, t) for i, t in near_rows() if i is not None and i != 9]
    import pyarrow as pa

    names = spotsigs._anchor_names(spotsigs.ANCHORS)
    sets = {}
    for (i, _), s in zip(rows, spotsigs.signatures(pa.array([t or "" for _, t in rows]), names)):
        if len(s):
            sets.setdefault(tuple(s), i)
            sets[tuple(s)] = min(i, sets[tuple(s)])
    ids = {i: set(s) for s, i in sets.items()}
    want = {(min(a, b), max(a, b)) for a in ids for b in ids if a < b and len(ids[a] & ids[b]) >= 0.8 * len(ids[a] | ids[b])}
    got = spotsigs.near_pairs(docs(rows)).collect()
    assert {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in got} == want and len(got) == len(want)


# --- sharding ------------------------------------------------------------------------------------------


def test_shards_are_even_and_gapless(spark, docs):
    rows = ODD + [(100 + i, "x" * (i % 97)) for i in range(900)] + [(77, "y" * 40)] * 500
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    out = sharding.shard(docs(rows, "slot shard part"), "doc_id", size).select("doc_id", "text", sharding.SHARD, sharding.SLOT).collect()
    assert Counter((r[0], r[1]) for r in out) == Counter(rows)
    by: dict = {}
    for r in out:
        by.setdefault(r[2], []).append(r)
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    for k, got in by.items():
        assert sorted(r[3] for r in got) == list(range(len(got)))
        most = max(len((t or "").encode()) + 1 for _, t in rows)
        assert abs(sum(len((r[1] or "").encode()) + 1 for r in got) - total / 16) <= most + 0.02 * total
    low = [min(r[0] if r[0] is not None else -1 for r in by[k]) for k in sorted(by)]
    assert low == sorted(low)
    assert sharding.shard(docs([])).collect() == []


def test_heavy_ranges_are_split_into_parts(spark, docs):
    rows = [(i, "z" * 50) for i in range(400)]
    out = sharding.shard(docs(rows), "doc_id", F.octet_length("text"), part_weight=64).collect()
    by = Counter(r[sharding.SHARD] for r in out)
    assert all(n == 25 for n in by.values()) and sorted(r[sharding.SLOT] for r in out if r[sharding.SHARD] == 3) == list(range(25))


# --- language --------------------------------------------------------------------------------------------


def test_held_out_accuracy_and_odd_texts(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    out = language.op6(spark, SF001).join(d.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == d.count() and sum(r["lang_pred"] == r["truth"] for r in held) >= 0.97 * len(held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in out)


def test_language_of_odd_texts(spark, docs):
    df = docs(ODD + [(60, "... 123 ??")], "score held_out")
    names, prototypes = language.train(df, F.lit(True))
    assert names == ["en"]
    out = {(r["doc_id"], r["text"]): r for r in language.predict(df, names, prototypes).collect()}
    for (_, t), r in out.items():
        has = any(c.isalpha() for c in t or "")
        assert r["__tm_lang"] == ("en" if has else "und") and (has or r["__tm_score"] == 0)
    empty = language.train(docs([]), F.lit(True))
    assert empty[0] == [] and {r["__tm_lang"] for r in language.predict(df, *empty).collect()} == {"und"}
    assert language.predict(docs([]), names, prototypes).collect() == []


def test_language_holds_little_memory(spark, docs):
    """The text goes to Python once, and a task's arrays stay small however many n-grams a block has."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    from tidemark.llm.common import blocks

    df = docs(ODD)
    names, prototypes = language.train(df, F.lit(True))
    assert "__tm_text" not in language.predict(df, names, prototypes)._jdf.queryExecution().executedPlan().children().head().toString()
    letters = np.random.default_rng(1).integers(0x61, 0x7B, (400, 5000), np.uint8)
    batch = pa.RecordBatch.from_arrays([pa.array([row.tobytes().decode() for row in letters])], ["text"])
    list(language.bundles(pa.array(["abc"])))  # the table of letters is made once
    tracemalloc.start()
    found = sum(1 for part in blocks(batch, 0, language.COUNTED_BYTES) for _ in language.bundles(part.column(0)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 400 and peak < 80e6


# --- personal data ------------------------------------------------------------------------------------------

PATTERNS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_base(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) or k == 2 and 12 <= len(d) <= 19 and total % 10 == 0
                    or k == 3 and 9 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_ip_parts_count_by_value_however_long():
    zeros = "0" * 5000
    for text, ok in ((f"at {'0' * 21}1.2.3.4 now", True), (f"{zeros}255.0.{zeros}.1", True), (f"{zeros}256.0.0.1", False), (f"{'9' * 5000}.0.0.1", False)):
        assert [k for _, k, _ in pii.base_spans(text) if k == 1] == [1] * ok


def test_base_spans_equal_the_patterns():
    import random

    r = random.Random(5)
    parts = ["@", ".", "a.b@c.d", "x@y", "1.2.3.4", "300.1.1.1", "4550997810720808", "4550-9978 1072 0808", "+1 (367) 555-7441", "+", " ", "-", "é", "12", "@a.b", "255", "5.5"]
    for _ in range(3000):
        t = "".join(r.choices(parts, k=r.randint(0, 9)))
        assert pii.base_spans(t) == brute_base(t), t


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.train(spark.read.parquet(f"{SF001}/documents.parquet"))


def test_detect_keeps_base_and_adds_checked_spans(spark, docs, tagger):
    rows = ODD + [(60, "Call +1 (367) 555-7441 or 53.121.55.90 4550997810720808 now."), (61, "mail fhctton.79@mail5.example.com."),
                  (62, "in 1999 there were 12,345 of 99 and v1.2.3, é" * 3)]
    out = {(r["doc_id"], r["text"]): r for r in pii.detect(docs(rows, "spans base"), tagger).collect()}
    for (i, t), r in out.items():
        base = [(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in r["__tm_base"]]
        assert base == brute_base(t or "")
        for s in r["__tm_added"]:
            assert all(s["start"] >= e or s["end"] <= a for a, _, e in base)
    r = out[60, rows[-3][1]]
    assert "367" not in r["__tm_redacted"] and "<PHONE>" in r["__tm_redacted"]
    assert out[62, rows[-1][1]]["__tm_redacted"] == rows[-1][1]
    assert pii.detect(docs([]), tagger).collect() == []


def test_tagger_finds_forms_it_has_not_seen(tagger):
    import random

    r, hit, every, false = random.Random(99), 0, 0, 0
    for _ in range(20):
        forms = pii.made_forms(r)
        texts = [f"The hentha reshon {f} edlyti anor ther." for _, f in forms]
        for (k, f), found, (_, added) in zip(forms, pii.tagged_spans(tagger, texts), pii.find(tagger, texts)):
            every += k >= 0
            hit += k >= 0 and (18, k, 18 + len(f)) in found
            false += k < 0 and len(added)
    assert hit >= 0.75 * every and false <= 2


def test_gradients_equal_differences():
    from tidemark.llm.tagger import STATE, Tagger

    rng = np.random.default_rng(0)
    ids, tags = rng.integers(1, 98, (3, 7)), np.array([[0, 1, 2, 0, 3, 4, 0], [0, 0, 1, 2, 2, 0, 0], [3, 4, 4, 0, 0, 1, 2]])
    t = Tagger(2)

    def loss():
        return t._loss(t.emissions(ids), tags)[0]

    states, kf, kb = t._states(ids)
    _, de, dmove = t._loss(states @ t.w["out"] + t.w["bias"], tags)
    grad = {n: np.zeros_like(w) for n, w in t.w.items()}
    grad["next"] = dmove
    ds = de @ t.w["out"].T
    t._back(ids, "f", kf, ds[:, :, :STATE], grad)
    t._back(ids[:, ::-1], "b", kb, ds[:, ::-1, STATE:], grad)
    for name, at in (("next", (0, 1)), ("recf", (2, 5)), ("recb", (3, 40)), ("inf", (int(ids[0, 2]), 9)), ("inb", (int(ids[1, 1]), 50))):
        w = t.w[name]
        old = w[at]
        w[at] = old + 1e-5
        up = loss()
        w[at] = old - 1e-5
        down = loss()
        w[at] = old
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_decode_is_the_best_legal_path():
    from itertools import product

    from tidemark.llm.tagger import Tagger

    t, rng = Tagger(1), np.random.default_rng(1)
    t.w["next"] = rng.normal(size=(3, 3))
    for n in (1, 2, 5):
        e = rng.normal(size=(1, 6, 3))
        move = t.w["next"] + t.barred
        best = max((p for p in product(range(3), repeat=n) if p[0] != 2),
                   key=lambda p: sum(e[0, i, s] for i, s in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:])))
        assert t.decode(e, np.array([n]))[0].tolist() == list(best)
