import hashlib
import subprocess
import sys
from collections import Counter
from itertools import product

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from tests.llm.conftest import SF001, words
from tests.llm.test_texts import brute_base, brute_join, brute_repeats, path
from tidemark.llm import chat, graph, oracle, queries, stages

ROWS = [(1, 0, "user", "How are you?\nTell me."), (1, 1, "assistant", "Fine, thank you.\nAnd you are well."), (1, 2, "user", "Yes?"),
        (2, 0, "system", "Be short."), (2, 1, "user", "What is it?"), (2, 2, "assistant", "It is a test."), (3, 0, None, None), (3, None, "user", ""),
        (None, 0, "user", "No id here?"), (1, 2, "user", "Yes?")]


@pytest.fixture()
def lines(spark):
    return chat.transcripts(spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").withColumn("block", F.lit(1)))


def test_roles_are_recovered_from_held_out_conversations(spark):
    every = chat.transcripts(spark.read.parquet(f"{SF001}/conversations.parquet"))
    held = F.col("conv") % 4 == 2
    model = chat.train(every.filter(~held), 64 << 20)
    got = chat.parse(every.filter(held).select("conv", "line", "text"), model, 64 << 20)
    both = got.join(every.select("conv", "line", F.col("role").alias("truth")), ["conv", "line"])
    assert both.agg(F.avg((F.col("role") == F.col("truth")).cast("int"))).head()[0] >= 0.85


def test_blocks_give_the_path_of_the_whole(spark):
    """The path over many blocks equals the best of all state sequences, found by trying them."""
    rows = [(1, i, t) for i, t in enumerate(["User: hello there?", "more of it", "AI: Yes.", "no marker here", "Q: and?"])]
    df = spark.createDataFrame(rows, "conv long, line long, text string")
    labelled = df.withColumn("role", F.when(F.col("line") < 2, "user").when(F.col("line") < 4, "assistant").otherwise("user")).withColumn(
        "first", ~F.col("line").isin(1, 3))
    model = chat.train(labelled)
    e = model.scores([r[2] for r in rows])
    best = max(product(range(chat.N), repeat=len(rows)), key=lambda p: model.start[p[0]] + e[0, p[0]] + sum(
        model.move[a, b] + e[i + 1, b] for i, (a, b) in enumerate(zip(p, p[1:]))))
    for span in (1, 2, 256):
        got = sorted((r["line"], r["role"], r["first"]) for r in chat.parse(df, model, span).collect())
        assert got == [(i, chat.ROLES[s // 2], s % 2 == 0) for i, s in enumerate(best)]


def test_odd_conversations(spark, lines):
    model = chat.train(lines, 64 << 20)
    parsed = chat.parse(lines.select("conv", "line", "text", "role"), model, 64 << 20)
    assert parsed.count() == lines.count()
    out = chat.turns(parsed).collect()
    for r in out:
        assert r["rendered"].startswith(f"<|{r['role']}|>\n") and r["rendered"].endswith("\n<|end|>\n")
    by: dict = {}
    for r in out:
        by.setdefault(r["conv"], []).append(r["turn"])
    assert set(by) == {1, 2, 3, None} and all(sorted(t) == list(range(len(t))) for t in by.values())
    none = lines.limit(0)
    assert chat.turns(chat.parse(none.select("conv", "line", "text"), chat.train(none))).collect() == []


def test_blocks_hold_a_fixed_number_of_lines_whatever_repeats_or_is_null(spark):
    """Lines of no conversation, of one number or of none: blocks stay small and the path is that of the whole."""
    rows = [(c, n, t) for c in (None, 1) for n in (0, 0, 5, None) for t in ["User: hello?", "more of it", "AI: Yes.", "x" * 80 + "y", "x" * 80, ""] * 8]
    df = spark.createDataFrame(rows, "conv long, line long, text string")
    labelled = df.withColumn("role", F.when(F.col("text") < "N", "assistant").otherwise("user")).withColumn("first", F.col("text").contains(":"))
    model = chat.train(labelled)
    got = chat.parse(df, model, 7).collect()
    assert max(Counter((r["conv"], r["block"]) for r in got).values()) == 7
    for c in (None, 1):
        whole = sorted((n is None, n or 0, t) for x, n, t in rows if x == c)
        e = model.scores([t for _, _, t in whole])
        best = model.start + e[0]
        for x in e[1:]:
            best = (best[:, None] + model.move).max(0) + x
        states = model.path(e, -1, int(best.argmax()))
        mine = sorted((r for r in got if r["conv"] == c), key=lambda r: (r["block"], r["place"]))
        assert [(r["line"] is None, r["line"] or 0, r["text"]) for r in mine] == whole
        assert [(r["role"], r["first"]) for r in mine] == [(chat.ROLES[s // 2], s % 2 == 0) for s in states]


def test_training_counts_every_move(spark):
    """600 lines of one conversation: no move is left out, wherever ranges or blocks are cut."""
    states = [2 * (i // 7 % 2 + 1) + (i % 7 > 0) for i in range(600)]
    rows = [(7, i, f"line {i}", chat.ROLES[s // 2], s % 2 == 0) for i, s in enumerate(states)]
    model = chat.train(spark.createDataFrame(rows, "conv long, line long, text string, role string, first boolean").repartition(8))
    want = chat.Model(Counter([("start", states[0], 0), *(("move", a, b) for a, b in zip(states, states[1:]))]))
    assert np.allclose(model.move, want.move) and np.allclose(model.start, want.start)


def test_a_turn_of_very_many_lines_ends_before_the_next(spark):
    rows = [(1, 0, "user", "\n" * (1 << 20)), (1, 1, "assistant", "Yes."), (1, None, "user", "late")]
    every = chat.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    ends = every.groupBy("role", F.col("text").endswith("late")).agg(F.min("line").alias("a"), F.max("line").alias("z")).orderBy("a").collect()
    assert len(ends) == 3 and ends[0]["z"] < ends[1]["a"] and ends[1]["role"] == "assistant"


def test_markers():
    assert [chat.features(x)[0] for x in ("User: hi", "[assistant] hi", "### Human: hi", "Note: hi", "plain words", "A", "agent> yes")] == [2, 3, 2, 4, 0, 0, 3]
    assert chat.unmarked("User: hi") == "hi" and chat.unmarked("Note: hi") == "Note: hi" and chat.unmarked("plain") == "plain"


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(500 + i, 501 + i) for i in range(40)] + [(900, 900), (None, 3)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    link: dict = {}
    for a, b in edges:
        if a is not None and a != b:
            link.setdefault(a, set()).add(b)
            link.setdefault(b, set()).add(a)
    for x in link:
        seen, todo = {x}, [x]
        while todo:
            for y in link[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        assert got[x] == min(seen)
    assert set(got) == set(link)


def test_components_plan_few_exchanges(spark, monkeypatch):
    """Each exchange costs the driver a thread and memory: a round has few, and stars need one round."""
    plans, store = [], graph.stored

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        return store(df, name)

    monkeypatch.setattr(graph, "stored", watched)
    stars = [(5, 1), (6, 1), (7, 1), (9, 8), (3, 3), (None, 2), (4, None), (5, 1)]
    got = dict(graph.components(spark.createDataFrame(stars, "a long, b long")).collect())
    assert got == {1: 1, 5: 1, 6: 1, 7: 1, 8: 8, 9: 8}
    assert len(plans) == 2 and max(plans) <= 8


def test_every_operator_has_one_query():
    names = list(queries.QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(names) <= set(entry_mod.queries()) and set(queries.ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle_pairs(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(queries.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, SF001).toPandas()[list(want.columns)]
    order = list(want.columns)
    assert (got.sort_values(order).astype(str).values == want.sort_values(order).astype(str).values).all()
    assert "embeddings" in oracle.OP1


def pipeline_rows():
    from tests.llm.test_texts import near_rows

    return [(i, t) for i, t in near_rows() if i != 9] + [(4000, "mail me at ab.c@mail1.example.com or +1 (367) 555-7441 soon, all of you")]


def test_each_stage_equals_brute_force(spark, docs):
    rows = pipeline_rows()
    df = docs(rows, "vid score")
    one = stages.known_language(spark, df, "")
    assert one.columns == df.columns
    kept = Counter((r["doc_id"], r["text"]) for r in one.collect())
    # 700 times one letter is in no learned language
    assert kept == Counter((i, t) for i, t in rows if any(c.isalpha() for c in t or "") and t != "x" * 700)

    two = stages.one_of_each_group(spark, one, "")
    assert two.columns == df.columns
    now = list(kept.elements())
    least = brute_join(now, 5, 80)
    first = {i for i, _, c in least if i is not None and i == c}
    assert Counter((r["doc_id"], r["text"]) for r in two.collect()) == Counter((i, t) for i, t in now if i is None or i in first)

    three = stages.without_repeated_bytes(spark, two, "")
    assert three.columns == df.columns
    now = [(r["doc_id"], r["text"]) for r in two.collect()]
    want = Counter()
    for (i, _), (n, gone, _, digest) in zip(now, brute_repeats([t for _, t in now])):
        if gone < n or not gone:
            want[i, digest] += 1
    got = three.collect()
    assert Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in got) == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)

    four = stages.without_personal_data(spark, three, "")
    assert four.columns == df.columns and four.count() == three.count()
    texts = {r["doc_id"]: r["text"] for r in four.collect()}
    assert texts[4000] == "mail me at <EMAIL> or <PHONE> soon, all of you"
    assert all(not brute_base(t) for t in texts.values())

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    five = stages.packed(spark, four, "").collect()
    total = sum(len(t.encode(r["text"], add_special_tokens=False).ids) + 1 for r in four.collect())
    assert sum(r["length"] for r in five) == total and len({r["sequence_id"] for r in five}) == len(five)


def test_jaccard_stage_loses_no_row_by_its_id(spark, docs):
    """Different texts under one id stay; near and exact copies go, also without an id."""
    a, b, c, d = (words(700 + i, 60) for i in range(4))
    rows = [(1, a), (1, b), (1, b), (0, None), (0, ""), (None, c), (None, c), (7, c + " more"), (None, d), (None, d), (None, None), (None, None)]
    got = Counter((r["doc_id"], r["text"]) for r in stages.one_of_each_group(spark, docs(rows), "").collect())
    assert got == Counter([(1, a), (1, b), (0, None), (0, ""), (7, c + " more"), (None, d), (None, None), (None, None)])


def test_stages_of_empty_and_unlabelled_tables(spark, docs):
    df = docs([])
    for f in (stages.known_language, stages.one_of_each_group, stages.without_repeated_bytes, stages.without_personal_data, stages.packed):
        assert f(spark, df, "").collect() == []
    bare = docs([(1, words(1, 30)), (2, "12"), (3, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert [r["doc_id"] for r in stages.known_language(spark, bare, "").collect()] == [1]


def test_pipeline_runs_and_names_its_stages(spark):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    out = entry_mod.queries()["pipeline"](spark, SF001)
    assert out.count() > 0 and {"doc_id", "ids", "sequence_id"} <= set(out.columns)


def test_workers_give_back_what_a_task_freed(spark, docs, monkeypatch):
    """Every Python step of the stages ends so; blocks below the last one in use otherwise stay with the worker."""
    import re

    from pyspark.sql.classic.dataframe import DataFrame
    from tidemark.llm import common

    def held():
        with open("/proc/self/smaps_rollup") as fh:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", fh.read())[1]) / 1024

    last = []

    @common.released
    def run(batches):
        for batch in batches:
            some = [np.ones(8192) for _ in range(3000)]  # 64 KB each
            last.append(some.pop())
            yield batch

    before = held()
    assert list(run(iter([1]))) == [1] and last and held() < before + 60

    steps, plain = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda df, run, *a, **b: steps.append(run) or plain(df, run, *a, **b))
    rows = docs(pipeline_rows())
    for stage in (stages.known_language, stages.one_of_each_group, stages.without_repeated_bytes, stages.without_personal_data, stages.packed):
        stage(spark, rows, None)
    assert len(steps) >= 15 and all(hasattr(step, "__wrapped__") for step in steps)


def test_the_rest_of_the_library_does_not_import_these_operators():
    said = subprocess.run([sys.executable, "-c", "import sys, tidemark, tidemark.plans.registry, tidemark.streaming; print([m for m in sys.modules if 'llm' in m])"],
                          capture_output=True, text=True, check=True, cwd=str(__import__("pathlib").Path(__file__).parents[2]))
    assert said.stdout.strip() == "[]"
