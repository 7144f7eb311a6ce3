"""What a task holds, and how rows grow: queries whose figures grew faster than their tables."""

from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayworks.operators import balls, gate, judge, retrieval
from assayworks.plans import catalog
from assayworks.streaming import history


@pytest.mark.parametrize("k", [1, 7, 500])
def test_best_of_tiles(monkeypatch, k):
    monkeypatch.setattr(retrieval, "OPEN_HITS", 100)
    rng = np.random.default_rng(k)
    scores = np.round(rng.random((9, 400)), 2)  # many ties
    scores[rng.random(scores.shape) < 0.1] = np.nan
    best = retrieval.Best(9, k)
    for at in range(0, 400, 60):
        for q in range(0, 9, 4):
            best.add(q, scores[q : q + 4, at : at + 60].copy(), pa.array(range(at, min(at + 60, 400))))
            assert best._open <= max(100, 9 * k) + 4 * 60
    got = {}
    for b in best.batches(pa.array(range(9))):
        for r in b.to_pylist():
            got.setdefault(r["query_id"], []).append((r["score"], r["doc_idx"]))
    for q in range(9):
        want = sorted(((s, i) for i, s in enumerate(scores[q]) if s == s), reverse=True)[:k]
        assert sorted(got[q], reverse=True) == want


def test_products_are_small(spark, monkeypatch):
    """No product of all queries of a block and all vectors of a batch, whatever their number."""
    shapes = []
    whole = retrieval.relevance
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(3 + i % 2)]) for i in range(3000)] + [(5000, [0.0] * 3), (5001, [float("inf"), 0.0, 1.0])], "doc_idx long, vector array<float>")
    queries = rows.where("doc_idx < 1200").withColumnRenamed("doc_idx", "query_id")

    def noted(q, v):
        s = whole(q, v)
        if s.size > retrieval.TILE_ROWS * retrieval.TILE_QUERIES:
            raise AssertionError(s.shape)
        shapes.append(s.shape)
        return s

    monkeypatch.setattr(retrieval, "relevance", noted)
    got = {(r["query_id"], r["rank"]): r["doc_idx"] for r in retrieval.dense_top(queries, rows, 3).collect()}
    good = [(r["doc_idx"], np.array(r["vector"])) for r in rows.where("doc_idx < 5000").collect()]
    for q, v in good[:40]:
        near = sorted(((round(1 - (2 - 2 * (v @ x) / np.linalg.norm(v) / np.linalg.norm(x)) / 2**0.5, 9), i) for i, x in good if len(x) == len(v)), reverse=True)[:3]
        assert [got[q, r] for r in (1, 2, 3)] == [i for _, i in near]
    assert len(got) == 3600


def test_arithmetic_hits_without_pairs(spark):
    docs, queries = spark.range(0, 3000, 2).withColumnRenamed("id", "doc_idx"), spark.range(0, 5000, 371).withColumnRenamed("id", "query_id")
    top = catalog._arithmetic_top(queries, docs, 10)
    got = {(r["query_id"], r["rank"]): r["doc_idx"] for r in top.collect()}
    for q in range(0, 5000, 371):
        assert [got[q, r] for r in range(1, 11)] == sorted(range(0, 3000, 2), key=lambda d: ((d * 7919 + q) % 1009, d))[:10]
    few = catalog._arithmetic_top(queries, docs.where("doc_idx < 6"), 10)
    assert few.groupBy("query_id").agg(F.count("*").alias("n")).where("n <> 3").count() == 0


def test_scores_are_made_where_documents_are(spark):
    """Neither tokens nor pairs of terms are shuffled; copies of a corpus only add to what a task reads."""
    words = [f"w{i % 7} w{i % 5} w{i % 3}  W{i % 11} only{i}" for i in range(400)]
    corpus = spark.createDataFrame([*enumerate(words), (900, None), (901, " ")], "doc_idx long, text string")
    queries = spark.createDataFrame([(1, "w1 w1 w2 w10"), (2, "only7"), (3, "none"), (4, None), (5, "w0 w3")], "query_id int, text string")
    every = {(r["query_id"], r["doc_idx"]): r["score"] for r in retrieval.bm25(queries, corpus, every=True).collect()}
    shared = {(r["query_id"], r["doc_idx"]): r["score"] for r in retrieval.bm25(queries, corpus).collect()}
    assert len(every) == 5 * 402 and all(every[k] == s for k, s in shared.items()) and len([k for k in shared if k[0] == 2]) == 1
    has = lambda q, d: set((dict([(1, "w1 w2 w10"), (2, "only7"), (5, "w0 w3")]).get(q) or "").split()) & set(words[d].lower().split())
    assert set(shared) == {(q, d) for q in (1, 2, 5) for d in range(400) if has(q, d)}
    best = {(r["query_id"], r["rank"]): r["doc_idx"] for r in retrieval.bm25_top(queries, corpus, 4).collect()}
    for q in (1, 2, 5):
        want = sorted(((round(s, 9), d) for (a, d), s in shared.items() if a == q), reverse=True)[:4]
        assert [best[q, r] for r in range(1, len(want) + 1)] == [d for _, d in want]
    plan = retrieval.bm25(queries, corpus)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Generate" not in plan


@pytest.mark.parametrize("most", [1, 3])
def test_blocks_of_queries_and_documents(spark, monkeypatch, most):
    corpus = spark.createDataFrame([(i, f"a{i % 4} b{i % 3} c") for i in range(60)], "doc_idx long, text string")
    queries = spark.createDataFrame([(q, f"a{q % 4} b{q % 2} c c") for q in range(9)] + [(20, "")], "query_id int, text string")
    rows = lambda df: sorted((r["query_id"], r["doc_idx"], round(r["score"], 9)) for r in df.collect())
    whole, top = rows(retrieval.bm25(queries, corpus, every=True)), rows(retrieval.bm25_top(queries, corpus, 5))
    monkeypatch.setattr(retrieval, "MOST_WEIGHTS", 4 * most)
    monkeypatch.setattr(retrieval, "MOST_HITS", 4 * most)
    assert rows(retrieval.bm25(queries, corpus, every=True)) == whole and len(whole) == 600
    assert rows(retrieval.bm25_top(queries, corpus, 5)) == top


class State:
    """What a handle gives, without a stream."""

    def __init__(self):
        self.values, self.timers = {}, []

    def getListState(self, name, schema):
        return self.of(name)

    def getValueState(self, name, schema):
        return self.of(name)

    def of(self, name):
        held = self.values

        class One:
            exists = lambda s: bool(held.get(name))
            get = lambda s: held.get(name, ())
            clear = lambda s: held.pop(name, None)

            def appendList(self, rows):
                held[name] = [*held.get(name, []), *rows]

            def put(self, rows):
                held[name] = list(rows)

            def update(self, row):
                held[name] = row

        return One()

    def registerTimer(self, at):
        self.timers.append(at)


def test_turns_that_come_together_set_one_timer():
    handle, of = State(), history.Histories(1000)
    of.init(handle)
    part = pd.DataFrame([(30, "c", "z", ""), (10, "a", "x", ""), (20, "b", "y", ""), (90, "d", "w", "")], columns=["at", "query_id", "input_query", "output_answer"])
    list(of.handleInputRows(("s",), iter([part.iloc[:2], part.iloc[2:]]), None))
    assert handle.timers == [10]
    passed = SimpleNamespace(getCurrentWatermarkInMs=lambda: 40)
    out = pd.concat(of.handleExpiredTimer(("s",), passed, None))
    assert list(out["query_id"]) == ["a", "b", "c"] and list(out["turn_index"]) == [1, 2, 3] and sorted(handle.timers[1:]) == [90, 1031]


def test_tasks_and_connections_of_judges_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(judge, "MOST_TASKS", 3)
    units, ledger = spark.range(200).select("id", F.col("id").cast("string").alias("p")), str(tmp_path / "ledger")
    got = judge.judged(units, "p", lambda ps: [f"<{p}>" for p in ps], "id", batch=4, ledger=ledger)
    assert {r["id"]: r["answer"] for r in got.collect()} == {i: f"<{i}>" for i in range(200)}
    assert len(list((tmp_path / "ledger").glob("*.parquet"))) == 3
    made = []
    whole = gate.socket.create_connection
    monkeypatch.setattr(gate.socket, "create_connection", lambda *a, **k: made.append(a) or whole(*a, **k))
    with gate.opened(spark, 2) as key:
        for _ in range(20):
            key.give(key.take())
    assert len(made) == 1


def test_balls_write_no_pairs(spark, monkeypatch):
    """Queries that reach every ball make no pairs of queries and balls, in one block or in several."""
    rng = np.random.default_rng(4)
    docs = spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(16)]) for i in range(400)], "doc_idx long, vector array<float>")
    queries = docs.where("doc_idx % 5 = 0").withColumnRenamed("doc_idx", "query_id")
    want = sorted((r["query_id"], r["rank"], r["doc_idx"]) for r in retrieval.top_k(retrieval.dense(queries, docs), 5).collect())
    for most in (4096, 30):
        monkeypatch.setattr(retrieval, "QUERY_BLOCK", most)
        names, whole = [], balls.kept
        monkeypatch.setattr(balls, "kept", lambda df, name: (names.append(name), whole(df, name))[1])
        found = balls.Balls.of(docs, 16).search(queries, 5)
        monkeypatch.setattr(balls, "kept", whole)
        assert sorted((r["query_id"], r["rank"], r["doc_idx"]) for r in found.best.collect()) == want
        assert "pairs" not in names and names.count("compared") == 2 * (1 if most > 80 else -(-800 // 270)) and found.compared <= found.pairs == 80 * 400
