import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from assayworks.functions.cells import blank, normalised, turn_number
from assayworks.operators import agreement, judge, retrieval, schema, scoring, units, voting
from assayworks.plans.catalog import contract
from assayworks.plans.monitoring import run
from assayworks.sources.loading import recursive_chunks
from assayworks.sources.traces import convert

TWO = [("a", "criterion", "numeric", "direct"), ("b", "criterion", "numeric", "inverted")]


def score(spark, method, sources, policy, rows, **more):
    df = spark.createDataFrame(rows, ", ".join(f"{s[0]} string" for s in sources))
    return [r[0] for r in scoring.score_units(df, contract(method, sources, policy, **more)).select("main_metric").collect()]


def test_truth_table(spark):
    rows = [("1", "0"), ("1", None), (None, None), ("0", "0")]
    assert score(spark, "mean_criteria", TWO, "exclude_value", rows) == [1, 1, None, 0.5]
    assert score(spark, "mean_criteria", TWO, "exclude_unit", rows) == [1, None, None, 0.5]
    assert score(spark, "mean_criteria", TWO, "zero", rows) == [1, 0.5, 0, 0.5]
    assert score(spark, "all_criteria", TWO, "exclude_value", rows) == [1, 1, None, 0]
    with pytest.raises(Exception, match="missing"):
        score(spark, "mean_criteria", TWO, "fail", rows)
    votes = [(x, "assessor_vote", "numeric", "direct") for x in "abc"]
    rows = [("1", "1", "0"), ("1", "0", None), ("1", None, None), (None, None, None)]
    assert score(spark, "majority", votes, "exclude_unit", rows, denominator="present") == [1, None, 1, None]
    assert score(spark, "majority", votes, "zero", rows, denominator="declared") == [1, 0, 0, 0]
    assert score(spark, "all_assessors", votes, "zero", rows) == [0, 0, 0, 0]
    with pytest.raises(Exception, match="0 and 1"):
        score(spark, "all_criteria", TWO, "zero", [("0.5", "1")])


def test_cells(spark):
    df = spark.createDataFrame([(" 85% ", "Yes "), ("", "\t"), (None, "no")], "v string, l string")
    got = df.select(normalised(F.col("v"), "numeric", False, "v").cast("double"), normalised(F.col("l"), "label", False, "l"),
                    normalised(F.col("l"), "map", True, "l", {"YES": 1, "no": 0}).cast("int"), blank(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [(0.85, "yes", 0, False), (None, None, None, True), (None, "no", 1, False)]
    turns = spark.createDataFrame([("1",), ("2.0",), ("0",), ("1.5",), (" ",), ("x",), (None,)], "t string")
    assert [r[0] for r in turns.select(turn_number(F.col("t"), turns.schema["t"].dataType)).collect()] == [1, 2, None, None, None, None, None]


def test_groups_and_units(spark):
    rows = [(0, "q0", "A", 2, "in0"), (1, "q1", " a ", 1, "in1"), (2, "q2", "b", 1, "in2"), (3, "q3", "b", 3, "in3"), (4, "q3", None, 1, "in4")]
    df = spark.createDataFrame(rows, "_pos long, query_id string, reference_group_id string, turn_index int, input_query string").withColumn("output_answer", F.lit(None).cast("string"))
    df = df.withColumn("main_metric", F.lit(1.0))
    got = {r["_pos"]: (r["_group_id"], r["turn_index"]) for r in units.normalize_umr(df, "dialogue").collect()}
    assert got == {0: ("A", 2), 1: ("A", 1), 2: ("b", 1), 3: ("b", 2), 4: ("row-4", 1)}
    c = contract("identity", [("assessment_score", "final_score", "numeric", "direct")], mode="dialogue")
    made = units.unitize(df, c)
    assert {r["_unit_id"]: r["_row_positions"] for r in made.collect()} == {"A": [1, 0], "b": [2, 3], "row-4": [4]}
    back = scoring.broadcast_scores(df, scoring.score_units(made, c))
    assert back.count() == 5 and back.where("main_metric = 1").count() == 5
    flat = units.unitize(df, contract("identity", [("assessment_score", "final_score", "numeric", "direct")]))
    assert sorted(r["_unit_id"] for r in flat.collect()) == ["q0", "q1", "q2", "q3", "q3#2"]


def test_unpack_refuses(spark):
    df = spark.createDataFrame([(0, "s", [])], "_pos long, session_id string, dialogue array<array<string>>")
    with pytest.raises(Exception, match="no turns"):
        units.unpack(df).collect()
    df = spark.createDataFrame([(0, "s", [["q", "i"]])], "_pos long, session_id string, dialogue array<array<string>>")
    with pytest.raises(Exception, match="three parts"):
        units.unpack(df).collect()


def test_positions(spark):
    rows = [(i * 7919 % 1000,) for i in range(1000)]
    got = units.with_positions(spark.createDataFrame(rows, "x int"), ["x"]).collect()
    assert all(r["x"] == r["_pos"] for r in got)


def test_votes(spark):
    rows = [([],), ([1],), ([1, 2, 1, 3, 1],), ([1, 2, None, 1, None],), ([3, 1, 1, 3],), ([None],)]
    got = [r[0] for r in spark.createDataFrame(rows, "v array<int>").select(voting.first_mode(F.col("v"))).collect()]
    assert got == [None, 1, 1, 1, 3, None]
    assert voting.assessor_columns(["agent_source_1", "agent_2_source_1", "agent_source_10", "x"], "source_1") == ["agent_source_1", "agent_2_source_1"]


def test_agreement(spark):
    rows = [(1, 1), (1, 0), (0, 0), (0, 0), (1, 1), (None, 1)]
    df = spark.createDataFrame(rows, "agent_c int, c int")
    got = agreement.agreement(df, ["c"]).head()
    assert got["acc_auto"] == pytest.approx(4 / 6)
    assert got["cohen_kappa"] == pytest.approx((0.8 - 0.48) / 0.52)
    same = spark.createDataFrame([(1, 1), (0, 0)], "agent_c int, c int")
    assert agreement.kappa_alpha(same, "agent_c", "c").head()["cohen_kappa"] == 1
    flat = spark.createDataFrame([(1, 1), (1, 0)], "agent_c int, c int")
    assert agreement.spearman(flat, "agent_c", "c").head()[0] is None
    train, test = agreement.split(spark.range(10).toDF("g"), "g", 0.8)
    assert train.count() == 8 and train.intersect(test).count() == 0


def test_bm25_brute_force(spark):
    import math

    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice("a b c d e f g".split()) for _ in range(rng.randint(1, 9)))) for i in range(30)]
    asked = [(0, "A b b"), (1, "g z")]
    got = {(r["query_id"], r["doc_idx"]): r["score"] for r in retrieval.bm25(
        spark.createDataFrame(asked, "query_id int, text string"), spark.createDataFrame(docs, "doc_idx int, text string"), every=True).collect()}
    parted = {i: t.split() for i, t in docs}
    n, avg = len(docs), sum(map(len, parted.values())) / len(docs)
    df = Counter(t for ts in parted.values() for t in set(ts))
    raw = {t: math.log(n - k + 0.5) - math.log(k + 0.5) for t, k in df.items()}
    mean = sum(raw.values()) / len(raw)
    for q, text in asked:
        for i, ts in parted.items():
            want = sum((raw[t] if raw[t] >= 0 else 0.25 * mean) * ts.count(t) * 2.5 / (ts.count(t) + 1.5 * (0.25 + 0.75 * len(ts) / avg)) for t in text.lower().split() if t in raw)
            assert got[q, i] == pytest.approx(want)


def test_rank_modes(spark):
    df = spark.createDataFrame([(0, i, s) for i, s in enumerate([5.0, 1.0, 9.0, 3.0])], "query_id int, doc_idx int, score double")
    true = {r["doc_idx"]: r["norm"] for r in retrieval.rank_normalised(df).collect()}
    assert sorted(true, key=true.get, reverse=True) == [2, 0, 3, 1] and true[2] == 1 and true[1] == 0
    odd = {r["doc_idx"]: round(r["norm"], 3) for r in retrieval.rank_normalised(df, "compat").collect()}
    assert odd == {0: 0.0, 1: 0.656, 2: -0.313, 3: 0.323}


def test_chunks(spark):
    sizes = {n: -(-n // 1000) or 1 for n in (0, 999, 1000, 1001)}
    df = spark.createDataFrame([(n, "x" * n) for n in sizes], "n int, t string")
    assert {r[0]: r[1] for r in df.select("n", F.size(retrieval.fixed_chunks(F.col("t")))).collect()} == sizes
    text = "\n\n".join(" ".join(f"w{i}" for i in range(k)) for k in (50, 400, 30))
    pieces = recursive_chunks(text, 300, 60)
    assert all(len(p) <= 300 for p in pieces) and set(" ".join(pieces).split()) == set(text.split())


def test_scales_and_answers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "s double")
    assert schema.infer_scale(df, "s") == schema.Scale("s", "long", (1, 2), True)
    assert schema.infer_scale(spark.range(60).toDF("s"), "s").values is None
    assert schema.last_object('<think>{"s":0}</think> ```json {"s":1}``` {bad') == {"s": 1}
    assert schema.last_object('{"a": {"b": 1}} and {"c": "}{"} end }') == {"c": "}{"}
    assert schema.last_object("none") is None and schema.last_object(None) is None


def test_judge_retries():
    calls, slept = [], []

    def flaky(prompts):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("429 too many requests, retry after: 7")
        return ["{}"]

    assert judge.ask(flaky, ["p"], sleep=slept.append) == [("{}", None)] and slept == [7, 7]

    def broken(prompts):
        raise ValueError("no")

    assert judge.ask(broken, ["p"], sleep=slept.append)[0][0] is None and slept[2:] == [3]


def test_traces(spark):
    body = '{"update":{"messages":[{"type":"human","content":"hi"},{"type":"human","content":"q"}],"message_to_user":"%s","scenario":"s"}}'
    rows = [(0, "t", "exit", body % ""), (1, "t", "exit", body % "a"), (2, "t", "noise", "{}")]
    spans = spark.createDataFrame(rows, "_pos long, trace_id string, span_name string, output_text string").withColumns(
        {c: F.lit("x") for c in ("session_id", "aef_kind", "start_time", "end_time")})
    assert [(r.input_query, r.output_answer) for r in convert(spans).collect()] == [("q", "a")]
    assert convert(spans, dedup=False).count() == 2
    assert convert(spans, route_keys=("route", "scenario"), guards=False).head()["route"] == "s"


def test_whole_run(spark):
    rows = [(i, f"q{i}", f"word{i % 2} same{i % 2}", "ans", float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "_pos long, query_id string, input_query string, output_answer string, good double")
    raw = {
        "contract_version": "laim-monitoring-metric.v2", "umr_version": "laim-umr.v2", "status": "computed", "basket_id": "b", "name": "m",
        "score_column": "main_metric", "assessment_mode": "qa",
        "scoring": {"method": "mean_criteria", "missing_policy": "exclude_value",
                    "sources": [{"source_id": "good", "column_name": "good", "role": "criterion"}]},
        "aggregation": {"method": "mean"}, "baseline": {"value": 1, "recomputed_value": 1, "scale": "ratio"}, "primary_validation": {"affects_monitoring": False},
    }
    out = run(df, raw, df.drop("good"))
    assert out.assessment_result["scored_units"] == 40 and out.scored_data.count() == 40
    assert out.acc_auto == out.figures["acc_auto"] == 1.0
