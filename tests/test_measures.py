"""Agreement over many criteria, scales of all columns, chunks, exact selection and ranks against plain Python."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayworks.operators import agreement, postings, retrieval, schema
from assayworks.operators.contract import ContractError
from assayworks.sources import loading
from assayworks.sources.kept import placed


def plain_measures(pairs):
    pairs = [(a, b) for a, b in pairs if a is not None and b is not None]
    n = len(pairs)
    if n < 2:
        return None, None, None
    same = sum(a == b for a, b in pairs)
    values = {v for p in pairs for v in p}
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    chance = sum(left.count(v) * right.count(v) for v in values) / n**2
    kappa = None if chance == 1 else (same / n - chance) / (1 - chance)
    spread = 4 * n * n - sum((left.count(v) + right.count(v)) ** 2 for v in values)
    alpha = None if not spread else 1 - (2 * n - 1) * 2 * (n - same) / spread
    rho = None
    if all(isinstance(v, (int, float)) for v in values) and len(set(left)) > 1 and len(set(right)) > 1:
        rho = pd.Series(left).rank().corr(pd.Series(right).rank())
    return kappa, alpha, rho


def test_by_criterion(spark):
    rng = random.Random(7)
    kinds = {"a": [1, 2, 3], "b": [0.5, 1.5, None], "c": ["x", "y", None], "d": [1], "e": [None], "f": list(range(200))}
    rows = [tuple(rng.choice(v) for v in kinds.values() for _ in "xy") for _ in range(300)]
    schema_ = ", ".join(f"agent_{c} {t}, {c} {t}" for c, t in zip(kinds, ("int", "double", "string", "int", "int", "long"), strict=True))
    df = spark.createDataFrame(rows, schema_)
    got = {r["criterion"]: r for r in agreement.by_criterion(df, list(kinds)).collect()}
    for i, c in enumerate(kinds):
        want = plain_measures([(r[2 * i], r[2 * i + 1]) for r in rows])
        if c == "e":
            assert c not in got
            continue
        for name, value in zip(("cohen_kappa", "krippendorff_alpha", "spearman"), want, strict=True):
            assert got[c][name] is None if value is None else math.isclose(got[c][name], value, abs_tol=1e-9), (c, name)
    mixed = spark.createDataFrame([(1.0, 1), (2.0, 2), (2.0, 1)], "agent_g double, g int")
    assert agreement.by_criterion(mixed, ["g"]).head()["cohen_kappa"] == pytest.approx(plain_measures([(1, 1), (2, 2), (2, 1)])[0])
    plan = lambda names: agreement.by_criterion(df, names)._jdf.queryExecution().optimizedPlan().numberedTreeString().count("\n")
    assert plan(["a"]) == plan(["a", "b", "c", "f"])


def test_scales_of_all_columns(spark):
    rows = [(i % 3, True if i % 2 else None, float(i % 2) if i % 5 else None, 0.5 * (i % 3), f"t{i}", None, i % 60) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b boolean, c double, d double, e string, f string, `g h` long").repartition(6)
    got = {s.name: (s.kind, s.values, s.nullable) for s in schema.infer_scales(df, df.columns, 10)}
    assert got == {
        "a": ("long", (0, 1, 2), False), "b": ("boolean", (True,), True), "c": ("long", (0, 1), True), "d": ("double", (0.0, 0.5, 1.0), False),
        "e": ("string", None, False), "f": ("string", None, True), "g h": ("long", None, False),
    }
    assert schema.infer_scale(df, "g h", 60).values == tuple(range(60)) and schema.infer_scale(df, "g h", 59).values is None
    with pytest.raises(ContractError):
        schema.infer_scales(df, ["a", "none"])
    none = schema.infer_scales(df.where("false"), ["a", "e"])
    assert [s.values for s in none] == [None, None] and schema.infer_scales(df, []) == []


def test_chunks(spark):
    rng = random.Random(5)
    long = [[f"{'long' * rng.choice([0, 0, 2])}w{k}" for k in range(rng.randint(1, 900))] for _ in range(20)]
    texts = ["", None, "x" * 2500] + ["".join(w + rng.choice([" ", " ", "\n", "\n\n"]) for w in words) for words in long]
    df = spark.createDataFrame([(str(i), t, i) for i, t in enumerate(texts)], "source string, content string, kept long")
    rows = loading.chunked(df, 300, 60).collect()
    for i, t in enumerate(texts):
        own = sorted((r["chunk_id"], r["content"]) for r in rows if r["source"] == str(i))
        assert [k for k, _ in own] == list(range(len(own))) and all(r["total_chunks"] == len(own) and r["kept"] == i for r in rows if r["source"] == str(i))
        assert all(0 < len(c) <= 300 for _, c in own)
        if i < 3:
            continue
        words, reached = (t or "").split(), 0
        for _, c in own:  # each chunk is a run of words that goes on where those before ended, or a little before
            part = c.split()
            at = words.index(part[0])
            assert words[at : at + len(part)] == part and at <= reached < at + len(part) and len(" ".join(words[at:reached])) <= 60
            reached = at + len(part)
        assert reached == len(words)
    spark.udtf.register("chunks_of", loading.chunk_function(10, 0))
    assert [tuple(r) for r in spark.sql("select * from lateral chunks_of('ab cd efghij klm')").collect()][0][1:] == (2, "ab cd")


def test_exact_selection(spark):
    rng = random.Random(11)
    sets = {1: [rng.choice([0.0, 1.0, 2.0]) for _ in range(500)], 2: [rng.gauss(0, 1e6) for _ in range(3000)], 3: [5.0], 4: [-1e308, 1e308, 0.0, 1e-300, 2e-300], 5: [rng.expovariate(1) ** 9 for _ in range(2000)]}
    df = spark.createDataFrame([(q, x) for q, v in sets.items() for x in v] + [(1, None)], "query_id int, score double").repartition(5)
    wanted = spark.createDataFrame([(q, t) for q, v in sets.items() for t in sorted({0, len(v) // 3, len(v) // 2, len(v) - 1})], "query_id int, target long")
    got = {(r["query_id"], r["target"]): r["value"] for r in retrieval.order_statistics(df, wanted).collect()}
    assert got == {(q, t): sorted(v)[t] for q, v in sets.items() for t in {0, len(v) // 3, len(v) // 2, len(v) - 1}}


def test_places(spark):
    rows = [(g, v) for g in (None, "a", "b") for v in range(400 if g == "a" else 7)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(6)
    got = placed(df, "g", [F.desc("v")], "at").collect()
    assert len(got) == len(rows) and all(r["at"] == (400 if r["g"] == "a" else 7) - r["v"] for r in got)


def test_a_retriever_that_grows(spark, tmp_path):
    rng = random.Random(2)
    text = lambda: " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 12)))
    letters = lambda df, c: df.withColumn("vector", F.transform(F.array(*(F.lit(k) for k in range(8))), lambda k: (F.length(c) % (k + 3)).cast("double")))
    docs = [(f"s{i}", i, text()) for i in range(80)]
    df = lambda rows: spark.createDataFrame(rows, "source string, chunk_id int, content string")
    queries = spark.createDataFrame([(1, "w1 w2 w3"), (2, "nothing here"), (3, "w39")], "query_id int, text string")
    index = postings.Index(spark, str(tmp_path / "index"))
    grown = retrieval.create_retriever("content", df(docs[:50]), letters, index).with_more(df(docs[40:])).with_more(df(docs[:5]))
    whole = retrieval.create_retriever("content", df(docs), letters)
    rows = lambda found: sorted((r["query_id"], r["rank"], r["doc_idx"], round(r["score"], 7)) for r in found.collect())
    assert rows(grown.search(queries)) == rows(whole.search(queries)) and grown.corpus.count() == 80 == index.documents()
