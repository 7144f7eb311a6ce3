"""Row order from files, value maps, and modes over maps."""

import copy

import pytest
from pyspark.sql import functions as F

from assayworks.operators import scoring, voting
from assayworks.operators.contract import ContractError, validate
from assayworks.sources import loading, positions
from assayworks.sources.kept import scanned
from tests.test_contract import GOOD


def test_scanned(spark):
    rows = [(i, i * 7 % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    got = {r["k"]: r["before"] for r in scanned(df, [F.col("k").desc()], {"before": F.col("v")}, "t").collect()}
    assert got == {k: sum(v for j, v in rows if j > k) for k, _ in rows}
    assert scanned(df.where("false"), [F.col("k")], {"before": F.col("v")}, "t").count() == 0


def test_positions_of_parquet(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    df = spark.range(0, 30_000, 1, 3).withColumn("x", F.xxhash64("id"))
    df.write.option("parquet.block.size", 32_768).parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("20000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = positions.of_parquet(spark, path)
            assert got.columns == ["id", "x", "_pos"] and got.where("id <> _pos").count() == 0 and got.count() == 30_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert positions.of_parquet(spark, path, "id").columns == ["id", "x"]


def test_positions_of_csv_and_frames(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + "".join(f'{i},"line\none {i % 3}"\n' for i in range(500)))
    got = loading.load_in_order(spark, str(path))
    assert got.where("cast(a as long) <> _pos or b not like 'line%'").count() == 0 and got.count() == 500
    folder = tmp_path / "parts"
    folder.mkdir()
    for k in range(3):
        (folder / f"{k}.csv").write_text("".join(f"{1000 * k + i}\n" for i in range(400 * k + 7)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        lines = positions.of_text(spark.read.text(str(folder)))
        order = [int(r["value"]) for r in lines.orderBy("_pos").collect()]
        assert order == [1000 * k + i for k in range(3) for i in range(400 * k + 7)] and lines.where("_pos >= 1221").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    framed = loading.load_in_order(spark, spark.range(0, 90, 1, 4))
    assert framed.where("id <> _pos").count() == 0 and framed.count() == 90
    assert loading.load_in_order(spark, None) is None and positions.of_frame(spark.range(0)).count() == 0


def with_rule(rule, polarity="direct"):
    raw = copy.deepcopy(GOOD)
    raw["scoring"]["sources"][0] |= {"normalization": rule, "polarity": polarity}
    return raw


def test_value_maps(spark):
    c = validate(with_rule({" Good ": 1, "bad": "0", "BAD": "0.25", 1: 0.5}))
    df = spark.createDataFrame([("good",), (" GOOD",), ("Bad",), ("1",), (" ",), (None,)], "a string")
    assert [r[0] for r in scoring.score_units(df, c).select("main_metric").collect()] == [1.0, 1.0, 0.25, 0.5, None, None]
    inverted = validate(with_rule({"yes": 1, "no": 0}, "inverted"))
    yes = spark.createDataFrame([("yes",), ("no",)], "a string")
    assert [r[0] for r in scoring.score_units(yes, inverted).select("main_metric").collect()] == [0.0, 1.0]
    for bad in (c, validate(with_rule({}))):
        with pytest.raises(Exception, match="no value for"):
            scoring.score_units(spark.createDataFrame([("odd",)], "a string"), bad).collect()
    for refused in ({"a": "x"}, {"a": None}, {"a": True}, {"a": float("inf")}, "dict", None, []):
        with pytest.raises(ContractError):
            validate(with_rule(refused))


def test_modes_over_maps(spark):
    rows = [({"a": 1, "b": 2}, {"b": 2, "a": 1}, {"a": 1}), ({"a": 1}, {"b": 1}, None), (None, None, None), ({}, {"a": 1}, {})]
    df = spark.createDataFrame(rows, "agent_0_c map<string,int>, agent_1_c map<string,int>, agent_2_c map<string,int>")
    assert [r["agent_c"] for r in voting.add_votes(df, ["c"]).collect()] == [{"a": 1, "b": 2}, {"a": 1}, None, {}]
