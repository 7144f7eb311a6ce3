"""Contracts compiled to column expressions; aggregation, and scores back on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.functions.cells import NUMBER, blank, normalised
from assayworks.operators.contract import SCORE, Contract, require


def _missing(policy: str, name: str) -> Column:
    if policy == "fail":
        return F.raise_error(F.lit(f"{name}: a value is missing")).cast("double")
    return F.lit(0.0 if policy == "zero" else None).cast("double")


def _binary(v: Column, name: str) -> Column:
    return F.when(v.isNull() | v.isin(0, 1), v).otherwise(F.raise_error(F.lit(f"{name}: only 0 and 1 are votes")).cast(NUMBER))


def score(contract: Contract) -> Column:
    """The score of a unit whose columns are named by source ids, as a double; null: excluded."""
    cells = {s.source_id: normalised(F.col(s.source_id), s.normalization, s.inverted, s.source_id, s.value_map) for s in contract.sources}
    missing = _missing(contract.policy, contract.name)
    method = contract.method
    if method == "identity":
        v = cells[contract.of_role("final_score")[0].source_id]
        return F.coalesce(v.cast("double"), missing)
    if method == "accuracy":
        a, b = (cells[contract.of_role(r)[0].source_id] for r in ("prediction", "target"))
        kinds = {contract.of_role(r)[0].normalization == "label" for r in ("prediction", "target")}
        same = a == b if len(kinds) == 1 else F.lit(False)
        return F.when(a.isNull() | b.isNull(), missing).otherwise(F.when(same, 1.0).otherwise(0.0))
    if method in ("mean_criteria", "all_criteria", "all_assessors"):
        values = [_binary(v, k) if method != "mean_criteria" else v for k, v in cells.items()]
        found = [v.isNotNull() for v in values]
        n = sum((f.cast("int") for f in found), F.lit(0))
        filled = [F.coalesce(v, F.lit(0).cast(NUMBER)) for v in values]
        if method == "mean_criteria":
            total = sum((v.cast("decimal(38,16)") for v in filled), F.lit(0).cast("decimal(38,16)")).cast("double")
            every, present, zeroed = total / len(values), F.when(n > 0, total / n), total / len(values)
        else:
            every = present = (F.least(*values) if len(values) > 1 else values[0]).cast("double")
            zeroed = (F.least(*filled) if len(filled) > 1 else filled[0]).cast("double")
        if contract.policy == "exclude_value":
            return present
        return F.when(n == len(values), every).otherwise(zeroed if contract.policy == "zero" else missing)
    votes = [_binary(v, k) for k, v in cells.items()]
    present = sum((v.isNotNull().cast("int") for v in votes), F.lit(0))
    positive = sum((F.coalesce(v.cast("int"), F.lit(0)) for v in votes), F.lit(0))
    of = F.lit(len(votes)) if contract.denominator == "declared" else present
    return F.when(present == 0, missing).when(2 * positive > of, 1.0).when(2 * positive < of, 0.0).otherwise(missing)


def with_sources(df: DataFrame, contract: Contract) -> DataFrame:
    """Add each source's column under the source's id; columns that are not there are skipped."""
    new = {s.source_id: F.col(f"`{s.column_name}`") for s in contract.sources if s.column_name in df.columns}
    return df.withColumns(new)


def score_units(units: DataFrame, contract: Contract) -> DataFrame:
    """Units with ``main_metric``; every source column must be there."""
    for s in contract.sources:
        require(s.source_id in units.columns, f"source {s.source_id} is missing")
    return units.withColumn(SCORE, score(contract))


def broadcast_scores(rows: DataFrame, units: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Scores of units on the rows they were made of, by ``_pos``; other rows get null."""
    new = [SCORE, "assessment_unit_id", *extra]
    each = units.select(F.explode("_row_positions").alias("_pos"), SCORE, F.col("_unit_id").alias("assessment_unit_id"), *extra)
    return rows.drop(*new).join(each, "_pos", "left")


def aggregate(units: DataFrame, contract: Contract) -> DataFrame:
    """One row: ``name, value, total_units, scored_units, excluded_units, weight_sum`` of units with ``main_metric``.

    Sums are exact decimals; only their quotient is a double.
    """
    value = F.when(~blank(F.col(SCORE), units.schema[SCORE].dataType), F.col(SCORE).cast("decimal(24,17)"))
    if contract.policy == "zero":
        value = F.coalesce(value, F.lit(0).cast("decimal(24,17)"))
    elif contract.policy == "fail":
        value = F.coalesce(value, F.raise_error(F.lit(f"{contract.name}: a score is missing")).cast("decimal(24,17)"))
    weight = F.col("input_query_count").cast("decimal(13,5)") if contract.weighted else F.lit(1).cast("decimal(13,5)")
    weight = F.when(value.isNotNull(), F.when(weight > 0, weight).otherwise(F.raise_error(F.lit("a weight must be positive")).cast("decimal(13,5)")))
    made = units.select(value.alias("v"), weight.alias("w")).agg(
        F.sum(F.col("v") * F.col("w")).alias("vw"), F.sum("w").alias("w"), F.count("*").alias("n"), F.count("v").alias("k")
    )
    whole = F.when(F.col("k") > 0, F.col("vw").cast("double") / F.col("w").cast("double"))
    return made.select(
        F.lit(contract.name).alias("name"),
        whole.alias("value"),
        F.col("n").alias("total_units"),
        F.col("k").alias("scored_units"),
        (F.col("n") - F.col("k")).alias("excluded_units"),
        F.col("w").cast("double").alias("weight_sum"),
    )


def aggregate_main_metric(units: DataFrame, contract: Contract) -> dict:
    """The row of :func:`aggregate`; it is an error if no unit is left."""
    out = aggregate(units, contract).head().asDict()
    require(out["scored_units"] > 0, "no unit has a score")
    return out
