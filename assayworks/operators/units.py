"""Conversation tables: normalising, ordered groups, and units to assess.

Rows carry their position in ``_pos`` (a long); nothing depends on the order in
which an engine happens to read rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayworks.functions.cells import blank, equality_key, turn_number
from assayworks.functions.sequences import dialogue
from assayworks.operators.agreement import range_bucket
from assayworks.operators.contract import SCORE, Contract, require
from assayworks.operators.scoring import with_sources
from assayworks.sources.kept import numbered

REQUIRED = ("query_id", "input_query", "output_answer")


def with_positions(df: DataFrame, order: list[str]) -> DataFrame:
    """Number rows by columns that order them, in ``_pos``; a table that has it stays as it is."""
    return df if "_pos" in df.columns else numbered(df, order, "_pos")


def _group_keys(df: DataFrame, column: str) -> tuple[Column, Column]:
    """A key that equal groups share, and whether a row has a group; a row without one is its own group."""
    kind = df.schema[column].dataType
    key = equality_key(F.col(column), kind)
    return F.coalesce(key, F.concat(F.lit("row:"), F.col("_pos").cast("string"))), key.isNotNull()


def unique_labels(df: DataFrame, column: str, fallback: Column, out: str = "label") -> DataFrame:
    """Add labels of a column: the k-th repeat (k > 1) of a value gets ``#k``; a blank gets the fallback.

    Repeats are counted within ranges of positions, so a value that most rows have is no one task's.
    """
    key = F.coalesce(equality_key(F.col(column), df.schema[column].dataType), F.concat(F.lit("row:"), F.col("_pos").cast("string")))
    keyed = df.withColumn("_key", key).withColumn("_range", range_bucket(df, "_pos"))
    k = F.row_number().over(W.partitionBy("_key", "_range").orderBy("_pos"))
    sizes = keyed.groupBy("_key", "_range").agg(F.count("*").alias("_n"))
    earlier = F.sum("_n").over(W.partitionBy("_key").orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    before = sizes.withColumn("_before", earlier).where("_before is not null").select("_key", "_range", "_before")
    named = keyed.withColumn("_k", k).join(before, ["_key", "_range"], "left").withColumn("_k", F.col("_k") + F.coalesce("_before", F.lit(0)))
    text = F.col(column).cast("string")
    label = F.when(blank(F.col(column), df.schema[column].dataType), fallback).when(F.col("_k") > 1, F.concat(text, F.lit("#"), F.col("_k").cast("string")))
    return named.withColumn(out, label.otherwise(text)).drop("_key", "_k", "_range", "_before")


def ordered_groups(df: DataFrame) -> DataFrame:
    """Add ``_group_key, _group_id, turn_index, _group_order`` to rows with ``reference_group_id``.

    Given turn numbers hold in a group only if they are exactly 1 to n; else rows
    go by position.  A group is named by its first row; groups are in order of it.
    """
    key, has = _group_keys(df, "reference_group_id")
    given = turn_number(F.col("turn_index"), df.schema["turn_index"].dataType) if "turn_index" in df.columns else F.lit(None).cast("long")
    rows = df.withColumns({"_group_key": key, "_has": has, "_given": given})
    # what a group is, by one aggregation that combines before the shuffle; n different turns from 1 to n are all of them
    facts = rows.groupBy(F.col("_group_key").alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), F.count("_given").alias("_m"), F.count_distinct("_given").alias("_d"), F.min("_given").alias("_lo"), F.max("_given").alias("_hi"),
        F.min("_pos").alias("_group_order"), F.min_by(F.col("reference_group_id").cast("string"), "_pos").alias("_name"),
    )
    usable = (F.col("_m") == F.col("_n")) & (F.col("_d") == F.col("_n")) & (F.col("_lo") == 1) & (F.col("_hi") == F.col("_n"))
    facts = facts.select("_key", F.coalesce(usable, F.lit(False)).alias("_usable"), "_group_order", "_name")
    held = rows.join(facts, F.col("_group_key") == F.col("_key")).drop("_key")
    order = W.partitionBy("_group_key").orderBy(F.when(F.col("_usable"), F.col("_given")), "_pos")
    name = F.when(F.col("_has"), F.col("_name")).otherwise(F.concat(F.lit("row-"), F.col("_pos").cast("string")))
    return held.withColumns({"turn_index": F.row_number().over(order).cast("long"), "_group_id": name}).drop("_has", "_given", "_usable", "_name")


def unpack(packed: DataFrame) -> DataFrame:
    """One row a turn out of ``dialogue`` (``array<array<string>>``, or text in any form of it) with ``session_id``."""
    if isinstance(packed.schema["dialogue"].dataType, T.StringType):
        packed = packed.withColumn("dialogue", dialogue(F.col("dialogue")))
    named = packed.drop("reference_group_id", "turn_index")
    if "session_id" not in named.columns:
        named = named.withColumn("session_id", F.lit(None).cast("string"))
    named = unique_labels(named, "session_id", F.concat(F.lit("session-"), (F.col("_pos") + 1).cast("string")), "reference_group_id")
    turns = F.when(F.size("dialogue") > 0, F.col("dialogue")).otherwise(F.raise_error(F.lit("a dialogue has no turns")).cast("array<array<string>>"))
    each = named.select("*", F.posexplode(turns).alias("_t", "_turn")).drop("dialogue", *REQUIRED)
    turn = F.when(F.size("_turn") == 3, F.col("_turn")).otherwise(F.raise_error(F.lit("a turn must have three parts")).cast("array<string>"))
    own = F.get(turn, F.lit(0))
    ident = F.when(blank(own), F.concat("reference_group_id", F.lit("-t"), (F.col("_t") + 1).cast("string"))).otherwise(own)
    count = F.coalesce(F.col("input_query_count"), F.lit(1)) if "input_query_count" in packed.columns else F.lit(1)
    out = each.withColumns(
        {
            "query_id": ident,
            "input_query": F.get(turn, F.lit(1)),
            "output_answer": F.get(turn, F.lit(2)),
            "turn_index": (F.col("_t") + 1).cast("long"),
            "input_query_count": count,
            "_session": F.col("_pos"),
        }
    )
    return out.withColumn("_pos", (F.col("_session") * F.lit(1 << 20) + F.col("_t")).cast("long")).drop("_t", "_turn", "_session")


def normalize_umr(df: DataFrame, mode: str) -> DataFrame:
    """A flat table of turns, with group, turn and count columns where the mode needs them."""
    if "dialogue" in df.columns:
        require(not any(c in df.columns for c in ("input_query", "output_answer")), "a table is either flat or packed, not both")
        df = unpack(df)
    for c in REQUIRED:
        require(c in df.columns, f"column {c} is missing")
    bad = F.raise_error(F.lit("query_id is blank")).cast("string")
    df = df.withColumn("query_id", F.when(blank(F.col("query_id")), bad).otherwise(F.col("query_id").cast("string")))
    if mode == "qa":
        return df
    if "reference_group_id" not in df.columns:
        require("session_id" in df.columns, f"{mode} needs reference_group_id or session_id")
        no = F.raise_error(F.lit("session_id is blank")).cast("string")
        df = df.withColumn("reference_group_id", F.when(blank(F.col("session_id")), no).otherwise(F.col("session_id").cast("string")))
    if "input_query_count" not in df.columns:
        df = df.withColumn("input_query_count", F.lit(1))
    return ordered_groups(df)


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _constant(c: str, kind) -> list[Column]:
    """Aggregates: the first value of a group that is not blank, and how many different ones there are."""
    full = ~blank(F.col(c), kind)
    return [
        F.min_by(F.when(full, F.col(c)), F.when(full, F.col("_pos"))).alias(c),
        F.count_distinct(equality_key(F.col(c), kind)).alias(f"_n_{c}"),
    ]


def unitize(df: DataFrame, contract: Contract) -> DataFrame:
    """Units of a flat or packed table: ``_unit_id, _row_positions, _group_id, assessment_context`` and the sources."""
    rows = normalize_umr(df, contract.mode)
    if "input_query_count" not in rows.columns:
        rows = rows.withColumn("input_query_count", F.lit(1))
    rows = with_sources(rows, contract)
    sources = [s.source_id for s in contract.sources if s.source_id in rows.columns]
    kept = [*sources, *([SCORE] if SCORE in rows.columns and SCORE not in sources else [])]
    if contract.mode == "dialogue":
        return _dialogues(rows, contract, kept)
    rows = unique_labels(rows, "query_id", F.concat(F.lit("row-"), F.col("_pos").cast("string")), "_unit_id")
    if contract.mode == "qa":
        now = F.struct(_text("input_query").alias("input_query"), _text("output_answer").alias("output_answer"))
        context = F.struct(now.alias("current_turn"), F.lit("qa").alias("mode"))
        group = F.col("_unit_id") if "_group_id" not in rows.columns else F.col("_group_id")
    else:
        turn = F.struct(_text("input_query").alias("input_query"), _text("output_answer").alias("output_answer"), F.col("turn_index"))
        before = W.partitionBy("_group_key").orderBy("turn_index").rowsBetween(W.unboundedPreceding, -1)
        rows = rows.withColumn("_history", F.collect_list(turn).over(before))
        context = F.struct(turn.alias("current_turn"), F.col("_history").alias("history"), F.lit("turn_with_history").alias("mode"))
        group = F.col("_group_id")
    return rows.select(
        "_unit_id", F.array("_pos").alias("_row_positions"), group.alias("_group_id"), context.alias("assessment_context"),
        "input_query_count", "input_query", "output_answer", *kept,
    )


def _dialogues(rows: DataFrame, contract: Contract, kept: list[str]) -> DataFrame:
    turn = F.struct("turn_index", _text("input_query").alias("input_query"), _text("output_answer").alias("output_answer"), F.col("_pos").alias("pos"))
    constants = [x for c in kept for x in _constant(c, rows.schema[c].dataType)]
    if contract.weighted:
        constants += _constant("input_query_count", rows.schema["input_query_count"].dataType)
    made = rows.groupBy("_group_key").agg(
        F.first("_group_id").alias("_group_id"), F.array_sort(F.collect_list(turn)).alias("_turns"), F.min("_group_order").alias("_first"), *constants
    )
    for c in [*kept, *(["input_query_count"] if contract.weighted else [])]:
        several = F.raise_error(F.lit(f"{c} differs within a dialogue")).cast(rows.schema[c].dataType)
        made = made.withColumn(c, F.when(F.col(f"_n_{c}") > 1, several).otherwise(F.col(c)))
    if not contract.weighted:
        made = made.withColumn("input_query_count", F.lit(1))
    turns = F.transform("_turns", lambda t: F.struct(t.input_query.alias("input_query"), t.output_answer.alias("output_answer"), t.turn_index.alias("turn_index")))
    return made.select(
        F.col("_group_id").alias("_unit_id"), F.transform("_turns", lambda t: t.pos).alias("_row_positions"), "_group_id",
        F.struct(F.lit("dialogue").alias("mode"), turns.alias("turns")).alias("assessment_context"), "input_query_count", turns.alias("dialogue"), *kept,
    )


def drift_frame(units: DataFrame, contract: Contract, reference: bool) -> DataFrame:
    """``question, answer, target, reference_group_id`` of units: what was asked, as text or a JSON list."""
    context = F.col("assessment_context")
    if contract.mode == "qa":
        question = context.current_turn.input_query
    elif contract.mode == "dialogue":
        question = F.to_json(F.transform(context.turns, lambda t: t.input_query))
    else:
        asked = F.transform(context.history, lambda t: t.input_query)
        question = F.to_json(F.concat(asked, F.array(context.current_turn.input_query)))
    require(not reference or SCORE in units.columns, f"the reference needs {SCORE}")
    target = F.col(SCORE).cast("double") if SCORE in units.columns else F.lit(None).cast("double")
    if reference and contract.policy == "fail":
        target = F.coalesce(target, F.raise_error(F.lit("a reference score is missing")).cast("double"))
    out = units.select(question.alias("question"), F.lit("").alias("answer"), target.alias("target"), F.coalesce("_group_id", "_unit_id").alias("reference_group_id"))
    return out.where("target is not null") if reference else out


def prepare_drift_frames(reference: DataFrame, monitoring: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    return drift_frame(unitize(reference, contract), contract, True), drift_frame(unitize(monitoring, contract), contract, False)
