"""Trace spans to question and answer rows."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assayworks.functions.sequences import NotASequence, parse
from assayworks.operators.contract import ContractError
from assayworks.sources.kept import forget, kept
from assayworks.sources.loading import load_table

_MESSAGE = "array<struct<type:string,content:string>>"
_VALUE = "array<struct<type:string,value:string>>"
CANONICAL = ("trace_id", "query_id", "session_id", "starttime", "endtime", "input_query", "output_answer")


class ConversionError(ContractError):
    """Spans that give no dialogue, or not the ones asked for."""


def last_of(messages: Column, kind: str) -> Column:
    """The content of the last message of a kind."""
    return F.try_element_at(F.filter(messages, lambda m: m["type"] == kind), F.lit(-1))["content"]


def _full(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def question_of(text: Column) -> Column:
    """The last thing a human said, in an update, a state or an envelope's new state; else a state's current phrase."""
    asked = [last_of(F.from_json(F.get_json_object(text, f"{root}.messages"), _MESSAGE), "human") for root in ("$.update", "$.new_state", "$")]
    return F.coalesce(*map(_full, asked), _full(F.get_json_object(text, "$.current_phrase")))


def answer_of(text: Column) -> Column:
    """What went out in an envelope, or is for the user; else the last thing the agent said."""
    out = F.from_json(F.get_json_object(text, "$.outgoing.content.message"), _VALUE)
    sent = F.array_join(F.transform(F.filter(out, lambda m: m["value"].isNotNull()), lambda m: m["value"]), "\n")
    told = [F.get_json_object(text, f"{root}.message_to_user") for root in ("$.update", "$")]
    said = [last_of(F.from_json(F.get_json_object(text, f"{root}.messages"), _MESSAGE), "ai") for root in ("$.update", "$")]
    return F.coalesce(_full(sent), *map(_full, told), *map(_full, said))


def route_of(text: Column, keys: tuple[str, ...]) -> Column:
    return F.coalesce(*[_full(F.get_json_object(text, f"{root}['{k}']")) for k in keys for root in ("$.update", "$", "$.new_state")])


def _only(rows: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    return rows.where(F.col(column).isin(*values)) if values else rows


def _known(rows: DataFrame, column: str, most: int = 20) -> list[str]:
    """Some values of a column, for a message."""
    return sorted(str(r[0]) for r in rows.select(column).distinct().limit(most).collect())


def convert(
    spans: DataFrame,
    span_names: tuple[str, ...] = ("exit",),
    kinds: tuple[str, ...] = (),
    question_field: str = "output_text",
    answer_field: str = "output_text",
    dedup: bool = True,
    route_keys: tuple[str, ...] = (),
    basket_answers: tuple[str, ...] = (),
    allow_empty: bool = False,
    guards: bool = True,
) -> DataFrame:
    """Spans to the columns ``CANONICAL`` (and ``route`` with ``route_keys``), and ``_pos`` where they have it.

    Empty filters let all through.  With ``dedup`` one row of each trace stays, one
    with an answer first, then the first by position (or by start).  With ``route_keys`` the
    answer is the route taken.  Guards refuse spans of which none pass the filters or none holds a
    dialogue, routes of a single class, and routes outside ``basket_answers``.  They are metrics that
    are observed while the result is written once; the table that comes back is the written one.
    """
    fields = ", ".join(f"{c} string" for c in (*CANONICAL, *(["route"] if route_keys else [])))
    if not spans.columns:
        if not allow_empty:
            raise ConversionError("there are 0 spans")
        return spans.sparkSession.createDataFrame([], fields)
    read, passed, made = Observation(), Observation(), Observation()
    counted = F.count(F.lit(1)).alias("n")
    source = spans.observe(read, counted) if guards else spans
    rows = _only(_only(source, "span_name", span_names), "aef_kind", kinds)
    rows = rows.observe(passed, counted) if guards else rows
    answer = route_of(F.col(answer_field), route_keys) if route_keys else answer_of(F.col(answer_field))
    out = rows.select(
        F.col("trace_id"), F.col("trace_id").alias("query_id"), "session_id", F.col("start_time").alias("starttime"), F.col("end_time").alias("endtime"),
        F.coalesce(question_of(F.col(question_field)), F.lit("")).alias("input_query"), F.coalesce(answer, F.lit("")).alias("output_answer"),
        *(["_pos"] if "_pos" in rows.columns else []),
    )
    if dedup:
        order = [(F.trim("output_answer") == "").cast("int"), F.col("_pos") if "_pos" in out.columns else F.col("starttime")]
        out = out.withColumn("_r", F.row_number().over(W.partitionBy("query_id").orderBy(*order))).where("_r = 1").drop("_r")
    if route_keys:
        out = out.withColumn("route", F.col("output_answer"))
    if not guards:
        return out
    kept_rows = kept(out.observe(made, *_facts(basket_answers)), "converted")
    try:
        n_read, n_passed = _observed(read).get("n", 0), _observed(passed).get("n", 0)
        if not n_read:
            if not allow_empty:
                raise ConversionError("there are 0 spans")
            forget(kept_rows)
            return spans.sparkSession.createDataFrame([], fields)
        if not n_passed and not allow_empty:
            raise ConversionError(f"no span passes {span_names} and {kinds}; there are the names {_known(spans, 'span_name')} and the kinds {_known(spans, 'aef_kind')}")
        _guard(_observed(made), bool(route_keys), basket_answers, allow_empty)
    except ConversionError:
        forget(kept_rows)
        raise
    return kept_rows


def _observed(metrics: Observation) -> dict:
    """Metrics of a table that was written; none if the plan was empty before it ran."""
    try:
        return metrics.get
    except Py4JJavaError:
        return {}


def _facts(basket: tuple[str, ...]) -> list[Column]:
    """What the guards have to know about the result."""
    full = F.when(F.trim("output_answer") != "", F.trim("output_answer"))
    either = F.when((F.trim("output_answer") != "") | (F.trim("input_query") != ""), 1)
    off = F.count(F.when(~full.isin(*basket), 1)) if basket else F.count(F.lit(None))
    return [F.count(F.lit(1)).alias("n"), F.count(either).alias("told"), F.min(full).alias("lo"), F.max(full).alias("hi"), off.alias("off")]


def _guard(seen: dict, routed: bool, basket: tuple[str, ...], allow_empty: bool) -> None:
    if seen.get("n") and not seen["told"] and not allow_empty:
        raise ConversionError("no dialogue was found in any span")
    if routed and seen.get("lo") is not None and seen["lo"] == seen["hi"]:
        raise ConversionError(f"all routes are of one class: {seen['lo']!r}")
    if basket and seen.get("off"):
        raise ConversionError(f"{seen['off']} answers are outside the basket's vocabulary {sorted(basket)}")


def _names(value) -> tuple[str, ...]:
    """A filter given as text: a printed list, or names between commas."""
    if value is None:
        return ()
    if not isinstance(value, str):
        return tuple(value)
    try:
        return tuple(str(x) for x in parse(value))
    except NotASequence:
        return tuple(x.strip() for x in value.split(",") if x.strip())


def _flag(value) -> bool:
    return value.strip().lower() in ("1", "true", "yes", "on") if isinstance(value, str) else bool(value)


def convert_node(
    spark: SparkSession, traces: DataFrame | bytes | str, span_name="exit", aef_kind="", route_keys="", basket_answers="",
    dedup="true", allow_empty="false", input_field: str = "output_text", answer_field: str = "output_text", postulation: str = "qa",
) -> dict[str, DataFrame]:
    """``{"result": rows}`` of a table, a path or a Parquet file's bytes; parameters may be texts."""
    spans = load_table(spark, traces)
    routed = _names(route_keys) if postulation == "classification" else ()
    if postulation == "classification" and not routed:
        raise ConversionError("a classification needs route_keys")
    return {
        "result": convert(
            spans, _names(span_name), _names(aef_kind), input_field, answer_field, _flag(dedup), routed, _names(basket_answers), _flag(allow_empty)
        )
    }
