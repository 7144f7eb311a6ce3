"""What a judge is asked: instruction, examples, domain texts, scale, the unit, and the form of the answer."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.operators.contract import Contract
from assayworks.operators.schema import Scale
from assayworks.sources.kept import numbered

#: Characters kept of an example's question and of a question to the domain.
MOST_QUESTION, MOST_DOMAIN_QUERY = 4000, 512
NO_DOMAIN = "There are no texts on the subject; judge by the instruction and the examples."


def source_instruction(contract: Contract) -> str:
    """What the fields of an answer stand for, a row of a small table each."""
    rows = [("field", "judges", "counts as", "better")]
    rows += [(s.source_id, s.column_name, s.role.replace("_", " "), "low" if s.inverted else "high") for s in contract.sources]
    return "\n".join(" | ".join(r) for r in rows)


def answer_form(names: list[str]) -> str:
    """Asks for a JSON object of this shape at the end."""
    shape = json.dumps(dict.fromkeys(names), ensure_ascii=False)
    return f"Close your reply with a JSON object of just this shape, and put for every null a value that its field may have:\n{shape}"


def scale_text(scales: list[Scale]) -> str:
    """The allowed values of each field."""
    listed = lambda s: ", ".join(s.labels()) if s.values is not None else f"any {s.kind}"
    return "\n".join(f"- {s.name}: {listed(s)}{' or null' if s.nullable else ''}" for s in scales)


def record_json(df: DataFrame, columns: list[str]) -> Column:
    """A record as JSON: keys in order, nulls kept; what is not a number is refused."""
    checked = []
    for c in sorted(columns):
        value = F.col(f"`{c}`")
        if df.schema[c].dataType.simpleString() in ("double", "float"):
            refused = F.raise_error(F.lit(f"{c}: not a number")).cast(df.schema[c].dataType)
            value = F.when(F.isnan(value) | (F.abs(value) == float("inf")), refused).otherwise(value)
        checked.append(value.alias(c))
    return F.to_json(F.struct(*checked), {"ignoreNullFields": "false"})


def example_pairs(labelled: DataFrame, context: list[str], answers: list[str]) -> DataFrame:
    """``question, answer`` JSON of labelled units; the question that is embedded is cut, the one in the prompt isn't."""
    question = record_json(labelled, context)
    return labelled.select("*", question.alias("question"), F.substring(question, 1, MOST_QUESTION).alias("embedded_question"), record_json(labelled, answers).alias("answer"))


def context_columns(columns: list[str], answers: list[str], service: tuple[str, ...] = ("_unit_id", "_row_positions", "_group_id")) -> list[str]:
    """Columns that tell about a unit: neither answers nor service columns."""
    return [c for c in columns if c not in answers and c not in service]


def without_words(text: Column, words: list[str]) -> Column:
    """A text without these words (as given, capitalised, in capitals, also inside others), single blanks left."""
    out = text
    for w in words:
        for form in dict.fromkeys((w, w.capitalize(), w.upper())):
            out = F.replace(out, F.lit(form), F.lit(""))
    return F.trim(F.regexp_replace(out, " {2,}", " "), F.lit(" \t\n\r\x0b\x0c"))


def joined_hits(hits: DataFrame, texts: DataFrame, text: Column, out: str) -> DataFrame:
    """``query_id`` and the texts of its hits in order of rank, a blank line between them."""
    held = hits.join(texts, "doc_idx").groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", text.alias("t")))).alias("h"))
    return held.select("query_id", F.array_join(F.transform("h", lambda x: x.t), "\n\n").alias(out))


def example_text() -> Column:
    return F.concat(F.lit("Question: "), F.col("question"), F.lit("\nAnswer: "), F.col("answer"))


def prompts(units: DataFrame, instruction: str, scales: list[Scale], examples: DataFrame | None = None, domain: DataFrame | None = None) -> DataFrame:
    """``query_id, prompt`` of ``units(query_id, text)`` with ``examples(query_id, examples)`` and ``domain(query_id, domain)``."""
    held = units.select("query_id", "text")
    none = F.lit(None).cast("string")
    held = held.join(examples, "query_id", "left") if examples is not None else held.withColumn("examples", none)
    held = held.join(domain, "query_id", "left") if domain is not None else held.withColumn("domain", none)
    parts = [
        F.lit("You assess the work of an agent.\n\nInstruction:\n" + instruction),
        F.concat(F.lit("Examples:\n"), F.coalesce("examples", F.lit("none"))),
        F.concat(F.lit("Texts on the subject:\n"), F.coalesce("domain", F.lit(NO_DOMAIN))),
        F.lit("Allowed values:\n" + scale_text(scales)),
        F.concat(F.lit("To assess:\n"), F.col("text")),
        F.lit(answer_form([s.name for s in scales])),
    ]
    return held.select("query_id", F.concat_ws("\n\n", *parts).alias("prompt"))


def structured(instruction: str, rewrite: Callable[[str], str], attempts: int = 3, delay: float = 5.0, sleep=None) -> str:
    """An instruction rewritten by a model, tried so often; if all attempts fail, as it was."""
    import time

    for n in range(attempts):
        try:
            found = rewrite(instruction)
        except Exception:  # a model may raise anything; the instruction itself will do
            found = ""
        if found and found.strip():
            return found
        if n + 1 < attempts:
            (sleep or time.sleep)(delay)
    return instruction


def sampled_rows(df: DataFrame, columns: list[str], rows: int = 15, width: int = 150, seed: int = 42) -> DataFrame:
    """A few rows with short cells to show a model what a table holds: gaps filled with each column's mode.

    A fixed number of rows is what this is for.
    """
    modes = df.agg(*[F.mode(F.col(f"`{c}`"), True).cast("string").alias(c) for c in columns]).head()
    cells = [F.substring(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(modes[c])), 1, width).alias(c) for c in columns]
    return df.select(*cells, F.xxhash64(F.lit(seed), *[F.col(f"`{c}`").cast("string") for c in columns]).alias("_o")).orderBy("_o").limit(rows).drop("_o")


def first_met(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column with ``_first``, the position of the first row that has it."""
    return df.groupBy(column).agg(F.min("_pos").alias("_first"))


def numbered_by_first(df: DataFrame, column: str) -> DataFrame:
    """``column, place``: distinct values numbered from 0 in order of their first rows."""
    return numbered(first_met(df, column), ["_first"], "place").select(column, "place")
