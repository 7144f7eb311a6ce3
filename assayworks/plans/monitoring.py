"""The whole run: calibrate a judge on labelled units, then score monitored ones."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.operators import agreement
from assayworks.operators.contract import SCORE, Contract, ContractError, for_judge, require, validate
from assayworks.operators.chat import JudgeConfig
from assayworks.operators.judge import Judge, check_failures, in_runs, judged, neighbour_judge, voted
from assayworks.operators.prompts import example_pairs, example_text, joined_hits, prompts, source_instruction, structured
from assayworks.operators.retrieval import Retriever, create_retriever
from assayworks.operators.schema import Scale, labelled_scales
from assayworks.operators.scoring import broadcast_scores, score_units
from assayworks.operators.units import normalize_umr, unitize
from assayworks.sources.documents import archive_documents, load_instruction
from assayworks.sources.kept import forget, kept, noting
from assayworks.sources.loading import chunked, load_in_order, load_monitoring

#: (units to judge, labelled units, criteria) -> ``query_id, agent_<criterion>``
Predict = Callable[[DataFrame, DataFrame, list[str]], DataFrame]
#: Fixed value: what a result calls its form.
RESULT_VERSION = "laim-assessment-result.v1"


@dataclass
class Result:
    scored_data: DataFrame | None
    acc_auto: float | None = None
    assessment_result: dict[str, Any] = field(default_factory=dict)

    #: Tables that ``scored_data`` reads; :meth:`discard` deletes them once it has been used.
    tables: list[DataFrame] = field(default_factory=list)

    def discard(self) -> None:
        forget(*self.tables)
        self.tables = []

    @property
    def figures(self) -> dict[str, float]:
        return self.assessment_result.get("calibration_metrics", {})


# --- frames


def source_missing(df: DataFrame, column: str) -> bool:
    """Whether a column is not there, or holds nothing but nulls and blanks."""
    if column not in df.columns:
        return True
    return not df.where(F.trim(F.col(f"`{column}`").cast("string")) != "").head(1)


def assessment_frame(df: DataFrame, contract: Contract) -> DataFrame:
    """For accuracy the prediction is the answer to assess; a table without predictions is refused."""
    if contract.method != "accuracy":
        return df
    prediction = contract.of_role("prediction")[0].column_name
    if source_missing(df, prediction):
        raise ContractError(f"there is no prediction in column {prediction}")
    return df.withColumn("output_answer", F.col(f"`{prediction}`"))


def assessor_units(df: DataFrame, contract: Contract, require_sources: bool) -> DataFrame:
    units = unitize(df, contract)
    missing = [s.source_id for s in contract.sources if s.source_id not in units.columns]
    require(not (require_sources and missing), f"the reference has no sources {missing}")
    return units


def labelled_units(units: DataFrame, criteria: list[str]) -> DataFrame:
    """Units with all labels (an empty text is one); none is refused."""
    out = units.na.drop("any", subset=criteria)
    require(bool(out.head(1)), "no unit of the reference is labelled, so there is no scale")
    return out


# --- judges


def _as_queries(units: DataFrame) -> DataFrame:
    return units.select(F.col("_unit_id").alias("query_id"), F.to_json("assessment_context").alias("text"))


@dataclass(frozen=True)
class Assessor:
    """Asks a judge about units: examples like them, texts on the subject, the scale and the instruction in each prompt.

    ``judge`` is a judge, or a :class:`JudgeConfig` whose judge checks answers against the scales
    of the labelled units.  ``embed(table, column)`` adds vectors.  Answers are asked for once
    and kept; a run that loses too many is refused.
    """

    judge: Judge | JudgeConfig
    instruction: str
    embed: Callable[[DataFrame, str], DataFrame]
    subject: Retriever | None = None
    runs: int = 1
    parallel: int = 4
    #: A folder for answers; a run that broke off goes on with it.  Prompts are asked in so many waves.
    ledger: str | None = None
    waves: int = 1
    retry: dict[str, Any] = field(default_factory=dict)

    def scales(self, labelled: DataFrame, criteria: list[str]) -> list[Scale]:
        return labelled_scales(labelled, criteria)

    def prompts(self, queries: DataFrame, examples: DataFrame, criteria: list[str], scales: list[Scale]) -> DataFrame:
        """``query_id, prompt``; examples are retrieved once for all runs."""
        pairs = example_pairs(examples, ["text"], criteria).select("question", "answer")
        index = create_retriever("question_answer", pairs, self.embed)
        asked = self.embed(queries, "text")
        near = joined_hits(index.search(asked), index.corpus.select("doc_idx", "question", "answer"), example_text(), "examples")
        about = None
        if self.subject is not None:
            about = joined_hits(self.subject.search(queries), self.subject.corpus.select("doc_idx", "content"), F.col("content"), "domain")
        return prompts(queries, self.instruction, scales, near, about)

    def __call__(self, queries: DataFrame, examples: DataFrame, criteria: list[str]) -> DataFrame:
        scales = self.scales(examples, criteria)
        judge = self.judge.build(scales) if isinstance(self.judge, JudgeConfig) else self.judge
        asked = in_runs(kept(self.prompts(queries, examples, criteria, scales), "prompts"), self.runs)
        asked = asked.withColumn("key", F.struct("query_id", "run"))
        answers = kept(judged(asked, "prompt", judge, "key", self.parallel, ledger=self.ledger, waves=self.waves, **self.retry), "answers")
        check_failures(answers)
        return voted(answers.select("key.query_id", "key.run", "answer"), scales, self.runs, "query_id")


def subject_retriever(spark, archive: str | None, embed, size: int = 1000, overlap: int = 200) -> Retriever | None:
    """Chunks of an archive's documents; none without documents that can be read."""
    read = archive_documents(spark, archive)
    if read is None:
        return None
    chunks = kept(chunked(read, size, overlap), "chunks")
    return create_retriever("content", chunks, embed) if chunks.head(1) else None


def predicted(units: DataFrame, labelled: DataFrame, criteria: list[str], predict: Predict) -> DataFrame:
    """``_unit_id, agent_*``, worked out once."""
    examples = labelled.select(F.xxhash64("_unit_id").alias("doc_idx"), F.to_json("assessment_context").alias("text"), *criteria)
    found = predict(_as_queries(units), examples, criteria)
    missing = [f"agent_{c}" for c in criteria if f"agent_{c}" not in found.columns]
    require(not missing, f"the judge gave no {missing}")
    return kept(found.withColumnRenamed("query_id", "_unit_id"), "predictions")


def _answered(criteria: list[str]):
    return F.coalesce(*[F.col(f"`agent_{c}`").cast("string") for c in criteria]).isNotNull()


def _scored(units: DataFrame, found: DataFrame, contract: Contract, criteria: list[str]) -> DataFrame:
    """Units with predictions as sources; a unit the judge failed on has no score, whatever the missing policy."""
    held = units.drop(*criteria, SCORE).join(found, "_unit_id", "left")
    held = kept(held.withColumns({c: F.col(f"`agent_{c}`") for c in criteria}).withColumn("_answered", _answered(criteria)), "judged")
    full = score_units(held.where("_answered"), contract)
    lost = held.where("not _answered").withColumn(SCORE, F.lit(None).cast(full.schema[SCORE].dataType))
    return kept(full.unionByName(lost).drop("_answered"), "scored")


def calibrate(labelled: DataFrame, criteria: list[str], predict: Predict, train_share: float = 0.8) -> tuple[dict[str, float], DataFrame, DataFrame]:
    """Figures of agreement on held-out units, these units, and the predictions for them.

    Units are dealt by group; units the judge failed on count for nothing, and if it
    failed on all the run is refused.
    """
    held = kept(labelled, "labelled")
    train, test = agreement.split(held, "_group_id", train_share)
    found = predicted(test, train, criteria, predict)
    pairs = test.select("_unit_id", *criteria).join(found, "_unit_id").where(_answered(criteria))
    pairs = kept(pairs, "pairs")
    require(bool(pairs.head(1)), "the judge answered none of the units to calibrate on")
    return agreement.agreement(pairs, criteria).head().asDict(), test, found


# --- results


def assessment_result(contract: Contract, scored: DataFrame, figures: dict[str, float] | None = None) -> dict[str, Any]:
    n = scored.agg(F.count("*").alias("total_units"), F.count(SCORE).alias("scored_units")).head().asDict()
    out = {"contract_version": RESULT_VERSION, "status": "computed", "assessment_mode": contract.mode, **n}
    return out if figures is None else {**out, "calibration_metrics": figures}


def unavailable_result(metric: dict[str, Any]) -> dict[str, Any]:
    """What a run says whose metric can't be computed."""
    out = {"contract_version": RESULT_VERSION, "status": "not_computable", "total_units": None, "scored_units": 0, "reason": metric.get("reason", "the metric can't be computed")}
    return {**out, **{k: metric[k] for k in ("assessment_mode", "reason_code") if metric.get(k) is not None}}


def unavailable_rows(rows: DataFrame | None) -> DataFrame | None:
    if rows is None:
        return None
    return rows.withColumns({SCORE: F.lit(None).cast("double"), "assessment_unit_id": F.lit(None).cast("string")})


def _broadcast(rows: DataFrame, scored: DataFrame, contract: Contract, criteria: list[str]) -> DataFrame:
    names = [c for c in scored.columns if c.startswith("agent_")]
    return broadcast_scores(normalize_umr(rows, contract.mode), scored, tuple(names)).withColumn("assessor_id", F.lit("judge"))


def run(
    reference: DataFrame,
    metric: dict,
    monitoring: DataFrame | None = None,
    stage: str = "combined",
    train_share: float = 0.8,
    predict: Predict = neighbour_judge,
) -> Result:
    """Tables with ``_pos`` to scored rows, agreement figures and a status."""
    if stage not in ("scoring", "monitoring", "combined"):
        raise ContractError(f"unknown stage {stage!r}")
    if stage != "scoring" and monitoring is None:
        raise ContractError(f"{stage} needs a monitoring table")
    known = validate(metric, require_computed=False)
    if known is None:
        return Result(unavailable_rows(monitoring), None, unavailable_result(metric))
    with noting() as made:
        contract = for_judge(known)
        units = assessor_units(assessment_frame(reference, known), contract, require_sources=True)
        criteria = [s.source_id for s in contract.sources]
        labelled = labelled_units(units, criteria)
        figures: dict[str, float] | None = None
        out, told = None, {}
        if stage in ("scoring", "combined"):
            figures, test, found = calibrate(labelled, criteria, predict, train_share)
            scored = _scored(test, found, contract, criteria)
            out, told = _broadcast(reference, scored, contract, criteria), assessment_result(known, scored, figures)
        if stage in ("monitoring", "combined"):
            rows = monitoring
            # spans of traces have no column of predictions: what was answered is assessed
            if known.method == "accuracy" and not source_missing(rows, known.of_role("prediction")[0].column_name):
                rows = assessment_frame(rows, known)
            other = assessor_units(rows, contract, require_sources=False)
            scored = _scored(other, predicted(other, labelled, criteria, predict), contract, criteria)
            out, told = _broadcast(monitoring, scored, contract, criteria), assessment_result(known, scored, figures)
    # what was judged and measured has been used; scores, and rows kept for their order, are still read
    read = [t for t in made if any(f"/assayworks-{name}-" in t._shared_path for name in ("scored", "rows", "starts"))]
    forget(*(t for t in made if t not in read))
    return Result(out, figures["acc_auto"] if figures else None, told, read)


def main(
    spark,
    reference_umr: DataFrame | str | bytes,
    monitoring_metric: dict,
    judge: Judge | JudgeConfig,
    embed: Callable[[DataFrame, str], DataFrame],
    assessor_instruction: str | dict | None = None,
    monitoring_umr: DataFrame | str | bytes | None = None,
    scoring_rag_train_size: float = 0.8,
    domain_rag_files_zip: str | None = None,
    stage: str = "combined",
    num_assessors: int = 1,
    rewrite: Callable[[str], str] | None = None,
    shorten: Callable[[str], str] | None = None,
    **retry: Any,
) -> Result:
    """The run from files: tables (rows in the order of their files, or by ``_pos`` where there is one), an instruction, an archive of texts on the subject, and a judge."""
    reference = load_in_order(spark, reference_umr)
    monitoring = None if monitoring_umr is None else load_monitoring(spark, monitoring_umr)
    known = validate(monitoring_metric, require_computed=False)
    if known is None:
        return run(reference, monitoring_metric, monitoring, stage, scoring_rag_train_size)
    instruction = load_instruction(assessor_instruction)
    require(bool(instruction.strip()), "a judge needs an instruction")
    for step in (rewrite, shorten):  # by a model, if one is given
        if step is not None:
            instruction = structured(instruction, step)
    instruction += "\n\n" + source_instruction(for_judge(known))
    subject = subject_retriever(spark, domain_rag_files_zip, embed)
    assessor = Assessor(judge, instruction, embed, subject, num_assessors, retry=retry)
    return run(reference, monitoring_metric, monitoring, stage, scoring_rag_train_size, assessor)
