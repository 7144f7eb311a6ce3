"""Judges: what answers the criteria of a unit.

A judge is any callable from a list of prompts to a list of answers of the same
length.  An item may be an exception, and the call may raise one for all: :class:`Refused`
if a quota is used up, :class:`NotSent` for a prompt that was never sent.  It runs beside the
data, in batches, with bounded attempts a prompt and one pause for all tasks of a cluster.
Answers go into a ledger, a Parquet folder, batch by batch, and a run asks what the ledger
leaves open: what broke off goes on where it was.  :class:`assayworks.operators.chat.HttpJudge`
asks a chat service; :func:`neighbour_judge` is an offline stand-in that votes over retrieved
labelled examples.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayworks.operators.contract import ContractError
from assayworks.operators.gate import Pass, opened
from assayworks.operators.retrieval import bm25_top
from assayworks.operators.schema import Scale, parse_answers
from assayworks.operators.voting import add_votes, first_mode
from assayworks.sources.kept import exists, forget, fresh_path, kept

Judge = Callable[[list[str]], Sequence[str | Exception | None]]
#: Calls in flight, attempts after refusals by quota and after other errors, pauses in seconds.
IN_FLIGHT, QUOTA_ATTEMPTS, OTHER_ATTEMPTS = 4, 6, 2
#: Tasks of a wave, each of which starts a worker and leaves a file.
MOST_TASKS = 1000
FIRST_PAUSE, LONGEST_PAUSE, DELAY = 2.0, 60.0, 3.0
#: Fixed value: the share of units that a judge may lose, one at least.
TOLERANCE = 0.1


class JudgeError(RuntimeError):
    """An answer that can't be used."""


class Refused(JudgeError):
    """A service takes no more calls for now; ``pause`` in seconds, if it says so."""

    def __init__(self, why: str, pause: float | None = None):
        super().__init__(why)
        self.pause = pause


class NotSent(JudgeError):
    """A prompt that was not sent, because another of its call was refused."""

    def __init__(self) -> None:
        super().__init__("not sent")


#: What errors of other clients say when a quota is used up.
BUSY_WORDS = ("429", "too many requests", "rate limit")


def refusal(error: Any) -> Refused | None:
    """An error as a refusal, if it is one: a judge of this library says so by type, another client by its status or words."""
    if isinstance(error, Refused):
        return error
    if not isinstance(error, Exception) or isinstance(error, JudgeError):
        return None
    told = str(error).lower()
    if getattr(error, "status_code", None) != 429 and not any(w in told for w in BUSY_WORDS):
        return None
    number = re.match(r"[^0-9]{0,4}([0-9]+(?:[.][0-9]+)?)", told.partition("after")[2])
    return Refused(str(error), float(number[1]) if number else None)


def pause_after(refusals: int, named: float | None = None) -> float:
    """Seconds to wait after so many refusals of a prompt: what the service names, else doubling up to a bound."""
    return named if named else min(FIRST_PAUSE * 2 ** (refusals - 1), LONGEST_PAUSE)


def ask(
    judge: Judge,
    prompts: list[str],
    attempts: int = QUOTA_ATTEMPTS,
    others: int = OTHER_ATTEMPTS,
    delay: float = DELAY,
    sleep: Callable[[float], None] = time.sleep,
    gate: Pass | None = None,
) -> list[tuple[str | None, str | None]]:
    """For each prompt its answer, or the last error.

    All prompts still open are asked together, behind the ``gate`` if there is one.  Attempts
    are counted for prompts that were sent; a call that sends none counts for its first.  After a refusal
    all tasks behind the gate wait for the longest pause that a prompt of the call asks for.
    """
    out: list[tuple[str | None, str | None]] = [(None, "not asked")] * len(prompts)
    refused, failed = [0] * len(prompts), [0] * len(prompts)
    open_ = list(range(len(prompts)))
    while open_:
        lease = gate.take(sleep) if gate else None
        pause = 0.0
        try:
            got = _answers(judge, [prompts[i] for i in open_])
            still, wait = [], 0.0
            for i, answer in zip(open_, got, strict=True):
                if isinstance(answer, str):
                    out[i] = (answer, None)
                    continue
                out[i] = (None, "no answer" if answer is None else f"{type(answer).__name__}: {answer}")
                if isinstance(answer, NotSent):
                    still.append(i)
                elif busy := refusal(answer):
                    refused[i] += 1
                    pause = max(pause, pause_after(refused[i], busy.pause))
                    still += [i] * (refused[i] < attempts)
                else:
                    failed[i] += 1
                    wait = max(wait, delay)
                    still += [i] * (failed[i] < others)
        finally:
            if gate:
                gate.give(lease, pause)
        open_ = still
        if open_ and (wait or (pause and not gate)):
            sleep(max(wait, 0.0 if gate else pause))
    return out


def _answers(judge: Judge, prompts: list[str]) -> Sequence[Any]:
    """What a judge gives for each prompt; what it raises is each one's, and a call that sent nothing is a failure of its first."""
    try:
        got = list(judge(prompts))
        if len(got) != len(prompts):
            raise JudgeError(f"{len(got)} answers to {len(prompts)} prompts")
    except Exception as e:  # a judge may raise anything; the rows record it
        got = [e, *[NotSent() if refusal(e) else e] * (len(prompts) - 1)]
    if all(isinstance(x, NotSent) for x in got):
        got[0] = JudgeError("nothing was sent")
    return got


def judged(units: DataFrame, prompt: str, judge: Judge, key: str = "_unit_id", parallel: int = IN_FLIGHT, batch: int = 32, ledger: str | None = None, waves: int = 1, **retry: Any) -> DataFrame:
    """``key, answer, error`` for each row, a written table; at most ``parallel`` calls are under way at a time on a whole cluster.

    Each wave is a job that deals its prompts out in tasks of about ``batch``, of more batches where that made more
    than ``MOST_TASKS``; a task's answers are
    in the ``ledger`` (a folder of its own) as soon as it ends, whatever becomes of the job.  A run
    with a ledger asks only for keys that have no answer there, so a lost executor costs the tasks
    that it had under way, and a run that broke off goes on with the same ledger.  Errors are asked again
    by the next run.  Of a key's rows in the ledger an answer counts before an error.
    """
    spark = units.sparkSession
    ledger = ledger or fresh_path(spark, "ledger")
    row = T.StructType([T.StructField(key, units.schema[key].dataType), T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())])
    asked = units.select(key, F.col(prompt).cast("string").alias("_prompt"), F.pmod(F.xxhash64(F.col(key)), F.lit(waves)).alias("_wave"))
    if exists(spark, ledger):
        known = spark.read.schema(row).parquet(ledger).where("answer is not null").select(key).distinct()
        asked = asked.join(known, key, "left_anti")
    open_ = kept(asked, "open", by=["_wave"])
    sizes = {r["_wave"]: r["n"] for r in open_.groupBy("_wave").agg(F.count("*").alias("n")).collect()}  # a row a wave
    with opened(spark, parallel) as gate:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, batch):
                    part = b.slice(at, batch)
                    got = ask(judge, [p or "" for p in part.column(1).to_pylist()], gate=gate, **retry)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([a for a, _ in got], pa.string()), pa.array([e for _, e in got], pa.string())], names=row.names)

        for wave in sorted(sizes):
            tasks = max(1, min(-(-sizes[wave] // batch), MOST_TASKS))
            dealt = open_.where(F.col("_wave") == wave).select(key, "_prompt").repartition(tasks)
            # a task's file is in place once it ends, and stays if the job fails
            dealt.mapInArrow(run, row).write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger)
    forget(open_)
    found = spark.read.schema(row).parquet(ledger) if exists(spark, ledger) else spark.createDataFrame([], row)
    best = F.max(F.struct(F.col("answer").isNotNull().alias("good"), "answer", "error")).alias("_best")
    return units.select(key).join(found.groupBy(key).agg(best), key, "left").select(key, "_best.answer", "_best.error")


def check_failures(answers: DataFrame, share: float = TOLERANCE) -> dict[str, int]:
    """Refuse a run that lost more than this share of its rows, and more than one; the counts.  Call it on a kept table."""
    r = answers.agg(F.count("*").alias("n"), F.count("error").alias("bad")).head()
    tolerated = max(1, int(share * r["n"]))
    if r["bad"] > tolerated:
        some = "; ".join(str(x["error"])[:300] for x in answers.where("error is not null").select("error").limit(3).collect())
        raise ContractError(f"the judge failed on {r['bad']} of {r['n']} units, {tolerated} are tolerated: {some}")
    return {"asked": r["n"], "failed": r["bad"]}


def in_runs(units: DataFrame, runs: int) -> DataFrame:
    """Each unit once for each run, with ``run`` from 0."""
    if runs < 1:
        raise ValueError("there must be at least one run")
    return units.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))


def voted(answers: DataFrame, scales: list[Scale], runs: int, key: str = "_unit_id") -> DataFrame:
    """``key``, ``agent_<run>_<criterion>`` of several runs, and their vote ``agent_<criterion>``; of equal counts the first run's.

    ``answers(key, run, answer)`` holds the JSON answers.  An answer with no field on its scale counts for nothing.
    """
    read = answers.select(key, "run", *parse_answers(F.col("answer"), scales))
    names = [s.name for s in scales]
    if runs == 1:
        return read.drop("run")
    wide = read.groupBy(key).agg(*[F.max(F.when(F.col("run") == i, F.col(f"`agent_{c}`"))).alias(f"agent_{i}_{c}") for i in range(runs) for c in names])
    return add_votes(wide, names)


# --- without a service


def neighbour_judge(units: DataFrame, examples: DataFrame, criteria: list[str], k: int = 10) -> DataFrame:
    """``query_id, agent_<criterion>``: the vote of the k nearest ``examples(doc_idx, text, <criteria>)`` by BM25, best first."""
    hits = bm25_top(units.select("query_id", "text"), examples.select("doc_idx", "text"), k)
    held = hits.join(examples.select("doc_idx", *criteria), "doc_idx")
    ranked = held.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", *criteria))).alias("_h"))
    votes = {f"agent_{c}": _vote(c) for c in criteria}
    return units.select("query_id").join(ranked.select("query_id", *[v.alias(n) for n, v in votes.items()]), "query_id", "left")


def _vote(criterion: str):
    return first_mode(F.transform("_h", lambda h: h[criterion]))
