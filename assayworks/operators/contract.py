"""The metric contract: a declarative description of how units are scored."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from decimal import Decimal, InvalidOperation
from typing import Any

#: Fixed values of the contract format.
VERSION, OLD_VERSION, UMR_VERSION = "laim-monitoring-metric.v2", "laim-monitoring-metric.v1", "laim-umr.v2"
MODES = ("qa", "turn_with_history", "dialogue")
POLICIES = ("fail", "exclude_unit", "exclude_value", "zero")
#: By method: role -> (least, most) number of sources; None: no upper limit.
ROLES: dict[str, dict[str, tuple[int, int | None]]] = {
    "identity": {"final_score": (1, 1)},
    "accuracy": {"prediction": (1, 1), "target": (1, 1)},
    "mean_criteria": {"criterion": (1, None)},
    "all_criteria": {"criterion": (1, None)},
    "majority": {"assessor_vote": (1, None)},
    "all_assessors": {"assessor_vote": (2, None)},
}
SCORE = "main_metric"
#: Columns that units have of their own.
UNIT_COLUMNS = ("_unit_id", "_row_positions", "_group_id", "assessment_context", "input_query_count", "input_query", "output_answer", "dialogue", SCORE)


class ContractError(ValueError):
    """A contract, or data under it, is refused."""


@dataclass(frozen=True)
class Source:
    source_id: str
    column_name: str
    role: str
    normalization: str = "numeric"
    polarity: str = "direct"
    #: With ``normalization="map"``: folded text to number.
    value_map: Mapping[str, Decimal] | None = None

    @property
    def inverted(self) -> bool:
        return self.polarity == "inverted"


@dataclass(frozen=True)
class Contract:
    basket_id: str
    name: str
    mode: str
    method: str
    policy: str
    sources: tuple[Source, ...]
    denominator: str | None
    weighted: bool
    scale: str
    baseline: Decimal
    recomputed: Decimal
    computed: bool = True

    def of_role(self, role: str) -> list[Source]:
        return [s for s in self.sources if s.role == role]


def require(ok: bool, why: str) -> None:
    if not ok:
        raise ContractError(why)


def finite(value: Any, name: str) -> Decimal:
    try:
        out = Decimal(str(value))
    except InvalidOperation:
        out = Decimal("NaN")
    require(out.is_finite() and not isinstance(value, bool), f"{name} must be a finite number, not {value!r}")
    return out


def _from_v1(raw: Mapping[str, Any]) -> dict[str, Any]:
    """The old format knew turns only."""
    out = {k: v for k, v in raw.items() if k not in ("evaluation_unit", "group_column")}
    if raw.get("status") == "not_evaluable":
        out["status"] = "not_computable"
    else:
        require(raw.get("evaluation_unit") == "turn", "a v1 contract must evaluate turns")
    return out | {"contract_version": VERSION, "umr_version": UMR_VERSION, "assessment_mode": "qa"}


def validate(raw: Mapping[str, Any], require_computed: bool = True) -> Contract | None:
    """Check a contract; None if it is one that cannot be computed and need not be."""
    require(isinstance(raw, Mapping), "a contract must be an object")
    if raw.get("contract_version") == OLD_VERSION:
        raw = _from_v1(raw)
    require(raw.get("contract_version") == VERSION, f"unknown contract version {raw.get('contract_version')!r}")
    require(raw.get("umr_version") == UMR_VERSION, f"unknown table version {raw.get('umr_version')!r}")
    status = raw.get("status")
    require(status in ("computed", "not_computable"), f"unknown status {status!r}")
    if status == "not_computable":
        require(not require_computed, "the metric is not computable")
        return None
    for key in ("basket_id", "name"):
        require(bool(str(raw.get(key) or "").strip()), f"{key} is missing")
    require(raw.get("score_column") == SCORE, f"score_column must be {SCORE}")
    mode = raw.get("assessment_mode")
    require(mode in MODES, f"unknown assessment_mode {mode!r}")
    scoring = raw.get("scoring")
    require(isinstance(scoring, Mapping), "scoring must be an object")
    method = scoring.get("method")
    require(method in ROLES, f"unknown method {method!r}")
    require(scoring.get("missing_policy") in POLICIES, f"unknown missing_policy {scoring.get('missing_policy')!r}")
    sources = tuple(_source(x) for x in scoring.get("sources") or ())
    ids = [s.source_id for s in sources]
    require(len(set(ids)) == len(ids), "source ids must differ")
    roles = ROLES[method]
    for s in sources:
        require(s.role in roles, f"{method} has no role {s.role!r}")
        require(s.normalization != "label" or method == "accuracy", f"{s.source_id}: {method} needs numbers, not labels")
    for role, (least, most) in roles.items():
        n = sum(s.role == role for s in sources)
        require(n >= least and (most is None or n <= most), f"{method} needs {least} to {most or 'any number of'} sources of role {role}, not {n}")
    denominator = scoring.get("majority_denominator")
    require((denominator in ("declared", "present")) if method == "majority" else denominator is None, "majority_denominator goes with majority, and only with it")
    aggregation = raw.get("aggregation")
    require(isinstance(aggregation, Mapping), "aggregation must be an object")
    how, weight = aggregation.get("method"), aggregation.get("weight_column")
    require((how, weight) in (("mean", None), ("frequency_weighted_mean", "input_query_count")), f"unknown aggregation {how!r} by {weight!r}")
    baseline = raw.get("baseline")
    require(isinstance(baseline, Mapping) and baseline.get("scale") in ("ratio", "raw"), "baseline must have a scale, ratio or raw")
    validation = raw.get("primary_validation")
    require(isinstance(validation, Mapping) and validation.get("affects_monitoring") is False, "primary_validation must not affect monitoring")
    return Contract(
        str(raw["basket_id"]), str(raw["name"]), mode, method, scoring["missing_policy"], sources, denominator, weight is not None,
        baseline["scale"], finite(baseline.get("value"), "baseline.value"), finite(baseline.get("recomputed_value"), "baseline.recomputed_value"),
    )


def _source(raw: Mapping[str, Any]) -> Source:
    require(isinstance(raw, Mapping), "a source must be an object")
    for key in ("source_id", "column_name", "role"):
        require(bool(str(raw.get(key) or "").strip()), f"a source lacks {key}")
    rule, polarity = raw.get("normalization", "numeric"), raw.get("polarity", "direct")
    values = None
    if isinstance(rule, Mapping):  # the map itself is the rule; texts that fold alike are one, the last counts
        values = {str(k).strip().lower(): finite(v, f"normalization[{k!r}] of {raw['source_id']}") for k, v in rule.items()}
        rule = "map"
    else:
        require(rule in ("numeric", "label"), f"unknown normalization {rule!r}")
    require(polarity in ("direct", "inverted"), f"unknown polarity {polarity!r}")
    require(not (rule == "label" and polarity == "inverted"), "a label cannot be inverted")
    require(raw["source_id"] not in UNIT_COLUMNS, f"{raw['source_id']} is a column of units")
    return Source(str(raw["source_id"]), str(raw["column_name"]), str(raw["role"]), rule, polarity, values)


def for_judge(contract: Contract) -> Contract:
    """What a judge is asked for: accuracy and whole dialogues become one given score."""
    if contract.method != "accuracy" and contract.mode != "dialogue":
        return contract
    return replace(contract, method="identity", denominator=None, sources=(Source("assessment_score", SCORE, "final_score"),))
