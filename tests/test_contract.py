import copy

import pytest

from assayworks.operators.contract import ContractError, for_judge, validate

GOOD = {
    "contract_version": "laim-monitoring-metric.v2", "umr_version": "laim-umr.v2", "status": "computed", "basket_id": "b", "name": "m",
    "score_column": "main_metric", "assessment_mode": "qa",
    "scoring": {"method": "mean_criteria", "missing_policy": "exclude_value", "majority_denominator": None,
                "sources": [{"source_id": "a", "column_name": "a", "role": "criterion", "normalization": "numeric", "polarity": "direct"}]},
    "aggregation": {"method": "mean"}, "baseline": {"value": "0.8", "recomputed_value": "0.8", "scale": "ratio"},
    "primary_validation": {"affects_monitoring": False},
}


def changed(path, value):
    out = copy.deepcopy(GOOD)
    at = out
    for k in path[:-1]:
        at = at[k]
    at[path[-1]] = value
    return out


def test_good_contract():
    c = validate(GOOD)
    assert (c.method, c.mode, c.policy, c.weighted) == ("mean_criteria", "qa", "exclude_value", False)


@pytest.mark.parametrize(
    "path, value",
    [
        (["contract_version"], "v9"), (["umr_version"], "x"), (["status"], "odd"), (["status"], "not_computable"), (["name"], " "),
        (["score_column"], "s"), (["assessment_mode"], "x"), (["scoring", "method"], "x"), (["scoring", "missing_policy"], "x"),
        (["scoring", "sources"], []), (["scoring", "majority_denominator"], "present"), (["scoring", "method"], "identity"),
        (["aggregation", "method"], "frequency_weighted_mean"), (["aggregation", "weight_column"], "w"), (["baseline", "value"], "NaN"),
        (["baseline", "scale"], "x"), (["primary_validation", "affects_monitoring"], True), (["primary_validation", "affects_monitoring"], 0),
        (["scoring", "sources", 0, "source_id"], "main_metric"), (["scoring", "sources", 0, "role"], "target"),
        (["scoring", "sources", 0, "normalization"], "dict"), (["scoring", "sources", 0, "normalization"], "label"),
        (["scoring", "sources", 0, "polarity"], "x"), (["scoring", "sources"], GOOD["scoring"]["sources"] * 2),
    ],
)
def test_refused(path, value):
    with pytest.raises(ContractError):
        validate(changed(path, value))


def test_old_version():
    old = {k: v for k, v in GOOD.items() if k not in ("umr_version", "assessment_mode")} | {"contract_version": "laim-monitoring-metric.v1", "evaluation_unit": "turn"}
    assert validate(old).mode == "qa"
    with pytest.raises(ContractError):
        validate(old | {"evaluation_unit": "dialogue"})
    assert validate(old | {"status": "not_evaluable"}, require_computed=False) is None


def test_rewrite_for_judge():
    assert for_judge(validate(changed(["assessment_mode"], "dialogue"))).method == "identity"
    assert for_judge(validate(GOOD)).method == "mean_criteria"
