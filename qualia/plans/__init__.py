from qualia.plans.engine import assemble, evaluate_rules, run_rules, verification_report
from qualia.plans.inputs import pick_inputs, transform
from qualia.plans.rules import (
    active_rules,
    collect_rules,
    group_rules,
    join_catalog,
    param_list,
    standardize_rules,
)

__all__ = [
    "active_rules",
    "assemble",
    "collect_rules",
    "evaluate_rules",
    "group_rules",
    "join_catalog",
    "param_list",
    "pick_inputs",
    "run_rules",
    "standardize_rules",
    "transform",
    "verification_report",
]
