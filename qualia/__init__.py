"""qualia: rule-driven checks on Spark tables.

Rules live as rows of a rule table; a catalog maps each rule code to a check.
``run_rules`` evaluates all active rules with plain Spark aggregates and returns
one result row per rule.
"""

from qualia.operators.checks import register_check
from qualia.plans.engine import assemble, evaluate_rules, run_rules, verification_report
from qualia.plans.inputs import transform
from qualia.schema import RESULT_BODY_COLUMNS, RESULT_COLUMNS, RESULT_SCHEMA
from qualia.sources.catalog import DEFAULT_CATALOG, default_catalog, read_catalog_csv

__all__ = [
    "DEFAULT_CATALOG",
    "RESULT_BODY_COLUMNS",
    "RESULT_COLUMNS",
    "RESULT_SCHEMA",
    "assemble",
    "default_catalog",
    "evaluate_rules",
    "read_catalog_csv",
    "register_check",
    "run_rules",
    "transform",
    "verification_report",
]
