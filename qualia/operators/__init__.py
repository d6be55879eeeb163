from qualia.operators.checks import REGISTRY, ROW, UNIQUE, Check, CheckContext, build_check, register_check
from qualia.operators.classify import METRICS_SCHEMA, check_outcomes, classify, metric_report
from qualia.operators.metrics import RowGroup, UniqueSpec, row_metrics, unique_metrics

__all__ = [
    "METRICS_SCHEMA",
    "REGISTRY",
    "ROW",
    "UNIQUE",
    "Check",
    "CheckContext",
    "RowGroup",
    "UniqueSpec",
    "build_check",
    "check_outcomes",
    "classify",
    "metric_report",
    "register_check",
    "row_metrics",
    "unique_metrics",
]
