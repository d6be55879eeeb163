"""Entry point that takes its inputs as a bundle, for callers that pass named inputs.

``input_data`` is one DataFrame (the rule table) or a dict of DataFrames. ``param_dict``
may name the entries (``rules_input_name``, ``catalog_input_name``); otherwise the rule table
is the entry with the required rule columns and the catalog the one with the catalog
columns. With no catalog every rule is ``NO_EVALUADA``. ``param_dict`` may also name a
``dataset`` (only that table's rules are run).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from qualia.plans.engine import run_rules
from qualia.schema import CATALOG_INPUT_COLUMNS, REQUIRED_RULE_COLUMNS


def pick_inputs(input_data: DataFrame | Mapping[str, DataFrame],
                param_dict: Mapping[str, Any] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rules, catalog or None) out of an input bundle."""
    if isinstance(input_data, DataFrame):
        return input_data, None
    asked = param_dict or {}

    def find(option: str, columns: Iterable[str]) -> DataFrame | None:
        if asked.get(option):
            return input_data.get(asked[option])
        return next((df for df in input_data.values() if set(columns) <= set(df.columns)), None)

    rules = find("rules_input_name", REQUIRED_RULE_COLUMNS)
    if rules is None:
        raise ValueError("no input has the columns of a rule table")
    return rules, find("catalog_input_name", CATALOG_INPUT_COLUMNS)


def transform(spark: SparkSession, input_data: DataFrame | Mapping[str, DataFrame],
              param_dict: Mapping[str, Any] | None = None, **kwargs) -> DataFrame:
    """Run the rules of an input bundle; ``kwargs`` go to :func:`run_rules`
    (``tables``, ``policy``, ``as_of`` ...)."""
    rules, catalog = pick_inputs(input_data, param_dict)
    dataset = (param_dict or {}).get("dataset") or None
    return run_rules(spark, rules, catalog, dataset=dataset, **kwargs)
