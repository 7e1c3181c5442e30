"""Follow-up actions on a set of keys."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.operators.stats import describe, histogram, supported_columns
from strucsift.plans.select import fetch

logger = logging.getLogger(__name__)

# Joined column names beyond this length are not spelled out in a file name.
LONGEST_NAME = 100


def _columns(table: DataFrame, columns: str | Sequence[str] | None) -> list[str]:
    names = [columns] if isinstance(columns, str) else list(columns or [])
    return supported_columns(table.schema, names)


def make_statistics(table: DataFrame, keys: DataFrame, columns: str | Sequence[str] | None) -> DataFrame | None:
    """Descriptive statistics of the selected entries; nothing without a usable column."""
    names = _columns(table, columns)
    return describe(fetch(table, keys, names), names) if names else None


def make_histograms(table: DataFrame, keys: DataFrame, columns: str | Sequence[str] | None) -> DataFrame | None:
    """Histogram table of the selected entries; nothing without a usable column."""
    names = _columns(table, columns)
    return histogram(fetch(table, keys, names), names) if names else None


def extract_text(table: DataFrame, keys: DataFrame, column: str = "smiles") -> DataFrame:
    """A string column of the selected entries without nulls."""
    return fetch(table, keys, column).select(column).filter(F.col(column).isNotNull())


def statistics_name(columns: Sequence[str]) -> str:
    joined = "-".join(columns)
    return f"statistics-{joined if len(joined) <= LONGEST_NAME else 'many'}"


def write_statistics(stats: DataFrame, path: str) -> None:
    """One CSV file with a header; the frame has one row per column."""
    stats.coalesce(1).write.option("header", True).csv(path)


def compare_selections(table: DataFrame, selections: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of several key sets, labelled by the set they belong to."""
    labelled = None
    for name, keys in selections.items():
        part = keys.select("entry_key").distinct().withColumn("selection", F.lit(name))
        labelled = part if labelled is None else labelled.unionByName(part)
    return labelled.join(table, "entry_key")


ACTIONS = {
    "make_statistics": make_statistics,
    "make_histograms": make_histograms,
    "extract_smiles": lambda table, keys, _columns: extract_text(table, keys),
}


def normalize_actions(actions: Sequence) -> dict:
    """Bare names and ``{name: arguments}`` entries as one mapping."""
    out: dict = {}
    for action in actions:
        out.update({action: None} if isinstance(action, str) else action)
    return out


def run_actions(table: DataFrame, keys: DataFrame, actions: Sequence) -> dict[str, DataFrame]:
    """Result frame of each supported action; unknown ones are reported and skipped."""
    results = {}
    for name, arguments in normalize_actions(actions).items():
        if name not in ACTIONS:
            logger.warning("action %s is not supported; choose from %s", name, ", ".join(ACTIONS))
            continue
        if arguments is None and name != "extract_smiles":
            continue
        result = ACTIONS[name](table, keys, arguments)
        if result is not None:
            results[name] = result
    return results
