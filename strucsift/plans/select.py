"""Query stage: predicate, then allowlist, then sampling, down to a set of entry keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.functions.predicates import apply_predicate, fingerprint_bits_in
from strucsift.operators.sampling import Sampler, run_sampler
from strucsift.sources.querydb import resolve_columns


def fetch(table: DataFrame, keys: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Columns of the selected entries. Repeated keys do not repeat rows."""
    names = [columns] if isinstance(columns, str) else list(columns)
    if "entry_key" not in names:
        names.append("entry_key")
    return table.select(*names).join(keys.select("entry_key"), "entry_key", "left_semi").select(*names)


def restrict(df: DataFrame, allowlist: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Rows whose identity columns all match one allowlist row; nulls never match."""
    names = resolve_columns(columns)
    missing = [c for c in names if c not in allowlist.columns]
    if missing:
        raise ValueError(f"allowlist lacks columns {missing}")
    kinds = dict(df.dtypes)
    typed = allowlist.select(*[F.col(c).try_cast(kinds[c]).alias(c) for c in names])
    return df.join(typed, names, "left_semi")


def select_rows(table: DataFrame, predicate: str, restrict_to: Mapping[str, Any] | None = None,
                method: str | Sampler = "random", n: int | None = None, seed: int | str | None = None,
                required_columns: Sequence[str] | None = None, kwargs: Mapping[str, Any] | None = None) -> DataFrame:
    """Keys of the entries that pass the predicate and the allowlist, sampled.

    Only ``entry_key`` and the columns these steps name are read from the table.
    """
    if not callable(method) and method not in ("random", "all"):
        raise ValueError(f"invalid sampling method: {method}")
    rows = apply_predicate(table, fingerprint_bits_in(table, predicate))
    if restrict_to is not None:
        if not {"columns", "values"} <= set(restrict_to):
            raise ValueError("restrict_to needs 'columns' and 'values'")
        if not isinstance(restrict_to["values"], DataFrame):
            raise ValueError("restrict_to['values'] must be a DataFrame")
        rows = restrict(rows, restrict_to["values"], restrict_to["columns"])
    if not callable(method):
        rows = rows.select("entry_key")
    return run_sampler(rows, method, n, seed, required_columns, kwargs).select("entry_key")
