"""User predicates: the body of a WHERE clause over the query table."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A quoted string, or a regex operator with the pattern after it.
_REGEX_OPERATOR = re.compile(r"(!?~)\s*('(?:[^']|'')*')|'(?:[^']|'')*'|\"[^\"]*\"")


class PredicateError(ValueError):
    """The predicate is empty or names columns the table does not have."""


def spark_predicate(body: str) -> str:
    """Write ``column ~ 'pattern'`` and ``column !~ 'pattern'`` the way Spark SQL does.

    Quoted strings are left alone. A pattern with a backslash becomes a raw literal, because
    Spark would otherwise treat the backslash as an escape.
    """
    def rewrite(match: re.Match) -> str:
        operator, pattern = match.group(1), match.group(2)
        if operator is None:
            return match.group(0)
        raw = "r" if "\\" in pattern and "''" not in pattern else ""
        return f"{' NOT' if operator == '!~' else ''} RLIKE {raw}{pattern}"

    return _REGEX_OPERATOR.sub(rewrite, body)


def apply_predicate(df: DataFrame, body: str) -> DataFrame:
    """Rows for which the predicate holds. Only a boolean expression is accepted."""
    if not body or not body.strip():
        raise PredicateError("no predicate given")
    try:
        return df.filter(F.expr(spark_predicate(body)))
    except AnalysisException as error:
        if "UNRESOLVED_COLUMN" not in (error.getCondition() or ""):
            raise
        bits = [c for c in df.columns if c.startswith("fingerprint_")]
        names = [c for c in df.columns if not c.startswith("fingerprint")]
        if bits or "fingerprint" in df.columns:
            names.append("fingerprint_[0-1023]")
        raise PredicateError(
            f"unknown column in predicate {body!r}; available columns: {', '.join(names)}"
        ) from error


def fingerprint_bits_in(df: DataFrame, body: str) -> str:
    """Let a predicate address bit ``fingerprint_<i>`` of the stored bit array."""
    if "fingerprint" not in df.columns:
        return body
    return re.sub(r"\bfingerprint_(\d+)\b", r"get(fingerprint, \1)", body)
