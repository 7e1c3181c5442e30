"""Free metadata of landed structures, typed where it is read.

Landed ``info`` is a map of texts, or a VARIANT made from it once, which keeps numbers, lists and
texts apart. Fields have the types of the format tables here; all others are texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types of metadata fields that are not texts.
FIELD_TYPES = {
    "charge": "bigint", "total_charge": "bigint", "num_atoms": "bigint", "spin": "double",
    "mulliken_charges": "array<double>", "lowdin_charges": "array<double>", "stress": "array<double>",
    "miller_index": "array<bigint>", "class": "int", "anomaly": "int", "ref_energy": "double", "energy": "double",
}
# A list of numbers as extended XYZ writes it: separated by white space, no commas.
_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
PLAIN_LIST = rf"^\s*\[?\s*{_NUMBER}(\s+{_NUMBER})+\s*\]?\s*$"


def json_of(text: Column) -> Column:
    """A text as JSON: itself if it is JSON, a list if it is numbers in a row, else a JSON string."""
    listed = F.concat(F.lit("["), F.regexp_replace(F.trim(F.translate(text, "[]\t\r\n", "     ")), " +", ","), F.lit("]"))
    quoted = F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)
    # The parser stops after one value: as the only element of a list nothing may follow it.
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    whole = F.try_parse_json(text).isNotNull() & alone.isNotNull() & F.try_variant_get(alone, "$[1]", "variant").isNull()
    return (
        F.when(text.rlike(PLAIN_LIST) & F.try_parse_json(listed).isNotNull(), listed).when(whole, text).otherwise(quoted)
    )


def as_variant(info: Column) -> Column:
    """A map of texts as one VARIANT object."""
    entries = F.transform(F.map_entries(info), lambda e: F.concat(
        F.regexp_extract(F.to_json(F.array(e["key"])), r"(?s)^\[(.*)\]$", 1), F.lit(":"),
        F.coalesce(json_of(e["value"]), F.lit("null"))))
    return F.parse_json(F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}")))


def text_field(name: str, kind: str = "string") -> Column:
    """A field of a map ``info`` in the given type; null where the structure lacks it."""
    value = F.try_element_at(F.col("info"), F.lit(name))
    if kind == "string":
        return value
    return F.variant_get(F.parse_json(json_of(value)), "$", kind)


def typed_field(df: DataFrame, name: str, kind: str | None = None) -> Column:
    """A field of ``info`` of ``df``, map or VARIANT, in the type of ``FIELD_TYPES``."""
    kind = kind or FIELD_TYPES.get(name, "string")
    if isinstance(df.schema["info"].dataType, T.VariantType):
        return F.variant_get("info", f"$['{name}']", kind)
    return text_field(name, kind)


def required_field(df: DataFrame, name: str) -> Column:
    """A field of ``info`` as text, or of a column of that name; a structure with neither fails the job."""
    if name in df.columns:
        return F.col(name)
    if isinstance(df.schema["info"].dataType, T.VariantType):
        there, names = F.variant_get("info", f"$['{name}']", "variant").isNotNull(), F.schema_of_variant("info")
    else:
        there = F.coalesce(F.map_contains_key("info", name), F.lit(False))
        names = F.array_join(F.array_sort(F.map_keys("info")), ", ")
    problem = F.raise_error(F.concat(
        F.lit(f"field {name} not found in "), F.col("entry_key"), F.lit("; available fields: "), F.coalesce(names, F.lit(""))))
    return F.when(there, typed_field(df, name, "string")).otherwise(problem)
