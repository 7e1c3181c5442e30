"""Reaction provenance from source paths.

Each parser maps a path column to a struct of reaction fields. Malformed paths give nulls,
never an error, so one bad record does not fail a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fields every parser fills, with their types.
REACTION_FIELDS = {
    "subset": "string",
    "reaction_id": "string",
    "reaction_pathway_id": "bigint",
    "reaction_step_idx": "bigint",
    "is_reactant": "boolean",
    "is_product": "boolean",
}

# Step numbers of the two endpoints of an RGD pathway.
RGD_FIRST_STEP, RGD_LAST_STEP = 0, 18
# Trans1x frames are the reactant, the product, then bands of eight images.
TRANS1X_REACTANT, TRANS1X_PRODUCT, TRANS1X_PRODUCT_STEP, TRANS1X_BAND = 0, 9, 10, 8


def _fields(**values: Column) -> Column:
    return F.struct(*[
        (values[name] if name in values else F.lit(None)).cast(kind).alias(name)
        for name, kind in REACTION_FIELDS.items()
    ])


def _path(source: Column, i: int) -> Column:
    return F.get(F.split(source, "/"), F.lit(i))


def _tokens(source: Column) -> Column:
    """Underscore-separated tokens of the second path component; null without one."""
    return F.split(_path(source, 1), "_")


def _token(source: Column, i: int) -> Column:
    return F.get(_tokens(source), F.lit(i))


def parse_rgd(source: Column) -> Column:
    """``rgd_uks/MR_693393_1_13_0_1/…``: id, pathway, step, charge, conformer."""
    tokens = _tokens(source)
    n = F.size(tokens)
    step_text = F.get(tokens, n - 3)
    ok = (n >= 5) & step_text.rlike("^[0-9]+$")
    step = step_text.try_cast("bigint")
    return _fields(
        reaction_id=F.when(ok, F.array_join(F.slice(tokens, F.lit(1), F.greatest(n - 4, F.lit(0))), "_")),
        reaction_pathway_id=F.when(ok, F.get(tokens, n - 4).try_cast("bigint")),
        reaction_step_idx=F.when(ok, step),
        is_reactant=F.when(ok, step == RGD_FIRST_STEP),
        is_product=F.when(ok, step == RGD_LAST_STEP),
    )


def parse_reactivity(source: Column) -> Column:
    """``pmechdb/r_12345_step3/…``, ``rmechdb/…`` and ``ani1xbb/r_11111_5/…``."""
    has_path = F.size(F.split(source, "/")) >= 2
    family = F.when(has_path, _path(source, 0))
    enough = F.size(_tokens(source)) >= 3
    mech = enough & family.isin("pmechdb", "rmechdb")
    ani = enough & (family == "ani1xbb")
    last = _token(source, 2)
    # Only the letters of the word "step" are trimmed, at both ends.
    mech_step = F.regexp_replace(last, "^[step]+|[step]+$", "").try_cast("bigint")
    return _fields(
        subset=family,
        reaction_id=F.when(mech | ani, _token(source, 1)).otherwise(F.lit("")),
        reaction_pathway_id=F.lit(0),
        reaction_step_idx=F.when(mech, mech_step).when(ani, last.try_cast("bigint")).otherwise(F.lit(0)),
        is_reactant=F.lit(False),
        is_product=F.lit(False),
    )


def parse_ani(source: Column) -> Column:
    """``ani2x/r_12345_7/…``: id and step."""
    return _fields(
        reaction_id=_token(source, 1),
        reaction_step_idx=_token(source, 2).try_cast("bigint"),
    )


def parse_trans1x(source: Column) -> Column:
    """``trans1x/r_12345_2_20/…``: id, number of pathways, frame number."""
    n = _token(source, 3).try_cast("bigint")
    reactant, product = n == TRANS1X_REACTANT, n == TRANS1X_PRODUCT
    image = F.pmod(n - 2, F.lit(TRANS1X_BAND)) + 1
    return _fields(
        reaction_id=_token(source, 1),
        reaction_pathway_id=F.when(n <= TRANS1X_PRODUCT, F.lit(0))
        .otherwise(F.floor((n - 2) / F.lit(TRANS1X_BAND))),
        reaction_step_idx=F.when(reactant, F.lit(0))
        .when(product, F.lit(TRANS1X_PRODUCT_STEP)).otherwise(image),
        is_reactant=F.when(reactant, F.lit(True)),
        is_product=F.when(product, F.lit(True)),
    )


def parse_metal_complexes(source: Column, reference_source: Column) -> Column:
    """Metal complexes: labelled by the source path and, if there is one, its reference."""
    halves = F.split(_path(source, 1), "step")
    step = F.get(F.split(F.get(halves, F.lit(1)), "_"), F.lit(0)).try_cast("bigint")
    reactive = reference_source.isNull() & source.contains("tm_react")
    parsed = reactive & step.isNotNull()
    failed = reference_source.contains("step") & (
        reference_source.contains("incomplete") | reference_source.contains("failed")
    )
    return _fields(
        subset=F.when(parsed, F.lit("reactivity_metal_complexes"))
        .when(reactive | (reference_source.isNull() & source.isNull()), F.lit(None))
        .when(failed, F.lit("failed_metal_complexes"))
        .otherwise(F.lit("ground_state_metal_complexes")),
        reaction_id=F.when(parsed, F.translate(F.get(halves, F.lit(0)), "_", "")),
        reaction_step_idx=F.when(parsed, step),
    )


def parse_source(subset: Column, source: Column, reference_source: Column) -> Column:
    """Dispatch on the mapped subset. Families that name their own subset override it."""
    mapped = subset

    def keep_subset(parsed: Column) -> Column:
        return parsed.withField("subset", mapped)

    return (
        F.when(subset == "rgd", keep_subset(parse_rgd(source)))
        .when(subset == "reactivity", parse_reactivity(source))
        .when(subset == "ani1", keep_subset(parse_ani(source)))
        .when(subset == "trans1x", keep_subset(parse_trans1x(source)))
        .when(subset == "metal_complexes", parse_metal_complexes(source, reference_source))
        .otherwise(_fields(subset=mapped))
    )
