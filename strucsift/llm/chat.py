"""Chat formatting by perspective rotation, with DataFrame functions only.

For every participant of a dialogue the dialogue is rendered once with that speaker as assistant,
all others as users with their names. The mask marks what the assistant has to learn: its texts
with their end marks. System turns are no participant's; they are rendered as system in every
perspective. A long dialogue is rendered in parts of ``PART_TURNS`` turn numbers, so that no task
gathers an unbounded one; offsets count in their part. Numbers that repeat or are null can give a
part more turns than that: it is cut by position into parts of ``PART_TURNS`` turns, and the later
parts of the dialogue are numbered on from there. Every part has a row for every participant of the
dialogue, also without own turns; a system turn is in its own part only.

Defined results: turns are ordered by number (nulls first, as part -1), then speaker, then text;
repeated rows are repeated turns. A null role is the speaker "unknown", a null text is empty. Start
and end marks inside a text are broken by a space. A dialogue of system turns alone has no
participant and gives no row. A row without a dialogue id is a dialogue of its own. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strucsift.llm.common import if_small
from strucsift.session import cut_lineage

PART_TURNS = 512
SYSTEM = "system"
UNKNOWN = "unknown"
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _head(speaker: Column, perspective: Column) -> Column:
    named = F.concat(F.lit(f"{BEGIN}user name="), speaker, F.lit("\n"))
    return (
        F.when(speaker == SYSTEM, F.lit(f"{BEGIN}system\n"))
        .when(speaker == perspective, F.lit(f"{BEGIN}assistant\n")).otherwise(named)
    )


def _parts(rows: DataFrame, part_turns: int) -> DataFrame:
    """(conv_id, part, said): the turns of every part in order, at most ``part_turns`` of them."""
    key = ["conv_id", "part"]
    over = cut_lineage(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part_turns), "long_parts")
    gathered = lambda some: some.groupBy(*key).agg(F.array_sort(F.collect_list("said")).alias("said"))
    if over.isEmpty():
        return gathered(rows)
    parts, long = if_small(over.select(*key)), if_small(over.select("conv_id").distinct())
    # How far the parts of dialogues with overfull ones move on.
    upto = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    more = F.coalesce(F.ceil(F.col("n") / part_turns) - 1, F.lit(0))
    moved = (
        rows.join(long, "conv_id", "left_semi").select(*key).distinct().join(over, key, "left")
        .select(*key, F.coalesce(F.sum(more).over(upto), F.lit(0)).cast("bigint").alias("shift"))
    )
    cut = _pieces(rows.join(parts, key, "left_semi"), part_turns)
    whole = gathered(rows.join(parts, key, "left_anti")).withColumn("piece", F.lit(0).cast("bigint"))
    return whole.unionByName(cut).join(if_small(cut_lineage(moved, "shifts")), key, "left").select(
        "conv_id", (F.col("part") + F.coalesce("shift", F.lit(0)) + F.col("piece")).alias("part"), "said")


def _pieces(rows: DataFrame, part_turns: int) -> DataFrame:
    """(conv_id, part, piece, said): overfull parts by position.

    Equal turns are counted first. The rest is ordered over all partitions, so that no part is
    ordered in one task; a turn's place is the size of earlier partitions and its place in its own.
    """
    key = ["conv_id", "part"]
    counted = rows.groupBy(*key, "said").agg(F.count(F.lit(1)).alias("n"))
    ordered = cut_lineage(counted.orderBy(*key, "said").select(
        "*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")), "ordered_turns")
    # One row per partition.
    tasks = ordered.groupBy("task").agg(F.sum("n").alias("size")).select("task", F.coalesce(F.sum("size").over(
        Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("task").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = cut_lineage(ordered.withColumn("upto", inside).join(F.broadcast(tasks), "task").select(
        *key, "said", "n", (F.col("before") + F.col("upto") - F.col("n")).alias("place")), "placed_turns")
    firsts = placed.groupBy(*key).agg(F.min("place").alias("first"))
    begin, width = F.col("place") - F.col("first"), F.lit(part_turns)
    spread = (
        placed.join(if_small(firsts), key).select(*key, "said", "n", begin.alias("begin"))
        .withColumn("piece", F.explode(F.sequence(
            F.floor(F.col("begin") / width), F.floor((F.col("begin") + F.col("n") - 1) / width))))
    )
    copies = F.least(F.col("begin") + F.col("n"), (F.col("piece") + 1) * width) - F.greatest(F.col("begin"), F.col("piece") * width)
    return spread.withColumn("said", F.array_repeat("said", copies.cast("int"))).groupBy(*key, "piece").agg(
        F.array_sort(F.flatten(F.collect_list("said"))).alias("said"))


def rotate_perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, perspective, part, n_turns, n_own, text, mask_start, mask_end) of all perspectives.

    ``turns`` has conv_id, turn, role and text. Masks are spans of characters of ``text``.
    """
    every = turns.select(
        "conv_id", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("bigint").alias("part"),
        F.struct(F.col("turn"), F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"),
                 F.replace(F.coalesce("text", F.lit("")), F.lit("<|im_"), F.lit("<| im_")).alias("body")).alias("said"))
    rows = every.filter(F.col("conv_id").isNotNull())
    people = rows.select(F.col("conv_id").alias("of"), F.col("said.speaker").alias("perspective")).filter(
        F.col("perspective") != SYSTEM).distinct()
    alone = every.filter(F.col("conv_id").isNull() & (F.col("said.speaker") != SYSTEM)).select(
        "conv_id", "part", F.array("said").alias("said"), F.col("said.speaker").alias("perspective"))
    both = _parts(rows, part_turns).join(people, F.col("conv_id") == F.col("of")).drop("of").unionByName(alone)
    segments = F.transform("said", lambda s: F.struct(
        _head(s["speaker"], F.col("perspective")).alias("head"), F.concat(s["body"], F.lit(END)).alias("body"),
        (s["speaker"] == F.col("perspective")).alias("own")))
    # Where each segment's body begins and ends, by a running total of lengths.
    start = "cast(array() as array<bigint>)"
    walked = F.aggregate(
        "segments", F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(start).alias("a"), F.expr(start).alias("b")),
        lambda acc, s: F.struct(
            (acc["at"] + F.char_length(s["head"]) + F.char_length(s["body"]) + 1).alias("at"),
            F.when(s["own"], F.array_append(acc["a"], acc["at"] + F.char_length(s["head"]))).otherwise(acc["a"]).alias("a"),
            F.when(s["own"], F.array_append(acc["b"], acc["at"] + F.char_length(s["head"]) + F.char_length(s["body"])))
            .otherwise(acc["b"]).alias("b")))
    return (
        both.withColumn("segments", segments).withColumn("walked", walked)
        .select("conv_id", "perspective", "part", F.size("said").cast("bigint").alias("n_turns"),
                F.size("walked.a").cast("bigint").alias("n_own"),
                F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), "").alias("text"),
                F.col("walked.a").alias("mask_start"), F.col("walked.b").alias("mask_end"))
    )


def with_mask_text(rendered: DataFrame) -> DataFrame:
    """Masks as one string of spans ``start-end``, separated by commas."""
    spans = F.zip_with("mask_start", "mask_end", lambda a, b: F.concat(a.cast("string"), F.lit("-"), b.cast("string")))
    return rendered.withColumn("mask", F.array_join(spans, ",")).drop("mask_start", "mask_end")


ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '{UNKNOWN}') AS speaker, replace(coalesce(text, ''), '<|im_', '<| im_') AS body,
    CAST(coalesce(floor(turn / {PART_TURNS}), -1) AS BIGINT) AS part FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> '{SYSTEM}'),
segments AS (
  SELECT t.conv_id, p.perspective, t.part, t.turn, t.speaker, t.body, t.speaker = p.perspective AS own,
    CASE WHEN t.speaker = '{SYSTEM}' THEN '{BEGIN}system' WHEN t.speaker = p.perspective THEN '{BEGIN}assistant'
      ELSE '{BEGIN}user name=' || t.speaker END || chr(10) AS head
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(body) + {len(END)} + 1) OVER (
    PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, speaker, body ROWS UNBOUNDED PRECEDING) AS upto
  FROM segments)
SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
  string_agg(head || body || '{END}' || chr(10), '' ORDER BY turn NULLS FIRST, speaker, body) AS text,
  coalesce(string_agg((upto - 1 - {len(END)} - length(body))::BIGINT::VARCHAR || '-' || (upto - 1)::BIGINT::VARCHAR, ','
    ORDER BY turn NULLS FIRST, speaker, body) FILTER (WHERE own), '') AS mask
FROM placed GROUP BY conv_id, perspective, part"""
