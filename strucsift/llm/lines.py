"""Line dedup by site: drop the lines that stand on too large a share of a host's pages.

For every host the pages that contain a line are counted and divided by the host's pages. Lines
above the ratio are boilerplate and dropped from all pages of the host. Lines are compared by a
64-bit hash of their trimmed text. At most (lines of an average page) / ratio lines of a host can be
boilerplate, so that a host's list stays small whatever its number of pages.

Defined results: blank lines are not counted and stay as they are. Rows without a host belong to no
site and keep all lines. A null text stays null and counts as a page without lines. Pages are rows:
repeated rows count each. Other columns are kept by ``drop_boilerplate``.

``drop_passages`` takes what no share of a site shows: long lines that several rows of the whole
table have, whatever their hosts. One copy stays, in the row of the least id (nulls last) among those
that are to stay: a row named in ``leaving`` keeps the copy only if all its rows leave. A row
that consists of shared lines nearly whole is a copy of a document and stays whole: near-duplicate
search judges it. Rows of equal id and text are treated alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strucsift.llm.common import BROADCAST_ROWS, if_small
from strucsift.session import cut_lineage

# A line is boilerplate on more than this share of a host's pages. Fewer pages with the line than the
# floor are no frequency; a site of at least so many pages can lose its navigation.
RATIO = 0.05
LEAST_PAGES = 3
# A line of more characters (every line of over 50 words has more) on so many rows is a shared
# passage. In sf0.1 long lines stand on 1 to 4 rows or on 19 and more; 5 does not grow with the table.
PASSAGE_CHARS = 100
PASSAGE_ROWS = 5
# Two texts of equal length that share 8/9 of their words have the Jaccard index 0.8 of near copies.
COPY_SHARE = (8, 9)

# HTML elements that end a line, and those without text.
BLOCKS = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|"
          "li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul")
SILENT = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
BREAK = rf"(?i)</?({BLOCKS})\b[^>]*>"
TAG = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]+)"
SPACES = " \t\n\x0b\x0c\r"


def html_lines(html: Column) -> Column:
    """The text of a page, one line per block element; entities stay as they are written."""
    text = F.regexp_replace(html, SILENT, "")
    return F.regexp_replace(F.regexp_replace(text, BREAK, "\n"), TAG, "")


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 2)), F.lit(""))


def _trim(line: Column) -> Column:
    return F.trim(line, F.lit(SPACES))


def _filled() -> Column:
    """The trimmed lines of ``text`` that are not blank."""
    return F.filter(F.transform(F.split("text", "\n"), _trim), lambda line: line != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, lines): the hashes of every host's boilerplate; ``pages`` has host and text."""
    sites = pages.filter(F.col("host").isNotNull())
    seen = sites.select("host", F.explode(F.array_distinct(F.transform(_filled(), lambda line: F.xxhash64(line)))).alias("line"))
    totals = sites.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counted = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages)
    return (
        counted.join(totals, "host").filter(F.col("n") > ratio * F.col("pages"))
        .groupBy("host").agg(F.collect_set("line").alias("lines"))
    )


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``pages`` (host, text, ...) with boilerplate lines dropped, n_lines and n_dropped.

    The hosts' lists are written once; they are sent to all executors if they are few enough, else
    joined by host.
    """
    own = [c for c in pages.columns if c not in ("text", "n_lines", "n_dropped")]
    found = cut_lineage(boilerplate(pages, ratio, least_pages), "boilerplate")
    few = (found.agg(F.sum(F.size("lines"))).first()[0] or 0) <= BROADCAST_ROWS
    listed = found.select(F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    marked = pages.select(*own, "text").join(F.broadcast(listed) if few else listed, F.col("host") == F.col("__host"), "left")
    lines, listed = F.split("text", "\n"), F.coalesce("__lines", F.array().cast("array<bigint>"))
    kept = F.filter(lines, lambda line: ~F.array_contains(listed, F.xxhash64(_trim(line))) | (_trim(line) == ""))
    n_lines = F.size(F.filter(lines, lambda line: _trim(line) != ""))
    return (
        marked.withColumn("__kept", kept)
        .withColumn("n_lines", F.coalesce(F.when(F.col("text").isNotNull(), n_lines), F.lit(0)).cast("bigint"))
        .withColumn("n_dropped", F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines) - F.size("__kept")), F.lit(0)).cast("bigint"))
        .withColumn("text", F.array_join("__kept", "\n"))
        .select(*own, "text", "n_lines", "n_dropped")
    )


def drop_passages(docs: DataFrame, least_rows: int = PASSAGE_ROWS, chars: int = PASSAGE_CHARS,
                  leaving: Callable[[], DataFrame] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with all copies of shared passages but one dropped, and n_passages.

    The hashes of all lines are written once with the id and text hash of their row. No task gathers
    a line's rows: counts and the row that keeps a copy are aggregates. ``leaving`` gives the ids (doc_id)
    that a later step is to remove; it is only called when there are shared passages.
    """
    own = [c for c in docs.columns if c != "n_passages"]
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    each = F.transform(_filled(), lambda line: F.struct(F.xxhash64(line).alias("line"), (F.char_length(line) > chars).alias("long")))
    seen = cut_lineage(docs.select(row.alias("row"), F.explode(F.array_distinct(each)).alias("e")).select("row", "e.*"), "lines")
    shared = cut_lineage(
        seen.groupBy("line", "long").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("keeper"))
        .filter(F.col("n") >= least_rows).select("line", "long", "keeper"), "shared")
    if leaving is not None and not shared.filter("long").isEmpty():
        going = cut_lineage(leaving().select(F.col("doc_id").alias("__going")).distinct(), "leaving")
        holders = seen.filter("long").drop("long").join(if_small(shared.filter("long").select("line")), "line", "left_semi")
        stays = holders.join(if_small(going), F.col("row.id") == F.col("__going"), "left").groupBy("line").agg(
            F.min(F.struct(F.col("__going").isNotNull().alias("goes"), "row")).alias("best"))
        chosen = stays.select("line", F.col("best.row").alias("stayer"))
        shared = cut_lineage(shared.join(chosen, "line", "left").select(
            "line", "long", F.when(F.col("long"), F.col("stayer")).otherwise(F.col("keeper")).alias("keeper")), "shared")
    gone = F.col("long") & ~F.col("row").eqNullSafe(F.col("keeper"))
    # A list is at most as long as its text.
    hits = cut_lineage(
        seen.drop("long").join(if_small(shared), "line").groupBy("row").agg(
            F.collect_set("line").alias("__common"), F.collect_set(F.when(gone, F.col("line"))).alias("__gone"))
        .filter(F.size("__gone") > 0).select(F.col("row.id").alias("__id"), F.col("row.hash").alias("__hash"), "__common", "__gone"),
        "passages")
    few = (hits.agg(F.sum(F.size("__common"))).first()[0] or 0) <= BROADCAST_ROWS
    marked = docs.select(*own).join(
        F.broadcast(hits) if few else hits,
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left")
    lines = F.split("text", "\n")
    length = lambda every: F.aggregate(every, F.lit(0).cast("bigint"), lambda n, line: n + F.char_length(_trim(line)))
    common = F.filter(lines, lambda line: F.array_contains("__common", F.xxhash64(_trim(line))))
    partly = COPY_SHARE[1] * length(common) <= COPY_SHARE[0] * length(lines)
    kept = F.filter(lines, lambda line: ~F.array_contains("__gone", F.xxhash64(_trim(line))))
    return (
        marked.withColumn("__kept", F.when(F.col("__gone").isNotNull(), F.when(partly, kept)))
        .withColumn("n_passages", F.coalesce(F.size(lines) - F.when(F.col("__kept").isNotNull(), F.size("__kept")), F.lit(0)).cast("bigint"))
        .withColumn("text", F.coalesce(F.array_join("__kept", "\n"), F.col("text")))
        .select(*own, "n_passages")
    )


def oracle(ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> str:
    """The query over ``pages`` in SQL."""
    quote = lambda text: text.replace("'", "''")
    clean = f"regexp_replace(html, '{quote(SILENT)}', '', 'g')"
    clean = f"regexp_replace({clean}, '{quote(BREAK)}', chr(10), 'g')"
    clean = f"regexp_replace({clean}, '{quote(TAG)}', '', 'g')"
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH cut AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '{HOST}', 2)), '') AS host, string_split({clean}, chr(10)) AS lines FROM pages),
seen AS (SELECT page_id, host, n, trim(lines[n], {white}) AS line, lines[n] AS raw
  FROM (SELECT page_id, host, lines, unnest(range(1, len(lines) + 1)) AS n FROM cut)),
totals AS (SELECT host, count(*) AS pages FROM cut WHERE host IS NOT NULL GROUP BY host),
counts AS (SELECT host, line, count(DISTINCT page_id) AS n FROM seen WHERE line <> '' AND host IS NOT NULL GROUP BY host, line),
bad AS (SELECT host, line FROM counts JOIN totals USING (host) WHERE n >= {least_pages} AND n > {ratio} * pages)
SELECT s.page_id, any_value(s.host) AS host, count(*) FILTER (WHERE s.line <> '') AS n_lines, count(b.line) AS n_dropped,
  coalesce(string_agg(s.raw, chr(10) ORDER BY s.n) FILTER (WHERE b.line IS NULL), '') AS text
FROM seen s LEFT JOIN bad b ON s.host = b.host AND s.line = b.line GROUP BY s.page_id"""
