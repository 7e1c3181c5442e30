"""The pipeline against plain versions of its stages, and on odd tables."""

from __future__ import annotations

import hashlib

import brute
import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strucsift.llm import bpe, lines
from strucsift.llm.common import field, map_texts

SMALL = "/root/testdata/sf0.001"


def plain_run(docs, trusted, benchmark):
    """docs: rows with the columns of documents -> {doc_id: (n_chars, ids digest)}."""
    kept = brute.quality_kept([r["text"] for r in docs], [r["doc_id"] in trusted for r in docs])
    docs = [r for r, k in zip(docs, kept, strict=True) if k]
    cut = brute.drop_lines([(r["doc_id"], r["source"], r["text"]) for r in docs], lines.RATIO, lines.LEAST_PAGES)
    out = []
    for r in docs:
        text, n, dropped = cut[r["doc_id"]]
        if not (dropped and dropped == n):
            out.append(r | {"text": text, "n_chars": len(text) if dropped else r["n_chars"]})
    kept_text = brute.drop_passages({r["doc_id"]: r["text"] for r in out}, lines.PASSAGE_ROWS, lines.PASSAGE_CHARS, lines.COPY_SHARE)
    out = [r | {"text": kept_text[r["doc_id"]], "n_chars": len(kept_text[r["doc_id"]]) if kept_text[r["doc_id"]] != r["text"] else r["n_chars"]}
           for r in out]
    groups = brute.near_groups({r["doc_id"]: r["text"] for r in out})
    out = [r for r in out if groups[r["doc_id"]][1] == r["doc_id"]]
    out = [r for r in out if not brute.contamination(r["text"], benchmark)[-1]]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    ids = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids for r in out}
    return {r["doc_id"]: (r["n_chars"], hashlib.sha256(" ".join(map(str, ids[r["doc_id"]])).encode()).hexdigest()) for r in out}


def test_run_equals_brute_force(spark):
    table = lambda n: spark.read.parquet(f"{SMALL}/{n}.parquet")
    docs = [r.asDict() for r in table("documents").collect()]
    trusted = {r.doc_id for r in table("labels").filter("quality = 1").collect()}
    expected = plain_run(docs, trusted, [tuple(r) for r in table("benchmark").select("item_id", "text").collect()])
    found = {r.doc_id: (r.n_chars, r.ids_sha256) for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert found == expected and 0 < len(found) < len(docs)


def planted(spark):
    """Rows like documents: a passage of six, the least of which is a near copy of a still smaller one without it."""
    words = lambda seed, n: " ".join(f"w{seed}x{i}" for i in range(n))
    passage, base = words("p", 20), words("base", 90)
    rows = [(1, base, "s1"), (2, f"{base}\n{passage}", "s2")]
    rows += [(i, f"{words(i, 40)}\n{passage}\nend {i}", f"s{i % 7}") for i in range(3, 8)]
    rows += [(i, words(i, 60), f"s{i % 7}") for i in range(8, 200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns(
        {"lang": F.lit("en"), "n_chars": F.char_length("text").cast("bigint")})
    return df, passage, {i: t for i, t, _ in rows}


def test_the_last_copy_of_a_passage_stays(spark):
    docs, passage, texts = planted(spark)
    cut = corpus_pipeline.line_dedup(spark, docs.withColumn("host", F.lit("x")), SMALL)
    found = {r.doc_id: r.text for r in cut.collect()}
    assert found == brute.drop_passages(texts, lines.PASSAGE_ROWS, lines.PASSAGE_CHARS, lines.COPY_SHARE)
    left = corpus_pipeline.near_dedup(spark, cut, SMALL).collect()
    assert [r.doc_id for r in left if passage in r.text] == [3] and 2 not in {r.doc_id for r in left}


def test_every_text_of_a_repeated_id_is_judged_alone(spark):
    """Each group of near copies keeps a row, also where ids repeat with other texts."""
    a, b, c = (" ".join(f"{n}{i}" for i in range(60)) for n in "abc")
    rows = [(3, b), (5, a), (5, f"{b} more"), (7, f"{a} more"), (9, c), (None, c), (9, c)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(5).cast("bigint"), "lo": F.lit(1)})
    found = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.near_dedup(spark, docs, SMALL).collect())
    kept_a = [x for x in found if x[1].startswith("a0")]
    assert len(kept_a) == 1 and [x for x in found if x[1].startswith("b0")] == [(3, b)]
    assert [x for x in found if x[1].startswith("c0")] == [(0, c), (9, c), (9, c)]


def test_stages_keep_columns_and_bear_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, good, None, None, 5), (3, good, "en", "a", 5), (3, good, "en", "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("kept", F.lit(0))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for source in (docs, docs.limit(0)):
            found = stage(spark, source, SMALL)
            assert found.columns == corpus_pipeline.COLUMNS and found.count() <= source.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == len(rows)


def test_line_dedup_drops_long_passages_of_any_source(spark):
    """A passage on 6 of 600 documents of six sources falls but for one copy; copies of documents stay whole."""
    words = lambda seed, n: " ".join(f"w{seed}x{i}" for i in range(n))
    passage, copied = words("p", 60), f"{words('c', 60)}\n{words('d', 60)}"
    rows = [(i, f"{words(i, 20)}\n{words(-i - 1, 20)}", f"s{i % 6}") for i in range(600)]
    for i in range(6):
        rows[90 + i] = (90 + i, f"{words(90 + i, 20)}\n  {passage} \nend {i}", f"s{i}")
        rows[300 + i] = (300 + i, copied, f"s{i}")
        rows[400 + i] = (None, f"{words(400 + i, 20)}\n{passage}\nend {i}", None)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns(
        {"lang": F.lit("en"), "n_chars": F.char_length("text").cast("bigint")})
    found = corpus_pipeline.line_dedup(spark, docs, SMALL).collect()
    assert len(found) == 600 and all(r.n_chars == len(r.text) for r in found)
    assert [r.doc_id for r in found if passage in r.text] == [90]
    assert sum(r.text == copied for r in found) == 6
    assert sorted(r.text for r in found if "end " in r.text and passage not in r.text) == sorted(
        [f"{words(90 + i, 20)}\nend {i}" for i in range(1, 6)] + [f"{words(400 + i, 20)}\nend {i}" for i in range(6)])


def test_verdicts_reach_null_ids_and_spare_repeated_ones(spark):
    """A rejected or contaminated row goes without an id too; a clean text under its id stays."""
    test = spark.read.parquet(f"{SMALL}/benchmark.parquet").filter("size(split(text, ' ')) >= 13").first().text
    good = {n: " ".join(f"{n}{i}" for i in range(30)) for n in "abcd"}
    n = -10**12
    rows = [(None, "junk"), (None, good["a"]), (n, "junk"), (n, good["b"]), (n, good["b"]), (n + 1, None)]
    table = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(5).cast("bigint")})
    found = corpus_pipeline.quality_rules(spark, table(rows), SMALL).collect()
    assert sorted(r.text for r in found) == sorted([good["a"], good["b"], good["b"]])
    rows = [(None, test), (None, good["c"]), (n, test), (n, good["d"]), (n, good["d"]), (None, None)]
    found = corpus_pipeline.decontamination(spark, table(rows), SMALL).collect()
    assert sorted(str(r.text) for r in found) == sorted([good["c"], good["d"], good["d"], "None"])


def test_workers_forget_the_tokenizer_in_other_stages(spark):
    docs = spark.createDataFrame([(i, f"word{i} other text") for i in range(64)], "doc_id bigint, text string").repartition(8)
    known = lambda **k: {r.n for r in map_texts(
        docs, [field("n", "bigint")], lambda batch: {"n": [bpe.compiled.cache_info().currsize] * batch.num_rows}, **k).collect()}
    tokenized = bpe.round_trip(docs).collect()
    assert known() == {0}
    again = bpe.round_trip(docs).collect()
    assert sorted(again) == sorted(tokenized) and 1 in known(uses=bpe.compiled)
