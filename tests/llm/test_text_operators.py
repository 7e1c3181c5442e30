"""The text operators against plain versions, the tokenizers' libraries, SQL and held-out labels."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from harness import compare, connect
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__
from strucsift.llm import (
    bpe, chat, common, decontaminate, language, lines, minhash, quality, textscan, tokencount, tokenfile, toxicity,
)
from strucsift.llm.components import components

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()

ODD = [
    None, "", " ", "\n\n", "one", "one two three four", "One TWO three four five", "one two three four five",
    "a\tb c  d\r\ne\x0bf", "x " * 3000, "same line\nsame line\nsame line \n\nother", "Ünïcödé 日本語 👍👍 Σσς ǅ",
    "<|endoftext|> and <|startoftext|>x<s>", "▁▁a ▁b  ▁", "l" * 5000, "é" * 70_000, "a\x00b \x00", "it's 12'34 we'll",
    " ".join(WORDS * 3), " ".join(WORDS * 3), "### *** |||", "…", "é İ ß ﬁ",
]


def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use."""
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "src", i % 2) for i, t in enumerate(ODD)]
    rows += [(None, "one two three four five", None, None, None), rows[-1], rows[-1]]
    names = "doc_id bigint, text string, lang string, source string, n_words int"
    df = spark.createDataFrame(rows, names)
    clashing = ["ids", "hash", "count", "score", "part", "host", "lines", "n_tokens", "kept", "rep", "bucket", "sig", "b", "share"]
    return df.withColumns({c: F.lit("x") for c in clashing})


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark_items(spark):
    return spark.read.parquet(f"{SMALL}/benchmark.parquet")


def both(spark, documents):
    return documents.select("doc_id", "text").unionByName(
        odd_documents(spark).select((F.col("doc_id") + 100_000).alias("doc_id"), "text"))


# --- shared scanning


def test_steps_bound_batches():
    batch = pa.record_batch({"text": pa.array(["a" * 60, None, "b" * 60, "c" * 200, ""])})
    assert [b.num_rows for b in common.steps(batch, most=100)] == [2, 1, 1, 1]
    assert [b.num_rows for b in common.steps(batch.slice(0, 0))] == []


def test_steps_bound_the_arrays_of_a_worker():
    batch = pa.record_batch({"text": pa.array(["alpha beta gamma " * 200] * 580)})
    tracemalloc.start()
    try:
        found = sum(len(textscan.words_of(b.column("text"), minhash.WORD).hash) for b in common.steps(batch))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 580 * 600 and most < 30e6


def test_words_of_slices_and_long_words():
    column = pa.array(["x y", "ab " + "q" * 200_000, None, "ab"]).slice(1)
    words = textscan.words_of(column, minhash.WORD)
    assert words.count.tolist() == [2, 0, 1] and words.hash[0] == words.hash[2] != words.hash[1]
    assert (words.ends() - words.start).tolist() == [2, 200_000, 2]


def twins(n):
    """A text of two letters and its complement, whose polynomial hashes are equal from 1,024 letters on."""
    first = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return first, first.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 65, 1024, 4096])
def test_rearranged_letters_are_other_words(spark, tmp_path, n):
    texts = [*twins(n), twins(n)[0].upper()]
    column = pa.array(texts)
    one, other, upper = textscan.words_of(column, minhash.WORD).hash
    assert one == upper != other
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    assert [r.component_id for r in minhash.near_duplicates(df).orderBy("doc_id").collect()] == [0, 1, 0]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [r.ids_sha256 for r in bpe.round_trip(df).orderBy("doc_id").collect()] == [
        hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for x in ids]
    tokenfile.write_tokens(df, str(tmp_path / "store"))
    assert [r.ids[:-1] for r in tokenfile.read_tokens(spark, str(tmp_path / "store")).orderBy("doc_id").collect()] == ids
    pieces = SentencePieceProcessor(model_file=public_tokenizers.path(tokencount.VOCABULARY))
    assert [r.n_tokens for r in tokencount.count_tokens(df).orderBy("doc_id").collect()] == [len(x) for x in pieces.encode(texts)]
    lines_of = pa.array(["\n".join(texts[:2]), "\n".join(texts[:1] * 2)])
    assert quality.base_counts(lines_of)["n_dup_lines"].tolist() == [0, 1]


# --- 1


def test_near_duplicates_equal_brute_force(spark, documents):
    source = both(spark, documents)
    found = {r.doc_id: r for r in minhash.near_duplicates(source).filter("doc_id IS NOT NULL").collect()}
    expected = brute.near_groups({r.doc_id: r.text for r in source.filter("doc_id IS NOT NULL").collect()})
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == expected
    assert all(r.kept == (i == r.component_id) for i, r in found.items())


def test_near_duplicates_of_a_crowd_with_outsiders(spark):
    """Many copies of one text with more or fewer edits: some linked, some just not."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(700):
        own = base[:]
        for _ in range(rnd.choice([0, 1, 2, 3, 4, 5, 6, 8, 10, 14])):
            own[rnd.randrange(150)] = f"e{i}x{rnd.random()}"
        texts[i] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    expected = brute.near_groups(texts)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert found == expected and len({c for _, c in expected.values()}) > 50


def test_blocks_compare_what_hubs_leave(spark, monkeypatch):
    """Block pairs of one bucket, with blocks smaller than the bucket."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rnd = random.Random(9)
    # Words far apart: each makes shingles of its own.
    chosen = [sorted(rnd.sample(range(60), rnd.randint(46, 56))) for _ in range(60)]
    texts = pa.array([" ".join(f"t{x} . . . . ." for x in s) for s in chosen])
    own = minhash.shingle_sets(texts)
    n = [len(s) for s in own]
    sig = [minhash.signature(s).tobytes() for s in own]
    reps = spark.createDataFrame([(i, bytes(s)) for i, s in enumerate(sig)], "rep bigint, sig binary")
    members = minhash._buckets(reps).withColumn("comp", F.col("rep") % 20)
    sets = spark.createDataFrame([(i, k, s.view(np.int64).tolist()) for i, (k, s) in enumerate(zip(n, own, strict=True))],
                                 "rep bigint, n bigint, shingles array<bigint>")
    support = minhash._support(sets, reps.select("rep"))
    every = [x for s in own for x in s.tolist()]
    often = {x for x, c in Counter(every).items() if c > 1}
    assert {r.rep: r.shared for r in support.collect()} == {i: len(often & set(s.tolist())) for i, s in enumerate(own)}
    found = [tuple(sorted(p)) for p in minhash._block_pairs(members, reps, support, 75, 1e-9).collect()]
    same = lambda i, j: 100 * len(np.intersect1d(own[i], own[j])) >= 75 * len(np.union1d(own[i], own[j]))
    links = {(j, i) for i in range(60) for j in range(i) if i % 20 != j % 20 and same(i, j)}
    assert links and links <= set(found) and len(found) == len(set(found))


def test_pruning_keeps_links_and_drops_others():
    needed = minhash.least_matches(75, 1e-4)
    assert len(needed) == minhash.N_HASHES // minhash.BATCH and needed == sorted(needed)
    draw = np.random.default_rng(1)
    left = draw.integers(0, 1 << 16, (4000, minhash.N_HASHES)).astype("<u2")
    for share, least, most in ((0.75, 3990, 4000), (0.3, 0, 0)):
        right = np.where(draw.random(left.shape) < share, left, left ^ 1)
        assert least <= len(minhash.survivors(left, right, needed)) <= most


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 200), (200, 300), (7, 7)]
    found = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).select("id", "root").collect())
    assert found == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 150)} | {200: 200, 300: 200}


def test_deduplicate_keeps_columns(spark):
    source = odd_documents(spark)
    kept = minhash.deduplicate(source)
    assert kept.columns == source.columns
    assert kept.filter("doc_id IS NULL").count() == 1
    assert {18, 19} & {r.doc_id for r in kept.collect()} == {18}


# --- 2


def token_rows(source):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(tokenfile.VOCABULARY))
    rows = sorted(source, key=lambda r: r.doc_id)
    out, start = [], 0
    for r in rows:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        out.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_equal_the_library(spark, documents, tmp_path):
    source = both(spark, documents).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    folder = str(tmp_path / "store")
    manifest = tokenfile.write_tokens(source, folder, part_bytes=100_000)
    assert len(manifest["parts"]) > 2 and manifest["width"] == 2
    found = [tuple(r) for r in tokenfile.read_checksums(spark, folder).orderBy("doc_id").collect()]
    assert found == token_rows(source.collect())
    ids = tokenfile.read_tokens(spark, folder).select("n_tokens", F.size("ids").alias("n"), F.element_at("ids", -1).alias("end")).collect()
    assert all(r.n_tokens == r.n and r.end == 1 for r in ids)
    part = manifest["parts"][1]
    offsets = np.memmap(f"{folder}/part-{part['part']:06d}.offsets", "<u8")
    assert len(offsets) == part["docs"] + 1 and offsets[-1] == part["ids"]


def test_token_files_of_null_ids_and_no_rows(spark, tmp_path):
    tokenfile.write_tokens(odd_documents(spark), str(tmp_path / "a"))
    rows = tokenfile.read_tokens(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert rows[0].doc_id is None and len(rows) == len(ODD) + 3
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:], strict=False))
    tokenfile.write_tokens(odd_documents(spark).limit(0), str(tmp_path / "b"))
    assert tokenfile.read_tokens(spark, str(tmp_path / "b")).count() == 0


# --- 3


def test_token_counts_equal_the_library(spark, documents):
    library = SentencePieceProcessor(model_file=public_tokenizers.path(tokencount.VOCABULARY))
    source = both(spark, documents)
    expected = sorted(((r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "")), n > 4096)
                       for r in source.collect()), key=str)
    assert pairs(tokencount.count_tokens(source), "doc_id", "n_bytes", "n_tokens", "over_limit") == expected


def test_state_maps_compose(spark):
    transducer = tokencount.Transducer(public_tokenizers.path(tokencount.VOCABULARY))
    rnd, letters = random.Random(3), "aaeeinst ▁▁  \nΣé👍ab\r;)"
    for _ in range(200):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))).replace(" ", "▁")
        cuts = sorted(rnd.randint(0, len(text)) for _ in range(6))
        slices = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        assert tokencount.count_slices(transducer, slices) == transducer.count(text)
        maps = [tokencount.slice_map(transducer, s) for s in slices[:3]]
        ab_c = tokencount.compose(transducer, tokencount.compose(transducer, maps[0], maps[1]), maps[2])
        a_bc = tokencount.compose(transducer, maps[0], tokencount.compose(transducer, maps[1], maps[2]))
        assert ab_c == a_bc


def test_long_chunks_are_composed(monkeypatch):
    path = public_tokenizers.path(tokencount.VOCABULARY)
    transducer, memory = tokencount.compiled(path)
    library, rnd, composed = SentencePieceProcessor(model_file=path), random.Random(5), []
    plain = tokencount.compose
    monkeypatch.setattr(tokencount, "compose", lambda *maps: composed.append(1) or plain(*maps))
    words = ["straße", "internation", "数据", "処理する", "Σύνολο", "👍", "данные", "xqz", "a", "\r", "don't"]
    unspaced = "".join(rnd.choice(words) for _ in range(200_000))
    texts = [unspaced, "ab" * 50_000, "▁".join(rnd.choice(words) for _ in range(3_000)), "数" * 5_000 + " tail", " " * 9_000 + "x", "short", None]
    assert len(unspaced.encode()) > 1_000_000
    counts = tokencount.count_batch(pa.array(texts), transducer, memory)
    assert counts.tolist() == [len(library.encode(t)) if t else 0 for t in texts]
    assert len(composed) > len(unspaced) // tokencount.SLICE


def test_transducer_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(tokencount, "MOST_TRANSITIONS", 50)
    monkeypatch.setattr(tokencount, "MOST_PAIRS", 50)
    transducer = tokencount.Transducer(public_tokenizers.path(tokencount.VOCABULARY))
    library = SentencePieceProcessor(model_file=public_tokenizers.path(tokencount.VOCABULARY))
    for word in ("understanding", "misunderstood", "internationalization", "naïveté", "tokenizers"):
        assert transducer.count("▁" + word) == len(library.encode(word))


# --- 4, 5


@pytest.mark.parametrize("name", ["op4_chat_perspectives", "op5_line_dedup"])
def test_queries_equal_sql(spark, name):
    con = connect(MIDDLE)
    difference, _ = compare(spark, con, name, __spark_entry__.queries()[name], __spark_entry__.oracle_sql()[name], MIDDLE)
    assert difference is None


def test_chat_of_odd_turns(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "bob", None), (1, 2, "system", "s"), (1, 600, "user", "<|im_end|>"), (1, None, None, "x"),
             (2, 0, "system", "alone"), (None, 0, "user", "no id"), (3, 0, "user", "twice"), (3, 0, "user", "twice")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit(1))
    found = {(r.conv_id, r.perspective, r.part): r for r in chat.rotate_perspectives(df).collect()}
    assert {k for k in found if k[0] == 1} == {(1, p, part) for p in ("user", "bob", "unknown") for part in (-1, 0, 1)}
    one = found[1, "user", 0]
    assert one.text == "<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>system\ns<|im_end|>\n"
    assert [one.text[a:b] for a, b in zip(one.mask_start, one.mask_end, strict=True)] == ["hi<|im_end|>"]
    assert "<| im_end|>" in found[1, "bob", 1].text and found[1, "bob", 1].n_own == 0
    assert (2, "system", 0) not in found and found[None, "user", 0].n_turns == 1 and found[3, "user", 0].n_own == 2
    assert chat.rotate_perspectives(df.limit(0)).count() == 0


def test_chat_bounds_parts_of_repeated_and_null_turns(spark):
    """Parts hold at most the given turns whatever their numbers; none is lost and none changes its order."""
    said = [(1, None, "ann", f"n{i % 7}") for i in range(23)] + [(1, 3, "bob", f"r{i:02}") for i in range(11)]
    said += [(1, 9, "ann", "late"), (2, 0, "ann", "other")] + [(2, 5, "bob", "same")] * 9
    rows = said + [(None, i % 2, "ann", f"alone {i}") for i in range(20)] + [(None, 1, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    found = chat.rotate_perspectives(df, 4).collect()
    assert max(r.n_turns for r in found) == 4
    keyed = {(r.conv_id, r.perspective, r.part): r for r in found if r.conv_id is not None}
    assert len(keyed) == sum(r.conv_id is not None for r in found)
    assert sorted(k[2] for k in keyed if k[:2] == (1, "ann")) == [-1, 0, 1, 2, 3, 4, 5, 6, 7, 9 // 4 + 7]
    for conv, who in ((1, "ann"), (1, "bob"), (2, "ann"), (2, "bob")):
        order = sorted((r for r in said if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        parts = [keyed[k] for k in sorted(keyed) if k[:2] == (conv, who)]
        assert "".join(p.text for p in parts) == "".join(
            ("<|im_start|>assistant\n" if r[2] == who else f"<|im_start|>user name={r[2]}\n") + f"{r[3]}<|im_end|>\n" for r in order)
        assert sum(p.n_own for p in parts) == sum(r[2] == who for r in order)
    alone = [r for r in found if r.conv_id is None]
    assert sorted(r.text for r in alone) == sorted(f"<|im_start|>assistant\nalone {i}<|im_end|>\n" for i in range(20))


def test_chat_uses_no_python(spark):
    plan = chat.with_mask_text(chat.rotate_perspectives(spark.read.parquet(f"{SMALL}/conversations.parquet")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "InArrow" not in text


def test_line_dedup_equals_brute_force(spark, documents):
    source = documents.select("doc_id", F.col("source").alias("host"), "text").unionByName(
        odd_documents(spark).select((F.coalesce("doc_id", F.lit(99)) + 100_000).alias("doc_id"), F.col("source").alias("host"), "text")
    ).dropDuplicates(["doc_id"])
    expected = brute.drop_lines([tuple(r) for r in source.collect()], 0.2, 2)
    found = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.drop_boilerplate(source, 0.2, 2).collect()}
    assert found == expected and sum(x[2] for x in found.values()) > 0
    assert lines.drop_boilerplate(source.limit(0)).count() == 0


def test_line_dedup_of_small_sites(spark):
    """Navigation on every page of a site falls from three pages on; two pages have no frequency."""
    rows = [(f"h{n}", f"Home | About\npage {i} of {n}") for n in (1, 2, 3, 9) for i in range(n)]
    found = lines.drop_boilerplate(spark.createDataFrame(rows, "host string, text string")).collect()
    assert {(r.host, r.n_dropped) for r in found} == {("h1", 0), ("h2", 0), ("h3", 1), ("h9", 1)}
    assert all(r.text.startswith("Home") == (r.host in ("h1", "h2")) and "page " in r.text for r in found)


def test_hosts(spark):
    urls = ["http://A.example.com/x", "https://u:p@b.org:80/?q", "c.net/x", None, "ftp://", "http://d.example?x#y"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(lines.host_of(F.col("url")).alias("h"))
    assert [r.h for r in df.collect()] == ["a.example.com", "b.org", None, None, None, "d.example"]


# --- 6


def test_toxicity_held_out(spark):
    found = __spark_entry__.queries()["op6_toxicity"](spark, MIDDLE)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    right = np.mean([r.predicted == r.toxic for r in rows])
    assert right > 0.93 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.02


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "scum": 4.0}, ["scum pond", "idiotes"], 1.0, -2.0)
    automaton = lexicon.automaton()
    hits = lambda text: [w for _, w in lexicon.hits(automaton, toxicity.fold(text))]
    assert hits("You IDIOT! 1di0t іdіоt ｉｄｉｏｔ id​iot idiots") == [5.0] * 6
    assert hits("id!ot idi07! ldlot") == [5.0] * 3
    assert hits("a scum pond, idiotes; no obscumt") == [] and hits("scum and pond $cum") == [4.0, 4.0]
    assert lexicon.density(automaton, None) == (0.0, 0) and toxicity.Lexicon({}).score(0.0) < 0.01


def test_toxicity_without_labels(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id bigint, toxic int")
    lexicon = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, lexicon).collect()
    assert len(rows) == len(ODD) + 3 and {r.predicted for r in rows} == {0} and len({r.score for r in rows}) == 1
    assert toxicity.score(docs.limit(0), lexicon).count() == 0


# --- 7


def test_decontamination_equals_brute_force(spark, documents, benchmark_items):
    items = benchmark_items.select("item_id", "text").unionByName(spark.createDataFrame(
        [(900, "Zeta eta THETA"), (901, None), (None, "one two"), (902, ""), (900, "five"), (903, "👍 日本語")], "item_id bigint, text string"))
    source, tests = both(spark, documents), [tuple(r) for r in items.collect()]
    expected = sorted(((r.doc_id, *brute.contamination(r.text, tests)) for r in source.collect()), key=str)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert pairs(decontaminate.digest(decontaminate.scan(source, items)), *columns) == expected
    assert any(r[5] for r in expected)
    unique = source.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    sliced = decontaminate.scan(unique, items, slice_windows=60)
    known = {r[0]: r for r in expected}
    assert pairs(decontaminate.digest(sliced), *columns) == sorted((known[r.doc_id] for r in unique.collect()), key=str)


def test_slices_agree_on_null_and_repeated_ids(spark):
    """Several slices give each row what one slice gives, whatever its id."""
    first, second = " ".join(WORDS[:14]), " ".join(reversed(WORDS[:16]))
    items = spark.createDataFrame([(1, first), (2, second)], "item_id int, text string")
    rows = [(None, f"x {first} y"), (None, "clean"), (None, second), (7, f"{first} {second}"), (7, "clean"), (7, second), (7, second), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    one, many = (decontaminate.scan(docs, items, slice_windows=n) for n in (1000, 2))
    key = lambda df: sorted(map(str, df.select(*one.columns).collect()))
    assert key(many) == key(one) and sum(r.n_hit > 0 for r in many.collect()) == 5
    named = decontaminate.scan(docs.withColumns({"items": F.lit("x"), "spans": F.lit(0)}), items, slice_windows=2)
    assert key(named) == key(one)


def test_decontamination_removes_spans_or_documents(spark):
    test = " ".join(WORDS[:15])
    docs = spark.createDataFrame([(1, f"Ünd, {test.upper()}! end"), (2, "fine"), (3, None), (4, f"{test} " + "word " * 400)], "doc_id int, text string")
    items = spark.createDataFrame([(1, test)], "item_id int, text string")
    assert {r.doc_id for r in decontaminate.remove(docs, items).collect()} == {2, 3, 4}
    cut = {r.doc_id: r.text for r in decontaminate.remove(docs, items, spans=True).collect()}
    assert cut == {1: "Ünd, ! end", 2: "fine", 3: None, 4: " " + "word " * 400}
    # Columns of the same names as the operator's own come through.
    named = docs.withColumns({"span_start": F.lit("s"), "span_end": F.lit(7)})
    for spans in (False, True):
        kept = decontaminate.remove(named, items, spans=spans)
        assert kept.columns == named.columns and {(r.span_start, r.span_end) for r in kept.collect()} == {("s", 7)}
    assert decontaminate.scan(docs, items.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.scan(docs.limit(0), items).count() == 0


# --- 8


def test_bpe_equals_the_library(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    source, expected = both(spark, documents), []
    for r in source.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    found = pairs(bpe.round_trip(source), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert found == sorted(expected, key=str)


def test_bpe_of_random_strings_and_all_letters():
    path = public_tokenizers.path(bpe.VOCABULARY)
    own, library = bpe.PrefixBpe(path), Tokenizer.from_file(path)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("aaabehilnorst'.,!?01 é👍<|endoftext|>") for _ in range(rnd.randint(0, 50))) for _ in range(3000)]
    texts += [f"a{chr(c)}b{chr(c)}́" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    for text, known in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert own.chunk(text) == known.ids, repr(text)


def test_bpe_columns_and_decoding(spark):
    source = odd_documents(spark)
    encoded = bpe.encode(source)
    assert set(encoded.columns) == set(source.columns) and encoded.schema["ids"].dataType.simpleString() == "array<int>"
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    for r in bpe.decode(encoded).collect():
        assert r.text == library.decode(r.ids, skip_special_tokens=False)
    assert bpe.encode(source.limit(0)).count() == 0


def test_a_file_of_another_kind_is_refused():
    with pytest.raises(Exception):
        bpe.PrefixBpe(public_tokenizers.path("byte_bpe_50k.json"))


# --- 9


def test_language_held_out(spark):
    found = __spark_entry__.queries()["op9_language"](spark, MIDDLE)
    truth = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = found.filter("held_out").join(truth, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    docs = odd_documents(spark)
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x", None)], "text string, lang string")
    model = language.learn(train)
    rows = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert rows[0].lang_pred == rows[1].lang_pred == rows[20].lang_pred == rows[21].lang_pred == "und" and rows[11].lang_pred != "und"
    assert {r.lang_pred for r in language.predict(docs, language.learn(train.filter("lang = 'en'"))).collect()} == {"und", "en"}
    nothing = language.learn(train.limit(0))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("k", [2, 4, 6, 12])
def test_codewords_differ(k):
    code = language.codewords(k)
    apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
    assert min(apart) >= max(1, code.shape[1] // 4) and (np.abs(code) == 1).all()


# --- 10


def test_quality_equals_brute_force(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").select("doc_id")
    source = both(spark, documents)
    rows, trusted = source.collect(), {r.doc_id for r in labels.collect()}
    texts = [r.text for r in rows]
    flags = [r.doc_id in trusted for r in rows]
    expected = sorted(((r.doc_id, *brute.base_counts(r.text), kept) for r, kept in
                       zip(rows, brute.quality_kept(texts, flags), strict=True)), key=str)
    found = quality.quality_rules(source, labels)
    assert pairs(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept") == expected
    ratios = sorted(r.llr for r in found.collect())
    assert np.allclose(ratios, sorted(brute.gram_ratios(texts, flags)), atol=1e-9)


def test_quality_without_target(spark):
    source = odd_documents(spark)
    rows = quality.quality_rules(source, None).collect()
    assert {r.llr for r in rows} == {0.0} and all(r.kept == (not r.base_failed) for r in rows)
    assert quality.quality_rules(source.limit(0), None).count() == 0


def test_language_against_plain(spark, documents):
    rows = documents.select("doc_id", "text", "lang").collect()
    training = [(r.text, r.lang) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5]
    expected = dict(zip([r.doc_id for r in rows], brute.languages(training, [r.text for r in rows]), strict=True))
    found = {r.doc_id: r for r in __spark_entry__.queries()["op9_language"](spark, SMALL).collect()}
    assert set(found) == set(expected)
    for i, (lang, score) in expected.items():
        assert found[i].lang_pred == lang and abs(found[i].score - score) < 1e-4, i
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_toxicity_against_plain(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    known = {r.doc_id: r.toxic == 1 for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.doc_id in texts}
    lexicon = toxicity.learn(docs, labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    folded = {i: toxicity.fold(t) for i, t in texts.items()}
    counts = {True: Counter(), False: Counter()}
    for i, toxic in known.items():
        counts[toxic].update({w[:k] for w in folded[i] for k in range(toxicity.SHORTEST, min(toxicity.LONGEST, len(w)) + 1)})
    n_pos, n_neg = sum(known.values()), len(known) - sum(known.values())
    enough = toxicity.SIGNIFICANT / (2 * np.log((n_pos + n_neg) / n_pos))
    tally = [(s, n, counts[False][s]) for s, n in counts[True].items() if n >= enough]
    assert len(counts[True]) < toxicity.CANDIDATES and lexicon.weights == toxicity.choose(tally, n_pos, n_neg) != {}
    weights = {toxicity.fold(s)[0]: w for s, w in lexicon.weights.items()}
    exceptions = [toxicity.fold(e) for e in lexicon.exceptions]
    found = {r.doc_id: r for r in __spark_entry__.queries()["op6_toxicity"](spark, MIDDLE).collect()}
    assert set(found) == set(texts)
    for i, words in folded.items():
        density = brute.toxic_density(words, weights, exceptions)
        score = 1 / (1 + np.exp(-np.clip(lexicon.slope * density + lexicon.level, -50, 50)))
        assert abs(found[i].score - score) < 1e-9 and found[i].predicted == (found[i].score >= 0.7), i
