"""Packing against the tokenizers library, exhaustive dynamic programming, and odd tables."""

from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strucsift.llm import packing, tokenfile
from strucsift.llm.queries import op12_packing
from strucsift.llm.textscan import words_of
from strucsift.llm.pieces import CHUNK, Memory, tokenize

SMALL = "/root/testdata/sf0.001"


def check_pieces(rows, texts):
    """Whether the pieces ``rows`` hold every id of ``texts`` {doc_id: text} once, gapless; gives the sequences' lengths."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, own in by_doc.items():
        ids = [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LIMIT
    return np.array([sum(r.length for r in own) for own in by_sequence.values()])


def test_query_holds_every_token_once(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    lengths = check_pieces(op12_packing(spark, SMALL).collect(), texts)
    assert packing.padding(lengths).sum() < 0.02 * lengths.sum()


def test_odd_texts_and_clashing_names(spark):
    texts = {0: None, 1: "", 2: " \n ", 3: "word " * 9000, 4: "x" * 70_000, 5: "One. Two! Three?\n(Four.) five", 6: "。" * 50,
             7: "<|endoftext|> a", 8: "Same. Text."}
    rows = [*texts.items(), (9, "Same. Text."), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    df = df.withColumns({c: F.lit("x") for c in ("ids", "start", "length", "sequence_id", "offset", "doc_tokens")})
    found = packing.pack(df).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(found, dict(rows))
    order = [r.doc_id for r in sorted(found, key=lambda r: (r.sequence_id, r.offset))]
    assert [i for k, i in enumerate(order) if k == 0 or order[k - 1] != i] == [i for i, _ in rows]
    assert packing.pack(df.limit(0)).count() == 0
    twice = packing.pack(df.filter("doc_id = 8").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))))
    assert [sum(r.length for r in twice.collect()), twice.filter("start = 0").count()] == [2 * twice.first().doc_tokens, 2]


def exhaustive(places, penalties, limit, least_power):
    """The least cost of a way to the last place."""
    cost = {0: 0}
    for place, penalty in zip(places, penalties, strict=True):
        ways = []
        for earlier, c in cost.items():
            n = place - earlier
            if n <= limit:
                free = n >= least_power and n & (n - 1) == 0
                ways.append(c + (0 if free else limit - n))
        cost[place] = min(ways) + penalty + packing.SEQUENCE
    return cost[places[-1]]


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_the_cheapest_with_and_without_trunks(seed):
    rnd = random.Random(seed)
    limit, total = 128, 3000
    places = sorted({*rnd.sample(range(1, total), 300), *range(60, total, 60), total})
    penalties = [rnd.choice([0, 4, 30]) for _ in places]
    cuts, way = packing.Cuts(limit), []
    for k in range(0, len(places), 40):
        cuts.extend(np.array(places[k:k + 40]), np.array(penalties[k:k + 40]), 4)
        if seed % 2:
            way = way[:-1] + cuts.trunk()
            assert len(cuts.places) < len(places)
    way = way[:-1] + cuts.finish()
    price = dict(zip(places, penalties, strict=True))
    spent = sum(packing.padding(np.array([b - a]), limit)[0] if b - a >= 4 else limit - (b - a) for a, b in zip(way, way[1:], strict=False))
    spent += sum(price[p] + packing.SEQUENCE for p in way[1:])
    assert way[0] == 0 and way[-1] == total and spent == exhaustive(places, penalties, limit, 4)


def test_sentences_and_gaps():
    column = pa.array(["One two. Three! (Four?) five\nsix 3.5 end.", None, "単。語", "a。 b"])
    words = words_of(column, CHUNK)
    assert np.flatnonzero(packing.sentence_ends(words, words.ends())).tolist() == [1, 2, 3, 4, 9]
    places, penalties = packing.fill_gaps(np.array([3, 4, 9]), np.array([0, 32, 0]), 0, 4, 1)
    assert places.tolist() == [3, 4, 5, 6, 7, 8, 9] and penalties.tolist() == [0, 32, 256, 256, 256, 256, 0]
    places, penalties = packing.fill_gaps(np.array([3, 14, 18]), np.array([0, 32, 0]), 0, 4, 3)
    assert places.tolist() == [3, 5, 8, 11, 14, 18] and penalties.tolist() == [0, 256, 256, 256, 32, 0]


def test_held_tokens_do_not_change_the_cuts(spark, monkeypatch):
    """Cutting off trunks early gives the sequences of the whole partition."""
    column = pa.array([r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()])
    batch = pa.record_batch({"doc_id": pa.array(range(len(column))), "text": column})
    encode, memory = packing.encoder(public_tokenizers.path(packing.VOCABULARY))

    def sequences(held):
        monkeypatch.setattr(packing, "HELD_TOKENS", held)
        packer, out = packing.Packer(1024), []
        for k in range(0, len(column), 7):
            packer.add(*packing._read(batch.slice(k, 7), memory, encode, 2))
            out.append(packer.pieces())
        out.append(packer.pieces(finish=True))
        return [r for b in out if b is not None for r in b.to_pylist()], sum(b is not None for b in out)

    early, parts = sequences(1)
    late, one = sequences(1 << 40)
    assert early == late and parts > 2 and one == 1


def fresh_encoder(path):
    """The encoder of ``path`` with a memory of its own."""
    encode, memory = tokenfile.encoder(path)
    return encode, Memory(memory.most, memory.apart)


def test_a_word_is_tokenized_once_whatever_marks_and_digits_stand_by_it():
    encode, memory = fresh_encoder(public_tokenizers.path(packing.VOCABULARY))
    seen = []
    tokenize(pa.array(["gamma, (gamma) gamma2 gamma's \"gamma\" gamma!", "7gamma, gamma..."]), memory, lambda c: seen.extend(c) or encode(c))
    assert seen.count("gamma") == 1 and not any("gamma" in c for c in seen if c != "gamma") and len(seen) == len(set(seen)) == 10


PARTS = ["a", "B", "re", "don", "'", "'s", "'T", "'ll", "''", "|", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<", ">", "0", "00",
         "1", "7", ".", ",", "-", "...", "=", "`", ";", "\u0301", "\u0338", "\u0308", "\u212a", "\u0130", "\u00df", "\u03a3", "\u00e9", "\u00a0",
         "\u3000", "\u0085", "\u200d", "\u0663", "\u00bd", "\u00b2", "\u20e3", "\u037e", "\x00", "\x1c", "\x1f", "\x7f", "\u1100", "\u1161", "\u11a8",
         "\U0001f44d", "\u65e5", " ", "\n", "\t", "e\u0301", "x" * 70, "0" * 70]


@pytest.mark.parametrize("seed", range(3))
def test_ids_of_cut_chunks_are_the_librarys(seed):
    path = public_tokenizers.path(packing.VOCABULARY)
    tokenizer, (encode, memory) = Tokenizer.from_file(path), fresh_encoder(path)
    rnd = random.Random(seed)
    texts = ["", "0", *("".join(rnd.choices(PARTS, k=rnd.randrange(1, 12))) for _ in range(3000))]
    texts += [a + b for a in PARTS for b in PARTS] if not seed else []
    for k in range(0, len(texts), 500):
        ids, border = tokenize(pa.array(texts[k:k + 500]), memory, encode)
        for i, text in enumerate(texts[k:k + 500]):
            assert ids[border[i]:border[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_chunks_stay_whole_for_other_tokenizers(tmp_path):
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": "\\S+"}
    (tmp_path / "other.json").write_text(json.dumps(spec))
    encode, memory = tokenfile.encoder(str(tmp_path / "other.json"))
    texts = ["the end.The 10th (of it's) kind", "...and 3.50,- more"]
    ids, border = tokenize(pa.array(texts), memory, encode)
    tokenizer = Tokenizer.from_file(str(tmp_path / "other.json"))
    assert [ids[a:b].tolist() for a, b in zip(border, border[1:], strict=False)] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts] and memory.apart is None


def test_pieces_of_cut_words_make_up_the_words():
    column = pa.array(["it's 3.5, no", None, " a1", "b"])
    plain, cut = words_of(column, CHUNK), words_of(column, CHUNK, tokenfile.between_words())
    whole, last = cut.whole()
    assert whole.start.tolist() == plain.start.tolist() and whole.first.tolist() == plain.first.tolist()
    assert cut.ends()[last].tolist() == plain.ends().tolist()
    data = cut.data.tobytes().decode()
    assert [data[a:b] for a, b in zip(cut.start, cut.ends(), strict=True)] == ["it", "'s", "3", ".", "5", ",", "no", "a", "1", "b"]
    empty, last = words_of(pa.array([None, ""]), CHUNK, tokenfile.between_words()).whole()
    assert not len(empty.start) and not len(last) and empty.first.tolist() == [0, 0, 0]
