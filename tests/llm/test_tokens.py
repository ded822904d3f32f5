import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hortulus.llm import bpe, mixing, splitting

SAMPLES = [
    "", " ", "\n\n  \n", "Hello world's  end", "<|endoftext|> x", "naïve café — Größe 18–22 °C", "Сухой склон у озера", "漢字かな" * 50,
    "😀🌿 𝔥𝔬𝔯𝔱𝔲𝔰", "a" * 5000, "ab" * 3000 + "\x1c \x1d", "x\r\n\r\ny\t\tz   w", "1234567890" * 30, "don't DON'T 's't", "​﻿  　end ",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_the_library(spark, library, small):
    random.seed(3)
    alphabet = "ab c'’é\n\tЖ漢😀.,1 "
    texts = [*SAMPLES, *["".join(random.choices(alphabet, k=random.randrange(60))) for _ in range(300)]]
    df = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("__text", F.lit(1))
    got = {r.doc_id: r.ids for r in bpe.encode_texts(df, "doc_id", "text").collect()}
    assert [got[i] for i in range(len(texts) + 1)] == [*library(texts), []]
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    whole = {r.doc_id: r.text for r in docs.collect()}
    coded = {r.doc_id: r.ids for r in bpe.encode_texts(docs, "doc_id", "text").collect()}
    assert [coded[k] for k in whole] == library(whole.values())


def test_repeated_null_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, len(r.ids)) for r in bpe.encode_texts(df, "doc_id", "text").collect()) == [(0, 1), (1, 2), (1, 2)]
    assert bpe.encode_texts(df.limit(0), "doc_id", "text").count() == 0
    assert {r.n_tokens for r in bpe.count_tokens(df, "text").collect()} == {1, 2}


def test_memory_of_words_is_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    encoder = bpe.Encoder(bpe.Vocabulary(__import__("json").loads(bpe.read_vocabulary(f"{bpe.TOKENIZERS}/byte_bpe_50k.json"))))
    first = [encoder.encode([t])[1].tolist() for t in SAMPLES]
    assert first == [encoder.encode([t])[1].tolist() for t in SAMPLES]


# ---------------------------------------------------------------- splitting


@pytest.mark.parametrize("limit, overlap", [(8, 0), (16, 4), (64, 32)])
def test_pieces_cover_the_text_within_the_limit(spark, library, small, limit, overlap):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(SAMPLES)] + [(-99, None)], "doc_id long, text string")
    df = docs.unionByName(extra).withColumn("piece", F.lit(0)).withColumn("limit_id", F.lit("x"))
    limits = spark.createDataFrame([(7, limit, overlap)], "limit_id int, max_tokens int, overlap_tokens int")
    texts = {r.doc_id: r.text for r in df.collect()}
    sizes = {k: len(v) for k, v in zip(texts, library(texts.values()))}
    pieces: dict = {}
    for r in splitting.split_texts(df, limits).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == {k for k, n in sizes.items() if n > limit}
    coded = library([r.piece for k in pieces for r in pieces[k]])
    assert max(map(len, coded)) <= limit
    for k, rows in pieces.items():
        rows.sort(key=lambda r: r.piece_nr)
        end = 0
        for r in rows:
            assert texts[k][r.start_char : r.start_char + len(r.piece)] == r.piece
            assert r.start_char <= end and r.n_tokens <= limit
            assert r.piece_nr == 0 or overlap - 3 <= r.overlap <= overlap
            assert r.start_char + len(r.piece) > end
            end = r.start_char + len(r.piece)
        assert end == len(texts[k])


def test_natural_boundaries_come_first(spark):
    text = "One two three four five. " * 3 + "\n\n" + "Six seven eight nine ten. " * 3
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    limits = spark.createDataFrame([(1, 24, 0)], "limit_id int, max_tokens int, overlap_tokens int")
    pieces = [r.piece for r in splitting.split_texts(df, limits).orderBy("piece_nr").collect()]
    assert "".join(pieces) == text and pieces[0].endswith("\n\n") and all(p.rstrip().endswith(".") for p in pieces if p.strip())


def test_unusable_limits(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    schema = "limit_id int, max_tokens int, overlap_tokens int"
    for bad in ((1, 4, 0), (1, 20, 15), (1, None, 0)):
        with pytest.raises(ValueError):
            splitting.split_texts(df, spark.createDataFrame([bad], schema))
    assert splitting.split_texts(df, spark.createDataFrame([], schema)).count() == 0
    assert splitting.split_texts(df.limit(0), spark.createDataFrame([(1, 20, 2)], schema)).count() == 0


# ---------------------------------------------------------------- mixing


def documents(spark):
    rows = [(i, f"text number {i} of the large source", "large") for i in range(200)]
    rows += [(1000 + i, f"small {i}", "small") for i in range(10)]
    rows += [(2000 + i, "the same text", "small") for i in range(5)] + [(3000, "the same text", "large")]
    rows += [(4000, None, "large"), (4001, "", "small"), (4002, "no source", None), (4003, "no weight", "other")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def weights(spark):
    return spark.createDataFrame([("large", 0.5, 1), ("small", 0.5, 4), ("none", 0.1, 2), (None, 0.2, 1)], "source string, target_share double, max_repeats int")


def test_shares_and_repeats(spark):
    mixture, shares = mixing.mix_sources(documents(spark).withColumn("bucket", F.lit(1)), weights(spark))
    rows, by = mixture.collect(), {r.source: r for r in shares.collect()}
    assert set(by) == {"large", "small", "none"} and by["none"].taken_tokens == 0
    taken: dict = {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.take_tokens
    assert taken == {s: by[s].taken_tokens for s in taken}
    assert abs(taken["large"] - taken["small"]) <= 1  # equal shares
    assert sum(r.take_tokens < r.n_tokens for r in rows) <= 2  # one text on the cut of each source
    used: dict = {}
    for r in rows:
        used[r.doc_id] = used.get(r.doc_id, 0) + 1
    assert max(n for d, n in used.items() if d < 1000) == 1 and max(used.values()) <= 4
    assert not {d for d in used if d >= 2001}  # the same text counts once, for its first document


def test_short_source_and_no_documents(spark):
    shares = {r.source: r for r in mixing.mix_sources(documents(spark), weights(spark), total_tokens=10**6)[1].collect()}
    assert shares["small"].taken_tokens == 4 * shares["small"].available_tokens < shares["small"].budget_tokens
    mixture, shares = mixing.mix_sources(documents(spark).limit(0), weights(spark))
    assert mixture.count() == 0 and {r.taken_tokens for r in shares.collect()} == {0}


def test_order_is_repeatable(spark):
    runs = [sorted(map(tuple, mixing.mix_sources(documents(spark).repartition(k), weights(spark))[0].collect())) for k in (1, 7)]
    assert runs[0] == runs[1]
    assert np.isfinite(len(runs[0]))


def test_copies_without_a_wanted_source_take_no_text(spark):
    docs = spark.createDataFrame([(1, None, "same text"), (2, "unweighted", "same text"), (3, "a", "same text")], "doc_id long, source string, text string")
    shares = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert [(r.source, r.doc_id) for r in mixing.mix_sources(docs, shares)[0].collect()] == [("a", 3)]
