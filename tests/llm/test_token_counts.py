"""Token counts against the library that the vocabulary belongs to."""

import random

import fixtures
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tillmark.llm import queries, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return token_counts.Pieces.load(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def strings():
    rng = random.Random(4)
    signs = "aeitnosrl  ▁\n\t\x00é語벨<s>/0x0A123🎉.,"
    found = ["", " ", "   ", "▁", "<s>", "</s> <unk> <0x0A>", "\x00", "x" * 50_000, "ab " * 50_000, " " * 20_000, "é" * 999, "🎉 " * 999]
    found += ["aaaaaaa", "▁a▁", "A\r\nB", "﻿x", "é", "ﬁ ①", "　a b"]
    return found + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]


def test_counts_equal_the_library(pieces, library):
    count = token_counts.counter(pieces)
    texts = strings()
    assert [count(t) for t in texts] == [len(x) for x in library.encode(texts, num_threads=1)]
    assert count(None) == 0


def test_whole_text_as_one_segment(pieces, library):
    for text in strings()[:300]:
        normal = library.normalize(text)
        if normal and len(normal) < 3000:
            assert token_counts.merged_count(normal, pieces.ranks) == len(library.encode(text))


def test_remembered_segments_are_bounded(pieces, library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    count = token_counts.counter(pieces)
    for text in strings()[-500:]:
        assert count(text) == len(library.encode(text))
    found = token_counts.Segments(pieces.ranks)
    assert [found[f"▁{n}"] for n in range(100)] and len(found) <= 10


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        token_counts.Pieces.load(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "awkward"])
def test_query_equals_the_library(spark, library, tmp_path, folder):
    if folder == "awkward":
        folder = str(tmp_path)
        documents = fixtures.clashing(spark).unionByName(
            spark.createDataFrame([(9000 + i, t, None, None, None) for i, t in enumerate(strings()[:200])], fixtures.SCHEMA),
            allowMissingColumns=True,
        )
        documents.write.parquet(f"{folder}/documents.parquet")
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for row in rows:
        n = len(library.encode(row.text or ""))
        want.append((row.doc_id, len((row.text or "").encode()), n, n > 4096))
    got = [tuple(r) for r in queries.op12_token_counts(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table_and_other_columns(spark, pieces):
    tokens = token_counts.tokens(F.col("text"), pieces)
    assert fixtures.empty(spark).withColumn("n", tokens).count() == 0
    documents = fixtures.clashing(spark)
    fixtures.kept_clashes(documents, documents.withColumn("n", tokens))
