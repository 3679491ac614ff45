"""Columns whose names are those that operators use inside, and tables of other operators' names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import (
    bpe, cover_tree, decontaminate, language, licences, mining, packing, personal, quality, search, secrets, simhash, token_files,
)

NAMES = ["_key", "_label", "_text", "_lang", "_hash", "_hit", "_bytes", "row", "key", "text_hash", "block", "query", "hash", "base",
         "_first", "_group", "ids", "start", "found", "own", "name"]
TOKENS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def table(docs):
    rows = [(i, f"some words number {i} of the text all rights reserved") for i in range(40)]
    rows += [(50, "the very same words of one text"), (51, "the very same words of one text"), (None, None)]
    return docs(rows, **{n: "x" for n in NAMES})


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "words number 3 of the text all rights reserved", *["y"] * len(NAMES))],
                                 "item_id INT, text STRING, " + ", ".join(f"`{n}` STRING" for n in NAMES))


@pytest.mark.parametrize("work", [
    lambda t, i: quality.score(t, quality.train(t, t.select(*t.columns, (F.col("doc_id") % 2).alias("quality")))),
    lambda t, i: token_files.round_trip(t, WORDS, 2),
    lambda t, i: decontaminate.report(t, i),
    lambda t, i: decontaminate.drop_contaminated(t, i),
    lambda t, i: decontaminate.remove_spans(t, i),
    lambda t, i: language.identify(t, language.train(t)),
    lambda t, i: licences.scan(t),
    lambda t, i: simhash.near_duplicates(t),
    lambda t, i: secrets.find(t),
    lambda t, i: secrets.redact(t),
    lambda t, i: personal.find(t, personal.train(t)),
    lambda t, i: personal.redact(t, personal.train(t)),
    lambda t, i: bpe.encode(t, TOKENS, public_tokenizers.PATTERN),
    lambda t, i: packing.pack(t, WORDS, 2),
    lambda t, i: search.search(t, i),
])
def test_text_operators(table, items, work):
    assert work(table, items).collect()


def test_vector_operators(spark):
    rows = [(i, i % 2, [float(i % 5), 1.0, float(i % 3)], *["x"] * len(NAMES)) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, label INT, embedding ARRAY<DOUBLE>, " + ", ".join(f"`{n}` STRING" for n in NAMES))
    assert cover_tree.near_vectors(df).count() == 60
    assert mining.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()


def test_pipeline(spark, table, items, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = table
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert name == "byte_level_bpe" or docs.columns == table.columns
    assert docs.count() > 0
