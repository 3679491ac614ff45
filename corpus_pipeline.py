"""A training-corpus pipeline over ``documents``: each stage works on what the one before kept."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, decontaminate, language, secrets, simhash
from barloom.llm.queries import bpe_digests, table
from barloom.llm.storage import lookup, stored

#: Text that no learned language codes in fewer bits a byte than this is in none of them. Text of a
#: learned language takes some 2 to 4 bits, and up to 8 where it is short and holds keys or
#: numbers; a script that was never seen takes about 20, as each byte escapes all contexts.
FOREIGN_BITS = 14.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those that the table's ``lang`` column teaches."""
    model = language.train(docs)
    whole = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    found = language.identify(whole, model, key="row")
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("bits_per_byte") < FOREIGN_BITS)
    return found.where(kept).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints: the one of the smallest id.

    Rows without an id come last; among rows of one id the hash of the whole row decides, and of
    rows alike in every column one stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.xxhash64("*").alias("row"))
    whole = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"), key.alias("key"))
    found = stored(simhash.near_duplicates(whole, key="key").select("key", (F.col("key") == F.col("component_id")).alias("first")))
    # Whole rows stay where they are as long as the keys that go, and those held twice, are few.
    gone = lookup(found.where("NOT first").select("key").distinct())
    twice = lookup(found.where("first").groupBy("key").count().where("count > 1").select("key"))
    kept = whole.join(gone, "key", "left_anti")
    once = kept.join(twice, "key", "left_anti")
    again = kept.join(twice, "key", "left_semi").dropDuplicates(["key"])
    return once.union(again).select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark and ``n_chars`` brought up to date."""
    return secrets.redact(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_tokens, ids_sha256, decoded_sha256)`` of every document's text."""
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    # Stored in between, so that a task needs one Python worker at a time and not two.
    coded = stored(bpe.encode(docs, tokens, public_tokenizers.PATTERN), compression="zstd")
    return bpe_digests(coded, tokens, "ids")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL can express neither code lengths, SimHash nor byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; each stage is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
