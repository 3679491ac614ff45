"""Each operator applied to its whole table: (spark, folder) -> DataFrame."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    bpe, cover_tree, decontaminate, language, licences, mining, packing, personal, quality, search, secrets, simhash, token_files,
)

QUERIES = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder, name) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op7_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


@query
def op10_bpe(spark, folder):
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(table(spark, folder, "documents"), tokens, public_tokenizers.PATTERN)
    return bpe_digests(coded, tokens)


def bpe_digests(coded: DataFrame, tokens, *keep) -> DataFrame:
    """Number and checksum of the ids of each document, and checksum of the bytes decoded from them."""
    listed = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    counted = coded.withColumns({
        "n_tokens": F.size("ids").cast("bigint"), "ids_sha256": F.sha2(listed.cast("binary"), 256)})
    decoded = bpe.decode(counted, tokens, ["doc_id", *keep, "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", *keep, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def fold(key, folds):
    """The rows' fold, from the checksum of the key as text; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


@query
def op5_language(spark, folder):
    documents = table(spark, folder, "documents")
    model = language.train(documents.where(fold("doc_id", 3) != 1))
    found = language.identify(documents, model)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op3_decontaminate(spark, folder):
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def listed(spans):
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(text):
    return F.sha2(text.cast("binary"), 256)


def per_kind(spans, kinds):
    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return [count(kind) for kind in kinds]


@query
def op8_secrets(spark, folder):
    found = secrets.find(table(spark, folder, "documents"))
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("spans", lambda s: s["rank"] < len(kinds))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *per_kind(F.col("spans"), kinds),
        digest(listed(base)).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


@query
def op9_personal(spark, folder):
    documents = table(spark, folder, "documents")
    found = personal.find(documents, personal.train(documents))
    every = F.array_sort(F.concat("base", "more"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *per_kind(F.col("base"), personal.KINDS),
        digest(listed(F.col("base"))).alias("base_sha256"), listed(every).alias("spans"),
    )


@query
def op1_quality(spark, folder):
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    model = quality.train(documents, labels.where(fold("doc_id", 5) != 0))
    found = quality.score(documents, model)
    return found.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op2_token_files(spark, folder):
    found = token_files.round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, special=True)
    return found.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
    )


@query
def op4_cover_tree(spark, folder):
    return cover_tree.near_vectors(table(spark, folder, "embeddings"))


@query
def op6_licences(spark, folder):
    found = licences.scan(table(spark, folder, "documents"))
    starts = F.transform("places", lambda p: p["word"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    every = F.array_union(base, F.transform("spans", lambda s: s["label"]))
    covered = F.array_max(F.transform("spans", lambda s: s["coverage"]))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(covered, F.lit(0.0))).alias("score"),
    )


@query
def op11_packing(spark, folder):
    packed = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, special=True)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op12_lexical_search(spark, folder):
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_hard_negatives(spark, folder):
    rows = table(spark, folder, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0)
