"""Benchmark decontamination: broadcast hash set of test n-grams against training windows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.storage import lookup

WINDOW = 10

# --- Fixed values: what separates words, and the letters that are lower-cased. ---
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# --- End of fixed values. ---


def lowered(text):
    """A-Z in lower case, all other characters as they are. Pure ASCII takes the quicker way."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text):
    """The words of a text in order; none for a null text."""
    text = F.coalesce(text, F.lit(""))
    return F.array_remove(F.split(lowered(text), SEPARATORS), "")


def window_hash(found, start, size):
    """Hash of the window of ``size`` words at ``start``: that of their array. Written out word by word, for
    Spark to compile with the scan; a function over the array is interpreted, at several times the cost."""
    return F.xxhash64(*[F.get(found, start + k) for k in range(size)])


def test_windows(items: DataFrame, key="item_id", text="text", window=WINDOW) -> DataFrame:
    """``(hash, size, gram, items)``: each distinct window of the test items, with its items.

    An item of fewer words than a window, but not none, is one window.
    """
    found = items.select(F.col(key).cast("string").alias("item"), words(F.col(text)).alias("found"))
    size = F.least(F.lit(window), F.size("found"))
    starts = F.sequence(F.lit(0), F.size("found") - window)
    full = F.transform(starts, lambda i: F.array(*[F.get("found", i + k) for k in range(window)]))
    every = F.when(F.size("found") >= window, full).otherwise(F.array("found"))
    grams = found.where(F.size("found") > 0).select("item", size.alias("size"), F.explode(every).alias("gram"))
    return grams.groupBy(F.xxhash64("gram").alias("hash"), "size", "gram").agg(F.collect_set("item").alias("items"))


def hits(df: DataFrame, items: DataFrame, key="doc_id", text="text", item_key="item_id", item_text="text",
         window=WINDOW) -> DataFrame:
    """``(key, text_hash, start, size, items)`` for each place of a text where a test window stands.

    ``text_hash`` tells apart rows that share a key; rows equal in both give the same places.
    Test windows are few against training windows: they are stored and broadcast if they measure up to
    64 MB, and joined by shuffle on their hash beyond that. Equal hashes are verified word by word.
    """
    grams = lookup(test_windows(items, item_key, item_text, window))
    # At most ``window`` sizes exist; most often there is one.
    sizes = sorted(grams.agg(F.collect_set("size")).first()[0]) or [window]
    found = df.select(F.col(key), F.xxhash64(F.col(text)).alias("text_hash"), words(F.col(text)).alias("found"))
    # Not a filter, which would be pushed below the words and split the text once more.
    enough = F.size("found") >= sizes[0]
    starts = F.when(enough, F.sequence(F.lit(0), F.size("found") - sizes[0]))
    placed = found.select(key, "text_hash", "found", F.explode(starts).alias("start"))
    if len(sizes) == 1:
        hashed = placed.withColumns({"size": F.lit(sizes[0]), "hash": window_hash(F.col("found"), F.col("start"), sizes[0])})
    else:
        hashed = placed.select("*", F.inline(F.array(*[
            F.struct(F.lit(s).alias("size"), F.when(F.col("start") + s <= F.size("found"), window_hash(
                F.col("found"), F.col("start"), s)).alias("hash"))
            for s in sizes
        ])))
    # From here on a row carries a window's words, not those of its text.
    here = F.array(*[F.get("found", F.col("start") + k) for k in range(sizes[-1])])
    probes = hashed.select(key, "text_hash", "start", "size", "hash", here.alias("here"))
    grams = grams.select(F.col("hash").alias("gram_hash"), F.col("size").alias("gram_size"), "gram", "items")
    met = probes.join(grams, (F.col("hash") == F.col("gram_hash")) & (F.col("size") == F.col("gram_size")))
    # Each side holds a column of both tables: else the words would become a key of the join, to be
    # hashed for every window and not for hits alone.
    taken = F.struct(F.slice("here", F.lit(1), F.col("size")), F.col("gram_hash"))
    verified = met.where(taken == F.struct(F.col("gram"), F.col("hash")))
    return verified.select(key, "text_hash", "start", "size", "items")


def report(df: DataFrame, items: DataFrame, key="doc_id", text="text", **options) -> DataFrame:
    """``(key, n_words, n_hit, items, contaminated)``, one row per input row.

    ``n_hit`` counts the words inside any occurrence of a test window, ``items`` are the sorted
    ids of the items with occurring windows, as strings. A null text has no words; null keys
    and repeated rows are kept and reported each. Empty tables on either side give no hits.
    """
    found = hits(df, items, key, text, **options)
    # Rows that share key and text repeat the same places: sets drop the repeats.
    hit = F.struct(F.col(key).alias("key"), F.col("text_hash").alias("text"))
    per_text = found.groupBy(hit.alias("_hit")).agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("_spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_items"),
    )
    covered = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda done, s: F.struct(
            F.greatest(done["end"], s["end"]).alias("end"),
            (done["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(done["end"], s["start"]))).alias("n")),
        lambda done: done["n"])
    per_text = per_text.select("_hit", covered.alias("n_hit"), "_items")
    rows = df.select(
        F.col(key), F.size(words(F.col(text))).cast("bigint").alias("n_words"),
        F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text")).alias("_hit"),
    )
    joined = rows.join(per_text, "_hit", "left")
    return joined.select(
        key, "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(df: DataFrame, items: DataFrame, key="doc_id", text="text", **options) -> DataFrame:
    """The rows of which no word lies in a test window, with all their columns."""
    found = hits(df, items, key, text, **options)
    gone = lookup(found.select(F.col(key).alias("_key"), F.col("text_hash").alias("_text")).distinct())
    rows = df.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"))
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("hash") == F.col("_text"))
    return rows.join(gone, same, "left_anti").select("row.*")


def remove_spans(df: DataFrame, items: DataFrame, key="doc_id", text="text", **options) -> DataFrame:
    """``(key, words)``: the normalised words of every text without those in a test window."""
    found = hits(df, items, key, text, **options)
    hit = F.struct(F.col(key).alias("key"), F.col("text_hash").alias("text"))
    spans = found.groupBy(hit.alias("_hit")).agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("_spans"))
    rows = df.select(
        F.col(key), words(F.col(text)).alias("_words"),
        F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text")).alias("_hit"),
    ).join(spans, "_hit", "left")

    def gap(done, s):
        """The words between the spans so far and the next one, if it does not touch them."""
        one = F.struct(done["end"].alias("start"), s["start"].alias("end"))
        gaps = F.when(s["start"] > done["end"], F.concat(done["gaps"], F.array(one))).otherwise(done["gaps"])
        return F.struct(F.greatest(done["end"], s["end"]).alias("end"), gaps.alias("gaps"))

    first = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("gaps"))
    gaps = F.aggregate("_spans", first, gap, lambda done: F.concat(done["gaps"], F.array(
        F.struct(done["end"].alias("start"), F.size("_words").alias("end")))))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice("_words", g["start"] + 1, g["end"] - g["start"])))
    return rows.select(key, F.when(F.col("_spans").isNull(), F.col("_words")).otherwise(kept).alias("words"))
