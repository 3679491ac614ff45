import random

from pyspark.sql import functions as F

from barloom.operators import duplicates
from barloom.operators.quality import duplicate_keys


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rows_equal_those_of_a_plain_count(spark, monkeypatch):
    rng = random.Random(1)
    data = [(rng.choice([None, *range(30)]), rng.choice([None, "a", "b", "ç"]), 1.5) for _ in range(300)] + [(7, "hot", 0.0)] * 500
    data += [(i, "once", 2.0) for i in range(1000, 3000)]
    df = spark.createDataFrame(data, "k INT, `s t` STRING, segment DOUBLE").repartition(5)
    for merged, held in ((1 << 20, 1 << 22), (100, 1), (1, 10)):
        monkeypatch.setattr(duplicates, "MERGED_KEYS", merged)
        assert rows(duplicates.repeated_keys(df, ["k", "`s t`"])) == rows(duplicate_keys(df, ["k", "`s t`"]))
    assert duplicates.repeated_keys(df.limit(0), ["k"]).count() == 0


def test_equal_hashes_of_other_keys_are_no_duplicates(spark, monkeypatch):
    """All keys share one slot, so all are suspects, and are counted apart."""
    monkeypatch.setattr(duplicates.F, "xxhash64", lambda *columns: F.lit(5).cast("bigint"))
    df = spark.range(0, 50, 1, 4).select((F.col("id") % 49).alias("id"))
    assert rows(duplicates.repeated_keys(df, ["id"])) == [(0, 2)]


def test_far_less_is_shuffled_than_the_keys(spark):
    """Sketches are some four bytes a key, where rows of keys take thirty and more."""
    df = spark.range(0, 400_000, 1, 4).select(F.concat(F.lit("a key of some length "), "id").alias("name"), "id")
    hashed = df.select(F.xxhash64("name", "id").alias("_hash"))
    sent = hashed.mapInArrow(duplicates._sketches(1), duplicates.SKETCH)
    size = sent.agg(F.sum(F.octet_length("once") + F.octet_length("again") + 8)).first()[0]
    assert size < 5 * 400_000 and duplicates.repeated_keys(df, ["name", "id"]).count() == 0
