import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import mining


def plain(rows, anchor, positives=5, negatives=10):
    """Brute force over (key, label, vector) rows, in exact whole numbers."""
    fine = [(k, lab, [math.floor(256 * x) for x in v]) for k, lab, v in rows
            if k is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, (key, lab, own) in enumerate(fine):
        if not anchor(key):
            continue
        scored = sorted((-sum(a * b for a, b in zip(own, v)), k, other) for j, (k, other, v) in enumerate(fine) if j != i and len(v) == len(own))
        for ps, pk, _ in [s for s in scored if s[2] == lab][:positives]:
            near = [(k, -s) for s, k, other in scored if other != lab and 30 * -ps <= 100 * -s <= 90 * -ps][:negatives]
            out += [(key, pk, rank, k, -ps, s) for rank, (k, s) in enumerate(near, 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    middle = rng.normal(size=(4, 6))
    made = [(i, int(i % 4), (middle[i % 4] + rng.normal(size=6)).round(2).tolist()) for i in range(240)]
    made += [(300 + i, 1, made[8][2]) for i in range(60)]
    made += [(400 + i, i % 3, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(40)]
    made += [(500, 1, None), (501, None, made[0][2]), (None, 1, made[0][2]), (502, 2, [1.0, None, 2.0, 0.0, 0.0, 1.0]),
             (503, 2, [1.0, float("nan"), 2.0, 0.0, 0.0, 1.0]), (504, 2, [float("inf")] * 6), (505, 1, []), (506, 1, []), (510, 2, []),
             (507, 9, [0.5] * 6), (508, 3, [0.0] * 6), (509, 0, [-9.0] * 6), (17, 1, made[17][2])]
    return made


def frame(spark, rows):
    listed = [(*r, "b", 1, 2) for r in rows]
    return spark.createDataFrame(listed, "vec_id BIGINT, label INT, embedding ARRAY<DOUBLE>, block STRING, `group` INT, at INT")


@pytest.mark.parametrize("block_rows, group_anchors", [(1024, 4096), (16, 5)])
def test_matches_brute_force(spark, rows, monkeypatch, block_rows, group_anchors):
    if block_rows < 1024:
        monkeypatch.setattr(mining, "CHUNK", 3)
    found = mining.hard_negatives(frame(spark, rows), F.col("vec_id") % 5 == 0, block_rows=block_rows, group_anchors=group_anchors)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain(rows, lambda k: k % 5 == 0)
    assert expected and sorted(map(tuple, found.collect()), key=str) == expected


def test_many_slices_and_tasks(spark, rows):
    blocks = mining.blocked(mining.stored(mining.placed(mining.usable(frame(spark, rows), F.col("vec_id") % 5 == 0, "vec_id", "embedding", "label"))), 8)
    anchors = mining.grouped(mining.anchors_of(blocks, 5), 7).withColumn(
        "ranges", F.array(F.struct(F.col("least").alias("low"), F.lit(mining.MOST).alias("high"))))
    once = mining.chosen_blocks(blocks, anchors, True)
    assert sorted(map(str, once.collect())) == sorted(map(str, mining.chosen_blocks(blocks, anchors, True, 100).collect()))
    one, many = (mining._first(mining.met(blocks, anchors, 5, True, n), ["block", "at"], 5) for n in (1000, 2))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    # Zone maps leave blocks of other labels and far ones unread.
    assert once.count() < anchors.select("group").distinct().count() * blocks.count() / 2


def test_empty_tables(spark, rows):
    empty = frame(spark, rows).limit(0)
    assert mining.hard_negatives(empty, F.col("vec_id") % 5 == 0).count() == 0
    assert mining.hard_negatives(frame(spark, rows), F.lit(False)).count() == 0
    assert mining.hard_negatives(frame(spark, rows), F.lit(None).cast("boolean")).count() == 0


def test_text_keys_and_labels(spark, rows):
    named = [(f"k{k}", f"l{lab}", v) for k, lab, v in rows if None not in (k, lab)]
    df = spark.createDataFrame(named, "vec_id STRING, label STRING, embedding ARRAY<DOUBLE>")
    found = mining.hard_negatives(df, F.col("vec_id").endswith("0"), block_rows=32)
    assert sorted(map(tuple, found.collect()), key=str) == plain(named, lambda k: k.endswith("0"))


@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 2), (1, 4), (5, 2)])
def test_the_curve_visits_each_cell_once_in_steps_of_one(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions).astype(np.uint8)
    order = sorted(range(len(cells)), key=[r.tobytes() for r in mining.hilbert(cells, bits)].__getitem__)
    assert len({r.tobytes() for r in mining.hilbert(cells, bits)}) == len(cells)
    assert (np.abs(np.diff(cells[order].astype(int), axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_for_every_row():
    rng = np.random.default_rng(1)
    anchors, block = rng.integers(-300, 300, (20, 8)), rng.integers(-300, 300, (50, 8))
    least, most = mining.bounds(anchors, block.min(axis=0)[None], block.max(axis=0)[None])
    scores = mining.products(anchors, block)
    assert (scores.min(axis=1) >= least[:, 0]).all() and (scores.max(axis=1) <= most[:, 0]).all()
    large = rng.integers(-2**28, 2**28, (3, 8))
    assert mining.products(large, large).tolist() == [[sum(map(int.__mul__, a, b)) for b in large.tolist()] for a in large.tolist()]
