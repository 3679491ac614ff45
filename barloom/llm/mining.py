"""Hard negatives of anchor vectors, from Hilbert-ordered blocks that zone maps choose.

Candidates are sorted by vector length, label and place on a Hilbert curve through all dimensions,
and stored in blocks with the least and largest value of each dimension. Interval arithmetic bounds
an anchor's inner products with a whole block; blocks whose bounds miss all that an anchor still looks
for are not read for it.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.storage import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
BLOCK_ROWS = 1024
BLOCK_BYTES = 1 << 20
#: Anchors that meet the same blocks together, blocks that one task reads for them, and zone maps compared at once.
GROUP_ANCHORS = 4096
TASK_BLOCKS = 16
ZONE_BYTES = 32 << 20
CHUNK = 256
CURVE_BITS = 2
LEAST, MOST = -(1 << 62), 1 << 62


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers below ``2**bits``, as rows of bytes that sort alike.

    Per bit from the top, each dimension in turn reflects or exchanges the lower bits of the first (J. Skilling's
    transposed form); a Gray code over the dimensions follows.
    """
    axes = cells.T.astype(np.uint8)
    if not len(axes):
        return np.zeros((len(cells), 0), np.uint8)
    for bit in range(bits - 1, 0, -1):
        low = np.uint8((1 << bit) - 1)
        for own in axes:
            flip = (own >> bit & 1).astype(bool)
            moved = np.where(flip, 0, (axes[0] ^ own) & low).astype(np.uint8)
            axes[0] ^= np.where(flip, low, moved).astype(np.uint8)
            own ^= moved
    axes = np.bitwise_xor.accumulate(axes, axis=0)
    turn = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] >> bit & 1, np.uint8((1 << bit) - 1), np.uint8(0))
    axes ^= turn
    planes = np.stack([axes >> bit & 1 for bit in range(bits - 1, -1, -1)])
    return np.packbits(planes.transpose(2, 0, 1).reshape(len(cells), -1), axis=1)


def cells_of(vectors: np.ndarray) -> np.ndarray:
    """Four cells a dimension, cut at zero and at two thirds of the vector's root mean square on both sides."""
    spread = np.sqrt(np.mean(np.square(vectors, dtype=np.float64), axis=1, keepdims=True)) * (2 / 3)
    return (vectors >= -spread).astype(np.uint8) + (vectors >= 0) + (vectors > spread)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows, by floating-point numbers where they hold every partial sum."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if most < 2 ** 53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


def bounds(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray):
    """Least and largest inner product of each anchor with any vector of each block, by interval arithmetic."""
    plus, minus = np.maximum(anchors, 0).astype(np.float64), np.minimum(anchors, 0).astype(np.float64)
    lows, highs = lows.astype(np.float64).T, highs.astype(np.float64).T
    slack = 1e-9 * (np.abs(anchors).astype(np.float64) @ np.maximum(np.abs(lows), np.abs(highs))) + 1e-9
    return plus @ lows + minus @ highs - slack, plus @ highs + minus @ lows + slack


def _matrix(data: bytes, rows, size) -> np.ndarray:
    """Stored vectors as rows of a matrix."""
    return np.frombuffer(data, "<i8").reshape(rows, size)


def usable(df: DataFrame, anchor, key, vector, label) -> DataFrame:
    """``(key, label, anchor, vector)`` of the rows that take part."""
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), anchor.alias("anchor"),
                     F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("key").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)


def placed(rows: DataFrame, scale=SCALE) -> DataFrame:
    """``(key, label, anchor, size, place, vector)``: whole-numbered components and the place on the curve."""
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("size", T.IntegerType()),
                           T.StructField("place", T.BinaryType()), T.StructField("vector", T.BinaryType())])

    def run(batches):
        for batch in batches:
            column = batch.column(3)
            sizes = np.diff(column.offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                some = pa.array(np.flatnonzero(sizes == size))
                flat = column.take(some).flatten().to_numpy(zero_copy_only=False)
                whole = np.clip(np.floor(flat * scale), LEAST, MOST).astype("<i8").reshape(len(some), size)
                curve = hilbert(cells_of(whole), CURVE_BITS) if size else np.zeros((len(some), 0), np.uint8)
                values = [pa.array([size] * len(some), pa.int32()), *(pa.array([r.tobytes() for r in m], pa.binary()) for m in (curve, whole))]
                kept = [batch.column(i).take(some) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*kept, *values], names=schema.names)

    return rows.mapInArrow(run, schema)


def blocked(points: DataFrame, block_rows=BLOCK_ROWS) -> DataFrame:
    """One stored row per block: its number, vector length, zone maps, and its rows in ascending order of keys."""
    key, label = points.schema["key"].dataType, points.schema["label"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("size", T.IntegerType()),
        T.StructField("lows", T.BinaryType()), T.StructField("highs", T.BinaryType()),
        T.StructField("only", label), T.StructField("keys", T.ArrayType(key)), T.StructField("labels", T.ArrayType(label)),
        T.StructField("anchors", T.ArrayType(T.BooleanType())), T.StructField("vectors", T.BinaryType()),
    ])
    order = ["size", "label", "place", "key"]
    dealt = points.repartitionByRange(*order).sortWithinPartitions(*order, "vector")

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        kinds, rest = None, None

        def block(table):
            nonlocal number
            keys = table["key"].to_pylist()
            table = table.take(pa.array(sorted(range(len(keys)), key=keys.__getitem__), pa.int64()))
            vectors = _matrix(b"".join(table["vector"].to_pylist()), len(table), table["size"][0].as_py())
            labels = table["label"].to_pylist()
            only = labels[0] if labels.count(labels[0]) == len(labels) else None
            columns = [number, vectors.shape[1], vectors.min(axis=0).tobytes(), vectors.max(axis=0).tobytes(), only,
                       table["key"].to_pylist(), labels, table["anchor"].to_pylist(), vectors.tobytes()]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds)], names=schema.names)

        def full(table, last):
            """The leading blocks of equal vector length, and the rows that may still grow."""
            parts = []
            while len(table):
                sizes = table["size"].to_numpy()
                run = int(np.append(sizes != sizes[0], True).argmax())
                step = max(1, min(block_rows, BLOCK_BYTES // max(1, 8 * int(sizes[0]))))
                if run == len(table) < step and not last:
                    break
                parts.append(table.slice(0, min(run, step)))
                table = table.slice(min(run, step))
            return parts, table

        for batch in batches:
            key, label = batch.schema.field("key").type, batch.schema.field("label").type
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), label, pa.list_(key), pa.list_(label), pa.list_(pa.bool_()), pa.binary()]
            table = pa.Table.from_batches([batch])
            parts, rest = full(pa.concat_tables([rest, table]) if rest else table, False)
            yield from map(block, parts)
        if rest:
            yield from map(block, full(rest, True)[0])

    # Row groups of a block or two, so that a filter on blocks leaves the others unread.
    return stored(dealt.mapInArrow(run, schema), **{"parquet.block.size": str(BLOCK_BYTES)})


def anchors_of(blocks: DataFrame, positives: int) -> DataFrame:
    """Every anchor with its place (``block``, ``at``) and ``least``: the score that its own block already
    gives its last positive, if the block holds that many."""
    key, label = (blocks.schema[c].dataType.elementType for c in ("keys", "labels"))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("size", T.IntegerType()),
        T.StructField("key", key), T.StructField("label", label), T.StructField("vector", T.BinaryType()), T.StructField("least", T.LongType()),
    ])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                places = np.flatnonzero(row["anchors"])
                if not len(places):
                    continue
                vectors = _matrix(row["vectors"], len(row["keys"]), row["size"])
                codes = np.unique(row["labels"], return_inverse=True)[1]
                leasts = []
                for at in range(0, len(places), CHUNK):
                    some = places[at:at + CHUNK]
                    scores = np.where(codes[some, None] == codes, products(vectors[some], vectors), LEAST)
                    scores[np.arange(len(some)), some] = LEAST
                    enough = len(codes) > positives
                    leasts += np.partition(scores, -positives, axis=1)[:, -positives].tolist() if enough else [LEAST] * len(some)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["block"]] * len(places)), pa.array(places, pa.int32()), pa.array([row["size"]] * len(places), pa.int32()),
                    *(pa.array([row[c][i] for i in places], batch.schema.field(c).type.value_type) for c in ("keys", "labels")),
                    pa.array([vectors[i].tobytes() for i in places], pa.binary()), pa.array(leasts, pa.int64())], names=schema.names)

    return blocks.where(F.exists("anchors", lambda a: a)).select("block", "size", "keys", "labels", "anchors", "vectors").mapInArrow(run, schema)


def grouped(anchors: DataFrame, group_anchors=GROUP_ANCHORS) -> DataFrame:
    """The anchors with a group of about ``group_anchors`` neighbours each, all of one vector length."""
    count = anchors.count()
    shares = [i * group_anchors / count for i in range(1, -(-count // group_anchors))]
    cuts = anchors.agg(F.percentile_approx("block", shares, 100 * len(shares))).first()[0] if shares else []
    own = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: c < F.col("block")))
    return stored(anchors.withColumn("group", F.struct("size", own.alias("number"))))


@dataclass
class Wanted:
    """Anchors of one group and what each still looks for: ranges ``low`` to ``high``, one row per anchor.

    ``best`` holds the rows found for each range, ``count`` at most; ``least`` is the score of the last of them.
    """

    vectors: np.ndarray
    labels: list
    low: np.ndarray
    high: np.ndarray
    count: int
    same: bool
    places: list = field(default_factory=list)
    best: dict = field(default_factory=dict)

    def chosen(self, lows, highs, only):
        """Which anchors have a range that scores with each block may fall into."""
        least, most = bounds(self.vectors, lows, highs)
        return self._meets(least, most) & self._labelled(only)

    def _meets(self, least, most):
        hit = np.zeros(least.shape, bool)
        for j in range(self.low.shape[1]):
            low, high = self.low[:, j, None], self.high[:, j, None]
            hit |= (low <= high) & (most >= low) & (least <= high)
        return hit

    def _labelled(self, only):
        """False where all rows of a block have the label that an anchor does not look for."""
        return np.array([[o is None or (o == label) == self.same for o in only] for label in self.labels], bool).reshape(len(self.labels), len(only))

    def add(self, block, keys, labels, vectors, lows, highs, only):
        """Take the block's rows that are among the best of a range so far."""
        rows = np.flatnonzero(self.chosen(lows, highs, [only])[:, 0])
        codes = {label: i for i, label in enumerate(dict.fromkeys(labels))}
        coded = np.array([codes[label] for label in labels])
        for first in range(0, len(rows), CHUNK):
            some = rows[first:first + CHUNK]
            scores = products(self.vectors[some], vectors)
            own = np.array([codes.get(self.labels[i], -1) for i in some])
            fits = (own[:, None] == coded) == self.same
            for k, i in enumerate(some.tolist()):
                if self.places[i][0] == block:
                    fits[k, self.places[i][1]] = False
            for j in range(self.low.shape[1]):
                hit = fits & (scores >= self.low[some, j, None]) & (scores <= self.high[some, j, None])
                for k in np.flatnonzero(hit.any(axis=1)).tolist():
                    self._merge(int(some[k]), j, np.flatnonzero(hit[k]), scores[k], keys)

    def _merge(self, i, j, at, scores, keys):
        if len(at) > self.count:
            # Rows of a block are in ascending order of keys, which decides among equal scores.
            at = at[np.argsort(-scores[at], kind="stable")[:self.count]]
        best = self.best.setdefault((i, j), [])
        best += [(int(scores[a]), keys[a]) for a in at.tolist()]
        best.sort(key=lambda b: (-b[0], b[1]))
        del best[self.count:]
        if len(best) == self.count:
            self.low[i, j] = max(self.low[i, j], best[-1][0])


def _wanted(rows, count, same) -> Wanted:
    """Of anchors' rows (dictionaries) with ``ranges``."""
    size = rows[0]["size"]
    vectors = _matrix(b"".join(r["vector"] for r in rows), len(rows), size)
    ranges = np.array([[[x["low"], x["high"]] for x in r["ranges"]] for r in rows], np.int64)
    return Wanted(vectors, [r["label"] for r in rows], ranges[:, :, 0].copy(), ranges[:, :, 1].copy(), count, same,
                  [(r["block"], r["at"]) for r in rows])


def chosen_blocks(blocks: DataFrame, anchors: DataFrame, same: bool, zone_bytes=ZONE_BYTES) -> DataFrame:
    """``(group, number)``: the blocks that some anchor of a group needs, by zone maps alone, stored.

    Zone maps are compared ``zone_bytes`` of them at a time, in blocks of anchors.
    """
    spark = blocks.sparkSession
    zones = blocks.select("block", "size", "lows", "highs", "only")
    total = zones.agg(F.sum(F.octet_length("lows") * 2 + 64)).first()[0] or 0
    slices = max(1, -(-total // zone_bytes))
    schema = T.StructType([anchors.schema["group"], T.StructField("number", T.LongType())])
    columns = ["group", "block", "at", "size", "label", "vector", "ranges"]
    found = []
    for part in range(slices):
        some = zones.where(F.pmod(F.xxhash64("block"), F.lit(slices)) == part).collect()
        by_size = {}
        for z in some:
            by_size.setdefault(z["size"], []).append((z["block"], z["lows"], z["highs"], z["only"]))
        shared = spark.sparkContext.broadcast(by_size)

        def run(batches, shared=shared):
            for batch in batches:
                groups, met = {}, {}
                for row in batch.to_pylist():
                    groups.setdefault((row["group"]["size"], row["group"]["number"]), []).append(row)
                for (size, group), rows in groups.items():
                    own = shared.value.get(size, [])
                    if not own:
                        continue
                    lows, highs = (_matrix(b"".join(z[i] for z in own), len(own), size) for i in (1, 2))
                    for at in range(0, len(rows), CHUNK):
                        hit = _wanted(rows[at:at + CHUNK], 1, same).chosen(lows, highs, [z[3] for z in own]).any(axis=0)
                        met.setdefault((size, group), set()).update(own[i][0] for i in np.flatnonzero(hit).tolist())
                pairs = [({"size": s, "number": g}, b) for (s, g), own in met.items() for b in sorted(own)]
                kind = batch.schema.field("group").type
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g for g, _ in pairs], kind), pa.array([b for _, b in pairs], pa.int64())], names=schema.names)

        found.append(stored(anchors.select(*columns).mapInArrow(run, schema).distinct()))
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


def met(blocks: DataFrame, anchors: DataFrame, count: int, same: bool, task_blocks=TASK_BLOCKS) -> DataFrame:
    """``(block, at, range, score, key)``: for every range of an anchor the best rows that each task has found.

    ``same`` looks for rows of the anchor's label, else for those of other labels. A group's blocks are dealt to tasks of
    about ``task_blocks``, each of which gets the group's anchors and reads its blocks one after the other.
    """
    pairs = stored(chosen_blocks(blocks, anchors, same))
    tasks = pairs.groupBy("group").agg(F.ceil(F.count("*") / task_blocks).cast("int").alias("tasks"))
    task = F.pmod(F.xxhash64("number"), F.col("tasks")).cast("int")
    dealt = pairs.join(tasks, "group").select("group", task.alias("task"), F.col("number").alias("block"))
    candidates = dealt.join(blocks, "block")
    sides = anchors.join(tasks, "group").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    asking = sides.select("group", "task", F.struct("block", "at", "size", "label", "vector", "ranges").alias("anchor"))
    reading = candidates.select(
        "group", "task", F.struct("block", "size", "lows", "highs", "only", "keys", "labels", "vectors").alias("candidate"))
    both = asking.unionByName(reading, allowMissingColumns=True)
    order = F.col("anchor").isNull()
    key = blocks.schema["keys"].dataType.elementType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("range", T.IntegerType()),
        T.StructField("score", T.LongType()), T.StructField("key", key)])
    stream = both.repartition("group", "task").sortWithinPartitions("group", "task", order).select("group", "task", "anchor", "candidate")

    def run(batches):
        current, rows, wanted, kind = None, [], None, None

        def result():
            best = [(*wanted.places[i], j, *b) for (i, j), own in wanted.best.items() for b in own] if wanted else []
            columns = zip(*best) if best else ((),) * 5
            kinds = pa.int64(), pa.int32(), pa.int32(), pa.int64(), kind
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

        for batch in batches:
            kind = batch.schema.field("candidate").type.field("keys").type.value_type
            for at in range(batch.num_rows):
                row = {c: batch.column(i)[at].as_py() for i, c in enumerate(batch.schema.names)}
                own = row["group"]["size"], row["group"]["number"], row["task"]
                if own != current:
                    if wanted:
                        yield result()
                    current, rows, wanted = own, [], None
                if row["anchor"] is not None:
                    rows.append(row["anchor"])
                    continue
                wanted = wanted or _wanted(rows, count, same)
                c = row["candidate"]
                lows, highs = (_matrix(c[n], 1, c["size"]) for n in ("lows", "highs"))
                wanted.add(c["block"], c["keys"], c["labels"], _matrix(c["vectors"], len(c["keys"]), c["size"]), lows, highs, c["only"])
        if wanted:
            yield result()

    return stream.mapInArrow(run, schema)


def _first(rows: DataFrame, by, count) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "key")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(df: DataFrame, anchor, key="vec_id", vector="embedding", label="label", scale=SCALE, positives=POSITIVES,
                   negatives=NEGATIVES, low=LOW, high=HIGH, block_rows=BLOCK_ROWS, group_anchors=GROUP_ANCHORS) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` is a condition that marks the anchors. Components become ``floor(scale * x)``; a score is the whole-numbered
    inner product with the anchor, higher ones first, then smaller keys. An anchor's positives are its first ``positives``
    other rows of its label; for each, the first ``negatives`` rows of other labels come out whose score lies from ``low``
    to ``high`` percent of the positive's.

    Rows with a null key, label, vector or component, or one that is not finite, take no part; a null condition is false.
    Vectors meet only those of their own length, empty ones score 0. Rows that share a key are rows of their own: an anchor's
    own row alone is not its positive. Scores are 64-bit integers. Keys and labels may be of any ordered type.
    """
    rows = usable(df, F.coalesce(anchor, F.lit(False)), key, vector, label)
    blocks = blocked(stored(placed(rows, scale)), block_rows)
    anchors = grouped(anchors_of(blocks, positives), group_anchors)
    bound = F.struct(F.col("least").alias("low"), F.lit(MOST).alias("high"))
    near = _first(met(blocks, anchors.withColumn("ranges", F.array(bound)), positives, True), ["block", "at"], positives)
    listed = near.groupBy("block", "at").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "key"))).alias("positives"))
    asking = stored(anchors.join(listed, ["block", "at"]))

    def floored(x):
        return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))

    def window(p):
        return F.struct((-floored(p["score"] * -low)).alias("low"), floored(p["score"] * high).alias("high"))

    padded = F.slice(F.concat(F.transform("positives", window), F.array_repeat(
        F.struct(F.lit(MOST).alias("low"), F.lit(LEAST).alias("high")), positives)), 1, positives)
    found = _first(met(blocks, asking.withColumn("ranges", padded), negatives, False), ["block", "at", "range"], negatives)
    named = asking.select("block", "at", F.col("key").alias("anchor_id"), "positives")
    return found.join(named, ["block", "at"]).select(
        "anchor_id", F.col("positives")[F.col("range")]["key"].alias("positive_id"), "rank", F.col("key").alias("negative_id"),
        F.col("positives")[F.col("range")]["score"].alias("positive_score"), F.col("score").alias("negative_score"))
