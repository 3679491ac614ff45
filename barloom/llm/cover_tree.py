"""Near-duplicate vectors by dual traversal of cover trees."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.components import components
from barloom.llm.storage import lookup, stored

SIMILARITY = 0.98
BLOCK_ROWS = 2048
PIVOT_SAMPLE = 4096
#: Blocks of a label that one task compares with all its blocks.
SHARE_BLOCKS = 256
PICKS = 128
CELLS = 1 << 20
SLACK = 1e-7
#: Below this radius cosines in double precision no longer tell the members of a node apart.
FINEST = 1e-7
#: Pairs whose vectors are compared at once.
COMPARED = 1 << 18


class CoverTree:
    """Nested nets of unit vectors with halving radii.

    The members of a node are consecutive in ``order``. A node's children cover its members within half
    of its net radius, and lie that far apart; the first has the node's own point. ``radius`` is
    the true distance from a node's point to its farthest member. Points that are equal, or so close
    that cosines do not part them, share a leaf.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.point, self.start, self.end, self.radius, self.first, self.count = [], [], [], [], [], []
        self.order = np.arange(len(points))
        members, nets = [], []

        def node(own, start, net):
            self.point.append(own[0])
            self.start.append(start)
            self.end.append(start + len(own))
            gaps = points[own] - points[own[0]] if len(own) > 1 else np.zeros((1, 1))
            self.radius.append(float(np.sqrt(np.einsum("ij,ij->i", gaps, gaps).max())))
            self.first.append(0)
            self.count.append(0)
            members.append(own)
            nets.append(net)

        if len(points):
            node(self.order.copy(), 0, 2.0)
        at = 0
        # Breadth first, so that the children of a node are neighbours.
        while at < len(members):
            own, net, start = members[at], nets[at], self.start[at]
            if self.radius[at] > FINEST:
                while net / 2 >= self.radius[at]:
                    net /= 2
                children = self._net(own, points[own], net / 2)
                # One child of a limit that halving no longer changes would be split for ever.
                if len(children) > 1 or self._limit(net / 2) < 1:
                    self.first[at], self.count[at] = len(members), len(children)
                    for child in children:
                        self.order[start:start + len(child)] = child
                        node(child, start, net / 2)
                        start += len(child)
            members[at] = None
            at += 1
        for name in ("point", "start", "end", "first", "count"):
            setattr(self, name, np.array(getattr(self, name), np.int64))
        self.radius = np.array(self.radius)

    @staticmethod
    def _limit(radius):
        """The cosine of unit vectors that lie ``radius`` apart."""
        return 1 - radius * radius / 2

    @classmethod
    def _net(cls, own, points, radius):
        """Parts of ``own``, each within ``radius`` of its first point, the first points farther apart."""
        parts, free, limit = [], np.ones(len(own), bool), cls._limit(radius)
        while free.any():
            picks = np.flatnonzero(free)[:PICKS]
            cosines = points @ points[picks].T
            for k, pick in enumerate(picks.tolist()):
                if free[pick]:
                    near = free & (cosines[:, k] >= limit)
                    near[pick] = False
                    parts.append(np.concatenate(([own[pick]], own[near])))
                    free &= ~near
                    free[pick] = False
        return parts

    def parts(self, node):
        """The children of a node, or a leaf itself, as consecutive node numbers."""
        first = self.first[node] if self.count[node] else node
        return np.arange(first, first + max(1, self.count[node]))


def close_pairs(left: CoverTree, right: CoverTree, reach: float):
    """Pairs of leaves ``(a, b)`` that may hold points within ``reach``; none that does is missed.

    From the roots down, both nodes of a pair are split and the pairs of their children kept whose points
    are no farther apart than both covering radii and ``reach`` allow. If both trees are the same one,
    a pair of nodes is visited in one order.
    """
    own = left is right
    stack = [(0, 0)] if len(left.points) and len(right.points) else []
    while stack:
        a, b = stack.pop()
        xs, ys = left.parts(a), right.parts(b)
        step = max(1, CELLS // len(ys))
        for at in range(0, len(xs), step):
            some = xs[at:at + step]
            cosines = left.points[left.point[some]] @ right.points[right.point[ys]].T
            far = np.sqrt(np.maximum(0, 2 - 2 * cosines))
            near = far <= left.radius[some, None] + right.radius[None, ys] + reach
            if own:
                near &= left.start[some, None] <= right.start[None, ys]
            i, j = np.nonzero(near)
            i, j = some[i], ys[j]
            leaf = (left.count[i] == 0) & (right.count[j] == 0)
            if leaf.any():
                yield i[leaf], j[leaf]
            stack.extend(zip(i[~leaf].tolist(), j[~leaf].tolist()))


def linked(left: np.ndarray, right: np.ndarray | None, similarity: float):
    """Batches of places (i, j) whose unit vectors' cosine is at least ``similarity``.

    Without ``right``, every such pair of ``left`` comes once, in either order.
    """
    reach = float(np.sqrt(max(0.0, 2 - 2 * similarity))) + SLACK
    tree = CoverTree(left)
    other = tree if right is None else CoverTree(right)
    for a, b in close_pairs(tree, other, reach):
        n, m = tree.end[a] - tree.start[a], other.end[b] - other.start[b]
        at = np.repeat(np.arange(len(a)), n * m)
        within = np.arange(len(at)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
        p, q = tree.start[a[at]] + within // m[at], other.start[b[at]] + within % m[at]
        if right is None:
            once = (p < q)
            p, q = p[once], q[once]
        i, j = tree.order[p], other.order[q]
        for at in range(0, len(i), COMPARED):
            x, y = i[at:at + COMPARED], j[at:at + COMPARED]
            near = np.einsum("ij,ij->i", tree.points[x], other.points[y]) >= similarity
            if near.any():
                yield x[near], y[near]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _matrix(column) -> np.ndarray:
    """Rows of a list column as a matrix; the caller has grouped them by length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _stars(size, pairs):
    """Counting links and joining what they connect: the smallest place reachable from each."""
    root = np.arange(size)
    i, j = (np.concatenate(p) for p in zip(*pairs))
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def vector_classes(df: DataFrame, key="vec_id", vector="embedding", label="label") -> DataFrame:
    """``(label, size, vector, first, copies)``: each usable vector of a label once.

    Usable: not null, not empty, not zero, all components finite, label and key not null.
    """
    values = F.col(vector).cast("array<double>")
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = df.select(F.col(key).alias("first"), F.col(label).alias("label"), values.alias("vector")).where(
        F.col("first").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine & F.exists(F.col("vector"), lambda x: x != 0))
    # -0.0 and 0.0 are one value; adding zero makes them so.
    same = F.transform("vector", lambda x: x + 0.0)
    return usable.groupBy("label", F.size("vector").alias("size"), same.alias("vector")).agg(
        F.min("first").alias("first"), F.count("*").alias("copies"))


def links(classes: DataFrame, similarity=SIMILARITY, block_rows=BLOCK_ROWS, pairs=False) -> DataFrame:
    """What dual traversals find between the classes, whose vectors are stored.

    ``pairs``: every linked pair ``(a, b)`` of classes by their ``first``, once, a < b. Else rows
    ``(node, links, root)``: for each class and block pair, its links weighted by copies, and the
    smallest class that its links reach inside the pair; summed and joined by the caller.

    Classes of a label are dealt to blocks of about ``block_rows`` around pivots, which bound what meets: two
    blocks are traversed together unless their centres are farther apart than their radii and the
    threshold allow. Each pair of blocks is a group of its own, so no label fills a task.
    """
    blocked, blocks = _blocks(classes, block_rows)
    reach = float(np.sqrt(max(0.0, 2 - 2 * similarity))) + SLACK
    left, right = (blocks.select(*[F.col(c).alias(f"{c}_{s}") for c in blocks.columns]) for s in "lr")
    apart = F.sqrt(F.aggregate(F.zip_with("centre_l", "centre_r", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x))
    # The blocks of a label are dealt over shares, each of which all its blocks visit: no label fills a task.
    shares = stored(blocks.groupBy("label", "size").agg(F.ceil(F.count("*") / SHARE_BLOCKS).cast("int").alias("shares")))
    visits = left.join(shares.select(F.col("label").alias("label_l"), F.col("size").alias("size_l"), "shares"), ["label_l", "size_l"])
    visits = visits.withColumn("share_l", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    hosts = right.join(shares.select(F.col("label").alias("label_r"), F.col("size").alias("size_r"), "shares"), ["label_r", "size_r"])
    hosts = hosts.withColumn("share_r", F.pmod(F.xxhash64("block_r"), F.col("shares")).cast("int")).drop("shares")
    meeting = visits.join(hosts, (F.col("label_l") == F.col("label_r")) & (F.col("size_l") == F.col("size_r"))
                          & (F.col("share_l") == F.col("share_r")) & (F.col("block_l") <= F.col("block_r")))
    meeting = meeting.where((F.col("block_l") == F.col("block_r")) | (apart <= F.col("radius_l") + F.col("radius_r") + reach))
    near = meeting.select(F.col("label_l").alias("label"), F.col("size_l").alias("size"),
                          F.col("block_l").alias("i"), F.col("block_r").alias("j"))
    sides = near.select("label", "size", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    dealt = sides.join(blocked, ["label", "size", "block"])
    key = blocked.schema["first"].dataType.simpleString()

    def traverse(table: pa.Table) -> pa.Table:
        firsts, copies = table["first"].to_pylist(), table["copies"].to_numpy()
        vectors, block = _matrix(table["vector"].combine_chunks()), table["block"].to_numpy()
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        places = [np.flatnonzero(block == k) for k in ((i,) if i == j else (i, j))]
        found = [
            (places[0][a], places[-1][b])
            for a, b in linked(vectors[places[0]], None if i == j else vectors[places[1]], similarity)
        ]
        a, b = (np.concatenate(p) for p in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
        if pairs:
            ends = [(min(firsts[x], firsts[y]), max(firsts[x], firsts[y])) for x, y in zip(a.tolist(), b.tolist())]
            columns = list(zip(*ends)) or [(), ()]
            return pa.table({"a": pa.array(columns[0], table["first"].type), "b": pa.array(columns[1], table["first"].type)})
        count = np.bincount(a, copies[b], len(firsts)) + np.bincount(b, copies[a], len(firsts))
        root = _stars(len(firsts), [(a, b)])
        some = np.flatnonzero(count)
        return pa.table({
            "node": pa.array([firsts[x] for x in some], table["first"].type),
            "links": pa.array(count[some].astype(np.int64)),
            "root": pa.array([firsts[x] for x in root[some]], table["first"].type),
        })

    schema = f"a {key}, b {key}" if pairs else f"node {key}, links BIGINT, root {key}"
    return dealt.groupBy("label", "size", "i", "j").applyInArrow(traverse, schema)


def _blocks(classes: DataFrame, block_rows):
    """The classes with unit vectors and their block, and each block's centre and radius.

    Pivots are a bounded sample: per label and vector length, by hash, as many as blocks are needed, but
    about ``PIVOT_SAMPLE`` in all. A class goes to its nearest pivot, if its label has one; the
    classes of a pivot, or of a label without, are cut by hash if they exceed ``block_rows``.
    """
    kinds = ["label", "size"]
    counted = classes.groupBy(*kinds).agg(F.count("*").alias("n"))
    wanted = F.ceil(F.col("n") / block_rows)
    share = min(1.0, PIVOT_SAMPLE / (counted.agg(F.sum(wanted)).first()[0] or 1))
    rates = counted.select(*kinds, (wanted / F.col("n") * share).alias("rate"))
    chance = F.pmod(F.xxhash64("first", "vector"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    pivots = {}
    sample = classes.withColumn("chance", chance).join(lookup(rates), kinds).where("chance < rate")
    for row in sample.select(*kinds, "vector").orderBy(*kinds, "first").collect():
        pivots.setdefault((row.label, row.size), []).append(row.vector)
    nets = {k: unit(np.array(v, float)) for k, v in pivots.items()}
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(nets)
    named = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    schema = f"label {named['label']}, size INT, first {named['first']}, copies BIGINT, vector ARRAY<DOUBLE>, pivot INT, apart DOUBLE"

    def assign(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = table["size"].to_numpy()
            for size in np.unique(sizes).tolist():
                part = table.filter(pa.array(sizes == size))
                vectors = unit(_matrix(part["vector"].combine_chunks()))
                pivot, apart = np.zeros(len(vectors), np.int32), np.full(len(vectors), 2.0)
                coded = part["label"].combine_chunks().dictionary_encode()
                codes, labels = coded.indices.to_numpy(), coded.dictionary.to_pylist()
                order = np.argsort(codes, kind="stable")
                for at in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
                    net = shared.value.get((labels[codes[at[0]]], size))
                    if net is not None:
                        pivot[at] = (vectors[at] @ net.T).argmax(axis=1)
                        cosines = np.einsum("ij,ij->i", vectors[at], net[pivot[at]])
                        apart[at] = np.sqrt(np.maximum(0, 2 - 2 * cosines))
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, vectors.size + 1, size, dtype=np.int32)), pa.array(vectors.reshape(-1)))
                yield from pa.table({
                    "label": part["label"], "size": part["size"], "first": part["first"], "copies": part["copies"],
                    "vector": flat, "pivot": pa.array(pivot), "apart": pa.array(apart)}).to_batches()

    placed = stored(classes.select("label", "size", "first", "copies", "vector").mapInArrow(assign, schema))
    cells = placed.groupBy(*kinds, "pivot").agg(F.ceil(F.count("*") / block_rows).alias("cuts"))
    cut = F.pmod(F.xxhash64("first"), F.col("cuts"))
    blocked = placed.join(cells, [*kinds, "pivot"]).withColumn("block", F.col("pivot") * F.lit(1 << 31) + cut)
    centres = spark.createDataFrame(
        [(*k, i, c.tolist()) for k, net in nets.items() for i, c in enumerate(net)],
        f"label {named['label']}, size INT, pivot INT, centre ARRAY<DOUBLE>")
    radii = blocked.groupBy(*kinds, "pivot", "block").agg(F.max("apart").alias("radius"))
    middle = F.coalesce("centre", F.array_repeat(F.lit(0.0), F.col("size")))
    blocks = radii.join(centres, [*kinds, "pivot"], "left").select(*kinds, "block", middle.alias("centre"), "radius")
    return blocked.select(*kinds, "block", "first", "copies", "vector"), stored(blocks)


def near_vectors(df: DataFrame, key="vec_id", vector="embedding", label="label", similarity=SIMILARITY,
                 block_rows=BLOCK_ROWS) -> DataFrame:
    """``(key, n_links, component_id, kept)``, one row per input row.

    Vectors of one label and length are linked if their cosine is at least ``similarity``. Vectors that are
    null, empty, zero or hold null or non-finite components, and those without label or key, link with
    nothing. Equal vectors are one class whose copies link with each other; no pair of copies is
    built. ``component_id`` is the smallest key reachable; a null key has a null one and is not kept.
    """
    classes = stored(vector_classes(df, key, vector, label))
    found = stored(links(classes, similarity, block_rows))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(counts, F.col("first") == F.col("node"), "left").drop("node")
        .join(joined, F.col("first") == F.col("node"), "left")
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "first").alias("component"))
    )
    rows = df.select(
        F.col(key).alias("_key"), F.col(label).alias("_label"),
        F.transform(F.col(vector).cast("array<double>"), lambda x: x + 0.0).alias("_vector"),
    )
    # NaN equals NaN in Spark, but such vectors have no class, so they find none.
    same = F.col("_key").isNotNull() & (F.col("_label") == F.col("label")) & (F.col("_vector") == F.col("vector"))
    met = rows.join(named, same, "left")
    component = F.coalesce("component", "_key")
    return met.select(
        F.col("_key").alias(key), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("_key") == component, F.lit(False)).alias("kept"),
    )
