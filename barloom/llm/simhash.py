"""Near-duplicate documents by SimHash fingerprints and covering locality-sensitive hashing."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.components import components
from barloom.llm.storage import stored
from barloom.llm.texts import map_texts

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BITS = 64
SPLIT_ROWS = 32_768
CELLS = 1 << 22


def fingerprint(text: bytes | None, words=SHINGLE_WORDS) -> int:
    """SimHash of a text: a bit is 1 if it is set in over half of the shingles' XXH64.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text of fewer
    words than a shingle is one shingle; a text of none, or null, has fingerprint 0.
    """
    found = (text or b"").lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(words, len(found)) - 1
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[i:j], SEED) for i, j in zip(starts.tolist(), ends[span:].tolist())])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(rows), 65_536):
        ones += np.unpackbits(rows[at:at + 65_536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big")


def fingerprints(df: DataFrame, key="doc_id", text="text", words=SHINGLE_WORDS) -> DataFrame:
    """``(key, fingerprint)`` with the 64 bits as a signed BIGINT, one row per input row."""
    def make():
        def apply(texts):
            values = np.array([fingerprint(t, words) for t in texts.to_pylist()], np.uint64)
            return [pa.array(values.view(np.int64))]
        return apply

    return map_texts(df, text, [key], [T.StructField("fingerprint", T.LongType())], make)


def covering_masks(radius: int, bits=BITS) -> list[int]:
    """2^(radius+1) - 1 bit masks of which, for any two words that differ in up to ``radius``
    bits, one at least holds none of the differing bits.

    Bit i is given a non-zero vector m(i) of radius+1 bits; the mask of a non-zero vector v holds
    the bits whose m(i) has an odd product with v. Up to ``radius`` vectors leave a non-zero v
    that has an even product with each of them.
    """
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(bits) if ((1 + i % vectors) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def local_stars(left: np.ndarray, right: np.ndarray | None, radius: int):
    """Star edges (node, root) that connect what links of up to ``radius`` bits connect.

    With ``right``, only links between the two sides count, else those within ``left``. Each
    value is compared with those not reached yet, in blocks; no list of pairs is built.
    """
    nodes = left if right is None else np.concatenate([left, right])
    side = np.zeros(len(nodes), bool) if right is None else np.arange(len(nodes)) >= len(left)
    bits = nodes.view(np.uint64)
    free = np.ones(len(nodes), bool)
    ends, roots = [], []
    for first in range(len(nodes)):
        if not free[first]:
            continue
        free[first] = False
        frontier = np.array([first])
        while len(frontier):
            reached = []
            step = max(1, CELLS // len(nodes))
            for at in range(0, len(frontier), step):
                rest = np.flatnonzero(free)
                if not len(rest):
                    break
                some = frontier[at:at + step]
                near = np.bitwise_count(bits[some, None] ^ bits[None, rest]) <= radius
                if right is not None:
                    near &= side[some, None] != side[None, rest]
                hit = rest[near.any(axis=0)]
                free[hit] = False
                reached.append(hit)
            frontier = np.concatenate(reached) if reached else frontier[:0]
            ends.append(nodes[frontier])
            roots.append(np.full(len(frontier), nodes[first], nodes.dtype))
    empty = np.zeros(0, nodes.dtype)
    return np.concatenate([empty, *ends]), np.concatenate([empty, *roots])


def _groups(batches, keys):
    """Runs of rows with equal ``keys`` (the leading columns) of sorted batches, as pieces
    ``(key, values, last)``: a piece ends with its batch, and ``last`` tells that the run does."""
    held = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns[:keys]:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
            key = tuple(int(c[start]) for c in columns[:keys])
            if held is not None:
                yield held[0], held[1], held[0] != key
            held = key, [c[start:end] for c in columns[keys:]]
    if held is not None:
        yield held[0], held[1], True


LINKED = "a BIGINT, b BIGINT, mask INT, kept BIGINT, block INT"


def _table(a, b, mask=None, kept=None, block=None):
    n = len(a)
    blank = pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())
    if mask is not None:
        blank = pa.array([mask] * n, pa.int32()), pa.array([kept] * n, pa.int64()), pa.array([block] * n, pa.int32())
    columns = [pa.array(np.asarray(a, np.int64)), b if isinstance(b, pa.Array) else pa.array(np.asarray(b, np.int64)), *blank]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "mask", "kept", "block"])


def _link_buckets(radius, split):
    """Sorted rows (mask, kept bits, fingerprint) to star edges. The rows of a bucket of more
    than ``split`` rows come out as they are, numbered in blocks, for ``_link_blocks``."""
    def run(batches):
        values, block, edges = [], 0, []
        for key, (piece,), last in _groups(batches, 2):
            values.append(piece)
            size = sum(map(len, values))
            if size > split or (block and last):
                pool = np.concatenate(values)
                cuts = range(0, size if last else size - size % split, split)
                for at in cuts:
                    some = pool[at:at + split]
                    yield _table(some, pa.nulls(len(some), pa.int64()), *key, block)
                    block += 1
                values = [] if last else [pool[size - size % split:]]
            elif last and size > 1:
                nodes, roots = local_stars(np.concatenate(values), None, radius)
                if len(nodes):
                    edges.append((nodes, roots))
            if last:
                values, block = [], 0
            if len(edges) > 10_000:
                yield _table(*map(np.concatenate, zip(*edges)))
                edges = []
        if edges:
            yield _table(*map(np.concatenate, zip(*edges)))
    return run


def _link_blocks(radius):
    """Sorted rows (mask, kept bits, block i, block j, own block, fingerprint) to star edges."""
    def run(batches):
        own, values = [], []
        for (_, _, i, j), (block, piece), last in _groups(batches, 4):
            own.append(block)
            values.append(piece)
            if not last:
                continue
            blocks, pool = np.concatenate(own), np.concatenate(values)
            own, values = [], []
            pair = (pool, None) if i == j else (pool[blocks == i], pool[blocks == j])
            nodes, roots = local_stars(*pair, radius)
            if len(nodes):
                yield _table(nodes, roots).select(["a", "b"])
    return run


def links(prints: DataFrame, radius=MAX_BITS, split=SPLIT_ROWS) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints which links of up to ``radius``
    differing bits connect; ``prints`` holds distinct fingerprints.

    Fingerprints meet in the bucket of some covering mask. A bucket gives a spanning star per
    connected part, never all its pairs; one of more than ``split`` rows is cut into blocks
    whose pairs are separate tasks.
    """
    masks = F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("kept"))
        for i, m in enumerate(covering_masks(radius))
    ])
    dealt = (
        prints.select(F.inline(masks), "fingerprint")
        .repartition("mask", "kept").sortWithinPartitions("mask", "kept", "fingerprint")
    )
    found = stored(dealt.mapInArrow(_link_buckets(radius, split), LINKED))
    crowded = found.where("block IS NOT NULL").select("mask", "kept", "block", F.col("a").alias("fingerprint"))
    counted = crowded.groupBy("mask", "kept").agg((F.max("block") + 1).alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = (
        crowded.join(counted, ["mask", "kept"]).withColumn("other", other)
        .select("mask", "kept", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "block", "fingerprint")
        .repartition("mask", "kept", "i", "j").sortWithinPartitions("mask", "kept", "i", "j")
    )
    more = paired.mapInArrow(_link_blocks(radius), "a BIGINT, b BIGINT")
    return found.where("block IS NULL").select("a", "b").union(more).distinct()


def near_duplicates(df: DataFrame, key="doc_id", text="text", words=SHINGLE_WORDS, radius=MAX_BITS,
                    split=SPLIT_ROWS) -> DataFrame:
    """``(key, fingerprint, component_id)``, one row per input row.

    Documents whose fingerprints differ in up to ``radius`` bits are linked; ``component_id``
    is the smallest key reachable. Fingerprints are linked, not documents, so copies cost
    nothing; rows sharing a key count as separate documents. A null text counts as empty; a
    null key is nobody's smallest key, so a component of such rows alone has a null id. An
    empty table gives an empty result; other columns are not looked at.
    """
    prints = stored(fingerprints(df, key, text, words))
    owners = prints.groupBy("fingerprint").agg(F.min(key).alias("_first"))
    joined = components(links(owners.select("fingerprint"), radius, split))
    grouped = (
        owners.join(joined.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .withColumn("_group", F.coalesce("component", "fingerprint"))
    )
    # Stored, so that the join of a large group is one that adaptive execution can split.
    lowest = stored(grouped.groupBy("_group").agg(F.min("_first").alias("component_id")))
    named = stored(grouped.join(lowest, "_group").select("fingerprint", "component_id"))
    return prints.join(named, "fingerprint").select(key, "fingerprint", "component_id")


def hexadecimal(fingerprint="fingerprint"):
    """A signed fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
