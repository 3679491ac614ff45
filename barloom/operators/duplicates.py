"""Repeated keys of large tables, where nearly all keys are held once.

Each task sends four bytes per key to the merge instead of the key, and only keys whose four bytes come up twice
are counted. This is the one operator outside ``llm`` that runs Python in tasks, on columns of hashes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.joins import fits_broadcast
from barloom.operators.quality import duplicate_keys
from barloom.sources.workspace import work_folder

#: Keys that one merge compares, about, and hashes that a task holds before it sends them on.
MERGED_KEYS, HELD_HASHES = 1 << 20, 1 << 22
SKETCH = "segment INT, once BINARY, again BINARY"


def _sketches(segments):
    """Hashes to rows (segment, slots, slots held twice here): the lower half of a hash is its slot."""
    def rows(hashes):
        found, counts = np.unique(hashes, return_counts=True)
        parts = (found >> np.uint64(32)) % np.uint64(segments)
        order = np.argsort(parts, kind="stable")
        found, counts, parts = found[order], counts[order], parts[order].astype(np.int32)
        slots = found.astype(np.uint32)
        edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        spans = [(a, b) for a, b in zip(edges, edges[1:]) if a < b]
        return pa.RecordBatch.from_arrays([
            pa.array([int(parts[a]) for a, _ in spans], pa.int32()),
            pa.array([slots[a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([slots[a:b][counts[a:b] > 1].tobytes() for a, b in spans], pa.binary())], names=["segment", "once", "again"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            size += batch.num_rows
            if size >= HELD_HASHES:
                yield rows(np.concatenate(held))
                held, size = [], 0
        if size:
            yield rows(np.concatenate(held))
    return run


def _merge(table: pa.Table) -> pa.Table:
    """The slots of one segment that several sketches hold, or one of them twice."""
    slots = np.sort(np.frombuffer(b"".join(table["once"].to_pylist()), np.uint32))
    twice = slots[1:][slots[1:] == slots[:-1]]
    again = np.frombuffer(b"".join(table["again"].to_pylist()), np.uint32)
    found = np.unique(np.concatenate([twice, again])).astype(np.int64)
    return pa.table({"segment": pa.array([table["segment"][0].as_py()] * len(found), pa.int32()), "slot": pa.array(found)})


def repeated_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row, with their row count: the rows of ``duplicate_keys``.

    Reads the table three times, its keys alone: to count rows, to sketch their hashes, and to pick the rows whose hash
    is suspect. A segment's sketches are one group of about ``MERGED_KEYS`` keys; a frequent key is one slot a task. Suspect
    hashes are broadcast if they measure up to 64 MB, and joined by shuffle beyond that.
    """
    spark = df.sparkSession
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_hash"))
    segments = max(1, -(-df.count() // MERGED_KEYS))
    sketched = hashed.select("_hash").mapInArrow(_sketches(segments), SKETCH)
    folder = work_folder(spark)
    sketched.groupBy("segment").applyInArrow(_merge, "segment INT, slot BIGINT").write.parquet(folder)
    suspects = spark.read.schema("segment INT, slot BIGINT").parquet(folder)
    suspects = F.broadcast(suspects) if fits_broadcast(suspects) else suspects
    upper = F.shiftrightunsigned("_hash", 32)
    placed = hashed.withColumns({"segment": (upper % segments).cast("int"), "slot": F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))})
    return duplicate_keys(placed.join(suspects, ["segment", "slot"], "left_semi"), keys)
