"""Run a function over the texts of a table, a few megabytes at a time."""

from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


class Memo(dict):
    """What ``find`` gives for a key, remembered; the older half goes when it is full, which only costs time."""

    def __init__(self, find, limit):
        self.find, self.limit = find, limit

    def __missing__(self, key):
        self.make_room()
        self[key] = found = self.find(key)
        return found

    def make_room(self):
        if len(self) >= self.limit:
            for old in list(islice(self, len(self) - self.limit // 2)):
                del self[old]


_kept = {}


def kept(key, build):
    """What the tasks of one Python worker share: the thing kept last, if it has this key, else a new one.

    Workers live on between stages, so only one thing is kept, and tasks of ``map_texts`` that share nothing let it go.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


def cut(batch: pa.RecordBatch, limit=SLICE_BYTES):
    """Slices of a batch whose last column holds about ``limit`` bytes, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
    part = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def small_batches(spark):
    """Lower the session's rows per Arrow batch where it is above ``BATCH_ROWS``.

    Spark's 10,000 rows are much for whole texts, which stand in memory on both sides of the exchange.
    """
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def map_texts(df: DataFrame, text: str, keep, fields, make, shares=False) -> DataFrame:
    """The ``keep`` columns and new ``fields``, computed from whole texts in Python.

    ``make()`` runs once per task; what it returns gets an Arrow array of UTF-8 byte strings
    (null for a null text) and gives one Arrow array per field. ``keep`` passes unchanged. ``shares``
    tells that ``make`` uses what the worker has kept.
    """
    small_batches(df.sparkSession)
    named = {f.name: f for f in df.schema.fields}
    schema = T.StructType([*[named[k] for k in keep], *fields])
    chosen = df.select(*[F.col(k) for k in keep], F.col(text).cast("string").cast("binary").alias("_bytes"))
    names = schema.names

    def run(batches):
        if not shares:
            _kept.clear()
        apply = make()
        for batch in batches:
            for piece in cut(batch):
                columns = piece.columns
                yield pa.RecordBatch.from_arrays([*columns[:-1], *apply(columns[-1])], names=names)
        # The worker lives on, and Arrow keeps what it once had.
        pa.default_memory_pool().release_unused()

    return chosen.mapInArrow(run, schema)
