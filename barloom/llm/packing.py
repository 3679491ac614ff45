"""Token sequences of bounded length by harmonic packing.

A document of ``n`` tokens is of class ``capacity // n``: lengths fall into classes by the reciprocals
of a whole number. A bin of class k takes k documents whole, and a document of more than ``capacity``
tokens fills bins of its own first. Each task fills its own bins, so nothing is shuffled. What k
documents leave free is filled with pieces of a few documents set aside for that, so that bins
are full; what a task has left over at its end is laid out one after another and cut into
full sequences and at last powers of two.
"""

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.storage import stored
from barloom.llm.texts import cut, small_batches
from barloom.llm.token_files import encoder

CAPACITY = 4096
BATCH_BYTES = 4 << 20


class Bins:
    """The open bins of one worker; ``take`` gives the pieces of sequences that are closed.

    A piece is ``(document, start, end, sequence, offset)``; documents are any objects.
    """

    def __init__(self, capacity=CAPACITY, first=0):
        self.capacity, self.sequence = capacity, first
        self.classes: dict[int, list] = {}
        self.aside, self.spare = deque(), 0
        self.closed = []

    def add(self, document, size):
        whole = size - size % self.capacity
        for start in range(0, whole, self.capacity):
            self._lay([(document, start, start + self.capacity)])
        if whole < size:
            self._place(document, whole, size)

    def _place(self, document, start, end):
        """To the documents that fill gaps while those cannot fill any gap, else to the bin of its class.

        The rest of a document that is cut already is set aside sooner than a whole one.
        """
        if self.spare < (4 if start else 1) * self.capacity:
            self.aside.append((document, start, end))
            self.spare += end - start
            return
        count = self.capacity // (end - start)
        own = self.classes.setdefault(count, [])
        own.append((document, start, end))
        if len(own) == count:
            del self.classes[count]
            self._lay([*own, *self._fill(self.capacity - sum(e - s for _, s, e in own))])

    def _fill(self, gap):
        """Pieces of ``gap`` tokens together, less than a capacity."""
        self.spare -= gap
        while gap:
            document, start, end = self.aside.popleft()
            middle = min(end, start + gap)
            gap -= middle - start
            if middle < end:
                self.aside.appendleft((document, middle, end))
            yield document, start, middle

    def _lay(self, pieces):
        offset = 0
        for document, start, end in pieces:
            self.closed.append((document, start, end, self.sequence, offset))
            offset += end - start
        self.sequence += 1

    def finish(self):
        """Lay out what is left: the larger classes first, then what was set aside."""
        left = [piece for count in sorted(self.classes) for piece in self.classes[count]]
        self.classes.clear()
        self.aside.extendleft(reversed(left))
        self.spare += sum(e - s for _, s, e in left)
        while self.spare >= self.capacity:
            self._lay(list(self._fill(self.capacity)))
        while self.spare:
            self._lay(list(self._fill(1 << self.spare.bit_length() - 1)))

    def take(self):
        done, self.closed = self.closed, []
        return done


def pack(df: DataFrame, path: str, end: int, key="doc_id", text="text", capacity=CAPACITY, special=False) -> DataFrame:
    """``(key, start, length, ids, doc_tokens, sequence_id, offset)``, one row per piece, stored.

    ``ids`` are little-endian unsigned 32-bit numbers of the tokenizer file at ``path``, each document's
    closed by ``end``; ``start`` counts the document's ids before the piece, ``offset`` the ids before it in its
    sequence. A sequence holds ``capacity`` ids or, at the end of a task, a power of two below it, so
    that none needs padding where either is a length to train on.

    Null and empty texts are the end id alone. Rows that share a key are documents of their own; keys may
    be of any type and null. An empty table gives no piece. Which documents meet depends on the table's
    partitions; the result is stored once, so it stays the same however often it is read. Texts of any
    length are cut by whole sequences; a task holds one slice of texts and its open bins.
    """
    spark = df.sparkSession
    small_batches(spark)
    chosen = df.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("bytes"))
    schema = T.StructType([
        T.StructField(key, chosen.schema["key"].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])

    def run(batches):
        encode = encoder(path, end, special=special)
        bins = Bins(capacity, TaskContext.get().partitionId() << 32)
        kind = None

        def rows(pieces):
            columns = [
                [d[0] for d, *_ in pieces], [s for _, s, *_ in pieces], [e - s for _, s, e, *_ in pieces],
                [d[1][4 * s:4 * e] for d, s, e, *_ in pieces], [len(d[1]) // 4 for d, *_ in pieces],
                [q for *_, q, _ in pieces], [o for *_, o in pieces],
            ]
            kinds = [kind, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

        def ready(pieces):
            at = size = 0
            for i, (_, start, last, *_) in enumerate(pieces):
                size += 4 * (last - start)
                if size >= BATCH_BYTES:
                    yield rows(pieces[at:i + 1])
                    at, size = i + 1, 0
            if at < len(pieces):
                yield rows(pieces[at:])

        for batch in batches:
            kind = batch.schema.field(0).type
            for piece in cut(batch):
                ids, counts = encode(piece.column(1).to_pylist())
                data = memoryview(ids.astype("<u4").tobytes())
                ends = 4 * np.cumsum(counts)
                for own, first, last in zip(piece.column(0).to_pylist(), (ends - 4 * counts).tolist(), ends.tolist()):
                    bins.add((own, bytes(data[first:last])), (last - first) // 4)
                yield from ready(bins.take())
        bins.finish()
        yield from ready(bins.take())

    return stored(chosen.mapInArrow(run, schema), compression="zstd")
