"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by merging linked bytes."""

import base64
import re
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.texts import Memo, kept, map_texts

MEMO_TOKENS = 250_000
MIX = 0x9E3779B97F4A7C15
FULL = (1 << 64) - 1
#: Pre-tokens of whole texts that are looked up together.
HELD_PIECES = 100_000


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ids, which count from 0."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _slot(hashed: int, seed: int, size: int) -> int:
    mixed = (hashed ^ seed * MIX) & FULL
    mixed = (mixed ^ mixed >> 29) * MIX & FULL
    return (mixed >> 32) % size


class MinimalPerfectHash:
    """Distinct keys to 0 … n-1 without gaps, by hash and displace.

    Keys fall into n buckets. Buckets of several keys, the largest first, get the first seed that
    sends their keys to free slots; a bucket of one key names its slot, as -1 - slot.
    """

    def __init__(self, keys: list[bytes]):
        self.size = size = len(keys)
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        if len(set(hashes)) < size:
            raise ValueError("keys must differ in their hash")
        buckets = [[] for _ in range(size)]
        for i, h in enumerate(hashes):
            buckets[h % size].append(i)
        seeds, self.order = [0] * size, [-1] * size
        for b in sorted(range(size), key=lambda b: -len(buckets[b])):
            if len(buckets[b]) < 2:
                break
            seed = 1
            while True:
                slots = [_slot(hashes[i], seed, size) for i in buckets[b]]
                if len(set(slots)) == len(slots) and all(self.order[s] < 0 for s in slots):
                    break
                seed += 1
            seeds[b] = seed
            for i, s in zip(buckets[b], slots):
                self.order[s] = i
        free = (s for s in range(size) if self.order[s] < 0)
        for b, keyed in enumerate(buckets):
            if len(keyed) == 1:
                slot = next(free)
                seeds[b], self.order[slot] = -1 - slot, keyed[0]
        self.seeds, self.order = np.array(seeds, np.int64), np.array(self.order, np.int64)

    def candidate(self, key: bytes) -> int:
        """The index of the key, if it is one of the keys; else of any other or -1."""
        return int(self.candidates([key])[0]) if self.size else -1

    def candidates(self, keys: list[bytes]) -> np.ndarray:
        """For each key its index, if it is one of the keys; else any other."""
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        seeds = self.seeds[hashed % np.uint64(self.size)]
        mixed = hashed ^ seeds.astype(np.uint64) * np.uint64(MIX)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(MIX)
        slots = ((mixed >> np.uint64(32)) % np.uint64(self.size)).astype(np.int64)
        return self.order[np.where(seeds < 0, -1 - seeds, slots)]


class Vocabulary:
    """Tokens by id, with both tiers of lookup."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.whole = MinimalPerfectHash(tokens)
        self.ranks = {t: i for i, t in enumerate(tokens)}

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        return self.encode_all([piece])[0]

    def encode_all(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens: whole ones by the perfect hash, the others merged."""
        if not pieces or not self.tokens:
            return [self.merge(p) for p in pieces]
        tokens, merge = self.tokens, self.merge
        found = self.whole.candidates(pieces).tolist()
        return [[i] if tokens[i] == p else merge(p) for i, p in zip(found, pieces)]

    def merge(self, piece: bytes) -> list[int]:
        """Merge neighbours by rank, the leftmost first among equals.

        A part is known by its first byte; ``after`` and ``before`` link parts. A heap entry ends where its two parts
        did: it is stale if the part after its first one no longer ends there. What follows the last part, and a
        part that is gone, end nowhere.
        """
        size, ranks, rank_of = len(piece), self.ranks, self.ranks.get
        heap = []
        for i in range(size - 1):
            rank = rank_of(piece[i:i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapify(heap)
        gone = size + 1
        after, before = [*range(1, size + 1), -1, -1], list(range(-1, size))
        while heap:
            _, i, end = heappop(heap)
            middle = after[i]
            if after[middle] != end:
                continue
            after[middle], after[i], before[end] = gone, end, i
            if end < size:
                last = after[end]
                rank = rank_of(piece[i:last])
                if rank is not None:
                    heappush(heap, (rank, i, last))
            left = before[i]
            if left >= 0:
                rank = rank_of(piece[left:end])
                if rank is not None:
                    heappush(heap, (rank, left, end))
        parts, i = [], 0
        while i < size:
            parts.append(ranks[piece[i:after[i]]])
            i = after[i]
        return parts


def ascii_pattern(pattern: str) -> bytes | None:
    """The same pattern for ASCII bytes, for Python's own quicker engine; None if it has properties other than L and N."""
    for name, plain in ((r"\p{L}", "A-Za-z"), (r"\p{N}", "0-9")):
        # A property by itself becomes a class, one within a class the ranges alone.
        pattern = re.sub(r"(\[[^\]]*\])|" + re.escape(name), lambda m: m[1].replace(name, plain) if m[1] else f"[{plain}]", pattern)
    return None if r"\p" in pattern else pattern.encode()


class _Pieces(Memo):
    """Pre-tokens to their ids as little-endian bytes, new ones looked up together."""

    def __init__(self, vocabulary, limit):
        super().__init__(None, limit)
        self.vocabulary = vocabulary

    def coded(self, pieces: list[str | bytes]) -> list[bytes]:
        """The ids of each pre-token; what is not remembered is looked up together."""
        held = list(map(self.get, pieces))
        missing = [i for i, h in enumerate(held) if h is None]
        if missing:
            new = list({pieces[i] for i in missing})
            ids = self.vocabulary.encode_all([p if type(p) is bytes else p.encode() for p in new])
            self.make_room()
            self.update(zip(new, [array("i", i).tobytes() for i in ids]))
            for i in missing:
                held[i] = self[pieces[i]]
        return held


def _memo(shared, pattern, limit):
    """The splitter and memo of a vocabulary that the tasks of a worker share."""
    def build():
        plain = ascii_pattern(pattern)
        return _splitter(regex.compile(pattern), plain and re.compile(plain)), _Pieces(shared.value, limit), shared

    return kept((id(shared.value), pattern, limit), build)[:2]


def _splitter(pieces, plain):
    """The pre-tokens of a text, as bytes if it is ASCII and otherwise as text."""
    def split(text: bytes):
        return plain.findall(text) if plain and text.isascii() else pieces.findall(text.decode())
    return split


def _arrays(buffers: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(b) // 4 for b in buffers]], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(buffers), np.int32)))


def encode(df: DataFrame, tokens: list[bytes], pattern: str, key="doc_id", text="text",
           memo=MEMO_TOKENS) -> DataFrame:
    """``(key, ids)``: token ids of every whole text, one row per input row.

    Each match of ``pattern`` is encoded by itself; special tokens are ordinary text. ``tokens``
    hold the vocabulary by id, which bounds what is broadcast. Null and empty texts have no ids.
    """
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(tokens))

    def make():
        split, known = _memo(shared, pattern, memo)

        def apply(texts):
            buffers, pieces, edges = [], [], [0]

            def flush():
                held = known.coded(pieces)
                buffers.extend(b"".join(held[a:b]) for a, b in zip(edges, edges[1:]))
                pieces.clear()
                edges[:] = [0]

            for text in texts.to_pylist():
                pieces.extend(split(text) if text else ())
                edges.append(len(pieces))
                if len(pieces) >= HELD_PIECES:
                    flush()
            flush()
            return [_arrays(buffers)]
        return apply

    return map_texts(df, text, [key], [T.StructField("ids", T.ArrayType(T.IntegerType()))], make, shares=True)


def decode(df: DataFrame, tokens: list[bytes], keep, ids="ids") -> DataFrame:
    """The ``keep`` columns and ``decoded``, the bytes that the ids stand for; null ids give none."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name in keep], T.StructField("decoded", T.BinaryType())])
    shared = df.sparkSession.sparkContext.broadcast(tokens)

    def run(batches):
        spelled = shared.value.__getitem__
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            edges, flat = column.offsets.to_numpy(), column.values
            texts = [
                b"".join(map(spelled, flat.slice(i, j - i).to_numpy().tolist()))
                for i, j in zip(edges[:-1].tolist(), edges[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())], names=schema.names)
        pa.default_memory_pool().release_unused()

    chosen = [f.name for f in schema.fields[:-1]]
    return df.select(*chosen, F.coalesce(F.col(ids), F.array().cast("array<int>"))).mapInArrow(run, schema)
