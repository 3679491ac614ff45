"""Language identification by prediction by partial matching over bytes."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.storage import lookup, stored
from barloom.llm.texts import map_texts

ORDER = 4
SAMPLE_DOCUMENTS = 400
SAMPLE_CHARS = 20_000
#: Rows learned from in all, shared out where there are many languages.
SAMPLE_TOTAL = 4_000
UNKNOWN = "und"
START = b"\n" * ORDER
PIECE = 1 << 18


def has_letter(text: bytes) -> bool:
    """True if a character is of one of Unicode's categories of letters; number signs such as Ⅷ, ½ or ① are none."""
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


class Index:
    """Positions of distinct 64-bit keys, by open addressing; lookups take whole arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.at = np.full(1 << bits, -1, np.int32)
        slots, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slots[left]] < 0
            claim = left[free]
            _, first = np.unique(slots[claim], return_index=True)
            won = claim[first]
            self.keys[slots[won]], self.at[slots[won]] = keys[won], won
            lost = np.ones(len(keys), bool)
            lost[won] = False
            left = left[lost[left]]
            slots[left] = (slots[left] + 1) & self.last

    def _home(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, -1 where it is not among the index's keys."""
        slots = self._home(keys)
        held = self.keys[slots]
        found = self.at[slots]
        pending = np.flatnonzero((held != keys) & (held >= 0))
        found[held != keys] = -1
        while len(pending):
            slots[pending] = (slots[pending] + 1) & self.last
            held = self.keys[slots[pending]]
            same = held == keys[pending]
            found[pending[same]] = self.at[slots[pending[same]]]
            pending = pending[~same & (held >= 0)]
        return found


def packed(data: np.ndarray, order=ORDER) -> list[np.ndarray]:
    """For each k up to ``order``, the last k+1 bytes up to every position from ``order`` on, as one number."""
    grams, value = [], np.zeros(max(0, len(data) - order), np.int64)
    for k in range(order + 1):
        value = value + (data[order - k:len(data) - k].astype(np.int64) << (8 * k))
        grams.append(value)
    return grams


def _aligned(keys, union, values):
    out = np.zeros(len(union), values.dtype)
    out[np.searchsorted(union, keys)] = values
    return out


class Model:
    """Byte context trees of all languages, frozen after training.

    Orders 0 to ``ORDER``, escapes by method C: with T bytes seen in a context, D of them
    different, byte c costs -log2(n(c) / (T + D)) bits, and the escape to the next shorter
    context costs -log2(D / (T + D)); a context never seen escapes for nothing, and below order 0 every byte
    costs 8 bits. ``costs[k]`` holds the bits of every known (k bytes, byte) in each language,
    shorter contexts included, so that a lookup of the longest known one gives the code length.
    """

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        counted = [self._count(samples[name]) for name in self.languages]
        self.grams, self.costs, self.contexts, self.escapes = [], [], [], []
        for k in range(ORDER + 1):
            grams = np.unique(np.concatenate([c[k][0] for c in counted] or [np.zeros(0, np.int64)]))
            contexts = np.unique(grams >> 8)
            shorter = self._shorter(grams, k)
            costs, escapes = np.zeros((len(grams), len(counted))), np.zeros((len(contexts), len(counted)))
            for i, counts in enumerate(counted):
                seen, n = counts[k]
                n = _aligned(seen, grams, n)
                where = np.searchsorted(contexts, grams >> 8)
                total = np.bincount(where, n, len(contexts))
                different = np.bincount(where, n > 0, len(contexts))
                all_ = np.maximum(total + different, 1)
                escapes[:, i] = np.where(different > 0, -np.log2(np.maximum(different, 1) / all_), 0)
                direct = -np.log2(np.maximum(n, 1) / all_[where])
                costs[:, i] = np.where(n > 0, direct, escapes[where, i] + shorter[:, i])
            self.grams.append(grams)
            self.contexts.append(contexts)
            self.costs.append(costs)
            self.escapes.append(escapes)
        self._index = None

    def _count(self, texts):
        found = [packed(np.frombuffer(START + t, np.uint8)) for t in texts]
        return [
            np.unique(np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]), return_counts=True)
            for k in range(ORDER + 1)
        ]

    def _shorter(self, grams, k):
        """Cost of the byte in the context one byte shorter, which every known one contains."""
        if k == 0:
            return np.full((len(grams), len(self.languages)), 8.0)
        return self.costs[k - 1][np.searchsorted(self.grams[k - 1], grams & ((1 << 8 * k) - 1))]

    def bits(self, grams: list[np.ndarray]) -> np.ndarray:
        """Code length of each position in each language."""
        if self._index is None:
            self._index = [Index(g) for g in self.grams], [Index(c) for c in self.contexts]
        out = np.zeros((len(grams[0]), len(self.languages)), np.float32)
        left = np.arange(len(out))
        for k in range(ORDER, -1, -1):
            keys = grams[k][left]
            at = self._index[0][k].find(keys)
            known = at >= 0
            out[left[known]] += self.costs[k][at[known]].astype(np.float32)
            left, keys = left[~known], keys[~known]
            at = self._index[1][k].find(keys >> 8)
            known = at >= 0
            out[left[known]] += self.escapes[k][at[known]].astype(np.float32)
        out[left] += 8
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Total bits of each text in each language, texts coded one by one from their start."""
        sums = np.zeros((len(texts), len(self.languages)))
        batch, size = [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), PIECE):
                piece = text[max(0, at - ORDER):at + PIECE]
                batch.append((i, START + piece if at == 0 else piece))
                size += len(piece)
                if size >= PIECE:
                    self._add(batch, sums)
                    batch, size = [], 0
        self._add(batch, sums)
        return sums

    def _add(self, batch, sums):
        if not batch:
            return
        lengths = np.array([len(b) - ORDER for _, b in batch])
        data = np.frombuffer(b"".join(b for _, b in batch), np.uint8)
        coded = np.ones(len(data), bool)
        starts = np.concatenate(([0], np.cumsum(lengths + ORDER)[:-1]))
        for j in range(ORDER):
            coded[starts + j] = False
        grams = [g[coded[ORDER:]] for g in packed(data)]
        bits = self.bits(grams).astype(np.float64)
        totals = np.add.reduceat(bits, np.concatenate(([0], np.cumsum(lengths)[:-1])), axis=0)
        np.add.at(sums, [i for i, _ in batch], totals)


def train(df: DataFrame, key="doc_id", text="text", lang="lang", documents=SAMPLE_DOCUMENTS,
          chars=SAMPLE_CHARS, total=SAMPLE_TOTAL) -> Model:
    """A model from about ``documents`` rows of each language, with ``chars`` characters of a text at most.

    Where there are more than ``total / documents`` languages, each gets its share of ``total`` rows; so neither
    many languages nor junk in their column fill the driver.

    Rows of any length are taken by a hash of their key and text, at a rate that follows from counting the
    rows of each language; a longer text gives a piece from a hashed place. So neither the
    sample nor the model grows with the table or its texts.
    """
    fit = df.where(F.col(lang).isNotNull() & (F.length(text) > 0))
    counted = stored(fit.groupBy(F.col(lang).alias("_lang")).agg(F.count("*").alias("_n")))
    share = min(documents, total / max(1, counted.count()))
    rates = lookup(counted.select("_lang", F.least(F.lit(1.0), share / F.col("_n")).alias("_rate")))
    chance = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    places = F.greatest(F.length(text) - chars, F.lit(0)) + 1
    place = F.pmod(F.xxhash64(F.col(text), F.col(key)), places).cast("int") + 1
    piece = F.substring(F.col(text), place, F.lit(chars))
    rows = (
        fit.select(F.col(lang).alias("_lang"), piece.alias("_text"), chance.alias("_chance"))
        .join(rates, "_lang").where("_chance < _rate").select("_lang", "_text").collect()
    )
    samples = {}
    for name, written in sorted(map(tuple, rows)):
        samples.setdefault(name, []).append(written.encode())
    return Model(samples)


def identify(df: DataFrame, model: Model, key="doc_id", text="text") -> DataFrame:
    """``(key, lang_pred, score, bits_per_byte)``, one row per input row.

    The language of the shortest code wins, the first by name among equals. ``score`` is its
    share of the probabilities that all languages' models give the text; ``bits_per_byte`` is
    the length of its code over that of the text. Null texts, texts without a letter, and all texts if
    nothing was learned, are ``und`` with score 0 and no rate.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("bits_per_byte", T.DoubleType())]

    def make():
        known = shared.value

        def apply(texts):
            plain = texts.to_pylist()
            usable = [bool(t and known.languages) and has_letter(t) for t in plain]
            some = [t for t, u in zip(plain, usable) if u]
            bits = known.code_lengths(some)
            names, scores, rates = [UNKNOWN] * len(plain), np.zeros(len(plain)), [None] * len(plain)
            at = np.flatnonzero(usable)
            if len(at):
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(at)), best]
                scores[at] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                for i, b, n, t in zip(at.tolist(), best.tolist(), least.tolist(), some):
                    names[i], rates[i] = known.languages[b], n / len(t)
            return [pa.array(names), pa.array(scores), pa.array(rates, pa.float64())]
        return apply

    return map_texts(df, text, [key], fields, make)
