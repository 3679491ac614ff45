"""Text quality: random-indexing word vectors pooled per document, and a two-layer network."""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.texts import cut, map_texts

BUCKETS = 1 << 14
DIMENSIONS = 32
ONES = 4
NEIGHBOURS = 2
SAMPLE_LABELS = 20_000
HIDDEN = 32
EPOCHS = 60
BATCH = 128
RATE = 0.01
CALIBRATION = 5
MEMO_WORDS = 250_000
PIECE_WORDS = 1 << 16
#: A word, a number's digits or a run of marks; a word in capitals differs from one in small letters.
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def index_vectors(buckets=BUCKETS, dimensions=DIMENSIONS, ones=ONES) -> np.ndarray:
    """A fixed sparse vector of ``ones`` entries of 1 or -1 for each bucket of words, and a zero one
    for the blanks between texts."""
    random = np.random.default_rng(7)
    rows = np.zeros((buckets + 1, dimensions), np.int32)
    places = np.argsort(random.random((buckets, dimensions)), axis=1)[:, :ones]
    rows[np.arange(buckets)[:, None], places] = random.choice([-1, 1], (buckets, ones))
    return rows


class _Buckets(dict):
    """Word to bucket, remembered up to a bound."""

    def __missing__(self, word):
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = bucket = xxhash.xxh32_intdigest(word.encode("utf-8", "replace")) % BUCKETS
        return bucket


def _coded(text: bytes | None, buckets: dict) -> np.ndarray:
    found = TOKEN.findall((text or b"").decode("utf-8", "replace"))
    return np.fromiter(map(buckets.__getitem__, found), np.int64, len(found))


def context_sums(df: DataFrame, text="text") -> DataFrame:
    """``(bucket, n, sums)``: over all texts, the words of each bucket and the summed index vectors of
    the ``NEIGHBOURS`` words on either side. A task sums its texts before anything is shuffled."""
    chosen = df.select(F.col(text).cast("string").cast("binary"))

    def run(batches):
        index, buckets = index_vectors(), _Buckets()
        sums, counts = np.zeros((BUCKETS, DIMENSIONS), np.int64), np.zeros(BUCKETS, np.int64)
        blank = np.full(NEIGHBOURS, BUCKETS)
        for batch in batches:
            for piece in cut(batch):
                parts = [p for t in piece.column(0).to_pylist() for p in (_coded(t, buckets), blank)]
                words = np.concatenate([blank, *parts])
                counts += np.bincount(words, minlength=BUCKETS + 1)[:BUCKETS]
                for at in range(NEIGHBOURS, len(words) - NEIGHBOURS, PIECE_WORDS):
                    _add_contexts(words[at - NEIGHBOURS:at + PIECE_WORDS + NEIGHBOURS], index, sums)
        seen = np.flatnonzero(counts)
        flat = pa.array(sums[seen].reshape(-1))
        edges = pa.array(np.arange(0, len(flat) + 1, DIMENSIONS, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(counts[seen]), pa.ListArray.from_arrays(edges, flat)], names=["bucket", "n", "sums"])

    partial = chosen.mapInArrow(run, "bucket BIGINT, n BIGINT, sums ARRAY<BIGINT>")
    columns = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(DIMENSIONS)]
    summed = partial.groupBy("bucket").agg(F.sum("n").alias("n"), *columns)
    return summed.select("bucket", "n", F.array(*[f"s{i}" for i in range(DIMENSIONS)]).alias("sums"))


def _add_contexts(words, index, sums):
    """Add to each word but the outermost the index vectors of its neighbours; blanks part the texts."""
    vectors = index[words]
    inner = words[NEIGHBOURS:-NEIGHBOURS]
    around = np.zeros((len(inner), DIMENSIONS), np.int32)
    for step in range(2 * NEIGHBOURS + 1):
        if step != NEIGHBOURS:
            around += vectors[step:step + len(inner)]
    real = np.flatnonzero(inner < BUCKETS)
    # Sorted by word, so that each word's rows are added in one go.
    real = real[np.argsort(inner[real], kind="stable")]
    if len(real):
        starts = np.flatnonzero(np.diff(inner[real], prepend=-1))
        sums[inner[real[starts]]] += np.add.reduceat(around[real], starts, axis=0)


@dataclass
class Model:
    """Word vectors by bucket, the network's weights, input scaling and temperature."""

    vectors: np.ndarray
    shares: np.ndarray
    weights: list | None = None
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    temperature: float = 1.0

    def pooled(self, text: bytes | None, buckets: dict) -> np.ndarray:
        """Mean and length of the mean word vector; spread; and how often words repeat."""
        words = _coded(text, buckets)
        if not len(words):
            return np.zeros(2 * DIMENSIONS + 6)
        counted, n = np.unique(words, return_counts=True)
        vectors, share = self.vectors[counted], n / len(words)
        mean = share @ vectors
        deviation = np.sqrt(np.maximum(0, share @ vectors ** 2 - mean ** 2))
        same = np.mean(words[1:] == words[:-1]) if len(words) > 1 else 0.0
        rest = [np.linalg.norm(mean), np.log1p(len(words)), len(counted) / len(words), np.sum(share ** 2), same,
                share @ self.shares[counted]]
        return np.concatenate([mean, deviation, rest])

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1; one half if nothing was learned."""
        if self.weights is None:
            return np.full(len(pooled), 0.5)
        _, margins = _forward(self.weights, (pooled - self.centre) / self.spread)
        return 1 / (1 + np.exp(-np.clip(margins / self.temperature, -500, 500)))


def word_vectors(df: DataFrame, text="text") -> Model:
    """Vectors of unit length from the contexts in all texts; frequent words count for less when pooled."""
    vectors, counts = np.zeros((BUCKETS, DIMENSIONS)), np.zeros(BUCKETS)
    for bucket, n, sums in context_sums(df, text).toLocalIterator():
        vectors[bucket], counts[bucket] = sums, n
    mean = vectors.sum(axis=0) / max(1, counts.sum())
    vectors = np.where(counts[:, None] > 0, vectors / np.maximum(counts, 1)[:, None] - mean, 0)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return Model(vectors, np.log1p(counts) / max(1e-9, np.log1p(counts.sum())))


def _forward(weights, x):
    first, bias, second, last = weights
    hidden = np.maximum(0, x @ first + bias)
    return hidden, hidden @ second + last


def fit(model: Model, pooled: np.ndarray, labels: np.ndarray, held: np.ndarray) -> Model:
    """Train the network on the rows not ``held`` by Adam, then set the temperature on the others."""
    x, y = pooled[~held], labels[~held].astype(float)
    if not len(x) or y.min() == y.max():
        return model
    model.centre, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - model.centre) / model.spread
    random = np.random.default_rng(11)
    weights = [random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
               random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(())]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = random.permutation(len(x))
        for at in range(0, len(x), BATCH):
            some = order[at:at + BATCH]
            hidden, margins = _forward(weights, x[some])
            error = (1 / (1 + np.exp(-np.clip(margins, -500, 500))) - y[some]) / len(some)
            back = error[:, None] * weights[2] * (hidden > 0)
            slopes = [x[some].T @ back, back.sum(axis=0), hidden.T @ error, error.sum()]
            step += 1
            for k, slope in enumerate(slopes):
                slope = slope + 1e-4 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope ** 2
                move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                weights[k] = weights[k] - RATE * move
    model.weights = weights
    if held.any():
        _, margins = _forward(weights, (pooled[held] - model.centre) / model.spread)
        truth = labels[held].astype(float)

        def loss(temperature):
            z = np.clip(margins / temperature, -500, 500)
            return np.mean(np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - truth * z)
        model.temperature = min(np.exp(np.linspace(-2, 3, 101)), key=loss)
    return model


def train(df: DataFrame, labels: DataFrame, key="doc_id", text="text", label="quality",
          sample=SAMPLE_LABELS) -> Model:
    """Word vectors from all texts of ``df``, and a network from about ``sample`` labelled texts.

    Labels are taken by a hash of their key at a rate that follows from their number; each key has the
    smallest of its labels, and labels other than 0 and 1 are left out. The different texts of those
    keys are counted and taken by a hash of key and text in the same way, each once however
    many rows hold it, so no key fills the driver.
    """
    model = word_vectors(df, text)
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).where("_label IN (0, 1)")
    known = known.where("_key IS NOT NULL").groupBy("_key").agg(F.min("_label").alias("_label"))
    total = known.count()
    chance = F.pmod(F.xxhash64("_key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = known.where(chance < (sample / total if total else 0.0))
    # About ``sample`` rows of two numbers, whatever the size of the tables.
    whole = df.select(F.col(key).alias("_own"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    met = whole.join(F.broadcast(some), F.col("_own") == F.col("_key")).drop("_own")
    different = met.select("_key", "_hash").distinct().count()
    chance = F.pmod(F.xxhash64("_key", "_hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = met.where(chance < (sample / different if different else 0.0))
    # Copies meet in each task first, so a text of many rows is shuffled once a task and pooled once.
    rows = chosen.groupBy("_key", "_label", "_hash").agg(F.first("_text").alias("_text"))
    fields = [T.StructField("pooled", T.ArrayType(T.DoubleType()))]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        buckets = _Buckets()

        def apply(texts):
            return [pa.array([shared.value.pooled(t, buckets).tolist() for t in texts.to_pylist()], pa.list_(pa.float64()))]
        return apply

    found = sorted(map_texts(rows, "_text", ["_key", "_label"], fields, make).collect(), key=lambda r: (str(r[0]), r[2]))
    if not found:
        return model
    held = np.array([xxhash.xxh32_intdigest(str(r[0])) % CALIBRATION == 0 for r in found])
    return fit(model, np.array([r.pooled for r in found]), np.array([r[1] for r in found]), held)


def score(df: DataFrame, model: Model, key="doc_id", text="text") -> DataFrame:
    """``(key, score)``, one row per input row: the calibrated probability of label 1.

    Null and empty texts are scored as texts without words; repeated rows and null keys are kept.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        buckets = _Buckets()

        def apply(texts):
            pooled = np.array([shared.value.pooled(t, buckets) for t in texts.to_pylist()])
            return [pa.array(shared.value.scores(pooled))]
        return apply

    return map_texts(df, text, [key], [T.StructField("score", T.DoubleType())], make)
