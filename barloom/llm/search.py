"""Ranked lexical search: best-first document intervals bounded by range maxima of posting lists.

Documents are dealt to shards. A shard keeps, for each term of the queries, the list of its documents in
ascending order with their impacts, and a sparse table that gives the largest impact of any range of
the list. A query bounds an interval of documents by the weighted sum of its terms' range maxima. The
interval of the largest bound is split at the document of its largest single impact, which is
scored; what remains on both sides is bounded anew, until no bound reaches the best scores found.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.storage import stored
from barloom.llm.texts import map_texts

TOP = 50
#: Postings of a shard, about; a shard holds whole documents.
SHARD_POSTINGS = 1 << 20
#: Bytes of distinct query texts that are searched at once; more are searched one block after the other.
QUERY_BYTES = 8 << 20
#: Intervals split at once.
SPLITS = 64
PIECE_BYTES = 4 << 20
SALTS = 64

#: Letters, digits and all bytes of other characters stay, A-Z in lower case; the rest parts terms.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def terms_of(text: bytes):
    """Lists of the terms of a text, some megabytes at a time."""
    spaced, at = text.translate(LETTERS), 0
    while at < len(spaced):
        gap = spaced.find(b" ", at + PIECE_BYTES)
        end = len(spaced) if gap < 0 else gap
        yield spaced[at:end].split()
        at = end


def postings(df: DataFrame, vocabulary: dict[bytes, int], key="doc_id", text="text") -> DataFrame:
    """``(key, n, terms, counts)``: number of a document's terms, and how often it has which of the vocabulary."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        known = shared.value
        names = known.keys()

        def one(text):
            counts, n = Counter(), 0
            for found in terms_of(text or b""):
                n += len(found)
                counts.update(found)
            some = sorted((known[t], counts[t]) for t in counts.keys() & names)
            return n, some

        def apply(texts):
            rows = [one(t) for t in texts.to_pylist()]
            ends = np.cumsum([0, *[len(s) for _, s in rows]], dtype=np.int32)
            flat = np.array([p for _, s in rows for p in s], np.int64).reshape(-1, 2)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[:, i].astype(k))) for i, k in ((0, np.int32), (1, np.int64))]
            return [pa.array([n for n, _ in rows], pa.int64()), *lists]
        return apply

    fields = [T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
              T.StructField("counts", T.ArrayType(T.LongType()))]
    return map_texts(df, text, [key], fields, make)


class Shard:
    """Posting lists of some documents with their sparse tables.

    ``lengths`` and ``sizes`` give each document's number of terms and of postings, which are consecutive in
    ``terms`` and ``counts``; ``norm`` turns lengths into length factors.
    """

    def __init__(self, lengths, sizes, terms, counts, norm):
        self.size = len(lengths)
        terms = terms.astype(np.int64)
        owner = np.repeat(np.arange(self.size), sizes)
        order = np.lexsort((owner, terms))
        self.owner = owner[order]
        # One ascending number per posting, by term and then document: a place is found by one search.
        self.places = terms[order] * self.size + self.owner
        tf = counts[order]
        self.impact = 1_000_000_000 * tf // (1000 * tf + 20 * norm(lengths[self.owner]))
        best = np.arange(len(order), dtype=np.int32)
        self.levels = [best]
        width = 1
        longest = np.bincount(terms).max(initial=0)
        while 2 * width <= longest:
            # Ranges that reach into the next list are made too, and never asked for.
            low, high = best[:-width], best[width:]
            best = np.concatenate([np.where(self.impact[high] > self.impact[low], high, low), best[len(low):]])
            self.levels.append(best)
            width *= 2
        self.levels = np.stack(self.levels)

    def lists(self, terms):
        """First and last place of each term's list."""
        return (np.searchsorted(self.places, terms * self.size), np.searchsorted(self.places, (terms + 1) * self.size))

    def maxima(self, first, last):
        """The place of the largest impact in each range, which is not empty, by two ranges that cover it."""
        level = np.frexp(last - first)[1] - 1
        a, b = self.levels[level, first], self.levels[level, last - (1 << level)]
        return np.where(self.impact[b] > self.impact[a], b, a)

    def search(self, terms, weights, least, top):
        """Batches of ``(documents, scores)`` that hold every document whose score is positive, reaches
        ``least``, and is among the ``top`` largest scores, equal ones included."""
        first, last = self.lists(terms)
        some = first < last
        terms, weights = terms[some], weights[some]
        bounds, places, firsts, lasts = self._bounded(first[some][None], last[some][None], weights)
        best = np.full(top, max(1, least), np.int64)
        splits = 4
        while len(bounds):
            least = best[0]
            alive = bounds >= least
            if not alive.all():
                bounds, places, firsts, lasts = bounds[alive], places[alive], firsts[alive], lasts[alive]
            if len(bounds) > splits:
                order = np.argpartition(bounds, len(bounds) - splits)
                chosen, rest = order[-splits:], order[:-splits]
            else:
                chosen, rest = np.arange(len(bounds)), np.zeros(0, np.int64)
            if not len(chosen):
                break
            splits = min(SPLITS, 2 * splits)
            documents = self.owner[places[chosen]]
            first, last = firsts[chosen], lasts[chosen]
            wanted = terms * self.size + documents[:, None]
            at = np.searchsorted(self.places, wanted)
            at = np.minimum(np.maximum(at, first), last)
            held = at < last
            held[held] = self.places[at[held]] == wanted[held]
            scores = np.where(held, self.impact[np.minimum(at, len(self.impact) - 1)] * weights, 0).sum(axis=1)
            good = scores >= least
            if good.any():
                yield documents[good], scores[good]
                best = np.sort(np.concatenate([best, scores[good]]))[-top:]
            parts = [self._bounded(first, at, weights), self._bounded(at + held, last, weights)]
            bounds, places, firsts, lasts = (
                np.concatenate([old[rest], *new]) for old, new in zip((bounds, places, firsts, lasts), zip(*parts)))

    def _bounded(self, first, last, weights):
        """Intervals that hold a posting: upper bound, place of the largest single impact, and their ranges."""
        full = first < last
        some = full.any(axis=1)
        first, last, full = first[some], last[some], full[some]
        most = np.zeros(first.shape, np.int64)
        places = np.zeros(first.shape, np.int64)
        places[full] = self.maxima(first[full], last[full])
        most[full] = self.impact[places[full]]
        most *= weights
        split = places[np.arange(len(first)), np.where(full, most, -1).argmax(axis=1)] if len(first) else places[:, :0].sum(axis=1)
        return most.sum(axis=1), split, first, last


def _weights(counted: dict[int, int], documents: int) -> dict[int, int]:
    """The weight of each term by the number of documents that hold it."""
    return {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in counted.items()}


class _Pool:
    """Documents of a task until they make a shard; equal ones once, with their smallest keys.

    The best documents of each query so far give later shards their least score.
    """

    def __init__(self, queries, norm, top):
        self.queries, self.norm, self.top = queries, norm, top
        self.best = [[] for _ in queries]
        self._empty()

    def _empty(self):
        self.keys, self.lengths, self.terms, self.counts = {}, [], [], []
        self.size = 0

    def add(self, key, n, terms, counts):
        if not len(terms):
            return
        same = n, terms.tobytes(), counts.tobytes()
        keys = self.keys.get(same)
        if keys is None:
            keys = self.keys[same] = []
            self.lengths.append(n)
            self.terms.append(terms)
            self.counts.append(counts)
            self.size += len(terms)
        keys.append(key)
        if len(keys) > 4 * self.top:
            keys[:] = self._smallest(keys)
        if self.size >= SHARD_POSTINGS:
            self.search()

    def _smallest(self, keys):
        return sorted(keys, key=lambda k: (k is None, k))[:self.top]

    def search(self):
        if not self.size:
            return
        # Documents of like length have like length factors, which makes the maxima of intervals closer.
        order = sorted(range(len(self.lengths)), key=self.lengths.__getitem__)
        keys = list(self.keys.values())
        keys = [self._smallest(keys[i]) for i in order]
        terms = [self.terms[i] for i in order]
        shard = Shard(np.array([self.lengths[i] for i in order], np.int64), np.array([len(t) for t in terms]),
                      np.concatenate(terms), np.concatenate([self.counts[i] for i in order]), self.norm)
        self._empty()
        for i, (wanted, weights) in enumerate(self.queries):
            best = self.best[i]
            least = best[-1][0] if len(best) == self.top else 1
            found = [
                (score, key) for documents, scores in shard.search(wanted, weights, least, self.top)
                for document, score in zip(documents.tolist(), scores.tolist()) for key in keys[document]
            ]
            self.best[i] = sorted(best + found, key=lambda b: (-b[0], b[1] is None, b[1]))[:self.top]


def _candidates(found: DataFrame, key, queries, norm, top) -> DataFrame:
    """``(query, key, score)``: the best documents of each task for each query."""
    kind = found.schema[key].dataType
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("key", kind), T.StructField("score", T.LongType())])
    shared = found.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        pool, kind = _Pool(shared.value, norm, top), pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            terms, counts = batch.column(2), batch.column(3)
            edges, flat, times = terms.offsets.to_numpy(), terms.values.to_numpy(), counts.values.to_numpy()
            for own, n, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), edges.tolist(), edges[1:].tolist()):
                pool.add(own, n, flat[a:b].copy(), times[a:b].copy())
        pool.search()
        rows = [(i, own, score) for i, best in enumerate(pool.best) for score, own in best]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((),) * 3, (pa.int32(), kind, pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return found.mapInArrow(run, schema)


def _best(rows: DataFrame, by, top) -> DataFrame:
    """The ``top`` rows of each group with their ranks: higher scores first, then smaller keys, nulls last."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(df: DataFrame, queries: DataFrame, key="doc_id", text="text", query_key="item_id", query_text="text",
           top=TOP, query_bytes=QUERY_BYTES) -> DataFrame:
    """``(query_key, rank, key, score)``: the ``top`` documents of the highest positive scores for each query.

    Terms are runs of ASCII letters and digits and of all other characters, A-Z in lower case. A term of
    df documents weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))``, N counting the documents that have terms.
    A document with n of all L terms has the length factor ``50 + 50nN div L``; it scores the sum over a
    query's distinct terms of the weight times ``10^9 tf div (1000 tf + 20 factor)``. Equal scores go by ascending
    key, null keys last.

    Null and empty texts have no terms, are never found and find nothing. Rows that share a key or a text are
    documents of their own, and queries too. Keys may be of any ordered type. Only postings of the queries' terms are
    kept, one stored row per document; tasks search their own documents in shards of a bounded number of postings,
    and send on ``top`` rows a query. Equal query texts are searched once, ``query_bytes`` of texts at a time.
    """
    own = F.coalesce(F.col(query_text).cast("string"), F.lit(""))
    asked = queries.select(F.col(query_key).alias("asked"), F.sha2(own, 256).alias("name"), own.alias("own"))
    texts = stored(asked.select("name", "own").distinct())
    size = texts.agg(F.sum(F.octet_length("own"))).first()[0] or 0
    blocks = max(1, -(-size // query_bytes))
    found = []
    for block in range(blocks):
        part = texts.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == block).orderBy("name").collect()
        found.append(_search_block(df, [(r.name, r.own.encode()) for r in part], key, text, top))
    ranked = found[0]
    for more in found[1:]:
        ranked = ranked.union(more)
    return asked.select("asked", "name").join(ranked, "name").select(
        F.col("asked").alias(query_key), "rank", F.col("key").alias(key), "score")


def _search_block(df, texts, key, text, top) -> DataFrame:
    """``(name, rank, key, score)`` for the named query texts."""
    spark = df.sparkSession
    terms = [sorted({t for part in terms_of(own) for t in part}) for _, own in texts]
    vocabulary = {t: i for i, t in enumerate(sorted({t for own in terms for t in own}))}
    coded = stored(postings(df, vocabulary, key, text))
    documents, total = coded.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    # One row per term of the queries.
    counted = coded.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = _weights({r.term: r["count"] for r in counted}, documents)

    def norm(n):
        return 50 + 50 * n * documents // max(1, total)

    def weighted(own):
        known = [t for t in map(vocabulary.__getitem__, own) if weights.get(t)]
        return np.array(known, np.int64), np.array([weights[t] for t in known], np.int64)

    # Tasks of a shard each, whatever the size of the files they come from.
    shards = -(-sum(r["count"] for r in counted) // SHARD_POSTINGS)
    dealt = coded.repartition(shards) if shards > coded.rdd.getNumPartitions() else coded
    rows = _candidates(dealt, key, [weighted(own) for own in terms], norm, top)
    # Twice, so that no task gets what all others found for a query.
    first = _best(rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS))), ["query", "salt"], top)
    best = _best(first.drop("rank", "salt"), ["query"], top)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(texts)], "query INT, name STRING")
    return stored(best).join(names, "query").select("name", "rank", "key", "score")
