import numpy as np
from pyspark.sql import functions as F

from barloom.llm import quality
from barloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_context_sums_match_a_plain_version(spark, docs):
    texts = ["a b a c", "b", None, "", "a, b!! b"]
    found = {r.bucket: (r.n, list(r.sums)) for r in quality.context_sums(docs(list(enumerate(texts)))).collect()}
    index, buckets, expected = quality.index_vectors(), quality._Buckets(), {}
    for text in texts:
        words = [buckets[w] for w in quality.TOKEN.findall(text or "")]
        for i, w in enumerate(words):
            n, sums = expected.get(w, (0, np.zeros(quality.DIMENSIONS, int)))
            near = [words[j] for j in range(max(0, i - 2), min(len(words), i + 3)) if j != i]
            expected[w] = n + 1, sums + index[near].sum(axis=0)
    assert found == {w: (n, s.tolist()) for w, (n, s) in expected.items()}


def test_network_learns_and_is_calibrated():
    random = np.random.default_rng(1)
    x = random.normal(size=(3000, 6))
    chance = 1 / (1 + np.exp(-(x[:, 0] - x[:, 1])))
    labels, held = (random.random(3000) < chance).astype(int), np.arange(3000) % 3 == 0
    model = quality.fit(quality.Model(np.zeros((1, 1)), np.zeros(1)), x, labels, held)
    scores = model.scores(x)[held]
    assert ((scores > 0.5) == (chance[held] > 0.5)).mean() > 0.85 and np.abs(scores - chance[held]).mean() < 0.12


def test_documents(spark, docs):
    good, bad = "the cat sat on the mat, and so on.", "BUY!! BUY!! NOW!!"
    rows = [(i, good + f" word{i}" if i % 2 else bad * (1 + i % 3)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1, 1), (None, 1), (3, None), (999, 0)], "doc_id BIGINT, quality INT")
    model = quality.train(docs(rows), labels)
    asked = [(1, good), (2, bad), (3, None), (4, ""), (None, good), (5, good * 20_000), (6, good), (6, good)]
    found = quality.score(docs(asked), model).collect()
    scores = {r.doc_id: r.score for r in found}
    assert len(found) == len(asked) and all(0 <= s <= 1 for s in scores.values())
    assert scores[1] > 0.7 > 0.3 > scores[2] and scores[3] == scores[4] and scores[None] == scores[1]
    assert quality.score(docs([]), model).count() == 0
    nothing = quality.train(docs([]), labels)
    assert {r.score for r in quality.score(docs(asked), nothing).collect()} == {0.5}


def test_held_out_labels(spark):
    found = QUERIES["op1_quality"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    rows = found.join(truth, "doc_id").where("held_out").select(F.col("score"), F.col("quality")).collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_training_rows_are_bounded(spark, docs, monkeypatch):
    good, bad = "the cat sat on the mat, and so on.", "BUY!! BUY!! NOW!!"
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id BIGINT, quality INT")
    seen, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a: (seen.append(len(a[2])), fit(*a))[1])
    rows = [(i, (good if i % 2 else bad) + f" word{i}") for i in range(100)]
    # Copies of one key count once.
    quality.train(docs(rows + [rows[0]] * 3000), labels)
    # Of a key with many texts, as many are taken as the sample allows.
    quality.train(docs(rows + [(1, f"{good} other{i}") for i in range(3000)]), labels, sample=200)
    assert seen[0] == 100 and 120 < seen[1] < 280


def test_pooled_features_match_a_plain_version():
    random = np.random.default_rng(4)
    model = quality.Model(random.normal(size=(quality.BUCKETS, quality.DIMENSIONS)), random.random(quality.BUCKETS))
    buckets = quality._Buckets()
    for text in ["a b a c", "One, two!! two two 22 _ é", "x", "", None, " \n "]:
        words = [buckets[w] for w in quality.TOKEN.findall(text or "")]
        got = model.pooled(text and text.encode(), buckets)
        if not words:
            assert not got.any() and len(got) == 2 * quality.DIMENSIONS + 6
            continue
        n = len(words)
        mean = sum(model.vectors[w] for w in words) / n
        spread = np.sqrt(np.maximum(0, sum(model.vectors[w] ** 2 for w in words) / n - mean ** 2))
        rest = [np.sqrt((mean ** 2).sum()), np.log(1 + n), len(set(words)) / n, sum((words.count(w) / n) ** 2 for w in set(words)),
                sum(a == b for a, b in zip(words, words[1:])) / max(1, n - 1), sum(model.shares[w] for w in words) / n]
        assert np.allclose(got, [*mean, *spread, *rest])


def test_scores_match_a_plain_network():
    random = np.random.default_rng(5)
    width = 2 * quality.DIMENSIONS + 6
    weights = [random.normal(size=(width, 3)), random.normal(size=3), random.normal(size=3), random.normal()]
    model = quality.Model(np.zeros((1, 1)), np.zeros(1), weights, random.normal(size=width), random.random(width) + 0.5, 1.7)
    rows = random.normal(size=(20, width))
    for row, score in zip(rows, model.scores(rows)):
        x = [(v - c) / s for v, c, s in zip(row, model.centre, model.spread)]
        hidden = [max(0.0, sum(a * w for a, w in zip(x, weights[0][:, k])) + weights[1][k]) for k in range(3)]
        margin = sum(h * w for h, w in zip(hidden, weights[2])) + weights[3]
        assert abs(score - 1 / (1 + np.exp(-margin / 1.7))) < 1e-9
