import math

import numpy as np
from pyspark.sql import functions as F

from barloom.llm import language
from barloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain_bits(texts, text):
    """Code length of a text by the same rules, one byte and one context at a time."""
    counts = {}
    for t in texts:
        t = language.START + t
        for i in range(language.ORDER, len(t)):
            for k in range(language.ORDER + 1):
                symbols = counts.setdefault((k, t[i - k:i]), {})
                symbols[t[i]] = symbols.get(t[i], 0) + 1
    text, bits = language.START + text, 0.0
    for i in range(language.ORDER, len(text)):
        for k in range(language.ORDER, -1, -1):
            symbols = counts.get((k, text[i - k:i]))
            if not symbols:
                continue
            total, different = sum(symbols.values()), len(symbols)
            if text[i] in symbols:
                bits -= math.log2(symbols[text[i]] / (total + different))
                break
            bits -= math.log2(different / (total + different))
        else:
            bits += 8
    return bits


def test_code_lengths_match_a_plain_version():
    samples = {"aa": [b"the cat sat on the mat", b"the hat"], "bb": ["le chat était là".encode(), b"la la la"]}
    model = language.Model(samples)
    texts = [b"the chat", b"xyz", b"", "là bas".encode(), b"the cat sat on the mat" * 20]
    found = model.code_lengths(texts)
    expected = [[plain_bits(samples[name], t) for name in model.languages] for t in texts]
    assert np.allclose(found, expected, rtol=1e-5)


def test_pieces_of_a_long_text_add_up(monkeypatch):
    model = language.Model({"aa": [b"abcabcabd" * 5], "bb": [b"xyz"]})
    whole = model.code_lengths([b"abcabd" * 300, b"abc"])
    monkeypatch.setattr(language, "PIECE", 7)
    assert np.allclose(model.code_lengths([b"abcabd" * 300, b"abc"]), whole)


def test_index_finds_keys_and_nothing_else():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000))
    index = language.Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys[:-1][np.diff(keys) > 1] + 1) == -1).all()
    assert (language.Index(keys[:0]).find(keys) == -1).all()


def test_documents(spark, docs):
    english, french = "the cat sat on the mat with the hat ", "le chat était là sur la table "
    rows = [(i, t * 3) for i, t in enumerate([english, french] * 20)]
    lang = F.when(F.col("text").startswith("the"), "en").otherwise("fr")
    model = language.train(docs(rows).withColumn("lang", lang))
    assert model.languages == ["en", "fr"]
    asked = [(1, "the mat"), (2, "la table"), (2, "la table"), (3, None), (4, ""), (5, "123 !"), (None, "the hat"),
             (6, english * 40_000), (7, "😀")]
    found = {(r.doc_id, r.lang_pred) for r in language.identify(docs(asked), model).collect()}
    assert found == {(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (6, "en"), (7, "und")}
    rows = language.identify(docs(asked), model).collect()
    assert len(rows) == len(asked) and all(0 <= r.score <= 1 for r in rows)
    assert language.identify(docs([]), model).count() == 0
    nothing = language.train(docs([]))
    assert {r.lang_pred for r in language.identify(docs(asked), nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    found = QUERIES["op5_language"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    scored = found.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert scored.first()[0] > 0.98


def test_languages_of_long_texts_alone(docs, monkeypatch):
    english, french = "the cat sat on the mat with the hat ", "le chat était là sur la table "
    rows = [(i, english * 3 if i % 2 else f"{french * 900}{i}") for i in range(40)]
    df = docs(rows).withColumn("lang", F.when(F.col("text").startswith("the"), "en").otherwise("fr"))
    sampled = []
    monkeypatch.setattr(language.Model, "_count", lambda own, texts, count=language.Model._count: (sampled.extend(texts), count(own, texts))[1])
    model = language.train(df)
    assert model.languages == ["en", "fr"]
    long_ones = [t.decode() for t in sampled if len(t) > 10_000]
    assert len(long_ones) == 20 and {len(t) for t in long_ones} == {language.SAMPLE_CHARS}
    assert len({t[:40] for t in long_ones}) > 5 and sum(t in dict(rows)[0] + dict(rows)[2] for t in long_ones) > 10
    found = {r.doc_id: r.lang_pred for r in language.identify(docs([*rows[:2], (100, "la table"), (101, "the hat")]), model).collect()}
    assert found == {0: "fr", 1: "en", 100: "fr", 101: "en"}


def test_number_signs_are_no_letters(docs, spark):
    model = language.train(docs([(i, "plain words of one language") for i in range(9)]))
    rows = [(1, "½ ² Ⅷ ①"), (2, "12 !"), (3, "½ a"), (4, "ǅ ʰ ª"), (5, "漢")]
    found = {r.doc_id: r for r in language.identify(docs(rows), model).collect()}
    assert [found[d].lang_pred == "und" for d in range(1, 6)] == [True, True, False, False, False]
    assert found[1].score == 0 and found[1].bits_per_byte is None


def test_many_languages_share_the_sample(spark):
    df = spark.createDataFrame([(i, f"some text {i}", f"l{i % 50:02}") for i in range(2000)], "doc_id INT, text STRING, lang STRING")
    model = language.train(df, documents=40, total=200)
    assert len(model.languages) >= 45
    assert len(language.train(df, documents=40, total=10**6).languages) == 50
