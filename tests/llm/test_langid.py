import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import langid, queries

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score int"
STEMS = {"xx": ["tion", "the", "ing", "and"], "yy": ["żółć", "się", "cie", "nie"], "zz": ["のこと", "です", "ます", "した"]}


def made_up(rng, lang, n):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randrange(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    rows = [(made_up(rng, lang, 30), lang) for lang in STEMS for _ in range(60)]
    rng.shuffle(rows)
    return langid.train([t for t, _ in rows], [x for _, x in rows], [i % 5 == 0 for i in range(len(rows))])


def test_held_out_accuracy(spark):
    result = queries.op9_language_id(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = result.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert len(held) > 250 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.02


def test_scores_are_calibrated(spark):
    """On held-out documents, the mean score is close to the share that is right."""
    result = queries.op9_language_id(spark, SF_DIR).filter("held_out")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    row = result.join(docs, "doc_id").agg(F.avg("score").alias("s"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("r")).first()
    assert abs(row.s - row.r) < 0.03


def test_the_fold_and_null_labels_are_never_learned_from(spark):
    rows = [(i, "abc def", "en") for i in range(300)] + [(None, "ghi", "no id"), (1000, "x", None), (1001, None, "no text")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    marked = docs.withColumn("lang", F.when(queries.held_out(), "leak").otherwise(F.col("lang")))
    assert langid.fit(marked, usable=~queries.held_out()).languages == ["en"]


def test_subwords_stay_inside_words():
    lower = langid.alphabet()
    codes = langid.letters("Ab, c1É", lower)
    assert codes.tolist() == [0, ord("a"), ord("b"), 0, ord("c"), 0, ord("é"), 0]
    alone = [set(langid.subwords(langid.letters(w, lower)).tolist()) for w in ("ab", "c", "é")]
    assert set(langid.subwords(codes).tolist()) == set.union(*alone)


def test_long_texts_are_read_in_blocks(model, monkeypatch):
    text = made_up(random.Random(2), "yy", 3000)
    whole = model.logits(text)
    monkeypatch.setattr(langid, "BLOCK", 500)
    blocks = model.logits(text)
    assert np.allclose(whole, blocks, atol=0.05) and whole.argmax() == blocks.argmax()


def test_prediction_equals_mean_embedding(model):
    text = made_up(random.Random(3), "zz", 20)
    found = langid.subwords(langid.letters(text, model.lower))
    logits = np.mean([model.table[b] for b in found], axis=0) + model.bias
    p = np.exp(logits / model.temperature) / np.exp(logits / model.temperature).sum()
    lang, score, rejected = model.predict(text)
    assert lang == "zz" and score == pytest.approx(p.max(), rel=1e-5) and not rejected


def test_texts_without_letters(model):
    for text in (None, "", " \n", "123 !?", "🙂"):
        assert model.predict(text) == ("und", 0.0, True)


def test_rejection_threshold_gives_the_precision():
    model = langid.LanguageModel(["a", "b"], langid.alphabet(), np.array([[4.0, 0], [0, 4], [0.6, 0]]), np.zeros(2), 1.0, 0.5)
    grams = [np.array([0])] * 40 + [np.array([1])] * 40 + [np.array([2])] * 20
    target = np.array([0] * 40 + [1] * 40 + [0, 1] * 10)
    fitted = langid.calibrate(model, grams, target)
    logits = model.table[2] / fitted.temperature
    assert fitted.threshold > np.exp(logits.max()) / np.exp(logits).sum()


@pytest.mark.parametrize("wrong", [0.0, 0.04, 0.06, 0.08, 0.15, 0.3])
def test_noisy_labels_reject_no_clean_documents(spark, wrong):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = ["de", "en", "es", "fr"]
    at = F.pmod(F.xxhash64("doc_id"), F.lit(10_000))
    other = F.element_at(F.array(*map(F.lit, names)), (1 + F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(4))).cast("int"))
    noisy = docs.withColumn("lang", F.when(at < F.lit(10_000 * wrong * 4 / 3), other).otherwise(F.col("lang")))
    kept = langid.accepted(noisy, langid.fit(noisy))
    assert kept.count() >= 0.95 * docs.count()


def test_only_low_ranks_of_a_hot_label_are_shuffled(spark):
    rows = [(i, f"text number {i}", "en" if i % 20 else "fr", 0) for i in range(6000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    sample = langid.training_sample(docs, "doc_id", "text", "lang", F.lit(True), per_language=100)
    whole = langid._low_ranks
    got = sorted(map(tuple, sample.collect()))
    assert len(got) == 2 * 100 * len(langid.PIECES)
    langid._low_ranks = lambda *_: F.lit(True)
    try:
        sample = langid.training_sample(docs, "doc_id", "text", "lang", F.lit(True), per_language=100)
        assert got == sorted(map(tuple, sample.collect()))
    finally:
        langid._low_ranks = whole
    rank = F.xxhash64(F.lit(langid.SEED), F.col("doc_id").cast("string"), F.length("text"))
    passed = docs.filter(langid._low_ranks(docs, rank, F.col("lang"), 100)).groupBy("lang").count().collect()
    assert all(100 <= r["count"] <= 300 for r in passed)


def test_table_rows(spark, model):
    rng = random.Random(5)
    rows = [(1, made_up(rng, "xx", 9), None), (2, None, "xx"), (2, None, "xx"), (None, "", None), (3, made_up(rng, "yy", 9), "?")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(2)
    got = sorted((r.doc_id or 0, r.lang_pred) for r in langid.identify(docs, model, also=("doc_id",)).collect())
    assert got == [(0, "und"), (1, "xx"), (2, "und"), (2, "und"), (3, "yy")]
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 3}
    with pytest.raises(ValueError, match="score"):
        langid.identify(docs, model, also=("doc_id", "score"))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    model = langid.fit(docs)
    assert model.languages == [] and model.predict("text") == ("und", 0.0, True)
    assert langid.identify(docs, model, also=("doc_id",)).count() == 0 and langid.accepted(docs, model).count() == 0


def test_one_language_only(spark):
    docs = spark.createDataFrame([(i, "some text here", "en", 1) for i in range(20)], SCHEMA)
    assert langid.fit(docs).predict("other text")[:2] == ("en", 1.0)
