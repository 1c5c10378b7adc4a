"""The fitted operators: held-out quality on the driver's tables, and defined results on odd rows."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import common, language, quality, queries, toxicity

from .conftest import prose, same_rows


def area(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    label = np.asarray(label)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.fixture(scope="module")
def larger(data):
    return data.replace("sf0.001", "sf0.01")


def held_out(spark, name, sf, label, fold, value):
    got = queries.queries()[name](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col(label).alias("label")), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold == value) and 0 <= r.score <= 1
    return [r for r in rows if r.held_out]


def test_quality(spark, larger):
    rows = held_out(spark, "op1_quality_classifier", larger, "quality", 5, 0)
    assert area([r.score for r in rows], [r.label for r in rows]) > 0.93
    assert np.mean([r.predicted == r.label for r in rows]) > 0.93 and all(r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity(spark, larger):
    rows = held_out(spark, "op8_toxicity", larger, "toxic", 3, 1)
    assert np.mean([r.predicted == r.label for r in rows]) > 0.93 and all(r.predicted == (r.score >= 0.7) for r in rows)


def test_toxicity_recall(spark):
    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("no larger tables here")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").join(labels.select("doc_id", "toxic"), "doc_id")
    rows = [r for r in toxicity.score_toxicity(docs, labels).select("doc_id", "toxic", "toxicity.score").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    hit = sum(r.toxic == 1 and r.score >= toxicity.REJECT for r in rows)
    assert hit >= 0.9 * sum(r.toxic for r in rows) > 100 and hit >= 0.98 * sum(r.score >= toxicity.REJECT for r in rows)


def test_language(spark, larger):
    rows = queries.op6_language_id(spark, larger).join(spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) > 0.95


def test_odd_rows(spark, odd, empty, labels):
    none = labels.where("false")
    for f in (quality.score_quality, toxicity.score_toxicity):
        got = f(odd, labels)
        assert same_rows(odd, got) and f(odd, none).count() == odd.count() and f(empty, labels).count() == 0
    scores = quality.score_quality(odd, labels, out="score")  # a clash: the operator's column replaces it
    assert scores.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert len({r.score for r in scores.where("trim(text) = '' OR text IS NULL OR doc_id = 5").collect()}) == 1
    got = {(r.doc_id, r.text): r.language for r in language.identify(odd.withColumn("language", F.lit(3))).collect()}
    assert all(v.lang_pred == "und" and v.score == 0 for (_, t), v in got.items() if not t or not t.strip())
    assert all(v.lang_pred in ("en", "de", "xx", "und") for v in got.values())
    assert language.identify(empty).count() == 0
    assert {r.language.lang_pred for r in language.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_forward_backward_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        emit, trans = rng.normal(size=(1, n)), rng.normal(size=(2, 2))
        weight = {y: np.exp(sum(emit[0, i] * y[i] for i in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:]))) for y in product((0, 1), repeat=n)}
        total = sum(weight.values())
        want = [sum(v for y, v in weight.items() if y[i]) / total for i in range(n)]
        pairs = np.zeros((2, 2))
        for y, v in weight.items():
            for a, b in zip(y, y[1:]):
                pairs[a, b] += v / total
        got, seen = toxicity.forward_backward(emit, np.array([n]), trans, True)
        np.testing.assert_allclose(got[0], want, atol=1e-9)
        np.testing.assert_allclose(seen, pairs, atol=1e-9)


def test_padding_makes_no_difference():
    rng = np.random.default_rng(2)
    tagger = toxicity.Tagger(rng.normal(size=toxicity.FEATURES), rng.normal(size=(2, 2)))
    texts = [prose(i, n) for i, n in enumerate((1, 50, 3000, 0, 7))]
    together, _ = tagger.marginals(texts)
    for t, m in zip(texts, together):
        np.testing.assert_allclose(m, tagger.marginals([t])[0][0], atol=1e-12)


def test_toxic_spans_point_at_words(spark):
    docs = [(i, prose(i, 30) + (" vile, Vile! " if i % 3 == 0 else " kind ") + prose(i + 99, 5)) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(df, labels).collect()
    assert all((r.toxicity.score >= 0.7) == (r.doc_id % 3 == 0) for r in rows)
    for r in rows:
        if r.doc_id % 3 == 0:
            assert any("vile" in r.text[s.start : s.end].lower() for s in r.toxicity.spans)


def test_context_vectors_equal_plain_sums(spark):
    texts = ["a b c", "b a", None, "x " * 500, "C c! 12"]
    words, index = quality.Words(), quality.index_vectors().astype(int)
    total, seen = np.zeros((quality.BUCKETS, quality.DIM)), np.zeros(quality.BUCKETS)
    for t in texts:
        w, s, _ = words.numbers([t or ""])
        for i in range(len(w)):
            around = sum((index[w[j]] + index[s[j]] for j in range(max(0, i - 2), min(len(w), i + 3)) if j != i), np.zeros(quality.DIM))
            for row in (w[i], s[i]):
                total[row] += around
                seen[row] += 1
    got = quality.context_table(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    rows = seen > 0
    mean = total[rows] / seen[rows, None]
    centred = mean - np.average(mean, axis=0, weights=seen[rows])
    np.testing.assert_allclose(got[rows], centred / np.linalg.norm(centred, axis=1, keepdims=True), atol=1e-5)
    assert not got[~rows].any()


@pytest.mark.parametrize("module, score, label, most", [(quality, "score_quality", "quality", 8000), (toxicity, "score_toxicity", "toxic", 6000)])
def test_sample_is_as_large_as_it_was(spark, monkeypatch, module, score, label, most):
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    taken, sample = [], module.labelled_sample

    def spied(*args):
        taken.append(sample(*args).count())
        return sample(*args)

    monkeypatch.setattr(module, "labelled_sample", spied)
    getattr(module, score)(docs, docs.select("doc_id", F.lit(1).alias(label)))
    assert taken == [most]


def test_repeated_ids_give_one_training_row(spark, monkeypatch):
    docs = spark.createDataFrame([(7, f"hot {i}", "en" if i % 2 else "de") for i in range(600)] + [(i, prose(i, 9), "en") for i in range(20, 40)] + [(None, "x", "en")], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    rows = [sorted(common.labelled_sample(docs.repartition(n), labels, "quality", 15).collect()) for n in (1, 5)]
    assert rows[0] == rows[1] and len({r.doc_id for r in rows[0]}) == len(rows[0]) == 15
    whole = common.labelled_sample(docs, labels, "quality", 1000).collect()
    assert sorted(r.doc_id for r in whole) == [7, *range(20, 40)]
    seen = []
    monkeypatch.setattr(language, "train", lambda texts, langs, back, inverse: seen.append((texts, langs)))
    for n in (1, 5):
        language.fit(docs.repartition(n), 1000)
    assert seen[0] == seen[1] and len(seen[0][0]) == 21


def test_words_of_a_batch_are_hashed_once(monkeypatch):
    words = [b"", b"a", b"Abcd", b"abcde!", b"ABCDEFGHIJKL", b"...", b"abcdefgh", b"\xc3\xa9tudes"]
    assert toxicity.features_of(words).tolist() == [toxicity.features(w) for w in words]
    seen, hashed = [], toxicity.features_of
    monkeypatch.setattr(toxicity, "features_of", lambda some: seen.extend(some) or hashed(some))
    monkeypatch.setattr(toxicity, "MEMO", 6)
    monkeypatch.setattr(toxicity, "HASHED", 3)
    weights = np.random.default_rng(0).normal(size=toxicity.FEATURES)
    tagger, texts = toxicity.Tagger(weights, np.zeros((2, 2))), ["one two three two", "", "two four five Six seven eight one"]
    for _ in range(3):
        seen.clear()
        marginals, split = tagger.marginals(texts)
        assert len(seen) == len(set(seen)) and len(tagger.memo) <= 6
        for m, own in zip(marginals, split):
            assert np.allclose(m, 1 / (1 + np.exp(-np.array([weights[toxicity.features(w)].sum() for w in own]))))
