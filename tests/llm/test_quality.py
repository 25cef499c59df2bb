import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.quality import FEATURES, estimated_prior, features, fit, in_fold, keep_good, train, with_score
from tidemark.llm.words import words


def test_features_of_odd_texts(odd_docs):
    texts = [r.text for r in odd_docs.collect()]
    x = np.array([features(w) for w in words(pa.array(texts, pa.string()))])
    assert x.shape == (len(texts), FEATURES) and np.isfinite(x).all()
    assert not x[texts.index("")].any() and not x[texts.index(None)].any()


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (3, None, None), (None, 1, 0), (4, 0, 0), (6, 1, None)], "doc_id long, quality int, toxic int")
    model = train(odd_docs, labels)
    found = with_score(odd_docs, model)
    assert set(found.columns) == set(odd_docs.columns) and found.columns[-1] == "score"
    assert found.count() == odd_docs.count() and found.filter("score between 0 and 1").count() == odd_docs.count()
    assert keep_good(odd_docs, model).schema == odd_docs.schema
    assert with_score(no_docs, model).count() == 0
    unfitted = train(no_docs, labels)
    assert {r.score for r in with_score(odd_docs, unfitted).collect()} == {0.5} and keep_good(odd_docs, unfitted).count() == odd_docs.count()
    assert train(odd_docs, labels.limit(0)).prior == 0.5


def test_fold(spark):
    rows = spark.range(200).select("id", in_fold(F.col("id")).alias("fold")).collect()
    assert all(r.fold == (zlib.crc32(str(r.id).encode()) % 3 != 1) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS LONG) id").select(in_fold(F.col("id"))).first()[0]


def test_held_out_labels_and_ids_make_no_difference(spark, documents, sf_dir):
    """Neither other labels in the held-out fold nor other ids for the same texts change a score by themselves."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    changed = labels.withColumn("quality", F.when(in_fold(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    one, other = train(documents, labels), train(documents, changed)
    assert np.array_equal(one.weight, other.weight)
    moved = documents.withColumn("source", F.lit("x")).withColumn("lang", F.lit(None).cast("string"))
    assert np.array_equal(one.weight, train(moved, labels).weight)


def test_positives_are_bounded_and_all_else_is_used(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows, _ = quality._featured(documents, "doc_id", "text")
    assert len(quality.positives(rows, labels, 15)) == 15
    x = np.array([features(w) for w in words(pa.array([r.text for r in documents.collect()], pa.string()))]).astype(np.float16).astype(float)
    unlabelled = quality._Unlabelled(rows)
    assert unlabelled.n == documents.count() == unlabelled.of_half.sum()
    assert np.allclose(unlabelled.mean, x.mean(0), atol=1e-6)
    spread = x.std(0)
    assert np.allclose(np.where(spread > 2e-4, unlabelled.scale * spread, 1), 1, atol=1e-3)


def test_risk_slope_and_curvature_by_brute_force(spark, documents):
    docs = documents.limit(60).cache()
    rows, _ = quality._featured(docs, "doc_id", "text")
    unlabelled = quality._Unlabelled(rows)
    x = np.array([np.frombuffer(r.x, np.float16) for r in rows.collect()], float)
    half = np.array([r.half for r in rows.collect()])
    z = quality.ready(x, unlabelled.mean, unlabelled.scale)
    w = np.random.default_rng(1).normal(size=z.shape[1]) * 0.1
    for k, found in zip((None, 0, 1), unlabelled.risks([w, w, w], [None, 0, 1])):
        own = z if k is None else z[half == k]
        s = 1 / (1 + np.exp(-own @ w))
        assert np.isclose(found[0], np.log1p(np.exp(own @ w)).mean())
        assert np.allclose(found[1], own.T @ s / len(own))
        assert np.allclose(found[2], (own * (s * (1 - s))[:, None]).T @ own / len(own), atol=1e-4)
    levels = [np.array([-1.0, 0.0, 1.0]), np.array([0.0, 0.1, 0.5])]
    assert unlabelled.above([w, -w], levels).tolist() == [
        [int((z[half == 0] @ w >= t).sum()) for t in levels[0]], [int((-z[half == 1] @ w >= t).sum()) for t in levels[1]]
    ]


class Held:
    """What ``_Unlabelled`` gives, of an array."""

    def __init__(self, x):
        self.x, self.half, self.n = x, np.arange(len(x)) % 2, len(x)
        self.of_half = np.array([(self.half == 0).sum(), (self.half == 1).sum()])
        self.mean, self.scale = x.mean(0), 1 / np.maximum(x.std(0), 1e-4)

    def ready(self, x):
        return quality.ready(x, self.mean, self.scale)

    def risks(self, weights, halves):
        z, out = self.ready(self.x), []
        for w, k in zip(weights, halves):
            own = z if k is None else z[self.half == k]
            s = 1 / (1 + np.exp(-own @ w))
            out.append((np.logaddexp(0, own @ w).mean(), own.T @ s / len(own), (own * (s * (1 - s))[:, None]).T @ own / len(own)))
        return out

    def above(self, weights, levels):
        z = self.ready(self.x)
        return np.array([((z[self.half == k] @ weights[k])[:, None] >= levels[k]).sum(0) for k in (0, 1)])


@pytest.mark.parametrize("prior", [0.002, 0.02, 0.3, 0.6, 0.9])
def test_prior(prior):
    rng = np.random.default_rng(3)
    positive = rng.normal(3, 1, 6000)
    unlabelled = np.where(rng.random(60_000) < prior, rng.normal(3, 1, 60_000), rng.normal(-3, 1, 60_000))
    above = np.array([(unlabelled >= t).sum() for t in quality.levels_of(positive)])
    assert abs(estimated_prior(positive, above, 60_000) - prior) < max(0.06 * prior, 0.0015)


@pytest.mark.parametrize("prior", [0.02, 0.2, 0.7])
def test_least_risk_is_the_least(prior):
    """No other weights nearby have a smaller risk, whether that of the negatives is above zero, held at it, or below it."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, FEATURES)) + (rng.random(500) < 0.4)[:, None] * 0.5
    positive = rng.normal(size=(200, FEATURES)) + 0.5
    held, keep = Held(x), np.append(np.full(FEATURES, 0.3), 0)
    p = held.ready(positive)
    split = quality._Positives(positive, held.mean, held.scale)

    def risk(w):
        negatives = held.risks([w], [None])[0][0] - prior * np.logaddexp(0, p @ w).mean()
        return prior * np.logaddexp(0, -p @ w).mean() + max(negatives, 0) + keep @ w**2 / 2

    w = quality._least_risk(split, prior, held, keep)
    least = risk(w)
    for _ in range(50):
        for far in (0.003, 0.03):
            assert risk(w + rng.normal(size=len(w)) * far) > least - 1e-3


def test_risk_stays_above_zero():
    """Positives and unlabelled texts that differ by chance alone are not torn apart."""
    rng = np.random.default_rng(5)
    positive, unlabelled = rng.random((300, FEATURES)), rng.random((300, FEATURES))
    model = fit(positive, Held(unlabelled))
    assert model.prior > 0.8 and (model.score(rng.random((300, FEATURES))) > 0.5).mean() > 0.9


def test_held_out_accuracy(spark):
    """On documents of sf0.1 in the held-out fold, which the model has no labels of."""
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels)).join(labels, "doc_id").filter(~in_fold(F.col("doc_id")))
    rows = [(r.score, r.quality) for r in scored.select("score", "quality").collect()]
    good, bad = (np.array([s for s, q in rows if q == k]) for k in (1, 0))
    assert len(bad) > 100
    assert (good[:, None] > bad[None]).mean() > 0.995
    assert (good >= 0.5).mean() > 0.995 and (bad < 0.5).mean() > 0.9
