import numpy as np
import pytest
from helpers import AWKWARD, documents
from pyspark.sql import functions as F

from tidewell.llm.quality_classifier import STATISTICS, Model, held_out, score_documents, shrunk, statistics


def test_held_out_accuracy(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    rows = scored.select("row.doc_id", "held_out", "score").join(labels, "doc_id").filter("held_out").collect()
    right = [(r.score >= 0.3) == (r.quality == 1) for r in rows]
    assert len(rows) > 50
    assert np.mean(right) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(r.score for r in score_documents(docs, x).select("score").collect()) for x in (labels, turned))
    assert np.allclose(a, b, rtol=1e-6, atol=1e-12)


def test_awkward_rows_and_missing_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    scored = score_documents(documents(spark), none).collect()
    assert [r.score for r in scored] == [0.5] * len(AWKWARD)
    one = spark.createDataFrame([(1, 1), (4, 1), (7, None), (None, 0), (99, 0)], "doc_id long, quality int")
    assert {r.score for r in score_documents(documents(spark), one).collect()} == {1.0}
    both = spark.createDataFrame([(i, i % 2) for i in range(10)] * 2, "doc_id long, quality int")
    scored = score_documents(documents(spark), both)
    assert scored.filter("score BETWEEN 0 AND 1").count() == len(AWKWARD)
    assert scored.filter("row.doc_id IS NULL AND held_out").count() == 0
    assert score_documents(documents(spark, []), both).collect() == []


def test_statistics_are_finite():
    for text in (None, "", " ", "\n\n", "x", "!!!", "é" * 1000, "a b " * 5000, "\x00"):
        x = statistics(text)
        assert x.shape == (len(STATISTICS),)
        assert np.isfinite(x).all()


def test_difference_is_that_of_the_densities():
    draw = np.random.default_rng(3)
    covariances = [np.cov(draw.normal(size=(4, 50)) * k) for k in (1, 3)]
    pooled = sum(covariances) / 2
    used = [shrunk(c, pooled, 0.2, 0.3, 0.01) for c in covariances]
    factors = [np.linalg.cholesky(c) for c in used]
    means = [np.zeros(4), np.ones(4)]
    model = Model(tuple(means), tuple(factors), tuple(np.linalg.slogdet(c)[1] for c in used), 0.7)
    x = draw.normal(size=(6, 4))
    density = [[-0.5 * (r - m) @ np.linalg.inv(c) @ (r - m) - 0.5 * np.log(np.linalg.det(c)) for r in x] for m, c in zip(means, used)]
    assert model.difference(x) == pytest.approx(np.array(density[1]) - np.array(density[0]) + 0.7)
