"""The quality classifier: accuracy on held-out rows, its parts against plain formulas, rows that are hard to handle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermatch.llm import qda, queries


@pytest.mark.parametrize("sf, least_bad, least_clean", [("sf0.01", 0.9, 0.97), ("sf0.1", 0.97, 0.99)])
def test_held_out_accuracy(spark, sf, least_bad, least_clean):
    path = f"/root/testdata/{sf}"
    got = queries.QUERIES["op11_classifier"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    held = got.where("held_out").toPandas()
    assert (held[held.quality == 0].predicted == 0).mean() >= least_bad
    assert (held[held.quality == 1].predicted == 1).mean() >= least_clean
    bad, clean = held[held.quality == 0].score.to_numpy(), held[held.quality == 1].score.to_numpy()
    assert (bad[:, None] < clean[None, :]).mean() >= 0.99  # area under the curve


def test_query_covers_all_rows(spark, small_docs):
    got = queries.QUERIES["op11_classifier"](spark, "/root/testdata/sf0.001")
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in small_docs.collect())
    assert all(0 < r.score < 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    folds = {r.doc_id: r.f for r in small_docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("f")).collect()}
    assert all(folds[r.doc_id] == r.held_out for r in rows)


def test_fit_equals_plain_moments(spark, small_docs):
    """Means, shrunk covariances and densities from Spark's sums equal those of numpy over the collected rows."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = qda.fit(qda.measured(small_docs), labels)
    rows = small_docs.join(labels, "doc_id").select("text", "quality").collect()
    x = np.array([qda.statistics(r.text) for r in rows])
    y = np.array([r.quality for r in rows])
    z = (x - x.mean(axis=0)) / np.where(x.std(axis=0) < 1e-6, 1, x.std(axis=0))
    density = []
    for k in (0, 1):
        own = z[y == k]
        centred = own - own.mean(axis=0)
        cov = centred.T @ centred / len(own)
        scatter = np.mean([((np.outer(c, c) - cov) ** 2).sum() for c in centred])
        mean_variance = np.trace(cov) / len(cov)
        share = min(1, max(1e-3, scatter / len(own) / ((cov - mean_variance * np.eye(len(cov))) ** 2).sum()))
        assert model.shrinkage[k] == pytest.approx(share, rel=1e-6)
        cov = (1 - share) * cov + share * mean_variance * np.eye(len(cov)) + 1e-9 * np.eye(len(cov))
        away = z - own.mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
        density.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * distance)
    assert np.allclose(model.log_odds(x), density[1] - density[0], rtol=1e-6, atol=1e-6)


def test_statistics_see_the_whole_text():
    plain = "Some plain words of prose, and more of them. " * 200
    tail = dict(zip(qda.NAMES, qda.statistics(plain + "a#$% b&&& c*** d||| " * 12)))
    base = dict(zip(qda.NAMES, qda.statistics(plain)))
    assert tail["worst_symbols"] > base["worst_symbols"] + 4 and tail["least_letters"] < base["least_letters"]
    assert len(qda.statistics("")) == len(qda.NAMES) and np.isfinite(qda.statistics("")).all()
    for text in ("\ud800", "a", " \n ", "\n" * 500, "A" * 300_000):
        assert np.isfinite(qda.statistics(text)).all()


def test_quality_on_hard_rows(spark, hard, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (2, 1, 0), (3, 0, None), (4, 0, 0), (5, 0, 0), (6, 1, 1), (6, 0, 1),
                                    (None, 1, 1), (77, 1, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    rows = qda.judged(hard, labels).collect()
    assert len(rows) == 10 and all(0 < r.score < 1 for r in rows)
    first = [r.score for r in rows if r.doc_id == 1]
    assert first[0] == first[1]
    assert qda.judged(nothing, labels).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert {(r.score, r.predicted) for r in qda.judged(hard, none).collect()} == {(0.5, 1)}
