"""Quality, toxicity, language: held-out accuracy, edge rows, empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import own_columns
from tillview.llm import langid, quality, toxicity
from tillview.llm.linear import Leader, remainder, sample, unanimous
from tillview.llm.queries import REGISTRY

MEDIUM = "/root/testdata/sf0.01"


def labelled(spark, folder, query, label):
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", label)
    return REGISTRY[query](spark, folder).join(labels, "doc_id").toPandas()


def test_quality_on_held_out_documents(spark):
    got = labelled(spark, MEDIUM, "op1_quality", "quality")
    held = got[got.held_out]
    assert len(held) > 50
    assert (held.predicted == held.quality).mean() >= 0.97
    assert held[held.quality == 1].predicted.mean() >= 0.99
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_toxic_documents_are_told_from_clean_ones(spark):
    got = labelled(spark, "/root/testdata/sf0.1", "op2_toxicity", "toxic")
    held = got[got.held_out]
    assert held[held.toxic == 0].predicted.mean() <= 0.01
    assert held[held.toxic == 1].predicted.mean() >= 0.7
    assert held[held.toxic == 1].severity.mean() > 5 * held[held.toxic == 0].severity.mean()
    assert got.severity.between(0, toxicity.LEVELS).all() and got.grade.between(0, toxicity.LEVELS).all()


def test_language_on_held_out_documents(spark):
    got = REGISTRY["op6_language_id"](spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.98
    assert got.rejected.mean() <= 0.01


@pytest.mark.parametrize("query", ["op1_quality", "op2_toxicity", "op6_language_id"])
def test_every_document_has_one_row(spark, small, documents, query):
    got = REGISTRY[query](spark, small)
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in documents.select("doc_id").collect())


def test_edge_rows(edges, documents):
    labels = edges.selectExpr("doc_id", "cast(doc_id % 2 as int) as label")
    weights = quality.fit_quality(edges, labels)
    scored = quality.score_quality(edges, weights).collect()
    assert len(scored) == 10 and all(0 <= r.score <= 1 for r in scored)
    by_text = {r.text: r.score for r in scored}
    assert by_text[None] == by_text[""] == by_text[" \t\n "]
    graded = toxicity.score_severity(edges, toxicity.fit_severity(edges, labels)).collect()
    assert len(graded) == 10 and all(0 <= r.severity <= toxicity.LEVELS for r in graded)
    identified = langid.identify(edges, langid.fit_languages(edges.unionByName(documents, allowMissingColumns=True)))
    assert own_columns(identified) and own_columns(toxicity.score_severity(edges, toxicity.fit_severity(edges, labels)))
    told = identified.collect()
    und = {r.text for r in told if r.lang_pred == langid.UNKNOWN}
    assert und == {None, "", " \t\n ", "123 456 !!"}
    assert all(r.rejected and r.score == 0 for r in told if r.text in und)
    assert {r.predicted for r in told} == {"x"}  # other columns stay


def test_empty_tables(edges, empty):
    labels = edges.selectExpr("doc_id", "1 as label")
    for docs, known in ((empty, labels), (edges, labels.where("false"))):
        assert quality.score_quality(docs, quality.fit_quality(docs, known)).count() == docs.count()
        found = toxicity.score_severity(docs, toxicity.fit_severity(docs, known))
        assert found.count() == docs.count() and found.where("predicted = 1").count() == 0
    assert langid.identify(empty, langid.fit_languages(empty)).count() == 0
    unknown = langid.identify(edges, langid.fit_languages(edges.where("lang is null"))).select("lang_pred").distinct().collect()
    assert [r[0] for r in unknown] == [langid.UNKNOWN]


def test_labels_that_disagree_are_left_out(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (3, None), (None, 1)], "doc_id long, y int")
    assert [tuple(r) for r in unanimous(labels, "doc_id", "y").collect()] == [(2, 1)]


def test_sample_is_bounded_and_whole_if_small(spark):
    rows = spark.range(5000)
    assert sample(rows, "id", 5000).count() == 5000
    assert 100 < sample(rows, "id", 200).count() < 320


def test_held_out_rows_are_not_learnt(spark, small):
    """Turned labels of held-out rows change no score."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{small}/labels.parquet").selectExpr("doc_id", "quality as label")
    turned = labels.withColumn("label", F.when(remainder("doc_id", 5) == 0, 1 - F.col("label")).otherwise(F.col("label")))
    fits = [quality.fit_quality(docs, x.where(remainder("doc_id", 5) != 0)) for x in (labels, turned)]
    assert np.array_equal(*fits)


def test_leader_is_the_closed_form():
    """The weights minimise the regularised sum of linearised losses."""
    model = Leader(2, alpha=0.5, beta=1.0, l1=0.1, l2=0.01)
    at = np.array([0])
    total, squares, pull = 0.0, 0.0, 0.0
    for gradient in (1.0, -0.3, 0.7, 0.2):
        w = model.weights(at)
        sigma = (np.sqrt(squares + gradient**2) - np.sqrt(squares)) / 0.5
        total, squares, pull = total + gradient, squares + gradient**2, pull + sigma * w[0]
        model.update(at, w, np.array([gradient]))
    grid = np.linspace(-3, 3, 600_001)
    loss = total * grid + 0.5 * (1 / 0.5 + np.sqrt(squares) / 0.5 + 0.01) * grid**2 - pull * grid + 0.1 * np.abs(grid)
    assert abs(model.weights()[0] - grid[np.argmin(loss)]) < 1e-4
    assert model.weights()[1] == 0


def test_thresholds_stay_apart():
    assert toxicity.apart(np.array([1.0, 0.0, 5.0])).tolist() == [1.0, 1.25, 5.0]
