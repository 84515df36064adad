"""Toxicity, quality and language: exact parts against brute force, learned parts on held-out rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockledger.llm import langid, quality, toxicity
from stockledger.llm.common import Shared, read
from stockledger.llm.queries import op1_toxicity, op6_quality, op7_language_id

from .edge import ROWS, empty, frame

SF = "/root/testdata/sf0.01"


def unit(rng, n_terms):
    at = np.sort(rng.choice(n_terms, rng.integers(1, 12), replace=False))
    x = rng.random(len(at)) + 0.01
    return at, x / np.sqrt(x @ x)


@pytest.mark.parametrize("seed, n", [(0, 1), (1, 70), (2, 400)])
def test_block_max_search_is_exact(seed, n):
    rng = np.random.default_rng(seed)
    vectors = [unit(rng, 60) for _ in range(n)]
    vectors += vectors[: n // 3]  # ties
    examples = [(100 + i, at, x, bool(i % 2)) for i, (at, x) in enumerate(vectors)]
    index = toxicity.BlockMaxIndex(examples, 60, block=16)
    dense = np.zeros((len(examples), 60), np.float32)
    for i, (at, x) in enumerate(vectors):
        dense[i, at] = x
    for at, x in [unit(rng, 60) for _ in range(40)]:
        q = np.zeros(60, np.float32)
        q[at] = x
        cosine = dense @ q
        for k in (1, 5, 15):
            got_at, got = index.nearest(at, x, k)
            want = np.sort(cosine[cosine > 0])[::-1][:k]
            assert len(got) == len(want) and np.allclose(got, want, atol=1e-5)
            ids = np.array(index.ids)[got_at]
            assert np.allclose(cosine[ids - 100], got, atol=1e-5) and len(set(ids.tolist())) == len(ids)
    one = index.nearest(*vectors[0], 3, without=index.ids.index(100))[0]
    assert 100 not in np.array(index.ids)[one]
    assert len(index.nearest(np.zeros(0, int), np.zeros(0), 5)[0]) == 0


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(12)] + [(5, None, 1), (6, 1, None)], "doc_id long, quality int, toxic int")
    model, stored = toxicity.fit(frame(spark), labels, "doc_id", "text", "toxic", F.lit(True), Shared(spark, "t"))
    out = toxicity.predict(stored, model, "doc_id").collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.score == model.alone for r in out if not r.neighbours)  # the rate of labelled examples like it
    for docs, lab in ((empty(spark), labels), (frame(spark), labels.where("toxic > 5"))):
        model, stored = toxicity.fit(docs, lab, "doc_id", "text", "toxic", F.lit(True), Shared(spark, "t"))
        assert toxicity.predict(stored, model, "doc_id").count() == docs.count()


def test_copies_of_rare_word_toxic_examples_are_found(spark):
    toxic_ = [" ".join(f"rare{i}x{j}" for j in range(30)) for i in range(3)]
    clean = [" ".join(f"plain{(i * 7 + j) % 50}" for j in range(30)) for i in range(40)]
    rows = [(f"d{i}", t) for i, t in enumerate(toxic_ + clean)] + [("copy", toxic_[1]), ("near", toxic_[2] + " and a few other words"), ("other", clean[3] + " new"), ("d0", None)]
    labels = spark.createDataFrame([(f"d{i}", int(i < 3)) for i in range(43)], "doc_id string, toxic int")
    model, stored = toxicity.fit(spark.createDataFrame(rows, "doc_id string, text string"), labels, "doc_id", "text", "toxic", F.lit(True), Shared(spark, "t"))
    out = {r.doc_id: r for r in toxicity.predict(stored, model, "doc_id").collect()}  # text ids are kept
    assert out["copy"].predicted == out["near"].predicted == 1 and out["copy"].neighbours[0] == "d1" and out["copy"].cosines[0] > 0.9999
    assert out["other"].predicted == 0 and not any(out[f"d{i}"].predicted for i in range(3, 43))


def test_scores_of_a_given_model_equal_brute_force(spark, sf_dir):
    """The query's neighbours, votes and scores from all dense cosines."""
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    model, stored = toxicity.fit(docs, labels, "doc_id", "text", "toxic", F.col("doc_id") % 4 != 2, Shared(spark, "t"))
    dense = np.zeros((model.index.n, len(model.vocabulary)))
    for b, (terms, slots, weights) in enumerate(model.index.postings):
        dense[b * model.index.block + slots, terms] = weights
    vectors = {r.doc_id: toxicity.unit_vector(bytes(r.terms), bytes(r.tfs), model.idf) for r in stored.collect()}
    for r in toxicity.predict(stored, model, "doc_id").collect():
        at, x = vectors[r.doc_id]
        cosine = np.round(dense[:, at] @ x, 6) if len(at) else np.zeros(model.index.n)
        best = np.lexsort((model.index.rank, -cosine))[: model.k]
        best = best[cosine[best] > 0]
        assert np.allclose(r.cosines, cosine[best], atol=2e-6)
        want = model.alone if not len(best) else 1 / (1 + np.exp(-(model.curve[0] * toxicity.vote(cosine[best], model.index.labels[best], model.weight) + model.curve[1])))
        assert abs(r.score - want) < 1e-3


def test_quality_of_odd_rows(spark):
    rows = quality.with_features(frame(spark), "doc_id", "text")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    model = quality.fit_labels(rows, labels, "doc_id", "quality", F.lit(True))
    out = rows.select("doc_id", quality.score(rows, model).alias("s")).collect()
    assert len(out) == len(ROWS) and all(0 <= r.s <= 1 for r in out)
    assert quality.fit_labels(rows, labels.where("quality = 1"), "doc_id", "quality", F.lit(True)) is None
    assert rows.select(quality.score(rows, None).alias("s")).distinct().collect()[0].s == 0.5
    assert quality.with_features(empty(spark), "doc_id", "text").count() == 0


def test_bradley_terry_recovers_an_order():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 4))
    truth = np.array([2.0, -1.0, 0.0, 0.5])
    good = rng.random(2000) < 1 / (1 + np.exp(-(x @ truth)))
    w = quality.bradley_terry(x, good)
    assert np.corrcoef(w, truth)[0, 1] > 0.98


def test_quality_fit_uses_every_labelled_row_and_pair(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 3)) * [1, 3, 0.2]
    good = rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -0.5, 2.0])))
    w = quality.bradley_terry(x, good)
    d = x[good][:, None] - x[~good][None]
    p = 1 / (1 + np.exp(d @ w))
    assert np.abs(quality.L2 * w - (d * p[..., None]).mean((0, 1))).max() < 1e-4  # the gradient over all pairs
    some = [F.col("a"), F.col("b"), *[F.lit(0.0)] * (len(quality.FEATURES) - 2)]
    rows = spark.range(24_000).select("id", (F.rand(3) + F.col("id") % 2).alias("a"), F.randn(4).alias("b"), (F.col("id") % 2).alias("y"))
    rows = rows.select("id", "y", *[c.alias(f) for c, f in zip(some, quality.FEATURES)]).localCheckpoint()
    model = quality.fit(rows, "y", "id")
    table = rows.toPandas()
    every = table[list(quality.FEATURES)].to_numpy(float)
    assert np.allclose(model.mean, every.mean(0)) and np.allclose(model.scale[:2], every.std(0)[:2])
    assert np.allclose(model.weights, quality.bradley_terry((every - model.mean) / model.scale, table.y.to_numpy() == 1), atol=1e-6)
    assert (model.score(every) > model.cut).sum() == 12_000  # as many pass as are labelled good


def test_language_of_odd_rows(spark):
    rows = [(i, ("der und die das ist nicht " if i % 2 else "the and of that is not ") * 5, "de" if i % 2 else "en") for i in range(100, 160)]
    docs = frame(spark, extra=False).withColumn("lang", F.lit(None).cast("string")).select("doc_id", "text", "lang")
    docs = docs.union(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    model = langid.fit(docs, "text", "lang", "doc_id", F.lit(True))
    out = {r.doc_id: r for r in langid.predict(docs, model, "doc_id", "text").collect()}
    assert all(out[i].lang_pred == lang and out[i].score > 0.9 for i, _, lang in rows)
    assert [out[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and out[1].score == 0
    assert out[8].lang_pred in ("de", "en")
    none = langid.fit(docs.where("lang is null"), "text", "lang", "doc_id", F.lit(True))
    assert none is None and {r.lang_pred for r in langid.predict(docs, None, "doc_id", "text").collect()} == {"und"}
    assert langid.predict(empty(spark), model, "doc_id", "text").count() == 0


def test_rare_languages_are_learned(spark):
    rows = [(i, ("der und die das ist nicht " if i % 2 else "the and of that is not ") * 5, "de" if i % 2 else "en") for i in range(400)]
    rows += [(1000 + i, f"que los una por para {w} " * 5, "es") for i, w in enumerate(("con", "este", "pero", "muy"))]
    rows += [(2000, "og ikke det som på " * 6, "da")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, "text", "lang", "doc_id", F.lit(True), sample_rows=60)
    assert model.langs == ["da", "de", "en", "es"]
    out = {r.doc_id: r.lang_pred for r in langid.predict(docs, model, "doc_id", "text").collect()}
    assert all(out[i] == lang for i, _, lang in rows)


def test_ftrl_learns_sparse_weights():
    rng = np.random.default_rng(5)
    examples = []
    for _ in range(400):
        y = int(rng.integers(3))
        at = np.unique(np.append(rng.choice(np.arange(50, 500), 8), [y, 10 + y]))
        examples.append((at, np.full(len(at), 1 / np.sqrt(len(at))), y))
    w, bias = langid.ftrl(examples, 3)
    right = sum(int((x @ w[at] + bias).argmax()) == y for at, x, y in examples)
    assert right > 390 and (w[500:] == 0).all()


def test_held_out_accuracy(spark):
    labels, docs = read(spark, SF, "labels"), read(spark, SF, "documents")
    tox = op1_toxicity(spark, SF).join(labels, "doc_id").where("held_out").selectExpr("avg(int(predicted = toxic)) as a").first().a
    good = op6_quality(spark, SF).join(labels, "doc_id").where("held_out").selectExpr("avg(int(predicted = quality)) as a").first().a
    lang = op7_language_id(spark, SF).join(docs.where("length(text) > 100"), "doc_id").where("held_out").selectExpr("avg(int(lang_pred = lang)) as a").first().a
    assert tox > 0.88 and good > 0.93 and lang > 0.98, (tox, good, lang)
