"""Preference ranking: held-out labels, the loss against plain descent, quantile thresholds, odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saldo.llm import preference, queries

SCHEMA = "doc_id long, text string"
WORDS = "the and with from that this have will your house garden water tree stone river light music paper".split()


def prose(n, seed):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n)) + "."


def corpus(spark, n=240):
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        body = prose(20 + k % 60, k)
        rows.append((k, " ".join(w + "$$" for w in body.split()) if bad else body))
        labels.append((k, int(not bad)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_held_out_labels(spark, sf):
    rows = queries.op13_preference_quality(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    for label in (0, 1):
        side = [r for r in held if r.quality == label]
        assert sum(r.predicted == label for r in side) >= 0.97 * len(side) > 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_weights_minimise_the_pairs_loss():
    draw = np.random.default_rng(5)
    good, bad = draw.standard_normal((40, 3)) + [1, 0, -1], draw.standard_normal((25, 3))
    pairs = preference.preferences(good, bad, 4)
    assert len(pairs) == 160
    w = preference.bradley_terry(pairs, ridge=0.01)

    def loss(x):
        return np.log1p(np.exp(-pairs @ x)).mean() + 0.005 * x @ x

    assert all(loss(w) < loss(w + e) for e in np.vstack((np.eye(3), -np.eye(3))) * 1e-3)


def test_every_pair_holds_a_good_and_a_bad_document():
    good, bad = np.arange(10.0)[:, None] + 100, np.arange(4.0)[:, None]
    pairs = preference.preferences(good, bad, 8)
    assert len(pairs) == 80 and (pairs > 90).all()
    # the ten good documents meet each bad one twice in eight rounds
    assert {g - b for g in range(100, 110) for b in range(4)} >= set(pairs.ravel().tolist())


def test_threshold_is_a_quantile_in_the_gap(spark):
    ranking = preference.Ranking(np.zeros(1), np.array([1.0, 2.0, 3.0]), np.array([-3.0, -2.0]))
    values = [(float(v),) for v in [*np.linspace(-4, -1.5, 200), *np.linspace(0.9, 4, 800)]]
    level, cut = preference.threshold(ranking, spark.createDataFrame(values, "strength double"))
    assert -1.5 < cut < 0.9 and abs(level - 0.2) < 0.01
    rare = [(-2.5,)] + [(float(v),) for v in np.linspace(0.9, 4, 20_000)]
    level, cut = preference.threshold(ranking, spark.createDataFrame(rare, "strength double"))
    assert -2.5 < cut < 0.9 and level < 0.001


def test_features_do_not_depend_on_the_batch():
    table = preference.class_table()
    texts = ["", "a", prose(500, 1), "x y x y\nx y x y", "É!É? 12 ###", prose(40_000, 2), "\n\n", "日本語。 ", prose(3, 3)]
    whole = preference.features(texts, table)
    assert np.isfinite(whole).all() and not whole[0].any() and not whole[6].any()
    for k, text in enumerate(texts):
        assert preference.features([text], table)[0] == pytest.approx(whole[k])
    doubled = preference.features(["a b c a b c"], table)[0][preference.CLASSES :]
    assert doubled[5] == pytest.approx(1 - 3 / 4) and doubled[4] == pytest.approx(1 - 3 / 6)


def test_scores(spark):
    docs, labels = corpus(spark)
    texts = [(1, prose(30, 900)), (2, " ".join(w + "$$" for w in WORDS)), (3, None), (4, ""), (None, prose(30, 900)), (1, prose(30, 900)), (5, prose(60_000, 901))]
    more = spark.createDataFrame([(1000 + (i or 0) if i else None, t) for i, t in texts], SCHEMA)
    got = preference.score(docs.unionByName(more), labels)
    assert got.count() == 240 + len(texts)
    mine = {r.doc_id: r for r in got.collect()}
    assert all(mine[k].predicted == int(k % 4 != 0) for k in range(240))
    assert mine[1001].predicted == mine[1005].predicted == mine[None].predicted == 1 and mine[1002].predicted == 0
    assert mine[1001].score == mine[None].score and mine[1003].score == mine[1004].score


def test_labels_that_cannot_teach(spark):
    docs, labels = corpus(spark, 40)
    for some, value in ((labels.filter("quality = 1"), 1.0), (labels.filter("quality = 0"), 0.0), (labels.limit(0), 0.5)):
        got = preference.score(docs, some).collect()
        assert len(got) == 40 and {(r.score, r.predicted) for r in got} == {(value, int(value >= 0.7))}
    wrong = labels.unionByName(labels).unionByName(labels.withColumn("quality", 1 - F.col("quality")))
    wrong = wrong.unionByName(spark.createDataFrame([(None, 0), (3, None)], "doc_id long, quality int"))
    assert {(r.doc_id, r.predicted) for r in preference.score(docs, wrong).collect()} == {(k, int(k % 4 != 0)) for k in range(40)}


def test_odd_tables(spark):
    docs, labels = corpus(spark, 40)
    assert preference.score(docs.limit(0), labels).count() == 0
    clash = docs.selectExpr("*", "1 as x", "2 as score", "'z' as strength", "doc_id as quality")
    assert preference.score(clash, labels.selectExpr("*", "'q' as text", "0 as x")).count() == 40


def test_learning_is_bounded(spark):
    """One id held by most rows adds no more than the bound to what is learned."""
    docs, labels = corpus(spark, 40)
    many = docs.unionByName(spark.range(500).select(F.lit(1).cast("bigint").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text")))
    ranking = preference.fit(preference.measured(many), labels, train_docs=20)
    assert len(ranking.good) == 20 and len(ranking.bad) == 10
    assert math.isfinite(ranking.weights.sum())
