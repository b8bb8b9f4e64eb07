"""Preference pairs of the quality ranking: no labelled row is left out."""

import numpy as np
import pytest

from paneloom.llm import ranking
from paneloom.llm.ngrams import Rows, fit_shards, labelled_texts, platt, platt_of_table


@pytest.mark.parametrize("good, bad", [(40, 20), (31, 47), (63, 5), (3, 31), (32, 16)])
def test_every_row_gives_a_pair(good, bad):
    n = good + bad  # each row has a feature of its own
    rows = Rows(np.arange(n), np.ones(n, np.float32), np.arange(1, n + 1), np.array([1] * good + [0] * bad))
    weights = ranking.fit_pairs(rows, epochs=1, share=n).weights
    assert (weights[:good] > 0).all() and (weights[good:n] < 0).all()


def plain_step(rows, weights, picked, slopes, squares, rate=2.0, decay=1e-4):
    """One adaptive step in dense arithmetic."""
    slope = np.zeros_like(weights)
    touched = np.zeros(len(weights), bool)
    for k, own in zip(picked, slopes):
        ids, values = rows.ids[rows.row(k)], rows.values[rows.row(k)]
        np.add.at(slope, ids, values * own)
        touched[ids] = True
    slope = np.where(touched, slope / len(picked) + decay * weights, 0)
    squares += slope**2
    return weights - rate * slope / np.sqrt(squares), squares


def sample(good, bad, seed=3):
    rng = np.random.default_rng(seed)
    ids, values, ends = [], [], []
    for k in range(good + bad):
        own = np.sort(rng.choice(40, 6, replace=False)) + (20 if k >= good and rng.random() < 0.8 else 0)
        ids.append(np.unique(own))
        values.append(rng.random(len(ids[-1])).astype(np.float32))
        ends.append(len(ids[-1]))
    return Rows(np.concatenate(ids), np.concatenate(values), np.cumsum(ends), np.array([1] * good + [0] * bad))


def test_fit_equals_bradley_terry_pair_by_pair():
    """The same draws, but the loss's slope summed up over every pair of a batch, and steps on dense features."""
    rows = sample(90, 60)
    rng = np.random.default_rng(11)
    held = ranking.held_rows(rows.labels, 5, rng)
    drawn = np.setdiff1d(np.arange(150), held)
    good, bad = drawn[rows.labels[drawn] == 1], drawn[rows.labels[drawn] == 0]
    assert len(held) == 30 and rows.labels[held].sum() == 18
    weights, squares = np.zeros(ranking.WIDTH), np.full(ranking.WIDTH, 1e-8)
    for _ in range(2):
        steps = max(-(-len(good) // 32), -(-len(bad) // 16))
        first, second = (rng.permutation(np.resize(x, steps * n)).reshape(steps, n) for x, n in ((good, 32), (bad, 16)))
        for g, b in zip(first, second):
            score = lambda k: float(weights[rows.ids[rows.row(k)]] @ rows.values[rows.row(k)])
            slope_g, slope_b = np.zeros(32), np.zeros(16)
            for i, x in enumerate(g):
                for j, y in enumerate(b):
                    doubt = 1 / (1 + np.exp(score(x) - score(y)))  # the slope of log(1 + exp(worse - better))
                    slope_g[i] -= doubt / 16
                    slope_b[j] += doubt / 32 * 2
            weights, squares = plain_step(rows, weights, [*g, *b], [*slope_g, *slope_b], squares)
    model = ranking.fit_pairs(rows, epochs=2)
    np.testing.assert_allclose(model.weights, weights, rtol=1e-4, atol=1e-5)
    scores = rows.scores(weights)[held]
    below = (scores < model.cut).sum()
    assert below == 12  # as many as the held-out rows of label 0


def test_fitting_lowers_the_loss_of_all_pairs():
    rows = sample(200, 120)
    losses = [ranking.pair_loss(rows, ranking.fit_pairs(rows, epochs=n).weights) for n in (1, 12)]
    plain = np.mean([[np.log1p(np.exp(rows.scores(np.ones(ranking.WIDTH))[b] - rows.scores(np.ones(ranking.WIDTH))[g])) for b in (200, 250)] for g in (0, 7)])
    few = Rows(np.concatenate([rows.ids[rows.row(k)] for k in (0, 7, 200, 250)]), np.concatenate([rows.values[rows.row(k)] for k in (0, 7, 200, 250)]),
               np.cumsum([len(rows.ids[rows.row(k)]) for k in (0, 7, 200, 250)]), np.array([1, 1, 0, 0]))
    assert losses[1] < losses[0] < np.log(2) and abs(ranking.pair_loss(few, np.ones(ranking.WIDTH)) - plain) < 1e-6


def own_words(spark, n=160):
    """Documents of a word of their own each, so that only rows that were learned from can be told apart."""
    rows = [(k, f"{(k * 7919 + 13) % 1000003:x}zq{(k * 104729) % 999983:x}", k % 2) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_every_labelled_row_is_learned_from(spark):
    """Eight shards of 20 rows: before, the first 20 rows alone gave the model."""
    rows = own_words(spark)
    docs, labels = rows.drop("quality"), rows.drop("text")
    scores = {r["doc_id"]: r["score"] for r in ranking.rank_quality(docs, labels, "quality", sample=20).collect()}
    held = {r["doc_id"] for r in labels.where("pmod(xxhash64(cast(doc_id as string), 'held'), 5) = 0").collect()}
    drawn = sorted((scores[k], k % 2) for k in scores if k not in held)
    assert 20 < len(drawn) < 160
    order = [label for _, label in drawn]
    ahead = sum(order[:i].count(0) for i in range(len(order)) if order[i] == 1)
    assert ahead / (order.count(1) * order.count(0)) > 0.9


@pytest.mark.parametrize("most_bytes", [1, 2_000, 10**9])
def test_shards_count_every_row(spark, most_bytes):
    rows = own_words(spark, 50)
    texts = labelled_texts(rows.drop("quality"), rows.selectExpr("doc_id", "quality AS label"), 3)
    weights = fit_shards(texts, 3, lambda some: np.full(ranking.WIDTH, 1.0), most_bytes)
    assert weights[0] == 1.0
    assert fit_shards(texts, 3, lambda some: None) is None
    if most_bytes > 10**6:  # the mean of the labels, by rows
        weights = fit_shards(texts, 3, lambda some: np.full(ranking.WIDTH, some.labels.mean()), most_bytes)
        assert weights[0] == pytest.approx(0.5)


def test_rare_labels_reach_every_shard(spark):
    rows = own_words(spark, 60).selectExpr("doc_id", "text", "cast(doc_id >= 3 as int) AS label")
    texts = labelled_texts(rows.drop("label"), rows.drop("text"), 4, rare=0, copies=4)
    assert sorted((r["doc_id"], r["copy"]) for r in texts.where("label = 0").collect()) == [(k, c) for k in range(3) for c in range(4)]
    assert texts.where("label = 1").count() == 57 and texts.select("doc_id").distinct().count() == 60


def test_scale_and_cut_of_a_table(spark):
    """The distributed scale equals that of one task."""
    rng = np.random.default_rng(2)
    scores = np.round(rng.normal(size=200), 1)
    labels = (scores + rng.normal(size=200) > -0.5).astype(int)
    df = spark.createDataFrame([(float(x), int(y)) for x, y in zip(scores, labels)], "score double, label int")
    assert platt_of_table(df) == pytest.approx(platt(scores, labels), rel=1e-6)


@pytest.mark.parametrize("good", [0, 40])
def test_one_label_only_keeps_all(spark, good):
    rows = own_words(spark, 40)
    labels = rows.selectExpr("doc_id", f"cast(doc_id < {good} as int) AS quality")
    found = ranking.rank_quality(rows.drop("quality"), labels, "quality", sample=10).collect()
    assert len(found) == 40 and {r["predicted"] for r in found} == {1}
