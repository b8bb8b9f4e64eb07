"""Quality classifier (7): Bradley-Terry scores learned from preference pairs, cut at a score quantile."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from paneloom.llm.ngrams import FEATURE_BYTES, Grams, Learner, Rows, WIDTH, fit_in_task, fit_shards, labelled_features, labelled_keys, labelled_texts, platt, platt_of_table, sigmoid
from paneloom.llm.tasks import documents, map_documents
from paneloom.operators.stats import running_counts
from paneloom.session import cut_lineage

SAMPLE = 4_000  # labelled rows that a task fits; where there are more, several fit side by side
SHARE = 5  # one labelled row in so many gives no pairs but the scale and the cut
CUT = 0.3  # the probability scale puts the quantile's score here


@dataclass(frozen=True)
class Ranker:
    weights: np.ndarray
    slope: float
    cut: float  # the raw score at the quantile

    def scale(self, raw: float) -> float:
        """0 to 1, CUT at the quantile's score."""
        return float(sigmoid(self.slope * (raw - self.cut) + np.log(CUT / (1 - CUT))))


def quantile_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """The score at the quantile that equals the share of label 0: as many documents lie below it as the labels
    reject. It is the middle of the two scores beside it; equal scores stay on one side."""
    order = np.sort(scores)
    k = int((labels != 1).sum())
    if k == 0 or k == len(order):
        return float(order[0] - 1e-6 if k == 0 else order[-1] + 1e-6)
    return float((order[k - 1] + order[k]) / 2)


def held_rows(labels: np.ndarray, share: int, rng: np.random.Generator) -> np.ndarray:
    """Every ``share``-th row of each label, drawn at random; none where a label would lose its last rows."""
    parts = [rng.permutation(np.flatnonzero(labels == label)) for label in (1, 0)]
    held = [p[: len(p) // share] for p in parts]
    return np.concatenate(held) if all(len(p) >= 2 * share for p in parts) else np.empty(0, np.int64)


def learn_pairs(rows: Rows, drawn: np.ndarray, rng: np.random.Generator, epochs: int, better: int, worse: int) -> np.ndarray:
    """Weights after ``epochs`` over the ``drawn`` rows, which have both labels."""
    learner = Learner()
    good, bad = drawn[rows.labels[drawn] == 1], drawn[rows.labels[drawn] == 0]
    for _ in range(epochs):
        steps = max(-(-len(good) // better), -(-len(bad) // worse))  # rounded up: the last rows are drawn as well
        first = rng.permutation(np.resize(good, steps * better)).reshape(steps, better)
        second = rng.permutation(np.resize(bad, steps * worse)).reshape(steps, worse)
        for g, b in zip(first, second):
            doubt = sigmoid(learner.scores(rows, b)[None, :] - learner.scores(rows, g)[:, None])  # of each preference
            learner.step(rows, np.concatenate((g, b)), np.concatenate((-doubt.mean(1), doubt.mean(0) * better / worse)))
    return learner.weights


def fit_pairs(rows: Rows, epochs: int = 12, better: int = 32, worse: int = 16, seed: int = 11, share: int = SHARE) -> Ranker:
    """Bradley-Terry: each document of label 1 is preferred to each of label 0 in its batch, and the logistic
    loss of their score difference, a difference of features, is lowered.

    A fifth of the rows gives no pairs: their scores place the scale and the cut (with few rows, all do both). Every
    other document is drawn in each epoch; rows are repeated until both labels fill its batches. Without both
    labels, all texts score 1.
    """
    if not (rows.labels == 1).any() or not (rows.labels == 0).any():
        return Ranker(np.zeros(WIDTH, np.float32), 1.0, -50.0)
    rng = np.random.default_rng(seed)
    held = held_rows(rows.labels, share, rng)
    drawn = np.setdiff1d(np.arange(len(rows)), held)
    weights = learn_pairs(rows, drawn, rng, epochs, better, worse)
    judged = held if len(held) else drawn
    scores, labels = rows.scores(weights)[judged], rows.labels[judged]
    return Ranker(weights.astype(np.float32), max(platt(scores, labels)[0], 1e-3), quantile_cut(scores, labels))


def fit_all_pairs(
    docs: DataFrame, keys: DataFrame, good: int, bad: int, shards: int, epochs: int = 12, better: int = 32, worse: int = 16, seed: int = 11, share: int = SHARE
) -> Ranker:
    """``fit_pairs`` over any number of labelled rows, ``keys`` (doc_id, label) of ``docs``, in ``shards`` side by side.

    Every row is in a shard, a task fits each shard as ``fit_pairs`` does, and the model is the mean of the shards' weights
    by their rows. A row of the rarer label is in several where a shard would get less than two batches of it. The
    rows whose keys hash to a ``share``-th give no pairs (with few of a label, all do both): the model scores all of
    these, and the scale and the cut come from those scores.
    """
    def learn(rows: Rows) -> np.ndarray | None:
        if not (rows.labels == 1).any() or not (rows.labels == 0).any():
            return None
        return learn_pairs(rows, np.arange(len(rows)), np.random.default_rng(seed), epochs, better, worse)

    held = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("held")), F.lit(share)) == 0
    apart = min(good, bad) >= 2 * share * share
    drawn, judged = (keys.where(~held), keys.where(held)) if apart else (keys, keys)
    rare, few = (1, good) if good < bad else (0, bad)
    copies = min(shards, -(-2 * max(better, worse) * shards // max(few, 1)))
    weights = fit_shards(labelled_texts(docs, drawn, shards, rare, copies), shards, learn)
    if weights is None:
        return Ranker(np.zeros(WIDTH, np.float32), 1.0, -50.0)
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # WIDTH weights

    def make():
        grams = Grams()
        return lambda texts: {"score": [grams.score(t, sent.value) for t in texts]}

    scores = cut_lineage(map_documents(labelled_texts(docs, judged, shards), make, "score double", ("label",)), "scores")
    count = scores.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") != 1).alias("k"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    if not count["n"]:
        return Ranker(weights, 1.0, -50.0)
    if count["k"] in (0, count["n"]):
        cut = count["lo"] - 1e-6 if not count["k"] else count["hi"] + 1e-6
    else:  # the middle of the scores at the places k and k + 1
        ranked = running_counts(scores.groupBy("score").agg(F.count(F.lit(1)).alias("_n")), [], "score", "_n")
        beside = ranked.agg(*[F.min(F.when(F.col("_cum") >= count["k"] + more, F.col("score"))).alias(f"s{more}") for more in (0, 1)]).first()
        cut = (beside["s0"] + beside["s1"]) / 2
    return Ranker(weights, max(platt_of_table(scores)[0], 1e-3), float(cut))


def pair_loss(rows: Rows, weights: np.ndarray) -> float:
    """The mean logistic loss over all pairs of a document of label 1 and one of label 0."""
    scores = rows.scores(weights)
    return float(np.logaddexp(0, scores[rows.labels == 0][None, :] - scores[rows.labels == 1][:, None]).mean())


def rank_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, among: Column | None = None, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Each document's score, 0 to 1, and ``predicted``: 1 from the score quantile on that equals the share of label 0.

    Pairs come from all labelled rows (where ``among`` holds): up to ``sample`` of them are fitted in one task, more
    in several side by side; keys,
    sources and labels are no inputs. Each row is judged by its own text: null and empty texts have no n-grams and get
    the score of that; repeated rows score alike, rows that share a key by themselves; scores equal to the cut are kept;
    very long texts are scored whole; an empty table gives no rows; columns in ``carry`` go along, others are ignored.
    """

    def fitted(rows: Rows) -> tuple[np.ndarray, list[float]]:
        found = fit_pairs(rows)
        return found.weights, [found.slope, found.cut]

    plain = documents(docs, id_col, text_col)
    keys = cut_lineage(labelled_keys(labels, label, among, id_col), "labelled")
    size = keys.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad")).first()
    shards = -(-size["n"] // sample)
    if shards <= 1:  # long texts: a byte has four n-grams at most, in words of two bytes and in characters
        length = plain.join(keys, "doc_id", "left_semi").agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = -(-(24 * length + 64 * size["n"]) // FEATURE_BYTES)
    if shards <= 1:
        weights, numbers = fit_in_task(labelled_features(docs, labels, label, sample, among, id_col, text_col), fitted)
    else:
        model = fit_all_pairs(plain, keys, size["good"], size["bad"], shards)
        weights, numbers = model.weights, [model.slope, model.cut]
    sent = docs.sparkSession.sparkContext.broadcast(Ranker(weights, *numbers))  # WIDTH weights

    def make():
        grams = Grams()
        return lambda texts: {"score": [sent.value.scale(grams.score(t, sent.value.weights)) for t in texts]}

    named = docs.select(*[F.col(c) for c in carry if c not in (id_col, text_col)], F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = map_documents(named, make, "score double", ("doc_id", *(c if c != text_col else "text" for c in carry if c != id_col)))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
