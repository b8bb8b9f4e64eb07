"""Quality rules (5): a calibrated logistic regression over hashed n-grams, beside fixed counting rules."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from paneloom.llm.ngrams import Grams, Learner, Rows, WIDTH, fit_in_task, labelled_features, platt, sigmoid
from paneloom.llm.tasks import WordHashes, chain, documents, map_documents

SAMPLE = 4_000  # labelled rows that the model is fitted to, at most
SYMBOLS = "#*$%&|<>"
SPACES = "\x20\t\n\x0b\x0c\r"
REPEAT = 3  # words of a window


@dataclass(frozen=True)
class Classifier:
    weights: np.ndarray
    slope: float
    shift: float

    def probability(self, score: float) -> float:
        return float(sigmoid(self.slope * score + self.shift))


def fit(rows: Rows, epochs: int = 12, batch: int = 64, seed: int = 7) -> Classifier:
    """Four fifths of the rows fit the weights, the rest calibrates the probability. Without both labels
    every text gets the probability 1: there is nothing to reject by."""
    if len(set(rows.labels.tolist())) < 2:
        return Classifier(np.zeros(WIDTH, np.float32), 0.0, 50.0)
    rng, learner = np.random.default_rng(seed), Learner()
    order = rng.permutation(len(rows))
    held = order[: len(rows) // 5]
    if len(set(rows.labels[held].tolist())) < 2:
        held = order
    fitted = np.setdiff1d(order, held) if len(held) < len(order) else order
    for _ in range(epochs):
        shuffled = rng.permutation(fitted)
        for start in range(0, len(shuffled), batch):
            picked = shuffled[start : start + batch]
            learner.step(rows, picked, sigmoid(learner.scores(rows, picked)) - rows.labels[picked])
    slope, shift = platt(learner.scores(rows, held), rows.labels[held])
    return Classifier(learner.weights.astype(np.float32), slope, shift)


def base_counts(text: str | None, hashes: WordHashes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = hashes.of(text.encode().split())
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeated = 0
    if len(words) > REPEAT:
        count = len(words) - REPEAT + 1
        windows = words[:count]
        for k in range(1, REPEAT):
            windows = chain(windows, words[k : k + count])
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = np.concatenate((counts[inverse] > 1, np.zeros(REPEAT - 1, bool)))
        inside = twice.copy()
        for k in range(1, REPEAT):
            inside[k:] |= twice[:-k]
        repeated = int(inside.sum())
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
    )


def judge_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE, among: Column | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each document's counts, ``base_failed``, the probability of quality 1 and ``kept``: not failed, and a
    probability of at least ``threshold``.

    The model is fitted to at most ``sample`` labelled rows (where ``among`` holds) and goes to the tasks as
    weights of a fixed size; a task fits it, and the driver sees nothing else. Null and empty texts have no words and
    fail; repeated rows are judged alike; very long texts are judged whole; an empty table gives no rows; further
    columns are ignored.
    """
    def fitted(rows: Rows) -> tuple[np.ndarray, list[float]]:
        found = fit(rows)
        return found.weights, [found.slope, found.shift]

    weights, numbers = fit_in_task(labelled_features(docs, labels, "quality", sample, among, id_col, text_col), fitted)
    model = Classifier(weights, *numbers)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH weights

    def make():
        grams, hashes = Grams(), WordHashes()

        def score(texts: list) -> dict[str, list]:
            counts = list(zip(*(base_counts(t, hashes) for t in texts))) or [()] * 5
            chance = [sent.value.probability(grams.score(t, sent.value.weights)) for t in texts]
            return dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "probability"), [*map(list, counts), chance]))

        return score

    scored = map_documents(documents(docs, id_col, text_col), make, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, probability double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("probability") >= threshold))
