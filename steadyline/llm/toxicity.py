"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steadyline.llm.common import in_arrow, labelled_sample, ship, texts_of
from steadyline.llm.grams import gram_hashes, normal

SIZES = (3, 4, 5, 6)
BITS = 18
FIT_ROWS = 6000
# Standard errors by which an n-gram's two shares must differ; of 2**18 chance differences, two or so reach it.
SIGNIFICANT = 4.5
# Share of either class that must hold an n-gram; rarer ones come from copies of a few texts.
LEAST_SHARE = 0.02
FIT_CHARS = 20_000


@dataclass(frozen=True)
class ToxicityModel:
    """``weight[h]`` is the learned weight of n-gram h times its log-count ratio."""

    weight: np.ndarray
    bias: float

    def score(self, present: np.ndarray) -> float:
        margin = float(self.weight[present].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def present_grams(text: str, seen: np.ndarray) -> np.ndarray:
    """The distinct n-grams of a whole text. ``seen`` is a cleared table of ``2**BITS`` flags, left cleared."""
    for hashes in gram_hashes(normal(text), SIZES, BITS):
        seen[hashes] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def fit(sample: list[tuple[str, int]], epochs: int = 12, rate: float = 0.3, ridge: float = 2e-5, seed: int = 7) -> ToxicityModel:
    """Logistic regression on ``ratio[h] * (h is present)``.

    ``ratio`` is the logarithm of an n-gram's smoothed share of toxic texts over its share of others;
    it is 0, and the n-gram without effect, where the shares do not differ significantly
    or both are tiny.
    Steps are scaled for each weight by its past gradients; both classes weigh the same. A sample
    with one class, or none, gives a model that answers 0 (or 1 where all rows are toxic).
    """
    size = 1 << BITS
    goal = np.array([1 if y else 0 for _, y in sample], np.float64)
    if not len(goal) or goal.min() == goal.max():
        return ToxicityModel(np.zeros(size, np.float32), 30.0 if len(goal) and goal[0] else -30.0)
    seen = np.zeros(size, bool)
    rows = [present_grams(text, seen).astype(np.int32) for text, _ in sample]
    share, n = [], []
    for y in (0, 1):
        own = [r for r, g in zip(rows, goal, strict=True) if g == y]
        share.append((np.bincount(np.concatenate(own), minlength=size) + 1.0) / (len(own) + 2.0))
        n.append(len(own))
    ratio = np.log(share[1] / share[0])
    pooled = (share[0] * n[0] + share[1] * n[1]) / sum(n)
    error = np.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
    ratio[(np.abs(share[1] - share[0]) < SIGNIFICANT * error) | (np.maximum(*share) < LEAST_SHARE)] = 0
    weight, bias = np.zeros(size), 0.0
    past, past_bias = np.full(size, 1e-8), 1e-8
    balance = np.where(goal == 1, 0.5 / goal.mean(), 0.5 / (1 - goal.mean()))
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), 256):
            batch = order[at : at + 256]
            lengths = np.array([len(rows[i]) for i in batch])
            flat = np.concatenate([rows[i] for i in batch])
            ends = np.concatenate([[0], np.cumsum(ratio[flat] * weight[flat])])
            last = np.cumsum(lengths)
            margin = ends[last] - ends[last - lengths] + bias
            error = balance[batch] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - goal[batch]) / len(batch)
            grad = ratio * np.bincount(flat, np.repeat(error, lengths), size) + ridge * weight
            past += grad**2
            weight -= rate * grad / np.sqrt(past)
            past_bias += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(past_bias)
    return ToxicityModel((weight * ratio).astype(np.float32), bias)


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> ToxicityModel:
    """Fit on at most ``rows`` rows of ``labels`` (doc_id, toxic)."""
    return fit(labelled_sample(docs, labels, "toxic", rows, FIT_CHARS))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, predicted) for every row; ``score`` is the probability of the toxic label.

    A null or empty text, or one without letters, has no n-gram and is scored by the bias alone, like
    any text without a known sign. Repeated rows and ids are scored one by one; other columns are ignored.
    """

    def make():
        seen = np.zeros(1 << BITS, bool)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = np.array([model.score(present_grams(t, seen)) for t in texts_of(batch)], np.float64)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

        return work

    return in_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        "doc_id long, score double, predicted int",
        make,
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs``, all columns, that the model does not call toxic; null texts are judged as empty ones."""
    ship(docs.sparkSession)

    def run(batches):
        seen = np.zeros(1 << BITS, bool)
        for batch in batches:
            kept = [model.score(present_grams(t, seen)) < 0.5 for t in texts_of(batch)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
