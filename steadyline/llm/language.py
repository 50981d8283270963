"""Language identification: averaged hashed subword embeddings with a linear softmax."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steadyline.llm.common import in_arrow, labelled_sample, texts_of
from steadyline.llm.grams import gram_hashes, gram_list, normal

UNKNOWN = "und"
SIZES = (2, 3, 4)
BITS = 14
DIMENSIONS = 16
FIT_ROWS = 6000
FIT_CHARS = 20_000
REJECT_ERROR = 0.01

_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class LanguageModel:
    """``table[h]`` is the embedding of subword h times the softmax weights, scaled by the temperature.

    The average of embeddings followed by a linear layer equals the average of these rows, so scoring
    needs one row of logits for each subword. ``threshold``: answers of less confidence are rejected.
    """

    names: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    threshold: float

    def probabilities(self, text: str) -> np.ndarray:
        counts = np.zeros(1 << BITS, np.int64)
        for hashes in gram_hashes(normal(text), SIZES, BITS):
            counts += np.bincount(hashes, minlength=1 << BITS)
        return _softmax(counts @ self.table / max(1, counts.sum()) + self.bias)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _spans(text: str, random: np.random.Generator) -> list[str]:
    """A few spans of very different lengths, so that short texts are learned as well."""
    words = text.split()
    out = []
    for size in (2, 6, 20, 60):
        at = int(random.integers(0, max(1, len(words) - size + 1)))
        out.append(" ".join(words[at : at + size]))
    return out


def fit(sample: list[tuple[str, str]], epochs: int = 2, rate: float = 4.0, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent on spans of the sample, then calibration on a fifth kept apart.

    Temperature: the scale of the logits with the least log loss there. Threshold: the least confidence
    from which on at most ``REJECT_ERROR`` of the answers are wrong. Without any row the model knows no
    language; with one it always answers that.
    """
    random = np.random.default_rng(seed)
    names = tuple(sorted({label for _, label in sample}))
    k = len(names)
    if k < 2:
        return LanguageModel(names, np.zeros((1 << BITS, k)), np.zeros(k), 0.0)
    index = {name: i for i, name in enumerate(names)}
    rows, goal, apart = [], [], []
    for i, (text, label) in enumerate(sample):
        for span in _spans(text, random):
            grams = gram_list(normal(span), SIZES, BITS)
            if len(grams):
                rows.append(grams)
                goal.append(index[label])
                apart.append(i % 5 == 4)
    if not rows:
        return LanguageModel(names, np.zeros((1 << BITS, k)), np.zeros(k), 0.0)
    goal, apart = np.array(goal), np.array(apart)
    embed = random.normal(0, 0.1, (1 << BITS, DIMENSIONS)).astype(np.float32)
    weight = random.normal(0, 0.3, (DIMENSIONS, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    train = np.flatnonzero(~apart) if (~apart).any() else np.arange(len(rows))

    def mean_of(batch):
        sizes = np.array([len(rows[i]) for i in batch])
        flat = np.concatenate([rows[i] for i in batch])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return flat, sizes, np.add.reduceat(embed[flat], starts) / sizes[:, None]

    steps, done = epochs * -(-len(train) // 64), 0
    for _ in range(epochs):
        order = random.permutation(train)
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            flat, sizes, mean = mean_of(batch)
            error = _softmax(mean @ weight + bias)
            error[np.arange(len(batch)), goal[batch]] -= 1
            lr = rate * (1 - done / steps)
            back = (error @ weight.T) / sizes[:, None]
            weight -= (lr / len(batch) * (mean.T @ error)).astype(np.float32)
            bias -= (lr / len(batch) * error.sum(0)).astype(np.float32)
            np.subtract.at(embed, flat, np.repeat((lr * back).astype(np.float32), sizes, axis=0))
            done += 1
    held = np.flatnonzero(apart) if apart.any() else train
    logits = np.concatenate([mean_of(held[a : a + 512])[2] for a in range(0, len(held), 512)]) @ weight + bias
    scales = np.geomspace(0.25, 4, 33)
    losses = [-np.log(_softmax(s * logits)[np.arange(len(held)), goal[held]] + 1e-12).mean() for s in scales]
    scale = float(scales[int(np.argmin(losses))])
    p = _softmax(scale * logits)
    order = np.argsort(-p.max(1), kind="stable")
    wrong = (p.argmax(1) != goal[held])[order]
    fine = np.flatnonzero(np.cumsum(wrong) <= REJECT_ERROR * np.arange(1, len(wrong) + 1))
    threshold = float(p.max(1)[order][fine[-1]]) if len(fine) else 1.0
    return LanguageModel(names, (embed @ weight * scale).astype(np.float64), bias * scale, threshold)


def fit_on(docs: DataFrame, labelled: DataFrame, rows: int = FIT_ROWS) -> LanguageModel:
    """Fit on at most ``rows`` rows of ``labelled`` (doc_id, lang)."""
    return fit(labelled_sample(docs, labelled, "lang", rows, FIT_CHARS))


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) for every row.

    ``score`` is the calibrated probability of the answer, ``accepted`` says whether it reaches the
    model's threshold. A null text, an empty one or one without a letter is ``und`` with score 0 and
    not accepted, and so is any text under a model without languages. Ties go to the name first in order.
    Repeated rows and ids are answered one by one; other columns are ignored.
    """

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, scores, fine = [], [], []
            for text in texts_of(batch):
                if not model.names or not _LETTER.search(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    fine.append(False)
                    continue
                p = model.probabilities(text)
                best = int(p.argmax())
                names.append(model.names[best])
                scores.append(min(1.0, float(p[best])))
                fine.append(scores[-1] >= model.threshold)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(fine, pa.bool_())],
                ["doc_id", "lang_pred", "score", "accepted"],
            )

        return work

    return in_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        "doc_id long, lang_pred string, score double, accepted boolean",
        make,
    )
