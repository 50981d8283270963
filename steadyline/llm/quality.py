"""Quality by attention-based multiple-instance learning: a document is a bag of passages."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steadyline.llm.common import in_arrow, labelled_sample, texts_of

PASSAGE_WORDS = 64
HIDDEN = 32
ATTENTION = 16
FIT_ROWS = 6000
FIT_CHARS = 20_000

# Kinds of bytes; the pairs of neighbouring kinds describe the texture of a passage.
_KINDS = 12


def _kind_table() -> np.ndarray:
    table = np.full(256, 9, np.uint8)  # other ASCII
    table[0x80:0xC0], table[0xC0:] = 11, 10  # inside and at the start of a longer UTF-8 character
    table[[9, 10, 11, 12, 13]] = 1
    table[0x20] = 0
    table[ord("a") : ord("z") + 1] = 2
    table[ord("A") : ord("Z") + 1] = 3
    table[ord("0") : ord("9") + 1] = 4
    table[[ord(c) for c in ".,"]] = 5
    table[[ord(c) for c in "!?"]] = 6
    table[[ord(c) for c in "#*$%&<>"]] = 7
    table[ord("|")] = 8
    return table


_KIND = _kind_table()
_POWERS = np.cumprod(np.full(64, 16777619, np.uint32), dtype=np.uint32)
FEATURES = _KINDS * _KINDS + 5


def _seen_before(hashes: np.ndarray) -> np.ndarray:
    """Which entries are equal to an earlier one."""
    again = np.ones(len(hashes), bool)
    again[np.unique(hashes, return_index=True)[1]] = False
    return again


def passages(text: str) -> np.ndarray:
    """Features of every passage of a whole text, one row for each run of ``PASSAGE_WORDS`` words.

    Shares of neighbouring kinds of bytes; mean word length; shares of words that repeat within the passage, words
    and word pairs that repeat an earlier place of the document; length of the document. A text without
    words is one passage of zeros.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kind = _KIND[data]
    inside = kind > 1
    if not inside.any():
        return np.zeros((1, FEATURES), np.float32)
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & ~before)
    n = len(starts)
    k = -(-n // PASSAGE_WORDS)
    edges = starts[::PASSAGE_WORDS].copy()
    edges[0] = 0
    size = np.diff(np.append(edges, len(data)))
    of_byte = np.repeat(np.arange(k, dtype=np.int32), size)
    pair = of_byte[:-1] * (_KINDS * _KINDS) + kind[:-1] * np.int32(_KINDS) + kind[1:]
    texture = np.bincount(pair, minlength=k * _KINDS * _KINDS).reshape(k, -1)
    out = np.empty((k, FEATURES), np.float32)
    out[:, : _KINDS * _KINDS] = np.sqrt(texture / size[:, None])

    words = np.cumsum(inside & ~before) - 1
    words[words < 0] = 0
    place = np.minimum(np.arange(len(data)) - starts[words], 63)
    value = np.where(inside, (data.astype(np.uint32) + np.uint32(1)) * _POWERS[np.maximum(place, 0)], np.uint32(0))
    hashes = np.add.reduceat(value, starts)
    of_word = np.arange(n) // PASSAGE_WORDS
    per = np.bincount(of_word, minlength=k)
    pairs = hashes[:-1].astype(np.uint64) << np.uint64(32) | hashes[1:]
    within = _seen_before(of_word.astype(np.uint64) << np.uint64(32) | hashes)
    out[:, -5] = np.log1p(np.add.reduceat(inside, edges) / per)
    out[:, -4] = np.bincount(of_word, within, k) / per
    out[:, -3] = np.bincount(of_word, _seen_before(hashes), k) / per
    out[:, -2] = np.bincount(of_word[1:], _seen_before(pairs), k) / per
    out[:, -1] = np.log1p(n)
    return out


@dataclass(frozen=True)
class QualityModel:
    """Encoder ``w``, gate ``v`` and ``u`` with ``a``, output ``o``; inputs are shifted and scaled first."""

    shift: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, rows: np.ndarray) -> tuple[float, np.ndarray]:
        """Probability of label 1 and the attention on each passage."""
        p, attention, *_ = _forward(self.weights, (rows - self.shift) / self.scale, np.array([0]))
        return float(p[0]), attention


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray):
    sizes = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ w["w"] + w["wb"])
    t, g = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
    e = np.clip((t * g) @ w["a"], -30, 30)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    attention = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(attention[:, None] * h, starts)
    return _sigmoid(z @ w["o"] + w["ob"]), attention, h, t, g, z, sizes


def fit(sample: list[tuple[str, int]], epochs: int = 8, rate: float = 0.01, seed: int = 7) -> QualityModel:
    """Adam on the log loss of document labels; attention has no labels of its own.

    A sample with one class, or none, gives a model that answers that class (0 without any row).
    """
    random = np.random.default_rng(seed)
    f, d, q = FEATURES, HIDDEN, ATTENTION
    w = {
        "w": random.normal(0, f**-0.5, (f, d)), "wb": np.zeros(d), "v": random.normal(0, d**-0.5, (d, q)),
        "u": random.normal(0, d**-0.5, (d, q)), "a": random.normal(0, q**-0.5, q),
        "o": random.normal(0, d**-0.5, d), "ob": np.zeros(1),
    }
    goal = np.array([y for _, y in sample], np.float64)
    if not len(goal) or goal.min() == goal.max():
        w["o"], w["ob"] = np.zeros(d), np.array([30.0 if len(goal) and goal[0] else -30.0])
        return QualityModel(np.zeros(f), np.ones(f), w)
    bags = [passages(text) for text, _ in sample]
    every = np.concatenate(bags)
    shift, scale = every.mean(0), every.std(0) + 0.02
    bags = [((b - shift) / scale).astype(np.float64) for b in bags]
    first = {k: np.zeros_like(x) for k, x in w.items()}
    second = {k: np.zeros_like(x) for k, x in w.items()}
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(bags))
        for at in range(0, len(order), 128):
            batch = order[at : at + 128]
            x = np.concatenate([bags[i] for i in batch])
            starts = np.concatenate([[0], np.cumsum([len(bags[i]) for i in batch])[:-1]])
            p, attention, h, t, g, z, sizes = _forward(w, x, starts)
            error = (p - goal[batch]) / len(batch)
            dz = np.repeat(error[:, None] * w["o"], sizes, axis=0)
            da = (dz * h).sum(1)
            de = attention * (da - np.repeat(np.add.reduceat(attention * da, starts), sizes))
            dt, dg = de[:, None] * w["a"] * g * (1 - t**2), de[:, None] * w["a"] * t * g * (1 - g)
            dh = (attention[:, None] * dz + dt @ w["v"].T + dg @ w["u"].T) * (1 - h**2)
            grads = {
                "w": x.T @ dh, "wb": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de,
                "o": z.T @ error, "ob": np.array([error.sum()]),
            }
            step += 1
            for k, grad in grads.items():
                grad = grad + 1e-4 * w[k]
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad**2 - second[k])
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return QualityModel(shift, scale, w)


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> QualityModel:
    """Fit on at most ``rows`` rows of ``labels`` (doc_id, quality)."""
    return fit(labelled_sample(docs, labels, "quality", rows, FIT_CHARS))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score, predicted, n_passages, top_passage) for every row.

    ``top_passage`` is the passage with the most attention, the first of equal ones. A null or empty text is
    one passage without features. Repeated rows are scored one by one; other columns are ignored.
    """

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores, sizes, tops = [], [], []
            for text in texts_of(batch):
                rows = passages(text)
                score, attention = model.score(rows)
                scores.append(score)
                sizes.append(len(rows))
                tops.append(int(attention.argmax()))
            p = np.array(scores, np.float64)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(p),
                    pa.array((p >= 0.5).astype(np.int32)),
                    pa.array(sizes, pa.int32()),
                    pa.array(tops, pa.int32()),
                ],
                ["doc_id", "score", "predicted", "n_passages", "top_passage"],
            )

        return work

    return in_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        "doc_id long, score double, predicted int, n_passages int, top_passage int",
        make,
    )
