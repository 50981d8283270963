"""Best-fit packing of token sequences by a configuration linear program.

Only the histogram of piece lengths reaches the driver: at most ``capacity`` numbers, whatever the
size of the input. The program chooses how often each *configuration* (lengths that share a sequence)
is used; its prices follow the multiplicative-weights rule and a knapsack over the capacity finds the
configuration of the greatest price. Pieces then take their places by rank within their length.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from steadyline.llm.common import in_arrow, ship, texts_of
from steadyline.llm.token_files import bits_for, pack
from steadyline.llm.units import encoder

CAPACITY = 2048
# Rounds of prices in one solution of the program.
ROUNDS = 32
# Shares of the greatest price that a configuration may lack, the greater for what the lesser leaves in a round.
_SLACKS = (0.0002, 0.002)
_MOST_LAG = 5  # in rounds
_RATE = 0.005  # how strongly a length that lags behind gains weight
_LEAST = 0.01  # share of a round's pieces below which nothing more is spent
_GOOD_PART = 0.95  # share of the pieces left from which on another solution is not tried

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, bits int, payload binary, "
    "part int, rank long"
)

# A configuration: length -> copies in one sequence.
Configuration = dict[int, int]


def values(price: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack by dynamic programming: the greatest total price of lengths that fit in each capacity.

    ``price[l]`` is -inf for lengths not on offer.
    """
    best = np.zeros(capacity + 1)
    for c in range(1, capacity + 1):
        best[c] = max(best[c - 1], (best[c - 1 :: -1] + price[1 : c + 1]).max())
    return best


def _near_dearest(
    first: int, price: np.ndarray, best: np.ndarray, slack: float, free: np.ndarray, wish: np.ndarray, whole: np.ndarray
) -> Configuration | None:
    """A configuration with ``first`` whose price lacks at most ``slack`` of the greatest.

    It holds lengths with something ``free``, each at most ``whole`` times. Among the lengths that keep the price the
    one of the greatest ``wish`` is taken.
    """
    capacity = len(best) - 1
    out: Configuration = {}
    k, c = first, capacity
    slack -= best[capacity] - price[first] - best[capacity - first]
    while slack >= 0:
        out[k] = out.get(k, 0) + 1
        c -= k
        if not c or not best[c]:
            return out
        value = best[c - 1 :: -1] + price[1 : c + 1]
        score = np.where(value >= best[c] - slack, wish[1 : c + 1], 0)
        for used, n in out.items():
            if used <= c and whole[used] <= n:
                score[used - 1] = 0
        k = int(score.argmax()) + 1
        if not score[k - 1]:
            return out if best[c] <= slack else None
        slack = max(0.0, slack - (best[c] - value[k - 1]))
    return None


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[Configuration, int]]:
    """Best-fit decreasing on counts: equal sequences are filled together."""
    room: dict[int, list[tuple[Configuration, int]]] = defaultdict(list)
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            free = min((r for r, bins in room.items() if bins and r >= length), default=None)
            if free is None:
                free, config, bins = capacity, {}, n
            else:
                config, bins = room[free].pop()
            copies = min(free // length, n)
            used = min(bins, n // copies)
            if used < bins and config:
                room[free].append((config, bins - used))
            room[free - copies * length].append((config | {length: copies}, used))
            n -= copies * used
    merged: Counter = Counter()
    for bins in room.values():
        for config, n in bins:
            merged[tuple(sorted(config.items()))] += n
    return [(dict(k), n) for k, n in sorted(merged.items())]


def program(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float]:
    """Fractional uses of configurations, within the pieces of each length, and a bound from the prices.

    Multiplicative weights: a length has a weight, its share of the capacity at first. Every round lets each length spend
    ``1 / rounds`` of its pieces and what it could not spend before; a knapsack prices the configurations, and for one
    length after the other a configuration with it is used whose price lacks at most a small slack of the greatest.
    The weight of a length falls with the share of its pieces that is covered beyond the mean, and rises below it. The
    weights over the dearest configuration's price are a feasible dual solution: no packing, fractional or whole,
    has fewer sequences than the bound.
    """
    total = np.maximum(counts, 1).astype(float)
    weight = np.where(counts > 0, np.arange(capacity + 1) / capacity, -np.inf)
    given = np.zeros(capacity + 1)
    random = np.random.default_rng(len(counts))
    uses: dict[tuple, float] = defaultdict(float)
    bound, on_offer = 0.0, counts > 0
    for r in range(1, rounds + 1):
        best = values(weight, capacity)
        bound = max(bound, float(weight[on_offer] @ counts[on_offer]) / best[capacity])
        free = counts * (r / rounds) - given
        least = _LEAST * total / rounds
        free[free < least] = 0
        wish = np.where(free > 0, free / total * rounds + random.random(capacity + 1), 0)
        for slack in _SLACKS:
            for length in np.argsort(-free / total, kind="stable").tolist():
                while free[length] > 0:
                    config = _near_dearest(length, weight, best, slack * best[capacity], free, wish, counts)
                    if config is None:
                        break
                    times = min(free[k] / n for k, n in config.items())
                    for k, n in config.items():
                        free[k] -= n * times
                        given[k] += n * times
                        if free[k] < least[k]:
                            free[k] = wish[k] = 0
                    uses[tuple(sorted(config.items()))] += times
        lag = np.minimum(r - rounds * given / total, _MOST_LAG)
        weight = np.where(on_offer, weight * np.exp(_RATE * lag), -np.inf)
    return uses, bound


def _rounded(uses: dict[tuple, float], left: np.ndarray) -> Counter:
    """Whole uses: every use rounded down, then one more, the greatest fractions first, while its pieces last.

    ``left`` loses the pieces that are placed.
    """
    out: Counter = Counter()

    def take(config: tuple, times: int) -> None:
        for k, n in config:
            left[k] -= n * times
        out[config] += times

    for config, x in uses.items():
        if x >= 1:
            take(config, int(x))
    for config, _ in sorted(uses.items(), key=lambda u: (-(u[1] % 1), u[0])):
        if all(left[k] >= n for k, n in config):
            take(config, 1)
    return out


def configurations(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[Configuration, int]]:
    """How often to use which configuration so that ``counts[l]`` pieces of each length l are covered exactly.

    The program is solved and rounded, and again for what the rounding left, as long as that places a good part of
    it; what is left is packed best-fit decreasing. Of these roundings, each with one solution more than the one before,
    the one of the fewest sequences counts, of equal ones the last.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    out: Counter = Counter()
    if left[capacity]:
        out[((capacity, 1),)] += int(left[capacity])
        left[capacity] = 0
    solved = []
    while left.any() and (not solved or left.sum() <= _GOOD_PART * solved[-1][1].sum()):
        solved.append((out.copy(), left.copy()))
        uses, _ = program(left, capacity, rounds)
        out += _rounded(uses, left)
    solved = [*solved[1:], (out, left)]
    plans = [(uses, _best_fit(rest, capacity)) for uses, rest in reversed(solved)]
    out, rest = min(plans, key=lambda plan: plan[0].total() + sum(n for _, n in plan[1]))
    for config, n in rest:
        out[tuple(sorted(config.items()))] += n
    return [(dict(k), n) for k, n in sorted(out.items())]


class Places:
    """Where the r-th piece of a length goes. Its size follows the number of configurations alone."""

    _SHIFT = 44

    def __init__(self, plan: list[tuple[Configuration, int]]):
        rows, given, sequence = [], Counter(), 0
        for config, times in plan:
            offset = 0
            for length, copies in config.items():
                rows.append((length << self._SHIFT | given[length], sequence, copies, offset, length))
                given[length] += copies * times
                offset += length * copies
            sequence += times
        self.sequences = sequence
        rows.sort()
        self.first, self.sequence, self.copies, self.offset, self.length = (
            np.array([r[i] for r in rows], np.int64) for i in range(5)
        )

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length.astype(np.int64) << self._SHIFT | rank
        k = np.searchsorted(self.first, key, "right") - 1
        nth = key - self.first[k]
        return self.sequence[k] + nth // self.copies[k], self.offset[k] + nth % self.copies[k] * self.length[k]


def write_pieces(docs: DataFrame, path: str, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> None:
    """Encode whole texts, append ``end_id``, cut what is longer than ``capacity``, store the pieces.

    The first piece of a cut document is the short one, the others are full. A null or empty text is one
    piece with the end id. Repeated ids are packed as documents of their own. ``rank`` counts the pieces of a
    length within the writing task ``part``. ``payload`` holds the ids in the fewest bits.
    """

    def run(batches):
        tokens = encoder(tokenizer)
        bits = bits_for(max(tokens.vocabulary_size, end_id + 1))
        end = np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            out = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "payload", "rank")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                ids = tokens.encode(text) + end
                n = len(ids) // 4
                start, stop = 0, n % capacity or min(n, capacity)
                piece = 0
                while start < n:
                    own = ids[4 * start : 4 * stop]
                    size = stop - start
                    for name, value in zip(
                        out,
                        (doc_id, piece, start, size, zlib.crc32(own), pack(np.frombuffer(own, "<u4"), bits), seen[size]),
                        strict=True,
                    ):
                        out[name].append(value)
                    seen[size] += 1
                    piece, start, stop = piece + 1, stop, stop + capacity
            k = len(out["doc_id"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["doc_id"], pa.int64()),
                    pa.array(out["piece"], pa.int32()),
                    pa.array(out["start"], pa.int64()),
                    pa.array(out["length"], pa.int64()),
                    pa.array(out["ids_crc32"], pa.int64()),
                    pa.array([bits] * k, pa.int32()),
                    pa.array(out["payload"], pa.binary()),
                    pa.array([part] * k, pa.int32()),
                    pa.array(out["rank"], pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "bits", "payload", "part", "rank"],
            )

    ship(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read.mapInArrow(run, PIECES).write.parquet(path)


def pack_pieces(spark: SparkSession, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The stored pieces with ``sequence_id`` and ``offset``: gapless places in sequences of ``capacity`` ids.

    An empty store gives no row. Columns that a caller does not read (``payload``) are not read from the store.
    """
    pieces = spark.read.schema(PIECES).parquet(path)
    sizes = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row.length] = row.n
    places = Places(configurations(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumns(
        {"nth": F.col("rank"), "rank": F.col("rank") + F.col("base")}
    )
    own = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sequence, offset = places.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            return pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in own], pa.array(sequence), pa.array(offset)],
                [*own, "sequence_id", "offset"],
            )

        return work

    return in_arrow(
        ranked.select(*own, "rank"),
        "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long, "
        "sequence_id long, offset long",
        make,
    )


def packed_ids(spark: SparkSession, path: str, packed: DataFrame) -> DataFrame:
    """(sequence_id, offset, length, bits, payload): the ids of each place, for writers of training files."""
    stored = spark.read.schema(PIECES).parquet(path).withColumnRenamed("rank", "nth")
    key = ["part", "length", "nth"]
    return packed.join(stored.select(*key, "bits", "payload"), key).select(
        "sequence_id", "offset", "length", "bits", "payload"
    )
