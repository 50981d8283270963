"""Ranked lexical search: every item against every document by dense blocked matrix products.

Items are taken in tiles, each with the compact vocabulary of its own terms. A document tile is a dense matrix of
impacts, terms by documents; an item tile one of term weights, items by terms. Weights and impacts
are whole numbers held in float64. A product sums at most ``TERMS`` of them, which stays below 2^53, so the BLAS product is exact
in any order; parts of a larger vocabulary are added as 64-bit integers. Of each document tile only
the best documents of an item stay, equal scores by id, and Spark merges what the tasks found.

Texts are split once: what an item can match of a document (its number of terms, the terms that some item has, how
often) is stored in the shared folder and read by both the statistics and the products.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from steadyline.llm.common import in_arrow, ship, texts_of
from steadyline.llm.grouping import stored

# Items are searched in batches of about this many bytes of text and this many items, each with one pass over the texts.
BATCH_BYTES = 8 << 20
BATCH_ITEMS = 4096
# Items of a tile, terms of one product, documents of a tile.
ITEMS = 64
TERMS = 1 << 12
DOCUMENTS = 1024

_SEPARATORS = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_MAP = bytes(32 if _SEPARATORS.match(chr(c)) else c + 32 if 65 <= c <= 90 else c for c in range(128)) + bytes(range(128, 256))


def terms(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_MAP).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impact(times: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + 20 * m)


def length_norm(n: int, documents: int, total: int) -> int:
    return 100 - 50 + (50 * n * documents) // total


class ItemTile:
    """Up to ``ITEMS`` items over their own terms: which terms of the batch those are, and a weight for each item's."""

    def __init__(self, items: list[tuple[int, set[int]]], weights: np.ndarray):
        self.items = np.array([place for place, _ in items], np.int64)
        self.terms = np.array(sorted({t for _, own in items for t in own}), np.int64)
        self.weights = np.zeros((len(items), len(self.terms)))
        for row, (_, own) in enumerate(items):
            listed = np.array(sorted(own), np.int64)
            self.weights[row, np.searchsorted(self.terms, listed)] = weights[listed]

    def scores(self, owner: np.ndarray, term: np.ndarray, impacts: np.ndarray, documents: int) -> np.ndarray:
        """Items by documents, exact: ``impacts`` of ``term`` in document ``owner``."""
        place = np.minimum(np.searchsorted(self.terms, term), max(len(self.terms) - 1, 0))
        known = self.terms[place] == term if len(self.terms) else np.zeros(len(term), bool)
        owner, place, impacts = owner[known], place[known], impacts[known]
        total = np.zeros((len(self.items), documents), np.int64)
        for low in range(0, len(self.terms), TERMS):
            part = (place >= low) & (place < low + TERMS)
            dense = np.zeros((min(TERMS, len(self.terms) - low), documents))
            dense[place[part] - low, owner[part]] = impacts[part]
            total += (self.weights[:, low : low + TERMS] @ dense).astype(np.int64)
        return total


def best(scores: np.ndarray, ids: np.ndarray, none: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores above 0; equal scores by ascending id, null ids last."""
    if np.count_nonzero(scores > 0) > k:  # the k-th highest score and whatever equals it
        least = max(1, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
    else:
        least = 1
    found = np.flatnonzero(scores >= least)
    return found[np.lexsort((ids[found], none[found], -scores[found]))[:k]]


def _matches(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, times): a document's number of terms, and those of the vocabulary with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        known = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, found, times = [], [], []
            for text in texts_of(batch):
                own = terms(text)
                counts = Counter(own)
                hit = [(known[t], counts[t]) for t in counts.keys() & known.keys()]
                sizes.append(len(own))
                found.append([t for t, _ in hit])
                times.append([c for _, c in hit])
            columns = [pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "term", "times"])

        return work

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_arrow(read, "doc_id long, n long, term array<int>, times array<int>", make)


def _holding(matches: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of the ``size`` terms; a task sends one row for each of them at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            seen += np.bincount(batch.column("term").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(seen[held])], ["term", "df"])

    found = matches.select("term").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[found.column("term").to_numpy()] = found.column("df").to_numpy()
    return out


def _search(matches: DataFrame, tiles: list[ItemTile], documents: int, total: int, k: int) -> DataFrame:
    """(item, doc_id, score): the best ``k`` documents of every item in each task's documents."""
    shared = matches.sparkSession.sparkContext.broadcast(tiles)
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * sum(len(t.items) for t in shared.value)
        for whole in batches:
            for low in range(0, whole.num_rows, DOCUMENTS):
                batch = whole.slice(low, DOCUMENTS)
                ids = batch.column("doc_id").fill_null(0).to_numpy()
                none = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                norms = np.array([length_norm(n, documents, total) for n in batch.column("n").to_pylist()], np.int64)
                lists = batch.column("term")
                owner = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
                term = lists.flatten().to_numpy().astype(np.int64)
                impacts = impact(batch.column("times").flatten().to_numpy().astype(np.int64), norms[owner])
                at = 0
                for tile in shared.value:
                    for row in tile.scores(owner, term, impacts, len(ids)):
                        scores, own, absent = kept[at]
                        new = best(row, ids, none, k)
                        if len(new):
                            scores = np.concatenate([scores, row[new]])
                            own = np.concatenate([own, ids[new]])
                            absent = np.concatenate([absent, none[new]])
                            stay = best(scores, own, absent, k)
                            kept[at] = scores[stay], own[stay], absent[stay]
                        at += 1
        places = np.concatenate([t.items for t in shared.value])
        item = np.repeat(places, [len(scores) for scores, _, _ in kept])
        ids, none = (np.concatenate([x[c] for x in kept]) for c in (1, 2))
        columns = [pa.array(item), pa.array(ids, mask=none), pa.array(np.concatenate([x[0] for x in kept]))]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return matches.mapInArrow(run, "item long, doc_id long, score long")


def _batch(docs: DataFrame, items: dict[int | None, set[bytes]], k: int) -> DataFrame:
    """(item_id, doc_id, score) of one batch of items: the best of each task."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*items.values())))}
    matches = stored(_matches(docs, vocabulary), "matches")
    documents, total = matches.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    named = list(items.items())
    out = "item_id long, doc_id long, score long"
    if not total or not vocabulary:
        return spark.createDataFrame([], out)
    weights = np.array([weight(documents, int(df)) for df in _holding(matches, len(vocabulary))], np.int64)
    if int(weights.max()) * 1_000_000 * TERMS >= 1 << 53:
        raise OverflowError("a product of weights and impacts could pass 2^53")
    numbered = [(place, {vocabulary[t] for t in own}) for place, (_, own) in enumerate(named)]
    tiles = [ItemTile(numbered[low : low + ITEMS], weights) for low in range(0, len(numbered), ITEMS)]
    found = _search(matches.filter(F.size("term") > 0), tiles, documents, total, k)
    names = spark.createDataFrame([(place, item) for place, (item, _) in enumerate(named)], "item long, item_id long")
    return found.join(F.broadcast(names), "item").select("item_id", "doc_id", "score")  # at most BATCH_ITEMS or so


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents with a score above 0.

    Equal scores are ranked by ascending doc_id, null ids last; documents that repeat an id are ranked as rows of their own. Rows of
    one item_id (nulls too) are one item with the terms of all their texts, each once. Null and empty texts have no term:
    such items have no result, such documents count neither in N nor in L. Without documents or items
    there is no row. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    count, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    batches = max(1, -(-count // BATCH_ITEMS), -(-size // BATCH_BYTES))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for number in range(batches):
        own: dict[int | None, set[bytes]] = defaultdict(set)
        for row in asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(batches)) == number).collect():  # about BATCH_BYTES
            own[row.item_id].update(terms(row.text))
        if own:
            found = found.unionByName(stored(_batch(docs, own, k), "best"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), totals AS (
  SELECT count(*) FILTER (WHERE len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM lowered
), asked AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), flat AS (
  SELECT row_no, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM lowered
), held AS (
  SELECT row_no, doc_id, n, term, count(*) AS tf FROM flat WHERE term IN (SELECT term FROM asked)
  GROUP BY row_no, doc_id, n, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals
), parts AS (
  SELECT h.row_no, h.doc_id, h.term, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS s
  FROM held h JOIN weights w ON w.term = h.term, totals
), scores AS (
  SELECT a.item_id, p.row_no, p.doc_id, CAST(sum(p.s) AS BIGINT) AS score
  FROM asked a JOIN parts p ON p.term = a.term GROUP BY a.item_id, p.row_no, p.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""
