"""Near-duplicates by SuperMinHash signatures, banding, verification on full sets, and union of the links.

A document's set holds its distinct word shingles. SuperMinHash draws for each element one random permutation of
the signature's places, step by step; in step j the element offers j plus a random fraction to the
place that is j-th in its permutation, and every place keeps the least offer. As the ranks of one element differ
from place to place, the places of a signature are negatively correlated, which makes the estimate less
variable than that of independent hashes. An offer of a later step exceeds all of an earlier one, so the steps end
as soon as every place has an offer: large sets need one.

Signatures are cut into bands; sets that agree on a band share a bucket. A pair at similarity 0.8 shares none with a
chance of (1 - 0.8^4)^32 = 5e-8. Nodes of a bucket are compared on their full sets, in blocks: first around the
smallest node of the bucket, then wherever the components of a bucket's nodes still differ. Only a
spanning forest of the links leaves a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steadyline.llm import sieve
from steadyline.llm.common import in_arrow, ship, texts_of
from steadyline.llm.grouping import components, crossing, forest, stored
from steadyline.llm.simhash import LOWER
from steadyline.llm.wordhash import Words, joined, mixed, together

PLACES = 128
BANDS = 32
BLOCK = 256
_COLUMNS = 4096
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LOW, _HALF = np.uint64(0xFFFFFFFF), np.uint64(32)


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """Hashes of each text's distinct shingles, ascending; a text of fewer words is one shingle, one without words has none."""
    blank = [b" ".join(t.encode("utf-8", "surrogatepass").translate(LOWER).split()) for t in texts]
    for part in together([len(t) for t in blank]):
        known = Words(blank[part])
        starts, hashes = known.starts().tolist(), known.hashes
        whole = np.zeros(len(hashes), np.uint64)
        for k in range(words):
            whole = joined(whole, np.append(hashes[k:], np.zeros(min(k, len(hashes)), np.uint64)))
        for low, high in zip(starts, starts[1:], strict=False):
            if high - low >= words:
                yield np.unique(whole[low : high - words + 1])
            elif high > low:
                short = np.zeros(1, np.uint64)
                for k in range(low, high):
                    short = joined(short, hashes[k : k + 1])
                yield short
            else:
                yield np.zeros(0, np.uint64)


def signature(elements: np.ndarray, places: int = PLACES) -> np.ndarray:
    """For each place the least offer: rank in the upper 32 bits, fraction in the lower. No element: all ones."""
    least = np.full(places, np.iinfo(np.uint64).max, np.uint64)
    order, rows = None, np.arange(len(elements))
    for step in range(places if len(elements) else 0):
        drawn = mixed(elements + np.uint64((step + 1) * int(_GOLDEN) % (1 << 64)))
        other = step + (((drawn >> _HALF) * np.uint64(places - step)) >> _HALF).astype(np.int64)
        if step == 0:
            place = other
        else:
            if order is None:  # the permutations after the first swap
                order = np.tile(np.arange(places, dtype=np.int16), (len(elements), 1))
                order[rows, first] = 0
                order[:, 0] = first
            place = order[rows, other].astype(np.int64)
            order[rows, other] = order[:, step]
            order[:, step] = place
        first = other if step == 0 else first
        np.minimum.at(least, place, (np.uint64(step) << _HALF) | (drawn & _LOW))
        if int(least.max()) >> 32 <= step:
            break
    return least


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimate of the similarity of two sets from their signatures."""
    return float((a == b).mean())


def band_keys(least: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash for each band of the signature; the band's number is part of it."""
    keys = np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN
    for column in least.reshape(bands, -1).T:
        keys = mixed(keys ^ column) + _GOLDEN
    return mixed(keys)


def _described(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, same, size, bands): ``same`` is a digest of the set, null for an empty set."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            same, sizes, bands = [], [], []
            for own in shingle_sets(texts_of(batch), words):
                same.append(xxhash.xxh3_128_hexdigest(own.tobytes()) if len(own) else None)
                sizes.append(len(own))
                bands.append(band_keys(signature(own)).view(np.int64) if len(own) else None)
            columns = [pa.array(same, pa.string()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            names = ["doc_id", "text_hash", "same", "size", "bands"]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *columns], names)

        return work

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return in_arrow(read, "doc_id long, text_hash long, same string, size long, bands array<long>", make)


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, set) of the nodes in ``wanted`` (node, doc_id, text_hash).

    The sieve lets the texts of wanted rows through (and few others), so only these are hashed and moved.
    """
    place = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text_hash").alias("place")
    table = sieve.sent(wanted.select(place), "place")

    def make():
        bits = sieve.opened(table)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = sieve.passes(bits, batch.column("place").to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(keep))
            sets = pa.array([s.view(np.int64) for s in shingle_sets(texts_of(batch), words)], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), sets], ["doc_id", "text_hash", "set"])

        return work

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    found = in_arrow(read.select("doc_id", "text_hash", "text", place), "doc_id long, text_hash long, set array<long>", make)
    id_key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    keyed = found.select(F.col("doc_id").isNull().alias("none"), id_key.alias("id_key"), "text_hash", "set")
    asked = wanted.select("node", F.col("doc_id").isNull().alias("none"), id_key.alias("id_key"), "text_hash")
    # A row may be there several times; one of them will do.
    return asked.join(keyed, ["none", "id_key", "text_hash"]).dropDuplicates(["node"]).select("node", "set")


def linked_sets(rows: list[np.ndarray], columns: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of ``rows`` and of ``columns`` have ``percent`` or more of their union in common."""
    sizes = np.array([len(s) for s in [*rows, *columns]], np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, element, often = np.unique(np.concatenate([*rows, *columns]), return_inverse=True, return_counts=True)
    element = np.where(often > 1, np.cumsum(often > 1) - 1, -1)[element]  # what only one set has is in no intersection
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    common = np.zeros((len(rows), len(columns)), np.int64)
    for low in range(0, int(element.max(initial=-1)) + 1, _COLUMNS):
        a, b = np.searchsorted(element, [low, low + _COLUMNS])
        has = np.zeros((len(sizes), _COLUMNS), np.float32)
        has[owner[a:b], element[a:b] - low] = 1
        common += np.rint(has[: len(rows)] @ has[len(rows) :].T).astype(np.int64)
    union = sizes[: len(rows), None] + sizes[None, len(rows) :] - common
    return (common > 0) & (100 * common >= percent * union)


def _block_links(groups: DataFrame, keys: list[str], sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the links within each group; ``side`` as in ``grouping.crossing``."""
    ship(groups.sparkSession)

    def work(group: pa.Table) -> pa.Table:
        nodes, side = group.column("node").to_numpy(), group.column("side").to_numpy()
        own = [s.values.to_numpy(zero_copy_only=False) for s in group.column("set").combine_chunks()]
        if side.any():
            rows, columns = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            linked = linked_sets([own[k] for k in rows], [own[k] for k in columns], percent)
            found = forest(linked, other=True)
        else:
            rows = columns = np.arange(len(nodes))
            found = forest(linked_sets(own, own, percent) & ~np.eye(len(own), dtype=bool))
        a, b = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
        return pa.table({"a": nodes[rows[a]], "b": nodes[columns[b]]})

    met = groups.select(*keys, "side", "node").join(sets, "node")
    return met.groupBy(*keys).applyInArrow(work, "a long, b long")


def _links(docs: DataFrame, distinct: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links whose components are those of all linked pairs of nodes that share a bucket."""
    spark = docs.sparkSession
    keyed = distinct.select("node", F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).filter("n > 1")
    shared = stored(keyed.join(sizes, "key"), "buckets")
    wanted = distinct.join(shared.select("node").distinct(), "node").select("node", "first.doc_id", "first.text_hash")
    sets = stored(_sets_of(docs, wanted, words), "sets")
    # First, the nodes around each bucket's smallest one, which is in every block of them.
    around = shared.filter("node <> least").select("least", "node").distinct()
    counts = around.groupBy("least").agg(F.count(F.lit(1)).alias("n"))
    blocks = around.join(counts, "least").select(
        "least", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).alias("block"), "node"
    )
    centres = counts.select("least", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / BLOCK) - 1)).alias("block"), F.col("least").alias("node"))
    first = stored(_block_links(blocks.unionByName(centres).withColumn("side", F.lit(0)), ["least", "block"], sets, percent), "links")
    # Then, in each bucket, nodes whose components still differ.
    rooted = shared.join(components(spark, first), "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted, "rooted")
    # Of buckets with the same nodes, told by their number and two checksums, one will do.
    sums = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"sum{seed}") for seed in (1, 2)]
    alike = rooted.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *sums).groupBy("n", "sum1", "sum2").agg(F.min("key").alias("key"))
    groups = stored(crossing(rooted.join(alike.select("key"), "key"), ["key"], BLOCK), "crossing")
    return first.unionByName(_block_links(groups, ["key", "i", "j"], sets, percent))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Sets of ``words``-word shingles (A-Z in any case) that have ``percent`` or more of their union in common are linked;
    ``component_id`` is the smallest doc_id that a row reaches. A text of fewer words is one shingle. Null texts
    and texts without a word have no shingle and are linked with nothing, not with one another either. Repeated rows are
    linked like any equal texts. Null ids take part but are never the smallest: a component of null ids alone has a
    null id. ``kept``: the row has its component's id (or both are null). An empty table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    known = stored(_described(docs, words), "described")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    distinct = (
        known.filter("same IS NOT NULL")
        .groupBy("same")
        .agg(F.min(place).alias("first"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    distinct = stored(distinct, "distinct")  # which fixes the numbers
    roots = components(spark, _links(docs, distinct.select("node", "first", "bands"), words, percent))
    rooted = distinct.join(roots, "node", "left").select("same", "first.doc_id", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = rooted.join(least, "root").select("same", "component_id")
    found = known.select("doc_id", F.col("size").alias("n_shingles"), "same").join(classes, "same", "left")
    component = F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


# Exact similarities by the shared shingles of distinct sets, and what each set reaches.
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT row_no, doc_id,
         CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_sort(list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)])) END AS s
  FROM words
), classes AS (
  SELECT s, row_number() OVER () AS class, min(doc_id) AS least, len(s) AS size FROM sets WHERE len(s) > 0 GROUP BY s
), elements AS (
  SELECT class, size, unnest(s) AS e FROM classes
), pairs AS (
  SELECT x.class AS a, y.class AS b FROM elements x JOIN elements y ON x.e = y.e AND x.class < y.class
  GROUP BY x.class, y.class, x.size, y.size HAVING 100 * count(*) >= 80 * (x.size + y.size - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT class AS a, class AS b FROM classes
  UNION
  SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), roots AS (
  SELECT r.a AS class, min(c.least) AS component FROM reach r JOIN classes c ON c.class = r.b GROUP BY r.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE r.component END AS component_id,
       CASE WHEN len(s.s) = 0 THEN true ELSE s.doc_id IS NOT DISTINCT FROM r.component END AS kept
FROM sets s LEFT JOIN classes c ON c.s = s.s LEFT JOIN roots r ON r.class = c.class
"""
