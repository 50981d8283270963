"""SimHash near-duplicates: fingerprints, pigeonhole blocks, and the components of the links.

Fingerprints link when at most ``DISTANCE`` of their 64 bits differ. They are cut into six blocks;
three differing bits leave at least three blocks equal, so each pair of linked fingerprints agrees on
one of the twenty choices of three blocks (31 to 33 bits). A choice and its bits are a bucket.

Equal fingerprints count once. In a bucket of few fingerprints all pairs are verified as columns. A crowded
bucket is dealt into blocks, each compared whole within a task; two blocks then meet only where their
components still differ. What a block emits is a spanning forest: fewer links than fingerprints.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steadyline.llm.common import in_arrow, ship, texts_of
from steadyline.llm.grouping import components, crossing, dealt, forest, stored

DISTANCE = 3
SEED = 42
# Buckets of more fingerprints than this are compared in blocks. Both ways give the same components.
CROWDED = 12
BLOCK = 512
_BLOCKS = (11, 11, 11, 11, 10, 10)
_ROWS = 1 << 15

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: str, words: int) -> list[bytes]:
    """Overlapping word shingles in order, repeats included; a shorter text is one shingle, none if empty."""
    own = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if len(own) <= words:
        return [b" ".join(own)] if own else []
    joined = b" ".join(own)
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    return [joined[a:b] for a, b in zip(starts, ends[words - 1 :].tolist(), strict=False)]


def fingerprint(text: str, words: int) -> int:
    """Bit i is set where over half of the shingles' XXH64 have it; 0 without any word."""
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles(text, words)], "<u8")
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _ROWS):
        part = hashes[at : at + _ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _fingerprinted(texts: DataFrame, words: int) -> DataFrame:
    """``texts`` with the fingerprint ``fp`` in place of the text; the other columns are longs."""
    others = [c for c in texts.columns if c != "text"]

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = pa.array([fingerprint(t, words) for t in texts_of(batch)], pa.int64())
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), found], [*others, "fp"])

        return work

    return in_arrow(texts, ", ".join(f"{c} long" for c in [*others, "fp"]), make)


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp) of every row: the fingerprint as a signed long; a null text counts as empty."""
    return _fingerprinted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _masks() -> list[int]:
    masks, at = [], 0
    for size in _BLOCKS:
        masks.append(((1 << size) - 1) << at)
        at += size
    return [_signed(sum(three)) for three in combinations(masks, 3)]


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _near(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    return np.bitwise_count(rows[:, None] ^ columns[None, :]) <= DISTANCE


def _block_links(groups: DataFrame, keys: list[str]) -> DataFrame:
    """(a, b): a spanning forest of the links within each group; ``side`` as in ``grouping.crossing``."""
    ship(groups.sparkSession)

    def work(group: pa.Table) -> pa.Table:
        fps, side = group.column("node").to_numpy(), group.column("side").to_numpy()
        if side.any():
            rows, columns = fps[side == 0], fps[side == 1]
            found = forest(_near(rows, columns), other=True)
        else:
            rows = columns = fps
            found = forest(_near(fps, fps) & ~np.eye(len(fps), dtype=bool))
        a, b = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
        return pa.table({"a": rows[a], "b": columns[b]})

    return groups.select(*keys, "side", "node").groupBy(*keys).applyInArrow(work, "a long, b long")


def links(spark: SparkSession, distinct: DataFrame) -> DataFrame:
    """(a, b): links whose components are those of all pairs of ``distinct.fp`` at most ``DISTANCE`` bits apart."""
    keys = ["choice", "bits"]
    keyed = distinct.select(
        F.col("fp").alias("node"), F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in _masks()])).alias(*keys)
    )
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(keyed.join(sizes, keys), "buckets")

    few = shared.filter(F.col("n") <= CROWDED)
    members = few.groupBy(*keys).agg(F.collect_list("node").alias("fps"))  # at most CROWDED
    near = F.transform(
        "fps",
        lambda a: F.transform(
            F.filter("fps", lambda b: (b > a) & (_apart(a, b) <= DISTANCE)), lambda b: F.struct(a.alias("a"), b.alias("b"))
        ),
    )
    pairs = members.select(F.explode(F.flatten(near)).alias("p")).select("p.a", "p.b")

    many = stored(dealt(shared.filter(F.col("n") > CROWDED), keys, BLOCK), "crowded")
    within = _block_links(many.withColumn("side", F.lit(0)), [*keys, "block"])
    first = stored(pairs.unionByName(within).distinct(), "links")
    rooted = many.filter("blocks > 1").join(components(spark, first), "node", "left")
    rooted = stored(rooted.select(*keys, "node", F.coalesce("root", "node").alias("root")), "rooted")
    across = _block_links(crossing(rooted, keys, BLOCK), [*keys, "i", "j"])
    return first.unionByName(across)


def near_duplicates(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, fp, component_id): per row, the smallest doc_id that its fingerprint reaches by links.

    Texts without a word have fingerprint 0 and are linked like any other. Null ids take part but are never
    the smallest (a component of null ids alone has a null id). Repeated rows are classified one by one.
    An empty table gives no row. Extra columns are ignored.
    """
    spark = docs.sparkSession
    known = stored(fingerprints(docs, words), "fingerprints")
    distinct = known.groupBy("fp").agg(F.min("doc_id").alias("first"))
    classes = _classes(stored(distinct, "distinct")).select("fp", F.col("least").alias("component_id"))
    return known.join(classes, "fp").select("doc_id", "fp", "component_id")


def _classes(distinct: DataFrame) -> DataFrame:
    """(fp, least): of (fp, first), the smallest ``first`` of the fingerprint's component."""
    spark = distinct.sparkSession
    roots = components(spark, links(spark, distinct.select("fp")))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.join(least, "root").select("fp", "least")


def one_of_each(docs: DataFrame, words: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, of which each component of linked fingerprints keeps one.

    A component keeps its smallest (doc_id, hash of the text), null ids last. Null texts and texts without a word
    have fingerprint 0 and are one group with whatever links to it. Rows that repeat doc_id and text count as copies. An empty
    table stays empty.
    """
    on = ["_id_key", "_text_hash"]
    id_key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    known = stored(_fingerprinted(texts, words), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    distinct = stored(known.groupBy("fp").agg(F.min(place).alias("first")), "distinct")
    kept = _classes(distinct).select("least").distinct().select("least.doc_id", "least.text_hash")
    often = known.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    named = [F.col("doc_id").isNull().alias("_none"), id_key.alias("_id_key"), F.col("text_hash").alias("_text_hash")]
    kept, often = stored(kept.select(*named), "kept"), often.select(*named)
    on = ["_none", *on]
    marked = docs.withColumns({"_none": F.col("doc_id").isNull(), "_id_key": id_key, "_text_hash": F.xxhash64("text")})
    # Rows that are repeated as they are need one more step; without any this side is empty.
    single = marked.join(kept.join(often, on, "left_anti"), on, "left_semi")
    again = marked.join(kept.join(often, on, "left_semi"), on, "left_semi").dropDuplicates(on)
    return single.unionByName(again).select(*docs.columns)
