"""Token ids in files: fixed-width bit packing in blocks with offsets.

Format. A folder of Parquet files written by Spark, so a write is complete or absent whatever
executors are lost. Each row is a block of whole documents:

``shard``, ``block``  place of the block: shards follow one another, blocks follow within a shard
``first``             ids of the shard before this block
``n_ids``, ``bits``   how many ids, in how many bits each (the fewest that hold the vocabulary)
``payload``           the ids, least significant bit first: id i occupies bits [i * bits, (i + 1) * bits)
``docs``              (doc_id, n) of the documents in the block, in order

Every id has the same width, so any id is found by arithmetic alone and a block unpacks with numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from steadyline.llm.common import in_arrow, ship, texts_of
from steadyline.llm.units import encoder

# A block is closed at the first document end from this many ids on.
BLOCK_IDS = 1 << 16

SCHEMA = (
    "shard int, block int, first long, n_ids int, bits int, payload binary, "
    "docs array<struct<doc_id: long, n: int>>"
)
_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int32()),
        ("bits", pa.int32()),
        ("payload", pa.binary()),
        ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("n", pa.int32())]))),
    ]
)


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids, each in ``bits`` bits; an id that does not fit is an error."""
    ids = np.asarray(ids, "<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit in {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little")
    return np.packbits(each.reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """Ids [start, start + count) of a payload; only their bytes are touched."""
    if count <= 0:
        return np.zeros(0, np.uint32)
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, start * bits // 8).astype(np.uint32)
    low = start * bits // 8
    part = np.frombuffer(payload, np.uint8, -(-(start + count) * bits // 8) - low, low)
    skip = start * bits - low * 8
    each = np.unpackbits(part, bitorder="little")[skip : skip + count * bits].reshape(count, bits)
    whole = np.zeros((count, 32), np.uint8)
    whole[:, :bits] = each
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").reshape(-1)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every whole text, append ``end_id`` to each, and store the ids in ascending doc_id order.

    A null or empty text has the end id alone. Repeated ids are kept, ordered by their text; a null id
    comes first. An empty table gives an empty store. Only doc_id and text are read. Texts are dealt
    out by ranges of doc_id before they are encoded, so nothing is encoded twice, and an id shared by many
    rows is dealt by a hash of the text as well.
    """

    def run(batches):
        tokens = encoder(tokenizer)
        bits = bits_for(max(tokens.vocabulary_size, end_id + 1))
        end = np.array([end_id], "<u4").tobytes()
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[bytes] = []
        held_docs: list[dict] = []
        n_held = 0

        def closed():
            payload = pack(np.frombuffer(b"".join(held), "<u4"), bits)
            row = {
                "shard": shard, "block": block, "first": first, "n_ids": n_held,
                "bits": bits, "payload": payload, "docs": list(held_docs),
            }
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                ids = tokens.encode(text) + end
                held.append(ids)
                held_docs.append({"doc_id": doc_id, "n": len(ids) // 4})
                n_held += len(ids) // 4
                if n_held >= BLOCK_IDS:
                    yield closed()
                    block, first, n_held = block + 1, first + n_held, 0
                    held.clear()
                    held_docs.clear()
        if held:
            yield closed()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )
    ship(docs.sparkSession)
    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def _starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, base): ids of all shards before; one row for each shard."""
    sizes = spark.read.schema(SCHEMA).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ``ids`` are little-endian unsigned 32-bit integers."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            shards, doc_ids, starts, sizes, ids = [], [], [], [], []
            for row in batch.to_pylist():
                at = 0
                whole = unpack(row["payload"], row["bits"], 0, row["n_ids"])
                for doc in row["docs"]:
                    shards.append(row["shard"])
                    doc_ids.append(doc["doc_id"])
                    starts.append(row["first"] + at)
                    sizes.append(doc["n"])
                    ids.append(whole[at : at + doc["n"]].astype("<u4").tobytes())
                    at += doc["n"]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(shards, pa.int32()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["shard", "doc_id", "start", "n_tokens", "ids"],
            )

        return work

    stored = spark.read.schema(SCHEMA).parquet(path).select("shard", "first", "n_ids", "bits", "payload", "docs")
    found = in_arrow(stored, "shard int, doc_id long, start long, n_tokens long, ids binary", make)
    # One row for each shard: as many as the write had partitions.
    return found.join(F.broadcast(_starts(spark, path)), "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids"
    )


def read_slice(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """Random access: ids [start, start + count) of the whole store.

    Only the blocks that hold them are read; the driver gets what was asked for.
    """
    blocks = spark.read.schema(SCHEMA).parquet(path).join(F.broadcast(_starts(spark, path)), "shard")
    at = F.col("base") + F.col("first")
    hit = blocks.filter((at < start + count) & (at + F.col("n_ids") > start)).select(
        at.alias("at"), "n_ids", "bits", "payload"
    )
    parts = []
    for row in sorted(hit.collect(), key=lambda r: r.at):
        low, high = max(start, row.at), min(start + count, row.at + row.n_ids)
        parts.append(unpack(bytes(row.payload), row.bits, low - row.at, high - low))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
