"""Raw event stream → append-only position log and latest-state table.

One micro-batch feeds both tables, so the source is read once. Each write goes to a folder of its own,
named by the run that made it and the batch's number: a replay of a batch replaces itself, and no other
run can reach it. The state table keeps every batch's latest rows; readers take the last one per key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from steadyline.operators.events import RECORD_FIELDS, bronze_log, latest_per_key

_FIELDS = ", ".join(f"{name} STRING" for name in RECORD_FIELDS)
_STORED = f"{_FIELDS}, raw_json STRING, seq BIGINT, ingested_at TIMESTAMP, dt STRING"
LOG_SCHEMA = f"{_STORED}, run_id STRING, batch_id BIGINT"
CURRENT_SCHEMA = LOG_SCHEMA

# Versions of a record: the later sequence number wins, a replayed copy changes nothing.
_VERSION = ("seq", "ingested_at")


def read_events(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """An unbounded source read from its beginning, as ``value`` text (plus ``seq`` where it has one).

    Kafka's ``seq`` is the record offset: versions of a key share a partition if the producer keys its
    records, so their offsets order them. File sources provide ``seq`` through their schema.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.options(**{"startingOffsets": "earliest", **options})
        return reader.load().select(F.col("value").cast("string"), F.col("offset").alias("seq"))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def _write_batch(rows: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    """The rebalance hint deals the rows by date first: a date's rows become one file, or several full ones."""
    (
        rows.hint("rebalance", "dt")
        .withColumn("run_id", F.lit(run_id))
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "run_id", "batch_id")
        .parquet(path)
    )


def write_position_log(batch: DataFrame, batch_id: int, path: str, run_id: str = "batch") -> None:
    """Append a batch of log rows by date. Replaying a batch of the same run replaces its own rows."""
    _write_batch(batch, path, run_id, batch_id)


def read_position_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


@contextmanager
def _held(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows that are looked at several times; they are kept for that time unless the caller keeps them."""
    if rows.storageLevel.useMemory or rows.storageLevel.useDisk:
        yield rows
        return
    rows = rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


# Bits of a hash that number the places of the bitmaps of repeated keys, 8 MB in all.
_PLACE_BITS = 26


def _with_repeated(rows: DataFrame, key: str) -> DataFrame:
    """The rows with ``_repeated``: whether the key may be there several times; true for every key that is.

    Keys are counted by their hash and the repeated ones marked in bitmaps whose size does not follow the
    rows. So they are broadcast, and whole rows stay where they are. A null key is never repeated.
    """
    place = F.shiftrightunsigned(F.xxhash64(key), 64 - _PLACE_BITS)
    several = rows.filter(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    marked = several.filter("_n > 1").select(F.shiftrightunsigned("_hash", 64 - _PLACE_BITS).alias("_place"))
    bitmaps = marked.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits")
    )
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return (
        rows.withColumn("_bucket", F.bitmap_bucket_number(place))
        .join(F.broadcast(bitmaps), "_bucket", "left")
        .withColumn("_repeated", F.col(key).isNotNull() & F.coalesce(bit, F.lit(False)))
        .drop("_bucket", "_bits")
    )


def upsert_current(
    batch: DataFrame, path: str, batch_id: int = 0, run_id: str = "batch", key: str = "event_id"
) -> None:
    """Bring the state table up to the batch: its latest row of each key joins the stored versions.

    Hashes of keys are counted on their own; only rows of keys that the batch may have several times are compared.
    """
    with _held(batch) as rows:
        marked = _with_repeated(rows, key)
        single = marked.filter(~F.col("_repeated")).drop("_repeated")
        latest = latest_per_key(marked.filter("_repeated").drop("_repeated"), key, _VERSION)
        _write_batch(single.unionByName(latest), path, run_id, batch_id)


def latest_stored(stored: DataFrame, key: str = "event_id", version: Sequence[str] = _VERSION) -> DataFrame:
    """Of a Parquet table the last row of each key, whole rows being read once and last.

    Keys, versions and the rows' places tell which rows are superseded; these are left out of the scan of
    whole rows. A table without superseded rows is read as it is.
    """
    place = {"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.row_index")}
    rows = stored.withColumns(place)
    narrow = rows.select(key, *version, *place)
    several = narrow.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)
    versions = narrow.join(several, key, "left_semi").select(key, F.struct(*version, *place).alias("_row"))
    last = versions.groupBy(key).agg(F.max("_row").alias("_last"))
    older = versions.join(last, key).filter("_row <> _last").select("_row._file", "_row._at")
    return rows.join(older.hint("shuffle_hash"), list(place), "left_anti").drop(*place).select(*stored.columns)


def read_current(spark: SparkSession, path: str, key: str = "event_id") -> DataFrame:
    """The state table: one row per key, the last arrival."""
    return latest_stored(spark.read.schema(CURRENT_SCHEMA).parquet(path), key).drop("dt", "run_id", "batch_id")


def _of_dates(rows: DataFrame, dates: DataFrame | None) -> DataFrame:
    """Rows of the dates in ``dates.dt``; a blank date is stored as null and meets both."""
    if dates is None:
        return rows
    asked = dates.select(F.nullif("dt", F.lit("")).alias("_dt")).distinct()
    return rows.join(asked, F.nullif(rows["dt"], F.lit("")).eqNullSafe(F.col("_dt")), "left_semi")


def compact_current(
    spark: SparkSession, source: str, target: str, dates: DataFrame | None = None, key: str = "event_id"
) -> None:
    """Write one row per key of a state table (or of some of its dates) to ``target``, a folder of its own.

    Neither the state table nor the log is touched (the source may be a log: that rebuilds the state), so
    a run that fails loses nothing. A key fixes its date, so dates can be done apart.
    """
    latest = _of_dates(latest_stored(spark.read.schema(CURRENT_SCHEMA).parquet(source), key), dates)
    (
        latest.withColumn("run_id", F.lit("compacted"))
        .withColumn("batch_id", F.lit(0).cast("long"))
        .hint("rebalance", "dt")
        .write.partitionBy("dt", "run_id", "batch_id")
        .parquet(target)
    )


def compact_log(spark: SparkSession, source: str, target: str, dates: DataFrame | None = None) -> None:
    """Write the log's rows of closed dates (all by default) to ``target``, a folder of its own, in full files.

    Batches are put together: run and batch become ``compacted`` and 0. The source is not touched, so a run that fails loses nothing. Swapping the
    folders is the caller's.
    """
    rows = _of_dates(read_position_log(spark, source), dates)
    (
        rows.drop("run_id", "batch_id")
        .hint("rebalance", "dt")
        .withColumn("run_id", F.lit("compacted"))
        .withColumn("batch_id", F.lit(0).cast("long"))
        .write.partitionBy("dt", "run_id", "batch_id")
        .parquet(target)
    )


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the engine keeps with a checkpoint; a fresh checkpoint has a fresh one."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def start_bronze(
    source: DataFrame,
    log_path: str,
    current_path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the fan-out of one source stream into both tables.

    ``trigger`` defaults to a micro-batch every 30 seconds; pass ``{"availableNow": True}`` to drain
    and stop. A source without ``seq`` is ordered by the time of its batch alone.
    """
    if "seq" not in source.columns:
        source = source.withColumn("seq", F.lit(None).cast("long"))
    records = bronze_log(source)
    run: list[str] = []

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(_run_id(batch.sparkSession, checkpoint))
        batch.persist()
        try:
            write_position_log(batch, batch_id, log_path, run[0])
            upsert_current(batch, current_path, batch_id, run[0])
        finally:
            batch.unpersist()

    return (
        records.writeStream.foreachBatch(fan_out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def backfill(raw: DataFrame, log_path: str, current_path: str, run_id: str = "backfill") -> None:
    """Batch form of the fan-out, for bootstrap and replays of stored raw records."""
    if "seq" not in raw.columns:
        raw = raw.withColumn("seq", F.lit(None).cast("long"))
    rows = bronze_log(raw)
    write_position_log(rows, 0, log_path, run_id)
    upsert_current(rows, current_path, 0, run_id)
