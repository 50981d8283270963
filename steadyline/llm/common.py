"""Helpers shared by the document operators: table access, hold-out rules, Arrow tasks, bounded label samples."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = str(Path(__file__).resolve().parents[2])
_HASH_RANGE = 1 << 31


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def ship(spark: SparkSession) -> None:
    """Let Python workers of a single machine find this package whatever the working folder is.

    A cluster gets it as any other dependency (``--py-files`` or an installed package).
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def in_arrow(
    df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]
) -> DataFrame:
    """Map Arrow batches. ``make`` runs once in each task and gives the function for its batches."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            yield work(batch)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, max_chars: int
) -> list[tuple[str, object]]:
    """At most ``rows`` labelled texts of at most ``max_chars`` code points, the same on every run.

    The only place where an operator looks at part of the rows: a model is fitted on the driver on a
    sample of fixed size. Rows are chosen by a hash of the id, thinned before they are ordered, so
    that no task gets more than about ``rows`` of them. Null labels and texts are left out; an id with
    several labels takes the largest, with several texts the smallest.
    """
    known = labels.filter(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    total = known.count()
    if total == 0:
        return []
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_HASH_RANGE))
    cut = min(_HASH_RANGE, int(_HASH_RANGE * min(1.0, 1.3 * rows / total)) + 1)
    chosen = known.filter(place < cut).orderBy(place, "doc_id").limit(rows)
    found = (
        docs.select("doc_id", "text")
        .filter(F.char_length("text") <= max_chars)
        .join(F.broadcast(chosen), "doc_id")  # at most `rows` ids
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("label").alias("label"))
        .collect()
    )
    return [(r.text, r.label) for r in sorted(found, key=lambda r: r.doc_id)]
