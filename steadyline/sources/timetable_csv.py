"""The timetable as CSV with a header and a UTF-8 byte-order mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steadyline.sources.payloads import TIMETABLE_COLUMNS

_BOM = "﻿"


def write_timetable(timetable: DataFrame, path: str) -> None:
    """Each part file starts with the mark, as part of its header line."""
    first, *rest = TIMETABLE_COLUMNS
    (
        timetable.select(*TIMETABLE_COLUMNS)
        .toDF(_BOM + first, *rest)
        .write.mode("overwrite")
        .csv(path, header=True, emptyValue="", escape='"')
    )


def read_timetable(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, found by their names in the header; missing values as ``''``.

    Columns may come in any order and others may stand between them; a missing one is an error.
    """
    stored = spark.read.csv(path, header=True, escape='"')
    stored = stored.toDF(*[name.removeprefix(_BOM) for name in stored.columns])
    return stored.select(*[F.col(name).cast("string").alias(name) for name in TIMETABLE_COLUMNS]).fillna("")
