"""Grouping of linked nodes: components by stars, and buckets of any size compared block by block.

A bucket holds nodes that may be linked. Small blocks of it are compared whole; what is emitted is a spanning
forest of the links found, never all pairs. After a first round two nodes of a bucket need to meet only where
their components differ, see :func:`crossing`.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steadyline.session import shared_folder


def stored(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """Written to the shared folder and read again, which ends its lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, over undirected ``edges`` (a, b).

    Alternating large-star and small-star steps: a node's neighbours are attached to the smallest of
    them. Only minima per node are gathered, so a node may have any number of neighbours. Each step is
    written to the shared folder, which ends its lineage. Without edges there is no row.
    """
    path = shared_folder(spark, "edges")
    edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct().write.parquet(path)
    seen = None
    while True:
        now = spark.read.parquet(path)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least.select("a", F.least("a", "m").alias("m")), "a")
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        path = shared_folder(spark, "edges")
        large.write.parquet(path)
        now = spark.read.parquet(path)  # b < a throughout
        least = now.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            now.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select("e.a", F.col("e.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        path = shared_folder(spark, "edges")
        small.write.parquet(path)
    return spark.read.parquet(path).select(F.col("a").alias("node"), F.col("b").alias("root"))


def dealt(members: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Members (``keys``, node, n) of buckets of ``n`` with a number of ``blocks`` of about ``size`` and a ``block``."""
    blocks = F.ceil(F.col("n") / size).cast("int")
    return members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node", *keys), F.col("blocks")).cast("int"))


def crossing(members: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(``keys``, i, j, side, node): groups in which all nodes of a bucket with different roots meet.

    ``members`` holds (``keys``, node, root). The nodes of a bucket's most frequent root are compared with the others
    alone, so a bucket that is almost one component costs one copy of its nodes for each block of
    others. In a group with i = j all pairs count (``side`` 0), else those between side 0 and side 1.
    """
    counts = members.groupBy(*keys, "root").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy(*keys).agg(
        F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("n"), F.max("c").alias("m")
    )
    main = main.filter("n > m").select(
        *keys, "main", F.ceil((F.col("n") - F.col("m")) / size).cast("int").alias("others"), F.ceil(F.col("m") / size).cast("int").alias("mains")
    )
    place = F.xxhash64("node", *keys)
    own = F.when(F.col("root") == F.col("main"), F.col("others") + F.pmod(place, F.col("mains")).cast("int")).otherwise(
        F.pmod(place, F.col("others")).cast("int")
    )
    last = F.when(F.col("own") >= F.col("others"), F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    met = members.join(main, keys).withColumn("own", own).select(*keys, "node", "own", F.explode(F.sequence(F.lit(0), last)).alias("with"))
    return met.select(
        *keys,
        F.least("own", "with").alias("i"),
        F.greatest("own", "with").alias("j"),
        (F.col("own") > F.col("with")).cast("int").alias("side"),
        "node",
    )


def forest(linked: np.ndarray, other: bool = False) -> list[tuple[int, int]]:
    """Links (row, column) of a boolean matrix that join what all its links join.

    Rows and columns are the same nodes (a symmetric matrix), or two sets of them if ``other``.
    """
    rows, columns = linked.shape
    left_rows = np.ones(rows, bool)
    left_columns = np.ones(columns, bool) if other else left_rows
    out: list[tuple[int, int]] = []
    for start in np.flatnonzero(linked.any(1)).tolist():
        if not left_rows[start]:
            continue
        left_rows[start] = False
        reached = [(start, False)]
        while reached:
            at, is_column = reached.pop()
            if is_column:
                new = np.flatnonzero(linked[:, at] & left_rows)
                left_rows[new] = False
                out += [(k, at) for k in new.tolist()]
                reached += [(k, False) for k in new.tolist()]
            else:
                new = np.flatnonzero(linked[at] & left_columns)
                left_columns[new] = False
                out += [(at, k) for k in new.tolist()]
                reached += [(k, other) for k in new.tolist()]
    return out
