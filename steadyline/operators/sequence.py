"""Ordered-neighbour operators that do not depend on how large one key is.

A plain ``lag() OVER (PARTITION BY key ORDER BY time)`` sorts every row of a key in one task.
Here each key is cut into time buckets: the window runs per (key, bucket), and only the first
and last row of each bucket meet their neighbours across the bucket border, in a second window
with at most two rows per bucket. Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: Mapping[str, str],
    bucket: Column,
    keep: Callable[[], Column] | None = None,
) -> DataFrame:
    """Add ``previous[new] = column`` taken from the preceding row of the same key.

    ``bucket`` must not decrease along ``order``. ``keep`` is a filter over the new columns; rows
    failing it are dropped before the second exchange, which then moves the kept rows only.
    """
    local = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    rows = df.withColumn("_bucket", bucket)
    rows = rows.select(
        "*",
        (F.row_number().over(local) == 1).alias("_head"),
        F.lead(F.lit(True), 1, False).over(local).alias("_more"),
        *[F.lag(source).over(local).alias(name) for name, source in previous.items()],
    )
    edge = F.col("_head") | ~F.col("_more")
    if keep is not None:
        rows = rows.filter(keep() | edge)

    rows = rows.withColumn("_slot", F.when(~edge, F.col("_bucket")))
    across = Window.partitionBy(*keys, "_slot").orderBy("_bucket", *order)
    rows = rows.withColumns(
        {
            name: F.when(F.col("_head"), F.lag(source).over(across)).otherwise(F.col(name))
            for name, source in previous.items()
        }
    )
    if keep is not None:
        rows = rows.filter(keep())
    return rows.drop("_bucket", "_head", "_more", "_slot")


def _collapse(rows: DataFrame, within: WindowSpec, last: str, count: str) -> DataFrame:
    """Reduce consecutive rows to the ones with ``_starts``, each standing for its whole run.

    ``last`` becomes that of the run's final row, ``count`` the run's sum. ``_opens`` and ``_closes`` tell
    whether the run is the first or last of its partition. Only neighbouring rows are compared, in
    the one sort order the partition already has.
    """
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.select(
        "*",
        F.sum(count).over(upto).alias("_upto"),
        F.lag(last).over(within).alias("_prev_last"),
        F.lead(F.lit(True), 1, False).over(within).alias("_more"),
    ).withColumn("_before", F.col("_upto") - F.col(count))
    # What closes a run is the start after it, or the partition's final row.
    kept = marked.filter(F.col("_starts") | ~F.col("_more")).select(
        "*",
        F.lead("_starts").over(within).alias("_next_starts"),
        F.lead("_before").over(within).alias("_next_before"),
        F.lead("_upto").over(within).alias("_next_upto"),
        F.lead("_prev_last").over(within).alias("_next_prev_last"),
        F.lead(last).over(within).alias("_next_last"),
    )
    ends = F.when(F.col("_next_starts"), F.col("_next_before")).otherwise(F.col("_next_upto"))
    final = F.when(F.col("_next_starts"), F.col("_next_prev_last")).otherwise(F.col("_next_last"))
    alone = F.col("_next_starts").isNull()
    return kept.filter("_starts").select(
        *[c for c in rows.columns if c not in (last, count, "_starts")],
        F.when(alone, F.col(last)).otherwise(final).alias(last),
        F.when(alone, F.col(count)).otherwise(ends - F.col("_before")).alias(count),
        (F.col("_before") == 0).alias("_opens"),
        (~F.coalesce(F.col("_next_starts"), F.lit(False))).alias("_closes"),
    )


def match_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    first_cols: Sequence[str],
    bucket: Column,
    last: str = "last_ts",
    rows_name: str = "polls",
) -> DataFrame:
    """One row per run of consecutive equal ``value``: the greedy ``A+`` pattern.

    Returns the keys, ``first_cols`` of the run's first row, the last ``order[0]`` of the run and its
    length. Runs are found inside each (key, bucket); those touching a bucket border are then
    joined to their neighbours, and the ones inside a bucket are final as they are.
    """
    wanted = list(dict.fromkeys([*keys, *order, value, *first_cols]))
    local = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    first = F.row_number().over(local) == 1
    rows = df.select(
        *wanted,
        F.col(order[0]).alias(last),
        F.lit(1).cast("long").alias(rows_name),
        bucket.alias("_bucket"),
    ).withColumn("_starts", first | ~F.col(value).eqNullSafe(F.lag(value).over(local)))
    pieces = _collapse(rows, local, last, rows_name)

    inside = ~(F.col("_opens") | F.col("_closes"))
    across = Window.partitionBy(*keys, "_slot").orderBy("_bucket", *order)
    continues = (
        F.col("_opens")
        & (F.row_number().over(across) > 1)
        & F.col(value).eqNullSafe(F.lag(value).over(across))
    )
    joined = (
        pieces.withColumn("_slot", F.when(inside, F.col("_bucket")))
        .withColumn("_starts", ~continues)
        .drop("_opens", "_closes")
    )
    return _collapse(joined, across, last, rows_name).select(
        *dict.fromkeys([*keys, *first_cols]), last, rows_name
    )
