"""Arrivals kept by date: ranges that leave the table as a run over the whole log would.

A range starts from where each train was before it and may change what comes after it: a late row can make the
first arrival behind the range a repeat, or turn a repeated station into an arrival. :func:`build_arrivals`
reads the one from a snapshot and repairs the other.

Layout below the table's folder: ``dt=…`` holds the arrivals of a date; ``_state/as_of=…`` (left out of scans by its
name) each train's last arrival up to and including a date. Snapshots only save work: where one is missing, the
stored arrivals since the one before are read instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steadyline.operators.arrivals import (
    ARRIVAL_FIELDS,
    ARRIVAL_KEY,
    extract_arrivals,
    one_row_per_key,
    timed_positions,
)
from steadyline.session import shared_folder
from steadyline.sources.tables import (
    folders,
    read_arrivals,
    remove_folders,
    replace_dates,
    write_arrivals,
)

STORED_ARRIVALS = (
    "line STRING, train_no STRING, statn_id STRING, statn_nm STRING, statn_tnm STRING, "
    "updn_line STRING, direct_at STRING, seq BIGINT, arrival_ts TIMESTAMP_NTZ, dt STRING"
)
_KINDS = dict(part.strip().split(" ") for part in STORED_ARRIVALS.split(","))
_ORDER = ("arrival_ts", "seq")


def arrival_schema(extra: Sequence[str] = ()) -> str:
    """Columns of a stored arrival; further ones are text unless ``STORED_ARRIVALS`` knows them."""
    names = dict.fromkeys([*ARRIVAL_FIELDS, *extra, "seq", "arrival_ts", "dt"])
    return ", ".join(f"{name} {_KINDS.get(name, 'STRING')}" for name in names)


def between_dates(df: DataFrame, dt_from: str | None = None, dt_to: str | None = None) -> DataFrame:
    """Restrict a ``dt``-partitioned table to a range of dates, pruning its partitions."""
    if dt_from is not None:
        df = df.filter(F.col("dt") >= dt_from)
    if dt_to is not None:
        df = df.filter(F.col("dt") <= dt_to)
    return df


def _end_of(rows: DataFrame, keys: Sequence[str], pick, order: Sequence[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def last_known(arrivals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each train's last arrival."""
    return _end_of(arrivals, keys, F.max_by, _ORDER).select(*arrivals.columns)


# ---- snapshots ---------------------------------------------------------------------------------


def snapshot_dates(spark: SparkSession, path: str) -> list[str]:
    return sorted(folders(spark, f"{path}/_state", "as_of="))


def _save_state(state: DataFrame, path: str, as_of: str) -> None:
    state.write.mode("overwrite").parquet(f"{path}/_state/as_of={as_of}")


def state_before(spark: SparkSession, path: str, schema: str, keys: Sequence[str], dt_from: str) -> DataFrame:
    """Each train's last arrival before a date: the last snapshot before it, and stored arrivals since."""
    known = [d for d in snapshot_dates(spark, path) if d < dt_from]
    stored = read_arrivals(spark, path, schema).filter(F.col("dt") < dt_from)
    if known:
        snapshot = read_arrivals(spark, f"{path}/_state/as_of={known[-1]}", schema)
        stored = stored.filter(F.col("dt") > known[-1]).unionByName(snapshot)
    return last_known(stored, keys)


# ---- runs --------------------------------------------------------------------------------------


def build_arrivals(
    log: DataFrame,
    path: str,
    keys: Sequence[str] = ("train_no",),
    extra: Sequence[str] = (),
    dt_from: str | None = None,
    dt_to: str | None = None,
) -> list[str]:
    """Recover arrivals from the log and store them by date, as one run over the whole log would.

    By default the whole log is used and the table replaced. With a range only that part of the log is read;
    where each train was before is its last arrival then, however long it was silent, and the first
    arrival of a train after ``dt_to`` is dropped or restored where the range changed where the train was. Dates
    outside the range must be stored by runs with the same ``keys`` and ``extra``.

    The range is extracted once, into the shared folder; the table is touched by one write of whole dates after
    everything is known. A failing run leaves the table as it was. Returned are the dates that were written or cleared,
    which marts kept by date need to look at again.
    """
    spark, schema = log.sparkSession, arrival_schema(extra)
    if dt_from is None and dt_to is None:
        write_arrivals(extract_arrivals(log, keys, extra=extra), path)
        dates = folders(spark, path, "dt=")
        if dates and "dt" not in keys:
            _save_state(last_known(read_arrivals(spark, path, schema), keys), path, max(dates))
        return sorted(dates)
    scratch = shared_folder(spark, "arrivals-range")
    try:
        return _build_range(log, path, schema, keys, extra, dt_from, dt_to, scratch)
    finally:
        remove_folders(spark, [scratch])


def _build_range(log, path, schema, keys, extra, dt_from, dt_to, scratch) -> list[str]:
    spark = log.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    across = "dt" not in keys  # trains go on from one date to the next
    present = folders(spark, path, "dt=")
    built = [*present, *snapshot_dates(spark, path)]
    seed = None
    if dt_from is not None and across and built:
        seed = kept(state_before(spark, path, schema, keys, dt_from), "seed")
    found = extract_arrivals(between_dates(log, dt_from, dt_to), keys, extra=extra, seed=seed)
    rows = kept(one_row_per_key(between_dates(found, dt_from, dt_to)), "found")
    dates = {r.dt for r in rows.select("dt").distinct().collect()}  # at most the dates of the range
    state = None
    if across:
        state = kept(last_known(rows if seed is None else seed.unionByName(rows), keys), "state")
    replaced = {d for d in present if (dt_from is None or d >= dt_from) and (dt_to is None or d <= dt_to)}
    horizon = max(built, default="")
    repaired = None
    if across and dt_to is not None and horizon > dt_to:
        stored = between_dates(read_arrivals(spark, path, schema), None, horizon)
        inside = between_dates(stored, dt_from, dt_to)
        before = last_known(inside if seed is None else seed.unionByName(inside), keys)
        changed = kept(changed_trains(before, state, keys), "changed")
        trains = changed.count()
        if trains:
            following = kept(first_after(stored, changed, dt_to, keys), "following")
            count, last = following.agg(F.count(F.lit(1)), F.max("dt")).first()
            # Nothing behind a train's first stored arrival can change.
            polls = timed_positions(between_dates(log, None, last if count == trains else horizon))
            polls = polls.withColumnRenamed("recptn_ts", "arrival_ts").select(*stored.columns)
            edits = kept(forward_edits(first_after(polls, changed, dt_to, keys), following, changed, keys), "edits")
            edited = {r.dt for r in edits.select("dt").distinct().collect()}  # dates of trains' next arrivals
            if edited:
                repaired = kept(_applied(stored.filter(F.col("dt").isin(*edited)), edits), "repaired")
                replaced |= edited
                dates |= {r.dt for r in repaired.select("dt").distinct().collect()}
    # From here on the table changes. Snapshots of the range and later ones no longer hold.
    remove_folders(spark, [f"{path}/_state/as_of={d}" for d in snapshot_dates(spark, path) if dt_from is None or d >= dt_from])
    replace_dates(rows if repaired is None else rows.unionByName(repaired), path, replaced - dates)
    if state is not None:
        end = dt_to or max(dates, default=None)
        if end is not None:
            _save_state(state, path, end)
            if horizon > end:
                _save_state(state_before(spark, path, schema, keys, horizon + "~"), path, horizon)
    return sorted(replaced | dates)


# ---- repair behind a range ---------------------------------------------------------------------


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{left}.{name} <=> {right}.{name}" for name in names))


def changed_trains(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, station): trains whose station at the end of a range differs from what it was; null is unknown."""
    none = F.lit(None).cast("string")
    both = before.select(*keys, F.col("statn_id").alias("_old"), none.alias("station")).unionByName(
        after.select(*keys, none.alias("_old"), F.col("statn_id").alias("station"))
    )
    ends = both.groupBy(*keys).agg(F.max("_old").alias("_old"), F.max("station").alias("station"))
    return ends.filter(~F.col("_old").eqNullSafe(F.col("station"))).drop("_old")


def first_after(rows: DataFrame, trains: DataFrame, dt_to: str, keys: Sequence[str]) -> DataFrame:
    """The first row behind ``dt_to`` of each of ``trains`` that has one."""
    asked = rows.filter(F.col("dt") > dt_to).alias("r").join(trains.alias("t"), _same("r", "t", keys), "left_semi")
    return _end_of(asked, keys, F.min_by, _ORDER).select(*rows.columns)


def forward_edits(polls: DataFrame, following: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(arrival columns, _add): what changes behind a range, given trains' next positions and next stored arrivals.

    A train's next position is an arrival exactly if its station differs from the train's new one. Where it is stored and no
    longer an arrival it is dropped, where it is one and not stored it is added. Nothing further on changes.
    """
    known = F.coalesce(_same("p", "s", ["statn_id", *_ORDER]), F.lit(False))
    moved = ~F.col("p.statn_id").eqNullSafe(F.col("c.station"))
    met = changed.alias("c").join(polls.alias("p"), _same("c", "p", keys)).join(following.alias("s"), _same("c", "s", keys), "left")
    return met.filter(moved != known).select("p.*", moved.alias("_add"))


def _applied(stored: DataFrame, edits: DataFrame) -> DataFrame:
    """``stored`` without what ``edits`` drop and with what they add."""
    gone = edits.filter("NOT _add").alias("e")
    left = stored.alias("s").join(gone, _same("s", "e", [*ARRIVAL_KEY, "seq"]), "left_anti")
    return one_row_per_key(left.unionByName(edits.filter("_add").drop("_add")))
