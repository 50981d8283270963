"""Event identity and date-partition columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_date_col(recptn_dt: Column | str = "recptn_dt") -> Column:
    """First ten characters of a receive-time text."""
    return F.substring(recptn_dt, 1, 10)


def event_id_col(
    train_no: str = "train_no",
    statn_id: str = "statn_id",
    train_sttus: str = "train_sttus",
    recptn_dt: str = "recptn_dt",
) -> Column:
    """``train-station-status-date``.

    Repeated polls of a train standing at a station share the id; a missing part leaves an
    empty field but keeps its dash, so ``concat_ws`` (which skips nulls) does not fit.
    """
    parts = [F.col(train_no), F.col(statn_id), F.col(train_sttus), text_date_col(recptn_dt)]
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.coalesce(part, F.lit("")), F.lit("-")]
    return F.concat(*pieces[:-1])
