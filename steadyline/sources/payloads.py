"""Landed API payloads (one JSON document per row) → typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steadyline.operators.events import API_FIELDS

# Response codes of the position API.
OK_CODE = "INFO-000"
EMPTY_CODE = "INFO-200"

# Timetable column → API field, in column order after ``line``.
TIMETABLE_FIELDS = {
    "station_cd": "STATION_CD",
    "fr_code": "FR_CODE",
    "station_nm": "STATION_NM",
    "train_no": "TRAIN_NO",
    "arrive_time": "ARRIVETIME",
    "left_time": "LEFTTIME",
    "origin_station": "ORIGINSTATION",
    "dest_station": "DESTSTATION",
    "origin_nm": "SUBWAYSNAME",
    "dest_nm": "SUBWAYENAME",
    "week_tag": "WEEK_TAG",
    "inout_tag": "INOUT_TAG",
    "express_yn": "EXPRESS_YN",
    "fl_flag": "FL_FLAG",
    "branch_line": "BRANCH_LINE",
}
TIMETABLE_COLUMNS = ("line", *TIMETABLE_FIELDS)


def _strings(names) -> str:
    return ", ".join(f"{name}: STRING" for name in names)


_POSITIONS = (
    "errorMessage STRUCT<code: STRING, message: STRING>, "
    f"realtimePositionList ARRAY<STRUCT<{_strings(API_FIELDS)}>>, _corrupt STRING"
)
_TIMETABLE = (
    "SearchSTNTimeTableByIDService STRUCT<"
    f"row: ARRAY<STRUCT<{_strings(TIMETABLE_FIELDS.values())}>>>"
)
_STATIONS = (
    "SearchSTNBySubwayLineInfo STRUCT<"
    "row: ARRAY<STRUCT<STATION_CD: STRING, FR_CODE: STRING, STATION_NM: STRING, LINE_NUM: STRING>>>"
)


def parse_position_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(line, payload)`` → position rows, and the payloads that report an error.

    No code or the OK code means the list counts, the empty code means no rows. Any other code,
    or text that is not JSON, sets that payload apart without touching the others.
    """
    parsed = payloads.select(
        "line", F.from_json("payload", _POSITIONS, {"columnNameOfCorruptRecord": "_corrupt"}).alias("p")
    )
    code = F.col("p.errorMessage.code")
    unreadable = F.col("p").isNull() | F.col("p._corrupt").isNotNull()
    usable = ~unreadable & (code.isNull() | (code == OK_CODE))
    rows = (
        parsed.filter(usable)
        .select("line", F.explode("p.realtimePositionList").alias("r"))
        .select("line", *[F.col(f"r.{name}").alias(name) for name in API_FIELDS])
    )
    errors = parsed.filter(
        unreadable | (code.isNotNull() & ~code.isin(OK_CODE, EMPTY_CODE))
    ).select(
        "line",
        code.alias("code"),
        F.when(unreadable, "unreadable payload")
        .otherwise(F.col("p.errorMessage.message"))
        .alias("message"),
    )
    return rows, errors


def parse_timetable_payloads(payloads: DataFrame) -> DataFrame:
    """``(line, payload)`` → timetable rows; no service object gives no rows, no field gives ``''``."""
    parsed = payloads.select("line", F.from_json("payload", _TIMETABLE).alias("p"))
    rows = parsed.select(
        "line", F.explode("p.SearchSTNTimeTableByIDService.row").alias("r")
    )
    return rows.select(
        "line",
        *[
            F.coalesce(F.col(f"r.{api}"), F.lit("")).alias(name)
            for name, api in TIMETABLE_FIELDS.items()
        ],
    )


def line_stations(payloads: DataFrame, line: str, order: str = "seq") -> DataFrame:
    """``(seq, payload)`` → stations of one line, one row per code (the last listed), by code."""
    parsed = payloads.select(order, F.from_json("payload", _STATIONS).alias("p"))
    listed = parsed.select(
        order, F.posexplode("p.SearchSTNBySubwayLineInfo.row").alias("_pos", "r")
    ).filter(F.col("r.LINE_NUM") == line)
    station = F.struct(
        F.coalesce("r.FR_CODE", F.lit("")).alias("fr_code"),
        F.col("r.STATION_NM").alias("station_nm"),
    )
    return (
        listed.groupBy(F.col("r.STATION_CD").alias("station_cd"))
        .agg(F.max_by(station, F.struct(order, "_pos")).alias("_last"))
        .select("station_cd", "_last.*")
        .orderBy("station_cd")
    )


def to_keyed_json(df: DataFrame, key_field: str | None = "train_no") -> DataFrame:
    """Rows → ``(key, value)`` with compact JSON values that keep their nulls.

    An empty ``key_field`` gives no key. The result suits ``write.format("kafka")``.
    """
    key = F.col(key_field).cast("string") if key_field else F.lit(None).cast("string")
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(key.alias("key"), value.alias("value"))
