"""The driver's ``events`` table seen as train positions, payloads and a timetable.

Every view derives from the whole table, row by row, so the work of a query grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steadyline.functions.identity import event_id_col
from steadyline.functions.labels import inout_tag_col, week_tag_col
from steadyline.sources.payloads import EMPTY_CODE, OK_CODE, TIMETABLE_FIELDS, to_keyed_json

# The three lines the serving queries know.
LINES = ("1호선", "2호선", "9호선")
LINE_CODES = ("1001", "1002", "1009")
# The test rows are sparse (minutes apart), so the exact checks also use a half-day cutoff.
WIDE_CUTOFF_SEC = 43_200
LATE_SEC = 180


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _one_of(index: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"element_at(array({listed}), CAST({index} + 1 AS INT))"


_K = "CAST(get_json_object(props, '$.k') AS BIGINT) % 10"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position per event, with a share of blank, missing and unreadable values."""
    base = events(spark, sf_dir).selectExpr(
        "event_id AS seq",
        f"{_one_of('user_id % 3', LINES)} AS line",
        f"{_one_of('user_id % 3', LINE_CODES)} AS subway_id",
        "CAST(user_id AS STRING) AS train_no",
        f"CASE WHEN event_id % 89 <> 0 THEN concat('S', {_K}) END AS statn_id",
        f"concat('station-', {_K}) AS statn_nm",
        "concat('station-', user_id % 10) AS statn_tnm",
        "CASE WHEN event_id % 97 = 0 THEN '2' ELSE CAST(event_id % 2 AS STRING) END AS updn_line",
        "CASE event_type WHEN 'view' THEN '0' WHEN 'click' THEN '1' WHEN 'purchase' THEN '2' "
        "ELSE '3' END AS train_sttus",
        "CASE WHEN value > 100 THEN '1' ELSE '0' END AS direct_at",
        "'0' AS lstcar_at",
        "CASE WHEN event_id % 100 = 0 THEN '' WHEN event_id % 103 = 0 THEN 'bad-time' "
        "WHEN event_id % 107 <> 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS recptn_dt",
        "ts + make_dt_interval(0, 0, 0, CAST(event_id % 7 AS DECIMAL(8, 6))) AS ingested_at",
    )
    return base.withColumn("event_id", event_id_col())


def api_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions under their API field names."""
    return positions(spark, sf_dir).select(
        "seq",
        "line",
        F.col("subway_id").alias("subwayId"),
        F.col("train_no").alias("trainNo"),
        F.col("statn_id").alias("statnId"),
        F.col("statn_nm").alias("statnNm"),
        F.col("statn_tnm").alias("statnTnm"),
        F.col("updn_line").alias("updnLine"),
        F.col("train_sttus").alias("trainSttus"),
        F.col("direct_at").alias("directAt"),
        F.col("lstcar_at").alias("lstcarAt"),
        F.col("recptn_dt").alias("recptnDt"),
        "ingested_at",
    )


def position_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API responses of one line with at most 50 positions; some empty, some errors."""
    rows = api_rows(spark, sf_dir)
    poll = F.floor(F.col("seq") / 50)
    fields = [c for c in rows.columns if c not in ("seq", "line", "ingested_at")]
    kind = F.col("poll") % 7
    code = F.when(kind == 1, EMPTY_CODE).when(kind == 2, "ERROR-300").otherwise(OK_CODE)
    return (
        rows.groupBy("line", poll.alias("poll"))
        .agg(F.collect_list(F.struct(*fields)).alias("realtimePositionList"))
        .select(
            "line",
            F.to_json(
                F.struct(
                    F.when(
                        kind != 0,
                        F.struct(code.alias("code"), F.lit("message").alias("message")),
                    ).alias("errorMessage"),
                    F.when(~kind.isin(1, 2), F.col("realtimePositionList")).alias(
                        "realtimePositionList"
                    ),
                )
            ).alias("payload"),
        )
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq, value)`` as a stream would deliver it: event JSON, plus broken and id-less records."""
    rows = positions(spark, sf_dir).select(
        "seq",
        "event_id",
        "line",
        "subway_id",
        "train_no",
        "statn_id",
        "statn_nm",
        "statn_tnm",
        "updn_line",
        "train_sttus",
        "direct_at",
        "lstcar_at",
        "recptn_dt",
        F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
    )
    seq = F.col("seq")
    event = F.struct(*[c for c in rows.columns if c != "seq"])
    return rows.select(
        "seq",
        F.when(seq % 211 == 0, '{"event_id":"broken","line":')
        .when(seq % 223 == 0, '{"line":"no id"}')
        .otherwise(F.to_json(event, {"ignoreNullFields": "false"}))
        .alias("value"),
    )


def timetable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timetable API fields from the sign-up events: one scheduled arrival each."""
    k = F.expr(_K)
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "signup")
        .select(
            F.col("event_id").alias("seq"),
            F.lit("09호선").alias("line"),
            F.concat(F.lit("C"), k.cast("string")).alias("STATION_CD"),
            F.concat(F.lit("9"), k.cast("string")).alias("FR_CODE"),
            F.concat(F.lit("station-"), k.cast("string")).alias("STATION_NM"),
            F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("TRAIN_NO"),
            # Half of the times after midnight are written as hours from 24 on.
            F.when(
                (F.hour("ts") < 2) & _every(2),
                F.concat((F.hour("ts") + 24).cast("string"), F.date_format("ts", ":mm:ss")),
            )
            .otherwise(F.date_format("ts", "HH:mm:ss"))
            .alias("ARRIVETIME"),
            F.when(~_every(5), F.date_format("ts", "HH:mm:ss")).alias("LEFTTIME"),
            F.lit("0901").alias("ORIGINSTATION"),
            F.lit("0938").alias("DESTSTATION"),
            F.lit("first").alias("SUBWAYSNAME"),
            F.lit("last").alias("SUBWAYENAME"),
            week_tag_col(F.expr("ts - make_dt_interval(0, 3, 0, 0)")).alias("WEEK_TAG"),
            inout_tag_col((F.col("event_id") % 2).cast("string")).alias("INOUT_TAG"),
            F.when(F.col("value") > 100, "E").otherwise("G").alias("EXPRESS_YN"),
            F.lit("").alias("FL_FLAG"),
            F.when(~_every(3), "0").alias("BRANCH_LINE"),
        )
    )


def timetable_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timetable responses of at most 200 event numbers; every fifth has no service object."""
    rows = timetable_rows(spark, sf_dir)
    fields = list(TIMETABLE_FIELDS.values())
    page = F.floor(F.col("seq") / 200)
    service = F.when(
        F.col("page") % 5 != 0, F.struct(F.col("row"))
    ).alias("SearchSTNTimeTableByIDService")
    return (
        rows.groupBy("line", page.alias("page"))
        .agg(F.collect_list(F.struct(*fields)).alias("row"))
        .select("line", F.to_json(F.struct(service)).alias("payload"))
    )


def timetable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timetable_rows(spark, sf_dir)
    return rows.select(
        "line",
        *[
            F.coalesce(F.col(api), F.lit("")).alias(name)
            for name, api in TIMETABLE_FIELDS.items()
        ],
    )


def station_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-list responses of at most 100 suppliers; codes repeat between responses."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    key = F.col("s_suppkey")
    return (
        supplier.select(
            F.floor(key / 100).alias("seq"),
            F.struct(
                key,
                F.concat(F.lit("C"), (key % 12).cast("string")).alias("STATION_CD"),
                F.when(key % 2 == 0, (key % 12).cast("string")).alias("FR_CODE"),
                F.col("s_name").alias("STATION_NM"),
                F.when(key % 3 == 0, "08호선").otherwise("09호선").alias("LINE_NUM"),
            ).alias("station"),
        )
        .groupBy("seq")
        .agg(F.array_sort(F.collect_list("station")).alias("row"))
        .select(
            "seq",
            F.to_json(F.struct(F.struct("row").alias("SearchSTNBySubwayLineInfo"))).alias("payload"),
        )
    )


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(spark, sf_dir)
    return to_keyed_json(rows.drop("seq", "ingested_at"))
