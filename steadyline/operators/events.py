"""Position rows → events → bronze records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steadyline.functions.clock import wall_clock
from steadyline.functions.identity import event_id_col, text_date_col

# API field → event field.
API_FIELDS = {
    "subwayId": "subway_id",
    "trainNo": "train_no",
    "statnId": "statn_id",
    "statnNm": "statn_nm",
    "statnTnm": "statn_tnm",
    "updnLine": "updn_line",
    "trainSttus": "train_sttus",
    "directAt": "direct_at",
    "lstcarAt": "lstcar_at",
    "recptnDt": "recptn_dt",
}
# Fields of a stored record, in table order.
RECORD_FIELDS = ("event_id", "line", *API_FIELDS.values())


def normalize_events(rows: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """API rows (``line`` + camelCase fields) → 13-field events.

    Train number and receive time default to empty text, the other fields stay null when absent.
    """
    if ingested_at is None:
        ingested_at = F.date_format(
            F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
            "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'",
        )
    empty = F.lit("")
    named = rows.select(
        "line",
        *[F.col(api).alias(name) for api, name in API_FIELDS.items()],
        ingested_at.alias("ingested_at"),
    ).withColumns({name: F.coalesce(F.col(name), empty) for name in ("train_no", "recptn_dt")})
    return named.select(event_id_col().alias("event_id"), "line", *API_FIELDS.values(), "ingested_at")


def _nested_fields(raw: Column) -> Column:
    """Names of the record fields that hold an object or array.

    Null unless some field's text opens like one, so the normal record costs a few comparisons.
    """
    opens = F.lit(False)
    for name in RECORD_FIELDS:
        text = F.col(name)
        opens = opens | F.coalesce(text.startswith("{") | text.startswith("["), F.lit(False))
    values = F.from_json(raw, "MAP<STRING, VARIANT>")
    held = F.map_filter(values, lambda _, v: F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"))
    return F.when(opens, F.map_keys(held))


def parse_raw(df: DataFrame, value: str = "value") -> DataFrame:
    """Raw text → the twelve record fields and ``raw_json``; other input columns are kept.

    Fields are scalars: an object or array gives null. Malformed text and records without an
    ``event_id`` are dropped. ``inline`` keeps the parse out of reach of predicate pushdown, which
    would repeat it for every later filter on a field.
    """
    schema = ", ".join(f"{name} STRING" for name in (*RECORD_FIELDS, "_corrupt"))
    others = [c for c in df.columns if c != value]
    record = F.from_json(value, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = (
        df.select(*others, F.col(value).alias("raw_json"), F.inline(F.array(record)))
        .filter("_corrupt IS NULL AND event_id IS NOT NULL")
        .withColumn("_nested", _nested_fields(F.col("raw_json")))
    )
    whole = F.col("_nested").isNull()
    fields = [
        F.when(whole | ~F.array_contains("_nested", name), F.col(name)).alias(name)
        for name in RECORD_FIELDS
    ]
    return parsed.select(*fields, "raw_json", *others).filter("event_id IS NOT NULL")


def bronze_log(
    raw: DataFrame, ingested_at: Column | None = None, value: str = "value"
) -> DataFrame:
    """Every valid record, stamped with processing time and its date partition."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return parse_raw(raw, value).withColumns(
        {"ingested_at": stamp, "dt": text_date_col("recptn_dt")}
    )


def latest_per_key(df: DataFrame, key: str = "event_id", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The last row of each key. ``max_by`` reduces before the shuffle, so a hot key is harmless."""
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(key, "_row.*")
        .select(*df.columns)
    )


def bronze_current(
    raw: DataFrame,
    ingested_at: Column | None = None,
    order: tuple[str, ...] = ("seq",),
    value: str = "value",
) -> DataFrame:
    """One record per ``event_id``: the one that arrived last."""
    return latest_per_key(bronze_log(raw, ingested_at, value), order=order).drop("dt")


def valid_positions(log: DataFrame) -> DataFrame:
    """Log rows with a station and a receive time, plus ``recptn_ts`` (null where unparseable)."""
    return log.filter(
        F.col("statn_id").isNotNull()
        & F.col("recptn_dt").isNotNull()
        & (F.col("recptn_dt") != "")
    ).withColumn("recptn_ts", wall_clock("recptn_dt"))


def count_by(df: DataFrame, key: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def layer_counts(log: DataFrame, arrivals: DataFrame, key: str = "event_id") -> DataFrame:
    """Row counts of the three layers in one row: log ≥ current, log ≥ arrivals.

    The state table has one row per key, so the log's distinct keys are its size.
    """
    counted = log.agg(
        F.count(F.lit(1)).alias("log_rows"), F.count_distinct(key).alias("current_rows")
    ).withColumn("arrival_rows", F.lit(None).cast("long"))
    found = arrivals.agg(F.count(F.lit(1)).alias("arrival_rows"))
    names = ["log_rows", "current_rows", "arrival_rows"]
    both = counted.unionByName(found, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in names])
