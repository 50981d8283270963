"""Catalog tables and file tables: replace, scan, list and export."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from steadyline.operators.arrivals import one_row_per_key


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _location(spark: SparkSession, name: str) -> str | None:
    """Where the data of a table lies."""
    rows = spark.sql(f"DESCRIBE FORMATTED {_quoted(name)}").filter("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def _mart_folder(spark: SparkSession, name: str) -> str:
    """The folder for a mart's versions where none is given: below its namespace."""
    namespace, _, table = name.rpartition(".")
    at = spark.catalog.getDatabase(namespace or spark.catalog.currentDatabase()).locationUri
    return f"{at.rstrip('/')}/{table}_versions"


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def save_mart(
    df: DataFrame, name: str, location: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Create the namespace if missing, replace the whole table, and return it as stored.

    The new version is written beside the old one, below ``location``; then the table is pointed at it. A run that fails
    while writing leaves the table as it was, and a mart may be made from the table it replaces. The version before stays for
    readers that are not done, older ones are deleted. A table whose columns change is dropped and made again after
    the write; catalogs other than the session's replace it themselves. Previews should read the returned
    table: the mart is computed once.
    """
    spark = df.sparkSession
    namespace = name.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    if namespace.count(".") and not namespace.startswith("spark_catalog."):
        df.writeTo(name).using(fmt).createOrReplace()
        return spark.table(name)
    folder = location or _mart_folder(spark, name)
    version = f"{folder}/v-{uuid.uuid4().hex}"
    df.write.format(fmt).save(version)
    before = None
    if spark.catalog.tableExists(name):
        before = _location(spark, name)
        if _columns(spark.table(name)) == _columns(df):
            spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{version}'")
        else:
            spark.sql(f"DROP TABLE {_quoted(name)}")
            before = None
    if before is None:
        spark.catalog.createTable(name, path=version, source=fmt, schema=df.schema)
    spark.catalog.refreshTable(name)
    kept = {version.rpartition("/v-")[2], (before or "").rpartition("/v-")[2]}
    remove_folders(spark, [f"{folder}/v-{v}" for v in folders(spark, folder, "v-") - kept])
    return spark.table(name)


def scan_count(spark: SparkSession, name: str, alias: str = "rows") -> DataFrame:
    return spark.table(name).agg(F.count(F.lit(1)).alias(alias))


def list_namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW NAMESPACES IN {catalog}" if catalog else "SHOW NAMESPACES")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def _hadoop(spark: SparkSession, path: str):
    """The path and the file system it is on."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str, prefix: str) -> set[str]:
    """What follows ``prefix`` in the names of the folders below ``path``; none where it does not exist."""
    at, files = _hadoop(spark, path)
    if not files.exists(at):
        return set()
    names = [s.getPath().getName() for s in files.listStatus(at)]
    return {name[len(prefix):] for name in names if name.startswith(prefix)}


def remove_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        at, files = _hadoop(spark, path)
        files.delete(at, True)


def write_arrivals(arrivals: DataFrame, path: str, tie: tuple[str, ...] = ("seq",)) -> None:
    """Replace the whole table: arrivals by date, one row per key.

    The rebalance hint sizes the files of a date and splits a large one.
    """
    one_row_per_key(arrivals, tie).hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(path)


def replace_dates(rows: DataFrame, path: str, emptied: Iterable[str] = ()) -> None:
    """Replace the dates of ``rows`` and clear those in ``emptied``; other dates stay."""
    (
        rows.hint("rebalance", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )
    remove_folders(rows.sparkSession, [f"{path}/dt={date}" for date in emptied])


def read_arrivals(spark: SparkSession, path: str, schema) -> DataFrame:
    """Stored arrivals; the schema keeps ``dt`` a text column."""
    return spark.read.schema(schema).parquet(path)


def export_tables(
    spark: SparkSession, tables: Mapping[str, str], out: str, single_file: bool = False
) -> DataFrame:
    """Write each named table as CSV with a header and report ``(name, table, rows, error)``.

    ``raw_json`` is left out. A table that fails is reported and skipped. Rows are counted while
    writing. ``single_file`` sends a table through one task: only for small ones.
    """
    report = []
    for name, table in tables.items():
        try:
            if not spark.catalog.tableExists(table):
                raise LookupError(f"no table {table}")
            df = spark.table(table)
            if "raw_json" in df.columns:
                df = df.drop("raw_json")
            seen = Observation()
            counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            if single_file:
                counted = counted.coalesce(1)
            counted.write.mode("overwrite").csv(f"{out}/{name}", header=True, escape='"')
            report.append((name, table, seen.get["rows"], None))
        except Exception as error:  # one table must not stop the others
            report.append((name, table, None, str(error).splitlines()[0]))
    return spark.createDataFrame(report, "name STRING, table STRING, rows BIGINT, error STRING")
