"""Physical plans over stored tables: what is read, shuffled and joined."""

from __future__ import annotations

import glob
import re

import pytest

from steadyline.operators.arrivals import extract_arrivals, section_traversal
from steadyline.operators.events import bronze_log, latest_per_key
from steadyline.operators.freshness import freshness_mart
from steadyline.operators.headways import headway_mart, headways
from steadyline.plans import adapter, incremental, marts, medallion
from steadyline.plans.registry import QUERIES
from steadyline.sources import tables
from steadyline.streaming import bronze

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Arguments: hashpartitioning\((.*?), \d+\)", plan)


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "log")
    bronze.backfill(adapter.raw_records(spark, SF), path, path + "-current")
    return bronze.read_position_log(spark, path)


@pytest.fixture(scope="module")
def stored(spark, log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "arrivals")
    tables.write_arrivals(extract_arrivals(log, extra=("direct_at",)), path)
    return medallion.stored_arrivals(spark, path)


def test_arrivals_scan_and_shuffles(log):
    plan = plan_of(extract_arrivals(medallion.between_dates(log, "2024-01-02", "2024-01-03")))
    assert "raw_json" not in re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "IsNotNull(statn_id)" in re.search(r"PushedFilters: (.*)", plan).group(1)
    assert "dt" in re.search(r"PartitionFilters: (.*)", plan).group(1)
    moved = exchanges(plan)
    assert len(moved) == 2
    assert "_bucket" in moved[0] and "_slot" in moved[1]


def test_headways_split_groups(stored):
    moved = exchanges(plan_of(headways(stored)))
    assert len(moved) == 1 and "_bucket" in moved[0]


def test_mart_has_no_join(stored):
    plan = plan_of(headway_mart(stored))
    assert "Join" not in plan
    read = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "train_no" not in read and "statn_tnm" not in read


def test_a_range_starts_from_one_snapshot(spark, log, tmp_path):
    path = str(tmp_path / "arrivals")
    medallion.build_arrivals(log, path, extra=("direct_at",), dt_to="2024-01-20")
    assert incremental.snapshot_dates(spark, path) == ["2024-01-20"]
    schema = incremental.arrival_schema(("direct_at",))
    plan = plan_of(incremental.state_before(spark, path, schema, ("train_no",), "2024-01-21"))
    pruned = next(p for p in re.findall(r"PartitionFilters: (.*)", plan) if "dt" in p)
    assert "> 2024-01-20" in pruned and "< 2024-01-21" in pruned  # no stored date lies between
    assert "as_of=2024-01-20" in plan


def test_freshness_reduces_before_shuffling(log):
    plan = plan_of(freshness_mart(log))
    assert "partial_count" in plan and "Window" not in plan
    assert "statn_nm" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_latest_row_reduces_before_shuffling(log):
    plan = plan_of(latest_per_key(log))
    assert "partial_max_by" in plan and "Window" not in plan


def test_current_state_sorts_and_aggregates_no_raw_text(spark, tmp_path):
    path = str(tmp_path / "current")
    bronze.upsert_current(bronze_log(adapter.raw_records(spark, SF)), path)
    plan = plan_of(bronze.read_current(spark, path))
    steps = re.split(r"\n\n", plan)
    for step in steps:
        if re.match(r"\(\d+\) (SortAggregate|ObjectHashAggregate|HashAggregate|Sort)\b", step):
            assert "raw_json" not in step
    narrow = [r for r in re.findall(r"ReadSchema: (.*)", plan) if "raw_json" not in r]
    assert narrow and plan.count("raw_json:string") == 1  # whole rows are scanned once


@pytest.mark.parametrize("bits", [1, 26])
def test_upsert_neither_sorts_nor_moves_whole_rows_to_find_repeated_keys(spark, monkeypatch, bits):
    monkeypatch.setattr(bronze, "_PLACE_BITS", bits)
    rows = spark.createDataFrame(
        [(None, 1), (None, 2), *((f"k{i}", 1) for i in range(200)), *((f"k{i}", 2) for i in range(7))], "event_id STRING, seq INT"
    )
    marked = bronze._with_repeated(rows, "event_id")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        plan = plan_of(marked)
        assert "SortMergeJoin" not in plan and all("event_id" not in m for m in exchanges(plan))
        found = {(r.event_id, r.seq): r._repeated for r in marked.collect()}
    finally:
        spark.conf.unset(threshold)
    assert len(found) == 209 and not found[None, 1] and not found[None, 2]
    assert all(found[f"k{i}", v] for i in range(7) for v in (1, 2))
    if bits == 26:
        assert sum(found.values()) == 14


def test_raw_text_is_parsed_once(spark):
    log = bronze_log(adapter.raw_records(spark, SF))
    plan = plan_of(extract_arrivals(log))
    assert plan.count("from_json(StructField(event_id") == 1


@pytest.mark.parametrize(
    "name", sorted(set(QUERIES) - {"append_log", "upsert_current", "bronze_fanout_log",
                                              "bronze_fanout_current", "stream_source"})
)
def test_no_pairwise_joins_and_no_python_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert forbidden not in plan


def test_traversal_moves_rows_once(stored):
    assert len(exchanges(plan_of(section_traversal(stored)))) == 1


def test_layer_counts_parse_no_text_again(spark):
    """The records were parsed once, into the stored log that is counted."""
    plan = plan_of(QUERIES["dedup_ratio"](spark, SF))
    assert "from_json" not in plan
    assert all("raw_json" not in read for read in re.findall(r"ReadSchema: (.*)", plan))


def test_gaps_split_lines_by_day(spark):
    moved = exchanges(plan_of(QUERIES["minute_gaps"](spark, SF)))
    assert not [m for m in moved if re.fullmatch(r"line#\d+", m)]


def test_refreshed_counts_read_the_dates_concerned(spark, stored, tmp_path):
    path = str(tmp_path / "counts")
    marts.build_headway_counts(stored, path, adapter.WIDE_CUTOFF_SEC)
    before = {d: glob.glob(f"{path}/dt={d}/*.parquet") for d in ("2024-01-04", "2024-01-05", "2024-01-06", "2024-01-07")}
    marts.build_headway_counts(stored, path, adapter.WIDE_CUTOFF_SEC, dates=["2024-01-05"])
    after = {d: glob.glob(f"{path}/dt={d}/*.parquet") for d in before}
    assert [d for d in before if before[d] != after[d]] == ["2024-01-05", "2024-01-06"]
    plan = plan_of(marts.stored_headway_counts(spark, path))
    assert "Exchange" not in plan
