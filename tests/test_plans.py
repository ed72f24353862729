"""Plan shapes the operators promise (checked on the physical plan text)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        entry.queries()[name](spark, SF).explain()
    return re.sub(r"#\d+L?", "", buf.getvalue())


def test_dedupe_is_an_aggregate_not_a_window(spark):
    p = plan(spark, "dedupe_latest")
    assert "Window" not in p and "partial_max" in p


def test_top_n_limits_groups_before_the_shuffle(spark):
    p = plan(spark, "top_n_per_group")
    lines = p.splitlines()
    first_exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("WindowGroupLimit" in line for line in lines[first_exchange + 1:])


def test_key_range_split_reaches_the_target_scan(spark):
    from tidewater.operators import incremental as I
    ev = spark.read.parquet(f"{SF}/events.parquet")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        I.delete_insert(ev, ev.filter("event_id > 100"), "event_id", prune_by_key_range=True).explain()
    scans = [line for line in buf.getvalue().splitlines() if "FileScan parquet" in line and "props" in line]
    assert any("event_id#" in s and ">= 101" in s for s in scans)


@pytest.mark.parametrize("name", ["inc_merge", "inc_merge_clauses", "inc_merge_no_key", "inc_merge_predicates",
                                  "inc_merge_by_position", "inc_delete_insert", "snapshot_changes"])
def test_no_nested_loops(spark, name):
    assert "NestedLoop" not in plan(spark, name) and "Cartesian" not in plan(spark, name)


@pytest.mark.parametrize("name", ["page_box_scores", "page_stat_cards", "page_play_by_play", "page_teams", "page_rows_with_ids",
                                  "page_headings", "page_list_rows", "page_links"])
def test_pages_are_parsed_once(spark, name):
    assert plan(spark, name).count("MapInPandas") == 1


@pytest.mark.parametrize("name", ["resultset_rows", "fact_per_game", "inc_merge_clauses"])
def test_no_python_in_jvm_only_queries(spark, name):
    p = plan(spark, name)
    assert "Python" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p


def test_standings_never_ranks_a_whole_conference(spark):
    p = plan(spark, "fact_standings")
    ranks = [line for line in p.splitlines() if "row_number()" in line]
    assert ranks and all("wins" in line.split("windowspecdefinition(")[1].split(",")[1] for line in ranks)


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "fact_standings")
    lineitem_scans = [line for line in p.splitlines() if "FileScan parquet" in line and "l_" in line]
    assert lineitem_scans and all("l_quantity" not in s and "l_extendedprice" not in s for s in lineitem_scans)


def test_partition_scoped_read_prunes_partitions(spark):
    import uuid

    from pyspark.sql import functions as F

    from tidewater.operators import writers as W
    from tidewater.session import scratch_path
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("day", F.to_date("ts").cast("string"))
    path = scratch_path(spark, f"tests/dpp-{uuid.uuid4().hex[:8]}")
    ev.write.partitionBy("day").parquet(path)
    scoped = W.touched_partitions(spark.read.parquet(path), ev.filter(F.col("user_id") == 3), ["day"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        scoped.explain()
    assert "dynamicpruning" in buf.getvalue()
    assert scoped.count() == ev.join(ev.filter(F.col("user_id") == 3).select("day").distinct(), "day", "left_semi").count()
