"""Physical plans that must hold at scale."""

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as driver
from quotelake.config import EngineConfig
from quotelake.operators.intervals import assign_intervals
from quotelake.operators.snapshots import SERIES, fold_ticks
from quotelake.plans import questions, quotes
from quotelake.plans.reconciliation import diff_report, full_data_view
from quotelake.registry.fixtures import Fixture
from quotelake.sources import ticks
from quotelake.session import new_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


QUADRATIC = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", ["quote_pipeline", "tick_window", "diff_report", "index_pipeline"])
def test_no_quadratic_join(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    assert not any(word in plan for word in QUADRATIC)


def test_interval_join_beyond_the_broadcast_bound(spark):
    fx = Fixture(spark, SF_DIR)
    cfg = EngineConfig(broadcast_bytes=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = assign_intervals(fx.term_ticks, fx.schedule, cfg)
        plan = plan_of(wide)
        got = {tuple(r) for r in wide.select("seqno", "idx").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "bucket" in plan and not any(word in plan for word in QUADRATIC)
    near = assign_intervals(fx.term_ticks, fx.schedule).select("seqno", "idx")
    assert got == {tuple(r) for r in near.collect()}


def test_ticks_are_folded_by_hash_before_the_shuffle(spark):
    fx = Fixture(spark, SF_DIR)
    placed = assign_intervals(fx.term_ticks, fx.schedule)
    plan = plan_of(fold_ticks(placed, [*SERIES, "cp", "idx"]))
    assert "partial_max" in plan and "HashAggregate" in plan
    assert "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2  # the fold and the day bounds


def test_wanted_days_prune_the_tick_folders(spark):
    fx = Fixture(spark, SF_DIR)
    path = new_path(spark, "ticks")
    rows = fx.ticks.withColumn("file_date", F.date_format("trade_date", "yyyyMMdd"))
    ticks.write_ticks(rows, path)
    one = ticks.read_ticks(spark, path, ["20240105"])
    assert re.search(r"PartitionFilters: \[[^\]]*cast\(day#\d+ as string\) = 20240105", plan_of(one))
    assert [str(r[0]) for r in one.select("trade_date").distinct().collect()] == ["2024-01-05"]
    everything = ticks.read_ticks(spark, path).where("trade_date = date'2024-01-05'")
    assert one.count() == everything.count() > 0


def test_full_data_view_filters_before_the_join(spark):
    fx = Fixture(spark, SF_DIR)
    ours, official = fx.view("fx_ours_wide"), fx.view("fx_official_wide")
    diffs = diff_report(ours, official)
    some = full_data_view(ours, diffs, cp="Call", time="100000")
    whole = full_data_view(ours, diffs).where("cp = 'Call' and time = '100000'")
    assert sorted(map(tuple, some.collect()), key=str) == sorted(
        map(tuple, whole.collect()), key=str
    )


def test_tick_stream_folds_and_reads_once(spark):
    plan = plan_of(driver.queries()["tick_stream"](spark, SF_DIR))
    assert plan.count("MapInArrow") <= 1
    assert plan.count("events.parquet") <= 2
    assert not any(word in plan for word in QUADRATIC)


def test_tick_stream_of_one_series_and_window(spark):
    fx = Fixture(spark, SF_DIR)
    book = quotes.filtered(fx.book)
    whole = questions.tick_stream(fx.term_ticks, fx.schedule, book).collect()
    low, high = fx.schedule.selectExpr("min(sysid)", "max(sysid)").first()
    ends = (low, (low + high) // 2)
    days = fx.schedule.select("trade_date").distinct()
    window = days.selectExpr("trade_date", f"{ends[0]}L range_start", f"{ends[1]}L range_end")
    some = questions.tick_stream(fx.term_ticks, fx.schedule, book, {"cp": "Put"}, window).collect()
    wanted = [r for r in whole if r["cp"] == "Put" and ends[0] < r["seqno"] <= ends[1]]
    assert sorted(map(str, some)) == sorted(map(str, wanted)) and some
