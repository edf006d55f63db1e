"""Folders by expiry and files by sequence number: what a question opens and reads."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from quotelake.operators import terms
from quotelake.plans import questions, quotes
from quotelake.registry.fixtures import Fixture
from quotelake.session import new_path
from quotelake.sources import tick_store
from quotelake.sources.folders import folder_files


def scans(df):
    """Run ``df``; files opened and rows handed on by its scans of the store."""
    df.collect()
    found, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        name = plan.nodeName()
        if name.startswith("Scan parquet") and "seqno" in plan.simpleString(100):
            metrics = plan.metrics()
            found.append(tuple(metrics.apply(m).value() for m in ("numFiles", "numOutputRows")))
        below = plan.children()
        plans += [below.apply(i) for i in range(below.size())]
        if name.startswith("AdaptiveSparkPlan"):
            plans.append(plan.executedPlan())
        elif "QueryStage" in name:
            plans.append(plan.plan())
    return found


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, SF_DIR)


@pytest.fixture(scope="module")
def parsed(fx):
    """The ticks, and as many of a later expiry that is neither near nor next."""
    later = {"yyyymm": F.lit(202412), "seqno": F.col("seqno") + 10**6}
    return fx.parsed.unionByName(fx.parsed.withColumns(later))


@pytest.fixture(scope="module")
def store(spark, parsed):
    path = new_path(spark, "store")
    tick_store.write_tick_store(parsed, path)
    return path


def test_expiries_are_those_of_the_ticks(spark, parsed, store):
    expected = {tuple(r) for r in parsed.select("trade_date", "yyyymm").distinct().collect()}
    assert {tuple(r) for r in tick_store.stored_expiries(spark, store).collect()} == expected


def test_terms_prune_folders_while_the_join_runs(spark, fx, store):
    found = tick_store.read_term_ticks(spark, store)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    got = {(r["seqno"], r["term"]) for r in found.collect()}
    assert got == {(r["seqno"], r["term"]) for r in fx.term_ticks.collect()}
    files = folder_files(spark, store)
    wanted = {tuple(map(str, r)) for r in terms.near_next_terms(fx.parsed).select("trade_date", "yyyymm").collect()}
    near_next = sum(len(n) for f, n in files.items() if tuple(p.split("=")[1] for p in f.split("/")) in wanted)
    opened = [s[0] for s in scans(tick_store.read_term_ticks(spark, store))]
    assert opened == [near_next] and near_next < sum(map(len, files.values()))
    one = scans(tick_store.read_term_ticks(spark, store, ["2024-01-05"]))
    assert one[0][0] == sum(len(n) for f, n in files.items() if "2024-01-05" in f and not f.endswith("202412"))


def test_a_question_reads_the_row_groups_of_its_bounds(spark):
    """A hundred thousand ticks of one expiry; the question is about some hundred."""
    path, n = new_path(spark, "store"), 100_000
    ticks = spark.range(n).select(
        F.lit("2024-01-04").cast("date").alias("trade_date"), (F.lit(202402) + F.col("id") % 2).cast("int").alias("yyyymm"),
        F.col("id").alias("seqno"), (F.lit(20000) + 100 * (F.col("id") % 10 < 3).cast("int")).alias("strike"),
        F.lit("Call").alias("cp"), F.rand(1).alias("bid"), F.rand(2).alias("ask"),
    )
    tick_store.write_tick_store(ticks, path, group_bytes=64 << 10, page_rows=1000)
    request = tick_store.TickRequest("2024-01-04", "Near", 20100, "Call", 60_400, 60_000, prev_end=30_100, prev_start=30_000)
    found = tick_store.request_ticks(spark, path, request)
    rows = found.collect()
    wanted = lambda a, b: {i for i in range(a + 1, b + 1) if i % 2 == 0 and i % 10 < 3}
    assert {r["seqno"] for r in rows if r["part"] == "current"} == wanted(60_000, 60_400)
    assert {r["seqno"] for r in rows if r["part"] == "prev"} == wanted(30_000, 30_100)
    assert "Or(And(GreaterThan(se" in found._jdf.queryExecution().executedPlan().toString()
    (_, read), = scans(tick_store.request_ticks(spark, path, request))
    assert read < n / 10


def test_a_term_that_a_date_lacks_gives_no_ticks(spark, store):
    request = tick_store.TickRequest("2020-01-04", "Near", 20100, "Call", 10, 0)
    assert tick_store.request_ticks(spark, store, request).count() == 0


@pytest.mark.parametrize("first", [0, 5])
def test_window_narrows_ticks_before_they_are_placed(spark, fx, store, monkeypatch, first):
    """Ticks of touched intervals alone reach the assignment, with the same rows shown."""
    seen = []
    whole_assign = questions.assign_intervals
    monkeypatch.setattr(questions, "assign_intervals", lambda t, *a: seen.append(t) or whole_assign(t, *a))
    book = quotes.filtered(fx.book)
    whole = [r for r in questions.tick_stream(fx.term_ticks, fx.schedule, book).collect()]
    bounds = fx.schedule.where(F.col("idx").isin(first, first + 2)).groupBy("trade_date").agg(
        F.min("prev_sysid").alias("range_start"), F.max("sysid").alias("range_end")
    )
    window = bounds.withColumn("range_start", F.when(F.lit(first == 0), F.lit(0)).otherwise(F.col("range_start") + 1)).where(
        "trade_date > date '2024-01-03'"
    )
    some = questions.tick_stream(fx.term_ticks, fx.schedule, book, None, window).collect()
    ranges = {r["trade_date"]: (r["range_start"], r["range_end"]) for r in window.collect()}
    wanted = [r for r in whole if r["trade_date"] in ranges and ranges[r["trade_date"]][0] < r["seqno"] <= ranges[r["trade_date"]][1]]
    assert sorted(map(str, some)) == sorted(map(str, wanted)) and some
    assert seen[1].count() < seen[0].count() / 4
