"""Streams: state that is kept, state that goes, silent steps and late rows."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from quotelake.functions.products import parse_product
from quotelake.operators.schedule import number_schedule
from quotelake.operators.snapshots import book_to_long, snapshot_book
from quotelake.registry.fixtures import Fixture
from quotelake.session import new_path
from quotelake.streaming import filtered, runs, snapshots

DAYS = ["2024-01-04", "2024-01-05"]


class Source:
    """A folder that is read as a stream, run after run, into another."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.folder, self.out, self.log = (new_path(spark, n) for n in ("in", "out", "log"))

    def run(self, part, build):
        part.write.mode("append").parquet(self.folder)
        stream = self.spark.readStream.schema(self.schema).parquet(self.folder)
        runs.run_available(build(stream), self.out, self.log)
        return self.spark.read.parquet(self.out)


@pytest.mark.parametrize("idle,restarts", [(3_600_000, True), (filtered.DAY_MS, False)])
def test_state_of_a_silent_series_goes_by_its_timer(spark, idle, restarts):
    fx = Fixture(spark, SF_DIR)
    day = fx.book.where((F.col("trade_date") == DAYS[0]) & F.col("strike").isin(20000, 20100)).where("term = 'Near'")
    silent = F.col("strike") == 20000
    hour = F.col("time").substr(1, 2).cast("int")
    build = lambda s: filtered.stream_filtered_quote(s, "0 seconds", idle)
    source = Source(spark, fx.book.schema)
    # One series stops at six, the other one moves the watermark on to fourteen.
    source.run(day.where((silent & (hour < 6)) | (~silent & (hour < 14))), build)
    found = source.run(day.where(silent & (hour > 15)), build).where(silent & (hour > 15))
    assert [r["restart"] for r in found.orderBy("idx").collect()][:1] == [restarts]
    other = spark.read.parquet(source.out).where(~silent).orderBy("idx").collect()
    assert [r["restart"] for r in other[1:]] == [r["time"] == "090000" for r in other[1:]]


def test_stream_equals_batch_with_silent_and_last_steps(spark):
    fx = Fixture(spark, SF_DIR)
    ticks = fx.view("fx_ticks").where(F.col("trade_date").cast("string").isin(DAYS))
    rows = ticks.join(fx.term_ticks.select("seqno", "term"), "seqno").drop("term")
    # The same schedule for the batch: every full hour, with what is known by then.
    hours = ticks.select("trade_date").distinct().select("*", F.explode(F.sequence(F.lit(3), F.lit(23))).alias("h"))
    known = hours.join(ticks.select("trade_date", "hh", "seqno"), "trade_date").where("hh <= h")
    times = known.groupBy("trade_date", F.format_string("%02d0000", "h").alias("time")).agg(F.max("seqno").alias("sysid"))
    marker = ticks.where("hh < 3").groupBy("trade_date").agg(F.max("seqno").alias("initial_sysid"))
    book = snapshot_book(fx.term_ticks.where(F.col("trade_date").cast("string").isin(DAYS)), number_schedule(times, marker))
    names = ["raw_bid", "raw_ask", "raw_sysid", "carry_sysid", "last_bid", "last_ask", "last_sysid", "min_bid", "min_ask", "min_sysid"]
    products = fx.term_ticks.select("trade_date", "term", "strike", "cp", "prod_id").distinct()
    batch = book_to_long(book).where("raw_sysid is not null").join(products, ["trade_date", "term", "strike", "cp"])
    expected = {(str(r["trade_date"]), r["prod_id"], r["time"][:2], *(r[n] for n in names)) for r in batch.collect()}

    parsed = parse_product(rows)
    beat = snapshots.heartbeat(parsed.limit(1), F.timestamp_seconds(F.lit(4_000_000_000)))
    build = lambda s: snapshots.stream_snapshot(s, "1 hour", "30 minutes", opens="030000")
    source = Source(spark, parsed.schema)
    first = source.run(parsed.where(F.col("trade_date") == DAYS[0]), build)
    # Without a later row the day's last steps wait.
    assert first.agg(F.max(F.date_format("step_start", "HH"))).first()[0] < "23"
    # A tick of the first morning, and of the best spread, that comes too late.
    late = parsed.where((F.col("trade_date") == DAYS[0]) & (F.col("hh") == 5)).limit(1)
    late = late.withColumns({"bid": F.lit(1.0), "ask": F.lit(1.01), "seqno": F.lit(10**9).cast("bigint")})
    second = parsed.where(F.col("trade_date") == DAYS[1])
    found = source.run(second.unionByName(late).unionByName(beat), build).collect()
    got = [(str(r["trade_date"]), r["prod_id"], r["step_start"].strftime("%H"), *(r[n] for n in names)) for r in found]
    assert len(got) == len(set(got)) and set(got) == expected
    # Silent steps are among them, and the last step of both days.
    assert len(got) > 2 * rows.select("trade_date", "hh", "prod_id").distinct().count()
    assert {(g[0], g[2]) for g in got} >= {(d, "23") for d in DAYS}
