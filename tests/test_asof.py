"""Newest quotes by one union and window, against the bucketed join."""

from conftest import SF_DIR
from pyspark.sql import functions as F

from quotelake.config import EngineConfig
from quotelake.operators.snapshots import asof_last, book_to_long, snapshot_book
from quotelake.registry.fixtures import Fixture

COLUMNS = ["trade_date", "term", "strike", "cp", "idx", "time", "raw_bid", "raw_ask", "raw_sysid"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_equals_the_bucketed_join_beyond_its_broadcast_limit(spark):
    fx = Fixture(spark, SF_DIR)
    cfg = EngineConfig(broadcast_bytes=0, seqno_bucket=16)
    days = F.col("trade_date") < "2024-01-06"
    ticks, schedule = fx.term_ticks.where(days), fx.schedule.where(days)
    book = snapshot_book(ticks, schedule, cfg=cfg)
    assert rows(asof_last(ticks, schedule)) == rows(book_to_long(book, with_derived=False))


def test_a_hot_series_is_cut_and_carried(spark):
    """One series with nearly all ticks; snapshots between, at and without ticks."""
    ticks = [(i, "Call" if i % 50 else "Put", 100 if i % 97 else 200, float(i), i + 1.0) for i in range(20_000)]
    shape = "seqno bigint, cp string, strike int, bid double, ask double"
    frame = spark.createDataFrame(ticks, shape).withColumns(
        {"trade_date": F.lit("2024-01-04").cast("date"), "term": F.lit("Near")}
    )
    times = [(i, f"{i:06d}", s, 0) for i, s in enumerate([0, 5, 5, 4000, 4001, 13_000, 13_000, 30_000])]
    schedule = spark.createDataFrame(times, "idx int, time string, sysid bigint, prev_sysid bigint").withColumn(
        "trade_date", F.lit("2024-01-04").cast("date")
    )
    expected = set()
    for idx, time, sysid, _ in times:
        for strike in (100, 200):
            for cp in ("Call", "Put"):
                seen = [t for t in ticks if t[0] <= sysid and t[1] == cp and t[2] == strike]
                expected.add((strike, cp, idx, time, *((seen[-1][3], seen[-1][0]) if seen else (None, None))))
    found = asof_last(frame, schedule).select("strike", "cp", "idx", "time", "raw_bid", "raw_sysid")
    assert {tuple(r) for r in found.collect()} == expected
