"""From files to files: ticks and official quotes in, wide table out."""

from conftest import SF_DIR
from pyspark.sql import functions as F

from quotelake.operators.schedule import (
    number_schedule,
    snapshot_schedule,
    strike_grid,
    template_strikes,
)
from quotelake.plans import quotes
from quotelake.registry.fixtures import Fixture
from quotelake.session import new_path
from quotelake.sources import official, ticks


def test_pipeline_over_files(spark):
    fx = Fixture(spark, SF_DIR)
    tick_path, official_path, out = (new_path(spark, n) for n in ("ticks", "official", "wide"))
    ticks.write_ticks(
        fx.ticks.withColumn("file_date", F.date_format("trade_date", "yyyyMMdd")), tick_path
    )
    # Official rows of every template cell, with a schedule per term.
    cells = strike_grid(fx.schedule, fx.strikes).withColumnRenamed("sysid", "snapshot_sysid")
    marker = fx.view("fx_marker").select(
        "trade_date", F.explode(F.array(F.lit("Near"), F.lit("Next"))).alias("term"),
        F.lit("84500").alias("time"), "initial_sysid",
    )
    official.write_official(cells, marker, official_path)

    raw = ticks.read_ticks(spark, tick_path)
    rows = official.read_quotes_wide(spark, official_path)
    start = official.read_start_marker(spark, official_path)
    plan = number_schedule(snapshot_schedule(rows), start)
    official.write_quotes_wide(quotes.quote_pipeline(raw, plan, template_strikes(rows)), out)

    columns = ["trade_date", "term", "time", "strike", "c_bid", "c_ask", "p_bid", "c_source",
               "c_last_sysid", "p_min_sysid", "c_last_outlier", "p_min_outlier", "c_ema", "p_gamma",
               "snapshot_sysid"]
    got = official.read_computed_wide(spark, out).select(*columns)
    expected = quotes.quote_pipeline(fx.ticks, fx.schedule).select(*columns)
    table = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert table(got) == table(expected)
