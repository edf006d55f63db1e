"""Dates that are run again replace their own files and leave the others."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from quotelake.registry.fixtures import Fixture
from quotelake.session import new_path
from quotelake.sources import index_files, official
from quotelake.sources.folders import folder_files

DAYS = ["2024-01-04", "2024-01-05"]


def of_days(df, days):
    return df.where(F.col("trade_date").cast("string").isin(days))


def writers(spark):
    fx = Fixture(spark, SF_DIR)
    wide, index = fx.view("fx_official_wide"), fx.view("fx_official_index")
    diffs = wide.select(
        "trade_date", "time", "term", "strike", F.lit("Call").alias("cp"), F.lit("EMA").alias("column"),
        F.col("c_ema").alias("ours"), F.col("p_ema").alias("official"),
        F.col("snapshot_sysid").alias("sysid"), F.lit(1).cast("bigint").alias("prev_sysid"),
    )
    return {
        "wide": (official.write_quotes_wide, wide),
        "index": (index_files.write_index, index),
        "diffs": (official.write_diffs, diffs),
        "stage1": (official.write_stage1, wide.select("trade_date", "term", "strike", "c_bid")),
    }


@pytest.mark.parametrize("name", ["wide", "index", "diffs", "stage1"])
def test_one_date_is_run_again(spark, name):
    write, rows = writers(spark)[name]
    path = new_path(spark, "again")
    write(of_days(rows, DAYS), path)
    before = folder_files(spark, path)
    assert {d for d in DAYS if any(f"trade_date={d}" in f for f in before)} == set(DAYS)
    write(of_days(rows, DAYS[1:]), path)
    after = folder_files(spark, path)
    assert after.keys() == before.keys()
    for folder, names in after.items():
        if DAYS[0] in folder:
            assert names == before[folder]
        else:
            assert not names & before[folder]


def test_folders_that_a_date_lost_go(spark):
    write, rows = writers(spark)["wide"]
    path = new_path(spark, "again")
    write(of_days(rows, DAYS), path)
    near = of_days(rows, DAYS[1:]).where("term = 'Near'")
    write(near, path)
    folders = folder_files(spark, path).keys()
    assert {f for f in folders if DAYS[1] in f} == {f"trade_date={DAYS[1]}/term=Near"}
    assert len({f for f in folders if DAYS[0] in f}) == 2
    write(rows.limit(0), path, [DAYS[1]])
    assert {f.split("/")[0] for f in folder_files(spark, path)} == {f"trade_date={DAYS[0]}"}
    assert official.read_computed_wide(spark, path).count() == of_days(rows, DAYS[:1]).count()


def test_a_date_without_differences_has_a_header_only(spark):
    write, rows = writers(spark)["diffs"]
    path = new_path(spark, "again")
    write(of_days(rows, DAYS), path)
    write(rows.limit(0), path, [DAYS[0]])
    found = official.read_diffs(spark, path)
    assert [str(r[0]) for r in found.select("trade_date").distinct().collect()] == [DAYS[1]]
    header = spark.read.text(f"{path}/trade_date={DAYS[0]}").collect()
    assert [r[0].split(",")[0] for r in header] == ["Date"]


def test_a_run_that_fails_leaves_the_files(spark):
    write, rows = writers(spark)["stage1"]
    path = new_path(spark, "again")
    write(of_days(rows, DAYS), path)
    before = folder_files(spark, path)
    broken = of_days(rows, DAYS).withColumn("c_bid", F.raise_error(F.lit("no quotes")).cast("double"))
    with pytest.raises(Exception, match="no quotes"):
        write(broken, path)
    assert folder_files(spark, path) == before
