"""Which dates exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed value: name of a difference report file.
REPORT_NAME = r"validation_diff_([0-9]{8})\.csv"


def list_dates(files: DataFrame) -> DataFrame:
    """Dates in the names of report files, newest first. ``files`` has ``path``."""
    text = F.regexp_extract("path", REPORT_NAME, 1)
    return (
        files.select(F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd"))).alias("trade_date"))
        .where("trade_date is not null")
        .distinct()
        .orderBy(F.desc("trade_date"))
    )


def report_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths under a folder, without reading any content."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path")
    )


def calendar_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    days = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    return spark.range(1).select(F.explode(days).alias("trade_date"))


def calendar_around(dated: DataFrame, before: int = 7, after: int = 7) -> DataFrame:
    """Every date from ``before`` days ahead of the first to ``after`` behind the last."""
    ends = dated.agg(F.min("trade_date").alias("low"), F.max("trade_date").alias("high"))
    days = F.sequence(F.date_sub("low", before), F.date_add("high", after))
    return ends.select(F.explode(days).alias("trade_date"))


def date_range_select(calendar: DataFrame, available: DataFrame) -> DataFrame:
    """Every date of a range with a mark whether it is available."""
    present = available.select("trade_date").distinct().withColumn("available", F.lit(True))
    return calendar.join(present, "trade_date", "left").fillna(False, subset=["available"])
