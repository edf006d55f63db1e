"""Raw tick files of many days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.quotes import text_to_price
from quotelake.schemas import TICK_COLUMNS
from quotelake.sources.headers import exact_names, read_by_header
from quotelake.sources.folders import by_file

# How a loosely named header maps to a tick column.
HEADER_HINTS = {
    "file_date": ("yymmdd",),
    "prod_id": ("prod_id",),
    "seqno": ("seqno",),
    "tick_time": ("time",),
    "bid": ("buy_price", "best_bid"),
    "ask": ("sell_price", "best_ask"),
}


def _typed(texts: DataFrame) -> DataFrame:
    return texts.select(
        F.trim("file_date").alias("file_date"),
        F.to_date(F.try_to_timestamp(F.trim("file_date"), F.lit("yyyyMMdd"))).alias("trade_date"),
        F.trim("seqno").try_cast("bigint").alias("seqno"),
        F.trim("tick_time").alias("tick_time"),
        F.trim("prod_id").alias("prod_id"),
        text_to_price(F.col("bid")).alias("bid"),
        text_to_price(F.col("ask")).alias("ask"),
        *[c for c in ("day",) if c in texts.columns],
    )


def _wanted_dates(ticks: DataFrame, dates: list[str] | None) -> DataFrame:
    """Exactly the wanted dates; in a folder per ``day`` also only its own date."""
    if dates is not None:
        ticks = ticks.where(F.col("file_date").isin(dates))
        if "day" in ticks.columns:
            ticks = ticks.where(F.col("day").cast("string").isin(dates))
    if "day" in ticks.columns:
        ticks = ticks.where(F.col("file_date") == F.col("day").cast("string")).drop("day")
    return ticks.drop("file_date")


def read_ticks(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """Tab separated tick files under ``path``, one folder ``day=YYYYMMDD`` per date.

    ``dates`` limits the folders that are listed and read.
    """
    return _wanted_dates(_typed(read_tick_texts(spark, path, dates)), dates)


def _folders(dates: list[str] | None) -> tuple[str, list[str]] | None:
    return None if dates is None else ("day", dates)


def read_tick_texts(
    spark: SparkSession, path: str, dates: list[str] | None = None, sep: str = "\t"
) -> DataFrame:
    """Tick files as texts, columns found by their names in each file."""
    names = exact_names(TICK_COLUMNS)
    return read_by_header(spark, path, sep, list(HEADER_HINTS), names, wanted=_folders(dates))


def locate_columns(names: list[str]) -> dict[str, int]:
    """Tick column -> its place in a header, found by substring."""
    found = {}
    for column, hints in HEADER_HINTS.items():
        for place, name in enumerate(names):
            taken = column == "tick_time" and "yymmdd" in name
            if not taken and any(h in name for h in hints):
                found[column] = place
                break
    return found


def read_ticks_flexible(
    spark: SparkSession, path: str, dates: list[str] | None = None, sep: str = ","
) -> DataFrame:
    """Tick files with another separator and loosely named headers, file by file."""
    texts = read_by_header(
        spark, path, sep, list(HEADER_HINTS), locate_columns, wanted=_folders(dates)
    )
    return _wanted_dates(_typed(texts), dates)


def write_ticks(
    ticks: DataFrame,
    path: str,
    sep: str = "\t",
    columns: tuple[str, ...] = tuple(TICK_COLUMNS.values()),
    mode: str = "error",
) -> None:
    """Tick files in the raw format, one folder per day, columns in the given order."""
    names = {v: k for k, v in TICK_COLUMNS.items()}
    rows = ticks.select(
        *[F.col(c).cast("string").alias(names.get(c, c)) for c in columns],
        F.date_format("trade_date", "yyyyMMdd").alias("day"),
    )
    by_file(rows, ["day"]).write.mode(mode).partitionBy("day").option("header", True).option(
        "sep", sep
    ).csv(path)
