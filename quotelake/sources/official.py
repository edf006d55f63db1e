"""Official and computed wide quote files, and difference reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.quotes import text_to_price
from quotelake.functions.times import pad_time
from quotelake.schemas import (
    DIFF_COLUMNS,
    OFFICIAL_QUOTE_COLUMNS,
    WIDE_QUOTE_COLUMNS,
    column_name,
    file_column,
)
from quotelake.sources.folders import NO_KEY, replace_folders
from quotelake.sources.headers import exact_names, read_by_header

PRICE_ENDINGS = ("bid", "ask", "ema", "gamma")


def _typed(name: str) -> Column:
    text = F.col(name)
    if name == "strike":
        return text.try_cast("double").cast("int").alias(name)
    if name.endswith("sysid"):
        return text.try_cast("double").cast("bigint").alias(name)
    if name.endswith(PRICE_ENDINGS):
        return text_to_price(text).alias(name)
    if name == "time":
        return pad_time(text).alias(name)
    return text.alias(name)


def _keys(df: DataFrame) -> list[str]:
    return [c for c in ("trade_date", "term") if c in df.columns]


def _by_name(spark: SparkSession, path: str, names: list[str], sep: str, **options) -> DataFrame:
    columns = {c: column_name(c) for c in names}
    return read_by_header(spark, path, sep, list(columns.values()), exact_names(columns), **options)


def read_official_text(spark: SparkSession, path: str) -> DataFrame:
    """Official wide files as texts, in folders ``trade_date=.../term=...``.

    ``field_1`` and ``field_2`` are the first fields of a row, which is all that the
    start row has.
    """
    fields = ("field_1", "field_2")
    return _by_name(spark, path, OFFICIAL_QUOTE_COLUMNS, "\t", first_fields=fields)


def read_quotes_wide(spark: SparkSession, path: str) -> DataFrame:
    """Typed official quotes without the start row, which has no strike."""
    texts = read_official_text(spark, path)
    names = [column_name(c) for c in OFFICIAL_QUOTE_COLUMNS if c != "date"]
    rows = texts.where(F.col("strike").isNotNull() & (F.trim("strike") != ""))
    return rows.select(*_keys(texts), *[_typed(n) for n in names])


def read_start_marker(spark: SparkSession, path: str) -> DataFrame:
    """Start row per file: a time and the sequence number before the first snapshot.

    The row has two fields only, so they are taken by place.
    """
    texts = read_official_text(spark, path)
    start = texts.where(F.col("strike").isNull() | (F.trim("strike") == ""))
    return start.select(
        *_keys(texts),
        pad_time(F.col("field_1")).alias("time"),
        F.trim("field_2").try_cast("bigint").alias("initial_sysid"),
    )


def read_computed_wide(spark: SparkSession, path: str) -> DataFrame:
    """Wide files written by :func:`write_quotes_wide`."""
    raw = _by_name(spark, path, WIDE_QUOTE_COLUMNS, ",")
    names = [column_name(c) for c in WIDE_QUOTE_COLUMNS]
    return raw.select(*_keys(raw), *[_typed(n) for n in names])


def write_quotes_wide(wide: DataFrame, path: str, dates: list[str] | None = None) -> None:
    """Wide CSV files in the fixed column order, one folder per date and term.

    Dates that are run again replace their folders; others are left alone
    (:func:`replace_folders`, also for ``dates``).
    """
    keys = _keys(wide)
    columns = [
        F.col(column_name(c)).cast("string").alias(file_column(column_name(c)))
        for c in WIDE_QUOTE_COLUMNS
    ]
    replace_folders(wide.select(*keys, *columns), keys, path, dates, header=True)


def write_official(
    rows: DataFrame, marker: DataFrame, path: str, columns: list[str] = OFFICIAL_QUOTE_COLUMNS
) -> None:
    """Official layout with its two-field start row, for tests and exchange."""
    keys = _keys(rows)
    text = lambda df, have: df.select(
        *keys,
        *[
            (F.col(n).cast("string") if n in have else F.lit(None).cast("string")).alias(c)
            for c, n in ((c, column_name(c)) for c in columns)
        ],
    )
    body = text(rows.withColumn("date", F.date_format("trade_date", "yyyyMMdd")),
                {*rows.columns, "date"})
    start = text(
        marker.select(
            *keys, F.col("time").alias("date"), F.col("initial_sysid").alias("time")
        ),
        {"date", "time"},
    )
    replace_folders(body.unionByName(start), keys, path, header=True, sep="\t")


def _named_diffs() -> list[Column]:
    """A difference under the column names of the report file."""
    source = dict(
        zip(
            DIFF_COLUMNS,
            ["trade_date", "time", "term", "strike", "cp", "column", "ours", "official",
             "sysid", "prev_sysid"],
            strict=True,
        )
    )
    return [
        (F.date_format(c, "yyyyMMdd") if c == "trade_date" else F.col(c)).alias(out)
        for out, c in source.items()
    ]


def write_diffs(diffs: DataFrame, path: str, dates: list[str] | None = None) -> None:
    """Difference reports, one folder per date, which a run of that date replaces.

    ``dates`` (``YYYY-MM-DD``) are the dates that were compared: one without differences
    gets a report with a header only, in place of what it had. Without ``dates`` and
    without differences there is one such report of no date.
    """
    rows = diffs.select("trade_date", *_named_diffs())
    fresh = replace_folders(rows, ["trade_date"], path, dates, header=True)
    silent = {f"trade_date={d}" for d in dates or ()} - fresh
    if not fresh and not dates:
        silent = {f"trade_date={NO_KEY}"}
    for folder in sorted(silent):
        empty = rows.sparkSession.createDataFrame([], rows.drop("trade_date").schema)
        empty.write.mode("overwrite").option("header", True).csv(f"{path}/{folder}")


def read_diffs(spark: SparkSession, path: str) -> DataFrame:
    columns = {c: c for c in DIFF_COLUMNS}
    rows = read_by_header(spark, path, ",", DIFF_COLUMNS, exact_names(columns))
    return rows.select(
        F.to_date("Date", "yyyyMMdd").alias("trade_date"),
        F.col("Time").alias("time"),
        F.col("Term").alias("term"),
        F.col("Strike").try_cast("int").alias("strike"),
        F.col("CP").alias("cp"),
        F.col("Column").alias("column"),
        F.col("Ours").try_cast("double").alias("ours"),
        F.col("PROD").try_cast("double").alias("official"),
        F.col("SysID").try_cast("bigint").alias("sysid"),
        F.col("Prev_SysID").try_cast("bigint").alias("prev_sysid"),
    )


def write_stage1(long: DataFrame, path: str, dates: list[str] | None = None) -> None:
    """Intermediate long table as Parquet, partitioned by date and term; dates that are
    run again replace their folders."""
    replace_folders(long, ["trade_date", "term"], path, dates, "parquet")
