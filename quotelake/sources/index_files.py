"""Input and output files of the index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.quotes import text_to_price
from quotelake.functions.times import pad_time
from quotelake.schemas import (
    CONTRIB_COLUMNS,
    FORWARD_COLUMNS,
    RATE_COLUMNS,
    SIGMA_COLUMNS,
)
from quotelake.sources.headers import exact_names, read_by_header
from quotelake.sources.folders import by_file, replace_folders


def _read(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    return read_by_header(spark, path, "\t", list(columns.values()), exact_names(columns))


def read_forward(spark: SparkSession, path: str) -> DataFrame:
    raw = _read(spark, path, FORWARD_COLUMNS)
    return raw.select(
        "trade_date", "term", pad_time(F.col("time")).alias("time"),
        text_to_price(F.col("tw_fwd")).alias("tw_fwd"), text_to_price(F.col("k0")).alias("k0"),
    )


def read_contrib(spark: SparkSession, path: str) -> DataFrame:
    """Contributions; ``X`` and blanks are missing values."""
    raw = _read(spark, path, CONTRIB_COLUMNS)
    return raw.select(
        "trade_date", "term", pad_time(F.col("time")).alias("time"),
        F.col("strike").try_cast("int").alias("strike"),
        *[text_to_price(F.col(c)).alias(c) for c in
          ("c_bid", "c_ask", "p_bid", "p_ask", "mid", "contrib")],
    )


def read_sigma(spark: SparkSession, path: str) -> DataFrame:
    raw = _read(spark, path, SIGMA_COLUMNS)
    texts = ("near_type", "next_type")
    numbers = [c for c in SIGMA_COLUMNS.values() if c not in ("file_date", "time", *texts)]
    return raw.select(
        "trade_date", pad_time(F.col("time")).alias("time"),
        *[text_to_price(F.col(c)).alias(c) for c in numbers], *texts,
    )


def read_rate(spark: SparkSession, path: str) -> DataFrame:
    """First row of the rate file of each date."""
    raw = _read(spark, path, RATE_COLUMNS).withColumn("line", F.monotonically_increasing_id())
    rates = F.struct(*[text_to_price(F.col(c)).alias(c) for c in RATE_COLUMNS.values()])
    return (
        raw.groupBy("trade_date").agg(F.min_by(rates, "line").alias("r"))
        .select("trade_date", "r.*")
    )


def read_index_inputs(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {
        "forward": read_forward(spark, f"{path}/forward"),
        "contrib": read_contrib(spark, f"{path}/contrib"),
        "sigma": read_sigma(spark, f"{path}/sigma"),
        "rate": read_rate(spark, f"{path}/rate"),
    }


def write_tsv(rows: DataFrame, columns: dict[str, str], path: str, keys: list[str]) -> None:
    """Rows in a file layout; columns the frame lacks stay empty."""
    have = set(rows.columns)
    out = [
        (F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(name)
        for name, c in columns.items()
    ]
    by_file(rows.select(*keys, *out), keys).write.partitionBy(*keys).option("sep", "\t").option(
        "header", True
    ).csv(path)


def ten_decimals(value: Column) -> Column:
    return F.format_string("%.10f", value)


def index_file_rows(index: DataFrame) -> DataFrame:
    """Index rows as texts, doubles with ten decimals."""
    doubles = {f.name for f in index.schema.fields if f.dataType.typeName() == "double"}
    return index.select(
        *[ten_decimals(F.col(c)).alias(c) if c in doubles else F.col(c) for c in index.columns]
    )


def original_file_rows(index: DataFrame) -> DataFrame:
    """Headerless second file: date, time with ``00``, blank, original index."""
    return index.select(
        "trade_date",
        F.date_format("trade_date", "yyyyMMdd").alias("date_text"),
        F.concat("time", F.lit("00")).alias("time_text"),
        F.lit("").alias("blank"),
        F.format_string("%.2f", F.col("original")).alias("original_text"),
    )


def write_index(index: DataFrame, path: str, dates: list[str] | None = None) -> None:
    """Both index files, in folders per date; dates that are run again replace theirs."""
    inverse = {v: k for k, v in SIGMA_COLUMNS.items()}
    day = ["trade_date"]
    rows = index_file_rows(index).withColumnsRenamed(inverse)
    replace_folders(rows, day, f"{path}/index", dates, sep="\t", header=True)
    replace_folders(original_file_rows(index), day, f"{path}/original", dates, sep="\t", header=False)
