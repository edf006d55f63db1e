"""Product identifiers: ``PP T AAAAA CC`` (root, class, strike, month and year)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.config import DEFAULT

# Month letters, January to December.
CALL_MONTHS = "ABCDEFGHIJKL"
PUT_MONTHS = "MNOPQRSTUVWX"


def _side_and_month(code: Column) -> tuple[Column, Column]:
    """Side and month of a known one-letter month code."""
    place = F.position(code, F.lit(CALL_MONTHS + PUT_MONTHS))
    return F.when(place <= 12, "Call").otherwise("Put"), (place - 1) % 12 + 1


def parse_product(
    df: DataFrame, prod_id: str = "prod_id", product: str = DEFAULT.product
) -> DataFrame:
    """Add ``product, strike, cp, year, month, yyyymm``; drop ids that do not parse.

    One pattern decides, so the extracting columns need no checks of their own
    and stay small enough for compiled code.
    """
    pid = F.col(prod_id)
    side, month = _side_and_month(F.substring(pid, 9, 1))
    year = F.lit(2020) + F.substring(pid, 10, 1).try_cast("int")
    return (
        df.withColumn(prod_id, F.trim(pid))
        .where(pid.rlike(f"^{re.escape(product)}[0-9]{{5}}[A-X][0-9]$"))
        .withColumns(
            {
                "product": F.lit(product),
                "strike": F.substring(pid, 4, 5).try_cast("int"),
                "cp": side,
                "year": year,
                "month": month,
                "yyyymm": year * 100 + month,
            }
        )
    )


def parse_product_lenient(
    df: DataFrame, prod_id: str = "prod_id", product: str = DEFAULT.product
) -> DataFrame:
    """Ids of ten or more characters with the right prefix; keeps the month-year code."""
    pid = F.col(prod_id)
    side, month = _side_and_month(F.substring(pid, 9, 1))
    year = F.lit(2020) + F.substring(pid, 10, 1).try_cast("int")
    return (
        df.withColumn(prod_id, F.trim(pid))
        .where(pid.rlike(f"^{re.escape(product)}[0-9]{{5}}[A-X][0-9]"))
        .withColumns(
            {
                "product": F.lit(product),
                "strike": F.substring(pid, 4, 5).try_cast("int"),
                "term_code": F.substring(pid, 9, 1000),
                "cp": side,
                "yyyymm": year * 100 + month,
            }
        )
    )


def build_product_id(
    strike: Column, cp: Column, yyyymm: Column, product: str = DEFAULT.product
) -> Column:
    """Inverse of :func:`parse_product`, strike padded to five digits."""
    month = (yyyymm % 100).cast("int")
    codes = F.when(cp == "Call", F.lit(CALL_MONTHS)).otherwise(F.lit(PUT_MONTHS))
    year_digit = F.floor(yyyymm / 100) % 10
    return F.concat(
        F.lit(product),
        F.lpad(strike.cast("string"), 5, "0"),
        F.substr(codes, month, F.lit(1)),
        year_digit.cast("int").cast("string"),
    )


def expiry_of_file(path: Column, product: str = DEFAULT.product) -> Column:
    """Expiry month ``yyyymm`` from a tick file name ``...{product}{month}{digit}.csv``."""
    pattern = product + r"([A-X])([0-9])\.csv"
    _, month = _side_and_month(F.regexp_extract(path, pattern, 1))
    year = F.lit(2020) + F.regexp_extract(path, pattern, 2).try_cast("int")
    return year * 100 + month
