"""Expiry terms: which two months of a day are Near and Next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig
from quotelake.session import bounded_broadcast


def enrich_products(ticks: DataFrame, products: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Join a dimension of parsed ids to the ticks; unknown ids drop out."""
    return ticks.join(bounded_broadcast(products, cfg.broadcast_bytes), "prod_id", "inner")


def near_next_terms(parsed: DataFrame) -> DataFrame:
    """``(trade_date, yyyymm, term)`` of every date with at least two expiries.

    The distinct runs on the map side first, so only a few months per date and
    task are shuffled.
    """
    months = parsed.select("trade_date", "yyyymm").distinct()
    by_month = Window.partitionBy("trade_date").orderBy("yyyymm")
    whole = Window.partitionBy("trade_date")
    return (
        months.withColumns(
            {
                "month_rank": F.dense_rank().over(by_month),
                "months": F.count(F.lit(1)).over(whole),
            }
        )
        .where("months >= 2 and month_rank <= 2")
        .select(
            "trade_date",
            "yyyymm",
            F.when(F.col("month_rank") == 1, "Near").otherwise("Next").alias("term"),
        )
    )


def split_terms(parsed: DataFrame, terms: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Ticks of Near and Next with their ``term``; other expiries are dropped."""
    return parsed.join(
        bounded_broadcast(terms, cfg.broadcast_bytes), ["trade_date", "yyyymm"], "inner"
    )


def quoted_strikes(term_ticks: DataFrame) -> DataFrame:
    return term_ticks.select("trade_date", "term", "strike").distinct()
