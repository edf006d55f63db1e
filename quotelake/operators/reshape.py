"""Long and wide forms, difference melting, paging."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig
from quotelake.schemas import SIDE_PREFIX, WIDE_QUOTE_COLUMNS, column_name
from quotelake.session import written_once

# The columns of a side that are compared, and their long names.
SIDE_MEASURES = {
    "ema": "EMA",
    "gamma": "Gamma",
    "bid": "Q_hat_Bid",
    "ask": "Q_hat_Ask",
    "last_bid": "Q_Last_Bid",
    "last_ask": "Q_Last_Ask",
    "min_bid": "Min_Bid",
    "min_ask": "Min_Ask",
}

ZERO_FILLED = ["bid", "ask", "last_bid", "last_ask", "min_bid", "min_ask", "ema"]


def unpivot_quotes(
    wide: DataFrame, keys: list[str], measures: Iterable[str]
) -> DataFrame:
    """Wide ``c_*``/``p_*`` columns to Call and Put rows with common names.

    A measure that a side lacks is null there.
    """
    measures = list(measures)
    kinds = {f.name: f.dataType for f in wide.schema.fields}

    def value(prefix: str, name: str) -> Column:
        column = f"{prefix}_{name}"
        if column in kinds:
            return F.col(column)
        other = next(kinds[f"{q}_{name}"] for q in SIDE_PREFIX.values() if f"{q}_{name}" in kinds)
        return F.lit(None).cast(other)

    known = [m for m in measures if any(f"{p}_{m}" in kinds for p in SIDE_PREFIX.values())]
    sides = F.array(
        *[
            F.struct(F.lit(cp).alias("cp"), *[value(p, m).alias(m) for m in known])
            for cp, p in SIDE_PREFIX.items()
        ]
    )
    return wide.select(*keys, F.inline(sides))


def pair_call_put(long: DataFrame, keys: list[str], measures: Iterable[str]) -> DataFrame:
    """Full outer pairing of Call and Put rows in one aggregation, without a join."""
    return long.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("cp") == cp, F.col(m))).alias(f"{p}_{m}")
            for cp, p in SIDE_PREFIX.items()
            for m in measures
        ]
    )


def pivot_quotes(long: DataFrame, keys: list[str], cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Long filtered quotes to the wide table in its fixed column order."""
    measures = [
        "bid", "ask", "source", "last_bid", "last_ask", "last_sysid", "last_outlier",
        "min_bid", "min_ask", "min_sysid", "min_outlier", "ema", "gamma",
    ]
    paired = long.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("cp") == cp, F.col(m))).alias(f"{p}_{m}")
            for cp, p in SIDE_PREFIX.items()
            for m in measures
        ],
        F.max("snapshot_sysid").alias("snapshot_sysid"),
    )
    return order_wide(paired, keys, cfg)


def order_wide(wide: DataFrame, keys: list[str], cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Fixed column order; a side without quotes reports the basic gamma."""
    body = [c for c in map(column_name, WIDE_QUOTE_COLUMNS) if c not in keys]
    gammas = {
        f"{p}_gamma": F.coalesce(F.col(f"{p}_gamma"), F.lit(cfg.gamma_zero))
        for p in SIDE_PREFIX.values()
    }
    return wide.withColumns(gammas).select(*keys, *body)


def fill_defaults(wide: DataFrame) -> DataFrame:
    """Missing prices and averages are written as 0."""
    names = [f"{p}_{m}" for p in SIDE_PREFIX.values() for m in ZERO_FILLED]
    return wide.fillna(0.0, subset=[n for n in names if n in wide.columns])


def union_terms(parts: list[DataFrame]) -> DataFrame:
    whole, *rest = parts
    for part in rest:
        whole = whole.unionByName(part)
    return whole


def distinct_options(quotes: DataFrame) -> DataFrame:
    """Sorted strikes and times available per date and term."""
    return quotes.groupBy("trade_date", "term").agg(
        F.sort_array(F.collect_set("strike")).alias("strikes"),
        F.sort_array(F.collect_set("time")).alias("times"),
    )


def slice_times(
    rows: DataFrame,
    keys: list[str],
    first: int | None = None,
    end_time: str | None = None,
    at: str | None = None,
) -> DataFrame:
    """Rows of the first N times per key, up to an end time, or at one time."""
    if first is not None:
        times = rows.select(*keys, "time").distinct()
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("time"))
        chosen = times.withColumn("n", rank).where(F.col("n") <= first).drop("n")
        return rows.join(chosen, [*keys, "time"], "left_semi")
    if end_time is not None:
        return rows.where(F.col("time") <= end_time)
    return rows.where(F.col("time") == at)


def page_rows(
    rows: DataFrame,
    order: list[str],
    page: int,
    per_page: int,
    only: dict | None = None,
) -> DataFrame:
    """One page of sorted rows with ``total``, ``total_pages`` and the clamped ``page``.

    ``only`` keeps rows with the given values; None or ``all`` keep every one. All
    other columns break ties of ``order``, so a page is the same on every run. The
    sorted partitions are written once, and their sizes, one number per partition,
    give the position of every row, near the front or deep.
    """
    for column, wanted in (only or {}).items():
        if wanted not in (None, "all"):
            rows = rows.where(F.col(column) == wanted)
    ties = [f.name for f in rows.schema if f.name not in order and f.dataType.typeName() != "map"]
    placed = written_once(rows.orderBy(*order, *ties)).withColumn(
        "place", F.monotonically_increasing_id()
    )
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    total = sum(row["count"] for row in counts)
    pages = max(1, -(-total // per_page))
    page = max(1, min(page, pages))
    start = (page - 1) * per_page

    chosen, before = F.lit(False), 0
    for row in counts:
        low, high = start - before, start - before + per_page
        if low < row["count"] and high > 0:
            chosen = chosen | ((part == row["part"]) & (within >= low) & (within < high))
        before += row["count"]
    return (
        placed.where(chosen)
        .orderBy("place")
        .drop("place")
        .withColumns(
            {
                "page": F.lit(page),
                "total": F.lit(total).cast("bigint"),
                "total_pages": F.lit(pages),
            }
        )
    )


def top_rows(rows: DataFrame, order: list, n: int) -> DataFrame:
    return rows.orderBy(*order).limit(n)
