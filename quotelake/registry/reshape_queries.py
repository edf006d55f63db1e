"""Sorts, limits, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.operators import reshape
from quotelake.plans import quotes
from quotelake.registry.base import query
from quotelake.registry.views import MEASURES
from quotelake.session import written_once

KEYS = ["trade_date", "term", "time", "strike"]


@query(
    """select * exclude (r) from (select *, cast(greatest(1, least(3, total_pages)) as integer) as page from (
select trade_date, term, time, strike, cp, "column", ours, official, count(*) over () as total,
 cast(ceil(count(*) over () / 100.0e0) as integer) as total_pages, row_number() over (order by time, strike, cp, "column") as r from o_diffs) d) p
where r > (page - 1) * 100 and r <= page * 100"""
)
def page_rows(fx):
    from quotelake.registry.comparison_queries import diffs_of

    rows = diffs_of(fx).select(*KEYS, "cp", "column", "ours", "official")
    return reshape.page_rows(rows, ["time", "strike", "cp", "column"], page=3, per_page=100)


@query(
    """select trade_date, term, strike, cp, time, raw_bid, raw_ask from o_snap where not last_valid
order by trade_date, term, time, strike, cp limit 5"""
)
def sample_invalid(fx):
    rows = fx.long_quotes.where(~F.col("last_valid")).select(
        "trade_date", "term", "strike", "cp", "time", "raw_bid", "raw_ask"
    )
    return reshape.top_rows(rows, ["trade_date", "term", "time", "strike", "cp"], 5)


@query(
    "select trade_date, term, time, strike, cp, raw_bid, raw_ask from o_snap order by trade_date, term, time, strike, cp"
)
def quote_sort(fx):
    rows = fx.long_quotes.select(*KEYS, "cp", "raw_bid", "raw_ask")
    return rows.orderBy("trade_date", "term", "time", "strike", "cp")


@query(
    f"select trade_date, term, time, strike, cp, last_sysid, {', '.join(MEASURES)} from o_official_long"
)
def unpivot_quotes(fx):
    return reshape.unpivot_quotes(
        fx.view("fx_official_wide"), KEYS, [*reshape.SIDE_MEASURES, "last_sysid"]
    )


WIDE = [
    "trade_date", "term", "strike", "time",
    *[f"{p}_{m}" for p in "cp" for m in
      ("bid", "ask", "source", "last_bid", "last_ask", "last_sysid", "last_outlier",
       "min_bid", "min_ask", "min_sysid", "min_outlier", "ema", "gamma")],
    "snapshot_sysid",
]


@query(f"select {', '.join(WIDE)} from o_wide", rounded=("c_ema", "p_ema"))
def pivot_quotes(fx):
    long = quotes.filtered_long(fx.book)
    return reshape.pivot_quotes(long, ["trade_date", "term", "strike", "time"]).select(*WIDE)


@query(f"select {', '.join(WIDE)} from o_wide_filled", rounded=("c_ema", "p_ema"))
def fill_defaults(fx):
    wide = quotes.wide_table(quotes.filtered(fx.book), fill=False)
    return reshape.fill_defaults(wide).select(*WIDE)


@query('select trade_date, term, time, strike, cp, "column", ours, official from o_diffs')
def melt_diffs(fx):
    from quotelake.registry.comparison_queries import matched_long
    from quotelake.operators.comparison import CELL, melt_diffs as melt

    return melt(matched_long(fx), CELL, reshape.SIDE_MEASURES)


@query(
    """select trade_date, term, strike, cp, idx, raw_bid from o_snap"""
)
def union_terms(fx):
    rows = fx.long_quotes.select("trade_date", "term", "strike", "cp", "idx", "raw_bid")
    rows = written_once(rows)
    return reshape.union_terms([rows.where(F.col("term") == t) for t in ("Near", "Next")])


@query(
    """select trade_date, term, string_agg(distinct cast(strike as varchar), ',' order by cast(strike as varchar)) as strikes, string_agg(distinct time, ',' order by time) as times from o_snap group by all"""
)
def distinct_options(fx):
    options = reshape.distinct_options(fx.book)
    return options.select(
        "trade_date", "term",
        F.array_join(F.col("strikes").cast("array<string>"), ",").alias("strikes"),
        F.array_join("times", ",").alias("times"),
    )
