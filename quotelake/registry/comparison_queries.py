"""Comparison predicates and reconciliation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.functions import compare
from quotelake.operators import comparison
from quotelake.plans import reconciliation
from quotelake.registry.base import query
from quotelake.registry.join_queries import COMPARED, INDEX_PAIRS, _column_diff_sql

KEYS = ["trade_date", "term", "time", "strike"]
WIDE_PAIRS = "fx_ours_wide o join fx_official_wide f using (trade_date, term, time, strike)"


def matched_long(fx):
    keep = [*comparison.CELL, *comparison.SIDE_MEASURES]
    side = lambda view: reconciliation.long_measures(fx.view(view)).select(*keep)
    return comparison.match_inner(side("fx_ours_wide"), side("fx_official_wide"), comparison.CELL)


def diffs_of(fx):
    """Difference report of the fixture; strikes modulo 50 form the series."""
    from pyspark.sql import Window

    ours = reconciliation.long_measures(fx.view("fx_ours_wide"))
    official = reconciliation.long_measures(fx.view("fx_official_wide"))
    order = Window.partitionBy("trade_date", "term", F.col("strike") % 50, "cp").orderBy(
        "time", "strike"
    )
    keep = [*comparison.CELL, *comparison.SIDE_MEASURES]
    numbered = official.select(
        *keep, F.col("last_sysid").alias("sysid"), F.lag("last_sysid", 1, 0).over(order).alias("prev_sysid")
    )
    matched = comparison.match_inner(ours.select(*keep), numbered, comparison.CELL)
    return comparison.quote_diffs(
        matched,
        comparison.CELL,
        [F.col("sysid_official").alias("sysid"), F.col("prev_sysid_official").alias("prev_sysid")],
    )


def _matched_wide(fx):
    return comparison.match_inner(fx.view("fx_ours_wide"), fx.view("fx_official_wide"), KEYS)


@query(
    f"""select strike, coalesce((o.c_ema is null) <> (f.c_ema is null) or abs(o.c_ema - f.c_ema) > 1e-4, false) as ema_differs,
 coalesce((o.p_ask is null) <> (f.p_ask is null) or abs(o.p_ask - f.p_ask) > 1e-4, false) as ask_differs from {WIDE_PAIRS}""",
    dates=(),
)
def float_diff(fx):
    differs = lambda c: compare.float_diff(F.col(f"{c}_ours"), F.col(f"{c}_official"))
    return _matched_wide(fx).select(
        "strike", differs("c_ema").alias("ema_differs"), differs("p_ask").alias("ask_differs")
    )


def _plain(c: str) -> str:
    return f"case when regexp_replace(trim(coalesce({c}, '')), '\\.0$', '') = '-' then '' else regexp_replace(trim(coalesce({c}, '')), '\\.0$', '') end"


@query(
    f"""select strike, {_plain('o.c_last_outlier')} <> {_plain('f.c_last_outlier')} as outlier_differs,
 {_plain("cast(o.c_last_sysid as varchar) || '.0'")} <> {_plain('cast(f.c_last_sysid as varchar)')} as sysid_differs from {WIDE_PAIRS}""",
    dates=(),
)
def string_diff(fx):
    ours = F.concat(F.col("c_last_sysid_ours").cast("string"), F.lit(".0"))
    return _matched_wide(fx).select(
        "strike",
        compare.string_diff(F.col("c_last_outlier_ours"), F.col("c_last_outlier_official")).alias(
            "outlier_differs"
        ),
        compare.string_diff(ours, F.col("c_last_sysid_official").cast("string")).alias(
            "sysid_differs"
        ),
    )


@query('select "column", cp, count(*) as diffs from o_diffs group by all', dates=())
def quote_diff_checks(fx):
    diffs = comparison.quote_diffs(matched_long(fx), comparison.CELL)
    return diffs.groupBy("column", "cp").agg(F.count(F.lit(1)).alias("diffs"))


@query(
    f"select trade_date, term, time, strike, {_column_diff_sql(COMPARED)} as differing from {WIDE_PAIRS}"
)
def row_column_diff(fx):
    matched = _matched_wide(fx)
    names = comparison.differing_columns(matched, COMPARED)
    return matched.select(*KEYS, F.array_join(names, ",").alias("differing"))


@query(
    f"""select trade_date, term, time, strike, 'Call' as cp, o.c_gamma as ours, f.c_gamma as official from {WIDE_PAIRS} where abs(o.c_gamma - f.c_gamma) > 0.01
union all select trade_date, term, time, strike, 'Put', o.p_gamma, f.p_gamma from {WIDE_PAIRS} where abs(o.p_gamma - f.p_gamma) > 0.01"""
)
def gamma_diff_list(fx):
    return comparison.gamma_diff_list(_matched_wide(fx), KEYS)


@query(
    f"""select coalesce(f.trade_date, o.trade_date) as trade_date, coalesce(f.time, o.time) as time, o.near_sigma2 - f.near_sigma2 as near_sigma2_diff,
 o.next_sigma2 - f.next_sigma2 as next_sigma2_diff, o.published - f.published as published_diff, o.original - f.original as original_diff,
 coalesce(abs(o.near_sigma2 - f.near_sigma2) > 1e-6, false) or coalesce(abs(o.next_sigma2 - f.next_sigma2) > 1e-6, false) or coalesce(abs(o.published - f.published) > 0.01, false)
 or coalesce(abs(o.original - f.original) > 0.01, false) or o.near_type is distinct from f.near_type or o.next_type is distinct from f.next_type as differs from {INDEX_PAIRS}""",
    rounded=("near_sigma2_diff", "next_sigma2_diff", "published_diff", "original_diff"),
)
def index_diff(fx):
    return comparison.index_diff(fx.view("fx_our_index"), fx.view("fx_official_index")).select(
        "trade_date", "time", "near_sigma2_diff", "next_sigma2_diff", "published_diff",
        "original_diff", "differs",
    )


FAILED = " or ".join(
    f"coalesce(abs(o.{c} - f.{c}) > 1e-4, false)"
    for c in ("near_sigma2", "next_sigma2", "published", "original")
)


@query(
    f"""select coalesce(f.trade_date, o.trade_date) as trade_date, count(*) as points, count(*) filter (where {FAILED}) as failed_points,
 count(*) filter (where {FAILED}) = 0 as passed from {INDEX_PAIRS} group by 1"""
)
def index_verify(fx):
    return comparison.index_verify(fx.view("fx_our_index"), fx.view("fx_official_index"))


@query(
    """select trade_date, term, cp, count(*) as compared, count(*) filter (where not coalesce(our_bid = bid, false) or not coalesce(our_ask = ask, false)) as mismatches
from (
 select trade_date, term, 'Call' as cp, o.c_last_bid as our_bid, o.c_last_ask as our_ask, f.snapshot_call_bid as bid, f.snapshot_call_ask as ask
 from fx_ours_wide o join fx_official_wide f using (trade_date, term, time, strike)
 union all select trade_date, term, 'Put', o.p_last_bid, o.p_last_ask, f.snapshot_put_bid, f.snapshot_put_ask
 from fx_ours_wide o join fx_official_wide f using (trade_date, term, time, strike)) x group by all"""
)
def official_snapshot_compare(fx):
    ours = reconciliation.long_measures(fx.view("fx_ours_wide"))
    return comparison.snapshot_compare(ours, fx.view("fx_official_wide"))
