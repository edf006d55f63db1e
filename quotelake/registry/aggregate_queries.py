"""Aggregations over ticks, schedules, contributions and differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.operators import comparison, index_series, reshape, statistics
from quotelake.operators import schedule as scheduling
from quotelake.operators import terms
from quotelake.operators.reshape import SIDE_MEASURES
from quotelake.plans import reconciliation
from quotelake.registry.base import query
from quotelake.registry.views import MEASURES
from quotelake.sources.calendar import calendar_around

KEYS = ["trade_date", "term", "time", "strike"]


@query("select trade_date, yyyymm, term from o_terms")
def near_next_terms(fx):
    return terms.near_next_terms(fx.parsed)


@query("select seqno, term, yyyymm, strike, cp, bid, ask from o_tt", dates=())
def split_terms(fx):
    split = terms.split_terms(fx.parsed, fx.terms)
    return split.select("seqno", "term", "yyyymm", "strike", "cp", "bid", "ask")


@query(
    """select trade_date, term, time, min(snapshot_sysid) as sysid from fx_official_wide group by all"""
)
def snapshot_schedule(fx):
    return scheduling.snapshot_schedule(fx.view("fx_official_wide"))


@query(
    """select trade_date, term, time, max(snapshot_sysid) as sysid from fx_official_wide group by all
union all select trade_date, t.term, '000000', initial_sysid from fx_marker cross join (values ('Near'), ('Next')) t(term)"""
)
def snapshot_schedule_last(fx):
    sides = F.explode(F.array(F.lit("Near"), F.lit("Next"))).alias("term")
    marker = fx.view("fx_marker").select("*", sides)
    return scheduling.snapshot_schedule_last(fx.view("fx_official_wide"), marker)


@query(
    """select distinct w.trade_date, w.term, w.strike from fx_official_wide w join
 (select trade_date, term, min(time) as time from fx_official_wide group by all) f using (trade_date, term, time)"""
)
def template_strikes(fx):
    return scheduling.template_strikes(fx.view("fx_official_wide"))


@query("select trade_date, time, term, contrib_sum, contrib_rows from o_contrib_sum", rounded=("contrib_sum",))
def contrib_sum(fx):
    return index_series.contrib_sum(fx.view("fx_contrib"))


@query(
    """select trade_date, cast(prior_date as varchar) as prior_date, case when prior_date is null then 24.36e0 else prior_close end as prior_close from o_prior"""
)
def prior_close(fx):
    return index_series.prior_close(fx.view("fx_official_index"), seed_close=24.36)


def _diffs(fx):
    from quotelake.registry.comparison_queries import diffs_of

    return diffs_of(fx)


COLUMN_LIST = ", ".join(f"('{c}')" for c in MEASURES.values())


@query(
    f"""select t.term, c.label as "column", t.total, coalesce(d.n, 0) as diffs, case when d.n is null then t.total end as no_diff_rows
from (select term, count(*) as total from o_ours_long group by term) t cross join (values {COLUMN_LIST}) c(label)
left join (select term, "column", count(*) as n from o_diffs group by all) d on d.term = t.term and d."column" = c.label""",
    dates=(),
)
def diff_summary(fx):
    compared = fx.view("fx_ours_wide").groupBy("term").agg((F.count(F.lit(1)) * 2).alias("total"))
    return statistics.diff_summary(_diffs(fx), compared, list(SIDE_MEASURES.values()))


def _matched_wide(fx):
    return comparison.match_inner(fx.view("fx_ours_wide"), fx.view("fx_official_wide"), KEYS)


TOLERANCES = {"c_ema": 1e-4, "p_ema": 1e-4, "c_bid": 0.1, "c_ask": 0.1, "p_bid": 0.1, "p_ask": 0.1}
WIDE_PAIRS = "fx_ours_wide o join fx_official_wide f using (trade_date, term, time, strike)"


@query(
    " union all ".join(
        f"""select '{c}' as "column", count(*) filter (where coalesce(abs(o.{c} - f.{c}) <= {tol}, true)) as matched, count(*) as total,
 count(*) filter (where coalesce(abs(o.{c} - f.{c}) <= {tol}, true)) * 100.0e0 / count(*) as match_percent from {WIDE_PAIRS}"""
        for c, tol in TOLERANCES.items()
    ),
    rounded=("match_percent",), dates=(),
)
def match_rate(fx):
    return statistics.match_rate(_matched_wide(fx), TOLERANCES)


INDEX_PAIRS = "fx_official_index f full join fx_our_index o on o.trade_date = f.trade_date and o.time = f.time"


@query(
    " union all ".join(
        f"""select '{c}' as "column", max(abs(o.{c} - f.{c})) as max_gap, count(*) filter (where abs(o.{c} - f.{c}) > 1e-4) as over_tolerance from {INDEX_PAIRS}"""
        for c in ("near_sigma2", "next_sigma2", "published", "original")
    ),
    rounded=("max_gap",), dates=(),
)
def error_profile(fx):
    return comparison.error_profile(fx.view("fx_our_index"), fx.view("fx_official_index"))


CODES = ["c_last_outlier", "c_min_outlier", "p_last_outlier", "p_min_outlier"]


@query(
    " union all ".join(
        f"""select '{c}' as "column", count(*) filter (where m) as matched, count(*) as total, count(*) filter (where m) * 100.0e0 / count(*) as match_percent
 from (select o.{c} = f.{c} or (o.{c} <> '-' and f.{c} <> '-') as m from {WIDE_PAIRS}) x"""
        for c in CODES
    ),
    rounded=("match_percent",), dates=(),
)
def outlier_match_rate(fx):
    return statistics.outlier_match_rate(_matched_wide(fx), CODES)


COUNTED = ["c_source", "p_source", "c_gamma", "c_last_outlier", "c_min_outlier"]


@query(
    " union all ".join(
        f"""select '{c}' as "column", cast({c} as varchar) as value, count(*) as rows from fx_ours_wide group by all""" for c in COUNTED
    ),
    dates=(),
)
def value_counts(fx):
    return statistics.value_counts(fx.view("fx_ours_wide"), COUNTED)


@query(
    """select term, "column", count(*) as diffs, count(distinct time) as times, count(distinct strike) as strikes, count(*) filter (where ours is null) as ours_missing,
 avg(ours - official) as mean_gap, min(ours - official) as min_gap, max(ours - official) as max_gap from o_diffs group by all""",
    rounded=("mean_gap", "min_gap", "max_gap"), dates=(),
)
def diff_profile(fx):
    return statistics.diff_profile(_diffs(fx))


@query(
    """select term, "column", avg(n) as mean_per_time, max(n) as max_per_time, arg_max(trade_date, o) as peak_date, arg_max(time, o) as peak_time
from (select *, n * 1000000 - row_number() over (partition by term, "column" order by trade_date, time) as o
 from (select term, "column", trade_date, time, count(*) as n from o_diffs group by all) x) y group by all""",
    rounded=("mean_per_time",), dates=("peak_date",),
)
def diff_peaks(fx):
    return statistics.diff_peaks(_diffs(fx))


@query(
    """select trade_date, term, time, strike, cp, string_agg("column", ',' order by "column") as diff_cols from o_diffs group by all"""
)
def diff_columns_list(fx):
    return comparison.diff_columns_list(_diffs(fx))


@query(
    """select trade_date, term, count(*) as total, count(*) filter (where last_valid) as last_valid, count(*) filter (where min_valid) as min_valid,
 count(*) filter (where last_valid) * 100.0e0 / count(*) as last_percent, count(*) filter (where min_valid) * 100.0e0 / count(*) as min_percent from o_snap group by all""",
    rounded=("last_percent", "min_percent"),
)
def validity_stats(fx):
    return statistics.validity_stats(fx.long_quotes)


@query(
    """select c.trade_date, case when w.trade_date is null then 'Skipped' when coalesce(d.n, 0) = 0 then 'Passed' else 'Mismatch' end as status, coalesce(d.n, 0) as diffs
from (select cast(unnest(generate_series(min(trade_date) - interval 7 day, max(trade_date) + interval 7 day, interval 1 day)) as date) as trade_date from fx_official_wide) c
left join (select distinct trade_date from fx_official_wide) w using (trade_date)
left join (select trade_date, count(*) as n from o_diffs group by all) d using (trade_date)"""
)
def daily_verdict(fx):
    days = calendar_around(fx.view("fx_official_wide"))
    return statistics.daily_verdict(days, fx.view("fx_official_wide"), _diffs(fx))


@query(
    """select trade_date, term, count(distinct time) as times, count(distinct strike) as strikes, count(*) as rows,
 count(distinct time) * count(distinct strike) = count(*) as complete from o_wide group by all"""
)
def grid_reconcile(fx):
    return statistics.grid_reconcile(fx.book)


def _sourced(fx):
    """Sides of our series with their source, and how they differ from the official ones."""
    ours, official = fx.view("fx_ours_series"), fx.view("fx_official_series")
    quotes = reshape.unpivot_quotes(ours, KEYS, ["source"])
    return quotes, reconciliation.diff_report(ours, official)


@query(
    """select f.*, coalesce(d.diffs, 0) as diffs, coalesce(d.early, 0) as diffs_before
from o_series_first f left join (
 select trade_date, term, strike, cp, sum(diffs)::bigint as diffs, sum(diffs) filter (where first_time is null or time < first_time)::bigint as early
 from o_series_times left join o_series_first using (trade_date, term, strike, cp) group by all) d using (trade_date, term, strike, cp)"""
)
def first_seen(fx):
    return statistics.first_seen(*_sourced(fx))


@query(
    """select trade_date, term, strike, cp, time, diffs, first_time, first_time is null or time < first_time as before_first
from o_series_times left join o_series_first using (trade_date, term, strike, cp)"""
)
def diffs_by_time(fx):
    return statistics.diffs_by_time(*_sourced(fx))
