"""Joins: products, intervals, as-of, template, pairing and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.functions import products
from quotelake.operators import comparison, exploration, index_series, intervals, reshape
from quotelake.operators import schedule as scheduling
from quotelake.operators import snapshots, terms
from quotelake.plans import reconciliation
from quotelake.registry.base import query
from quotelake.session import small_table

CELL = ["trade_date", "term", "strike", "cp", "idx"]


def spine_inputs(fx):
    return index_series.spine_lookup(
        fx.view("fx_sigma"), fx.view("fx_forward"), fx.view("fx_contrib")
    )


@query("select seqno, prod_id, strike, cp, yyyymm, bid, ask from o_parsed", dates=())
def enrich_products(fx):
    dimension = small_table(products.parse_product(fx.ticks.select("prod_id").distinct()))
    return terms.enrich_products(fx.ticks, dimension).select(
        "seqno", "prod_id", "strike", "cp", "yyyymm", "bid", "ask"
    )


@query(
    """select t.seqno, t.term, t.strike, t.cp, s.idx, s.time, s.prev_sysid as low, s.sysid as high
from o_tt t join o_schedule s on s.trade_date = t.trade_date and t.seqno > s.prev_sysid and t.seqno <= s.sysid""",
    dates=(),
)
def interval_join(fx):
    placed = intervals.interval_join(fx.term_ticks, fx.schedule)
    return placed.select("seqno", "term", "strike", "cp", "idx", "time", "low", "high")


@query("select trade_date, term, strike, cp, idx, time, raw_bid, raw_ask, raw_sysid from o_raw_asof")
def asof_last(fx):
    found = snapshots.asof_last(fx.term_ticks, fx.schedule)
    return found.select(*CELL, "time", "raw_bid", "raw_ask", "raw_sysid")


@query("select trade_date, term, strike, cp, idx, time, sysid, prev_sysid from o_grid")
def grid_template(fx):
    return scheduling.grid_template(fx.schedule, fx.strikes)


@query(
    """select coalesce(c.trade_date, p.trade_date) as trade_date, coalesce(c.time, p.time) as time, coalesce(c.strike, p.strike) as strike,
 c.bid as c_bid, c.ask as c_ask, p.bid as p_bid, p.ask as p_ask
from (select * from fx_one_sided where cp = 'Call') c
full join (select * from fx_one_sided where cp = 'Put') p
 on c.trade_date = p.trade_date and c.time = p.time and c.strike = p.strike"""
)
def pair_call_put(fx):
    return reshape.pair_call_put(fx.view("fx_one_sided"), ["trade_date", "time", "strike"], ["bid", "ask"])


@query(
    """select trade_date, term, time, strike, cp, ema_ours, ema_official, bid_ours, bid_official from o_matched_long"""
)
def match_inner(fx):
    cell = ["trade_date", "term", "time", "strike", "cp"]
    side = lambda view: reconciliation.long_measures(fx.view(view)).select(
        *cell, "ema", "bid"
    ).withColumn("time", comparison.int_key(F.col("time")))
    matched = comparison.match_inner(side("fx_ours_wide"), side("fx_official_wide"), cell)
    return matched.withColumn("time", F.lpad(F.col("time").cast("string"), 6, "0"))


INDEX_PAIRS = "fx_official_index f full join fx_our_index o on o.trade_date = f.trade_date and o.time = f.time"


@query(
    f"""select coalesce(f.trade_date, o.trade_date) as trade_date, coalesce(f.time, o.time) as time, o.near_sigma2 as near_sigma2_ours,
 f.near_sigma2 as near_sigma2_official, o.published as published_ours, f.published as published_official from {INDEX_PAIRS}"""
)
def match_outer(fx):
    pairs = comparison.match_outer(
        fx.view("fx_our_index"), fx.view("fx_official_index"), ["trade_date", "time"]
    )
    return pairs.select(
        "trade_date", "time", "near_sigma2_ours", "near_sigma2_official",
        "published_ours", "published_official",
    )


@query(
    """select trade_date, time, near_t, near_w, near_tw_fwd, near_k0, next_tw_fwd, next_k0, near_contrib_sum, next_contrib_sum,
 cast(near_contrib_rows as bigint) as near_contrib_rows, cast(next_contrib_rows as bigint) as next_contrib_rows from o_spine""",
    rounded=("near_t", "near_w", "near_contrib_sum", "next_contrib_sum"),
)
def spine_lookup(fx):
    return spine_inputs(fx).select(
        "trade_date", "time", "near_t", "near_w", "near_tw_fwd", "near_k0", "next_tw_fwd", "next_k0",
        "near_contrib_sum", "next_contrib_sum", "near_contrib_rows", "next_contrib_rows",
    )


OURS_DIFFS = """o_ours_long l left join (select trade_date, term, time, strike, cp, string_agg("column", ',' order by "column") as cols
 from o_diffs group by all) d using (trade_date, term, time, strike, cp)"""


@query(
    f"""select trade_date, term, time, strike, cp, ema, gamma, bid, coalesce(cols, '') as diff_cols, cols is not null as has_diff from {OURS_DIFFS}"""
)
def diff_mark(fx):
    from quotelake.registry.comparison_queries import diffs_of

    rows = reconciliation.full_data_view(fx.view("fx_ours_wide"), diffs_of(fx))
    return rows.select(
        "trade_date", "term", "time", "strike", "cp", "ema", "gamma", "bid", "diff_cols", "has_diff"
    )


@query(
    """select trade_date, term, time, strike, 'official' as only_in from fx_official_part f where not exists
 (select 1 from fx_ours_wide o where o.trade_date = f.trade_date and o.term = f.term and o.time = f.time and o.strike = f.strike)
union all select trade_date, term, time, strike, 'ours' from fx_ours_wide o where not exists
 (select 1 from fx_official_part f where o.trade_date = f.trade_date and o.term = f.term and o.time = f.time and o.strike = f.strike)"""
)
def strike_set_difference(fx):
    return comparison.strike_set_difference(fx.view("fx_ours_wide"), fx.view("fx_official_part"))


@query(
    """select trade_date, term, time, strike, c_source, p_source from fx_ours_wide o where exists
 (select 1 from o_diffs d where d.trade_date = o.trade_date and d.term = o.term and d.time = o.time and d.strike = o.strike)"""
)
def diff_semi(fx):
    from quotelake.registry.comparison_queries import diffs_of

    rows = comparison.diff_semi(fx.view("fx_ours_wide"), diffs_of(fx))
    return rows.select("trade_date", "term", "time", "strike", "c_source", "p_source")


@query(
    """select seqno, arg_min(idx, gap) as nearest_idx from (select t.seqno, s.idx, abs(t.seqno - s.sysid) * 100 + s.idx as gap
 from fx_ticks t join o_schedule s using (trade_date)) x group by seqno""",
    dates=(),
)
def nearest_snapshot(fx):
    return intervals.nearest_snapshot(fx.ticks, fx.schedule).select("seqno", "nearest_idx")


COMPARED = ["c_ema", "p_ema", "c_gamma", "c_bid", "c_ask", "p_bid", "p_ask", "c_last_outlier"]


def _column_diff_sql(columns: list[str]) -> str:
    parts = ", ".join(
        f"case when case when o.{c} is null or f.{c} is null then o.{c} is distinct from f.{c} "
        + (f"else o.{c} <> f.{c} end" if c.endswith("outlier") else f"else abs(o.{c} - f.{c}) > 1e-5 end")
        + f" then '{c}' end"
        for c in columns
    )
    return f"concat_ws(',', {parts})"


@query(
    f"""select trade_date, term, time, strike, o.c_ema as c_ema_ours, f.c_ema as c_ema_official, {_column_diff_sql(COMPARED)} as differing
from fx_ours_wide o join fx_official_wide f using (trade_date, term, time, strike)"""
)
def row_compare_lookup(fx):
    keys = ["trade_date", "term", "time", "strike"]
    matched = comparison.match_inner(fx.view("fx_ours_wide"), fx.view("fx_official_wide"), keys)
    differing = F.array_join(comparison.differing_columns(matched, COMPARED), ",")
    return matched.select(*keys, "c_ema_ours", "c_ema_official", differing.alias("differing"))


@query(
    """select seqno, (select 1) as one, centre_idx, idx from (select t.seqno, t.idx, c.idx as centre_idx from
 (select t.*, s.idx from o_tt t join o_schedule s on s.trade_date = t.trade_date and t.seqno > s.prev_sysid and t.seqno <= s.sysid) t
 join o_schedule c on c.trade_date = t.trade_date and t.idx between c.idx - 1 and c.idx + 1) x""",
    dates=(),
)
def neighbour_intervals(fx):
    placed = intervals.assign_intervals(fx.term_ticks, fx.schedule)
    around = exploration.neighbour_intervals(placed, fx.schedule, before=1, after=1)
    return around.select("seqno", F.lit(1).alias("one"), "centre_idx", "idx")


@query(
    """select trade_date, term, strike, cp, idx, time, last_bid, last_ask, last_sysid, last_time, last_prod_id, raw_sysid from o_snap"""
)
def locf_valid_last(fx):
    return fx.long_quotes.select(
        *CELL, "time", "last_bid", "last_ask", "last_sysid", "last_time", "last_prod_id", "raw_sysid"
    )


@query("select trade_date, term, strike, cp, idx, carry_bid, carry_ask, carry_sysid from o_carry_asof")
def carry_in_quote(fx):
    return fx.long_quotes.select(*CELL, "carry_bid", "carry_ask", "carry_sysid")


@query(
    "select trade_date, term, strike, cp, idx, min_bid, min_ask, min_spread, min_sysid from o_snap",
    rounded=("min_spread",),
)
def min_spread_quote(fx):
    return snapshots.min_spread_quote(fx.term_ticks, fx.schedule, fx.strikes).drop("time")


@query(
    """select trade_date, term, strike, cp, idx, arg_max(bid, seqno) as last_bid, arg_max(ask, seqno) as last_ask, max(seqno) as last_sysid,
 arg_max(tick_time, seqno) as last_time from (select t.*, s.idx from o_tt t join o_schedule s on s.trade_date = t.trade_date and t.seqno > s.prev_sysid and t.seqno <= s.sysid) p group by all"""
)
def last_quote(fx):
    placed = intervals.assign_intervals(fx.term_ticks, fx.schedule).where("idx >= 0")
    return snapshots.last_quote(placed, CELL)


TARGET = "(select trade_date, max(sysid) filter (where idx = 12) as sysid, max(sysid) filter (where idx = 11) as prev_sysid from o_schedule group by trade_date) g"


@query(
    f"""select k.trade_date, k.term, k.strike, c.cp, l.last_bid, l.last_ask, l.last_sysid, m.bid as min_bid, m.ask as min_ask, m.seqno as min_sysid
from o_strikes k cross join (values ('Call'), ('Put')) c(cp)
left join (select t.trade_date, t.term, t.strike, t.cp, arg_max(bid, seqno) as last_bid, arg_max(ask, seqno) as last_ask, max(seqno) as last_sysid
 from o_tt t join {TARGET} on g.trade_date = t.trade_date and t.seqno <= g.sysid group by all) l on l.trade_date = k.trade_date and l.term = k.term and l.strike = k.strike and l.cp = c.cp
left join (select *, row_number() over (partition by trade_date, term, strike, cp order by round(ask - bid, 8), seqno desc) as r from
 (select t.*, max(case when t.seqno <= g.prev_sysid then t.seqno end) over (partition by t.trade_date, t.term, t.strike, t.cp) as first_seq
  from o_tt t join {TARGET} on g.trade_date = t.trade_date and t.seqno <= g.sysid) a where seqno >= coalesce(first_seq, 0)) m
 on m.r = 1 and m.trade_date = k.trade_date and m.term = k.term and m.strike = k.strike and m.cp = c.cp"""
)
def min_spread_simple(fx):
    at = lambda i: F.max(F.when(F.col("idx") == i, F.col("sysid")))
    target = fx.schedule.groupBy("trade_date").agg(
        at(12).alias("sysid"), at(11).alias("prev_sysid")
    )
    return snapshots.snapshot_at(fx.term_ticks, target, fx.strikes).drop("min_spread")
