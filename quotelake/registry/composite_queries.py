"""Composite questions, each built from several operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.functions.index_math import round_half_up
from quotelake.operators import exploration, index_series, reshape
from quotelake.operators.index_series import index_series as run_index
from quotelake.plans import questions, quotes, reconciliation
from quotelake.registry.base import query
from quotelake.registry.reshape_queries import WIDE
from quotelake.registry.window_queries import STREAM

SNAPSHOT = [
    "trade_date", "term", "strike", "cp", "time", "snapshot_sysid", "raw_bid", "raw_ask",
    "last_bid", "last_ask", "last_sysid", "last_valid", "last_spread", "last_mid",
    "min_bid", "min_ask", "min_sysid", "min_valid", "min_spread", "min_mid",
]
DERIVED = ("last_spread", "last_mid", "min_spread", "min_mid")


@query(f"select {', '.join(SNAPSHOT)} from o_snap", rounded=DERIVED)
def snapshot_quotes(fx):
    return fx.long_quotes.select(*SNAPSHOT)


@query(f"select {', '.join(WIDE)} from o_wide_filled", rounded=("c_ema", "p_ema"))
def quote_pipeline(fx):
    return quotes.quote_pipeline(fx.ticks, fx.schedule).select(*WIDE)


INDEX = [
    "trade_date", "time", "near_t", "near_w", "near_sigma2", "near_type", "next_t", "next_w",
    "next_sigma2", "next_type", "published", "original", "near_contrib_rows", "next_contrib_rows",
]


@query(
    f"select {', '.join(INDEX)} from o_index",
    rounded=("near_t", "near_w", "near_sigma2", "next_t", "next_w", "next_sigma2", "original"),
)
def index_pipeline(fx):
    return run_index(
        fx.view("fx_sigma"), fx.view("fx_forward"), fx.view("fx_contrib"),
        fx.view("fx_official_index"),
    ).select(*INDEX)


@query('select trade_date, term, time, strike, cp, "column", ours, official, sysid, prev_sysid from o_series_diffs')
def diff_report(fx):
    return reconciliation.diff_report(fx.view("fx_ours_series"), fx.view("fx_official_series"))


@query(
    """select * exclude (r) from (select *, cast(greatest(1, least(2, total_pages)) as integer) as page from (
select *, count(*) over () as total, cast(greatest(1, ceil(count(*) over () / 100.0e0)) as integer) as total_pages,
 row_number() over (order by trade_date, term, time, strike, cp) as r
from (select trade_date, term, time, strike, cp, ema, gamma, bid, ask, coalesce(cols, '') as diff_cols, cols is not null as has_diff
from o_ours_long l left join (select trade_date, term, time, strike, cp, string_agg("column", ',' order by "column") as cols from o_diffs group by all) d
 using (trade_date, term, time, strike, cp) where cp = 'Call') v) n) p where r > (page - 1) * 100 and r <= page * 100"""
)
def full_data_view(fx):
    """Second page of the Call side, as a viewer asks for it."""
    diffs = reconciliation.diff_report(fx.view("fx_ours_wide"), fx.view("fx_official_wide"))
    rows = reconciliation.full_data_view(fx.view("fx_ours_wide"), diffs, cp="Call").select(
        "trade_date", "term", "time", "strike", "cp", "ema", "gamma", "bid", "ask", "diff_cols", "has_diff"
    )
    order = ["trade_date", "term", "time", "strike", "cp"]
    return reshape.page_rows(rows, order, page=2, per_page=100)


@query(
    """select t.seqno, s.idx as snapshot_idx, 'current' as part from o_tt t join o_schedule s on s.trade_date = t.trade_date and t.seqno > s.prev_sysid and t.seqno <= s.sysid
union all select t.seqno, s.idx, 'prev' from o_tt t join o_schedule s on s.trade_date = t.trade_date and t.seqno > s.prev_sysid - 500 and t.seqno <= s.prev_sysid""",
    dates=(),
)
def tick_window(fx):
    return exploration.tick_window(fx.term_ticks, fx.schedule).select("seqno", "snapshot_idx", "part")


ERRORS = (
    "concat_ws(',', case when coalesce(t.bid, 0) < 0 then 'E1' end, "
    "case when coalesce(t.ask, 0) <= coalesce(t.bid, 0) then 'E2' end)"
)


@query(
    f"""select s.*, case when kind = 'tick' then 1 else 0 end as place, t.tick_time, t.bid >= 0 and t.ask > t.bid as is_valid,
 case when t.seqno is null then '' else {ERRORS} end as error_codes
from ({STREAM}) s left join o_tt t on kind = 'tick' and t.trade_date = s.trade_date and t.seqno = s.seqno"""
)
def tick_stream(fx):
    return questions.tick_stream(fx.term_ticks, fx.schedule, quotes.filtered(fx.book))


@query(
    """select w.trade_date, w.term, w.strike, w.time, w.c_ema, w.p_ema, w.c_bid, w.p_ask, w.c_source, b.c_ema as c_ema_prev, b.p_ema as p_ema_prev,
 o.c_ema as c_ema_official, coalesce((w.c_ema is null) <> (o.c_ema is null) or abs(w.c_ema - o.c_ema) > 1e-4, false) as c_ema_differs
from o_wide w left join fx_official_series o on o.trade_date = w.trade_date and o.term = w.term and o.strike = w.strike and o.time = w.time left join o_wide b on b.trade_date = w.trade_date and b.term = w.term and b.strike = w.strike
 and b.time = lpad(cast((cast(substr(w.time, 1, 2) as integer) + 23) % 24 as varchar), 2, '0') || '0000'""",
    rounded=("c_ema", "p_ema", "c_ema_prev", "p_ema_prev", "c_ema_official"),
)
def calc_trace(fx):
    ours = quotes.wide_table(quotes.filtered(fx.book), fill=False)
    return exploration.calc_trace(ours, fx.view("fx_official_series"), step=3600).select(
        "trade_date", "term", "strike", "time", "c_ema", "p_ema", "c_bid", "p_ask", "c_source",
        "c_ema_prev", "p_ema_prev", "c_ema_official", "c_ema_differs",
    )


@query(
    """select trade_date, time, term, strike, contrib_raw, contrib, atm_strike, coalesce(strike = atm_strike, false) as is_atm
from (select *, min(case when contrib is null then strike end) over (partition by trade_date, time, term) as atm_strike from fx_contrib) x where contrib is not null"""
)
def contrib_snapshot(fx):
    return index_series.contrib_snapshot(fx.view("fx_contrib"))


@query(
    """select trade_date, time, case when published > 0 then floor(published * 100 + 0.5) / 100 end as published, floor(original * 100 + 0.5) / 100 as original
from fx_official_index where time >= '090000'"""
)
def index_trend(fx):
    return exploration.index_trend(fx.view("fx_official_index"), round_half_up)


@query(
    """select trade_date, mode, wanted_sysid, start_idx, end_idx, range_start, range_end from (
select r.trade_date, r.mode, r.wanted_sysid, w.start_idx, w.end_idx, coalesce(a.sysid, 0) as range_start, b.sysid as range_end
from (select trade_date, m.mode, initial_sysid + m.ahead as wanted_sysid from fx_marker cross join (values ('center', 40), ('prepend', 90), ('append', 150)) m(mode, ahead)) r
join (select trade_date, mode, wanted_sysid,
  greatest(0, case mode when 'center' then c - 1 when 'prepend' then coalesce(na, 0) - 3 else coalesce(nb, n) end) as start_idx,
  least(n, case mode when 'center' then c + 2 when 'prepend' then coalesce(na, 0) else coalesce(nb, n) + 3 end) as end_idx
 from (select r.trade_date, r.mode, r.wanted_sysid, arg_min(s.idx, abs(s.sysid - r.wanted_sysid) * 1000 + s.idx) as c,
   max(s.idx) filter (where s.sysid <= r.wanted_sysid) as na, min(s.idx) filter (where s.sysid >= r.wanted_sysid) as nb, max(s.idx) as n
  from (select trade_date, m.mode, initial_sysid + m.ahead as wanted_sysid from fx_marker cross join (values ('center', 40), ('prepend', 90), ('append', 150)) m(mode, ahead)) r
  join o_schedule s using (trade_date) group by all) g) w on w.trade_date = r.trade_date and w.mode = r.mode
left join o_schedule a on a.trade_date = r.trade_date and a.idx = w.start_idx - 1
left join o_schedule b on b.trade_date = r.trade_date and b.idx = w.end_idx) z"""
)
def interval_window(fx):
    modes = F.inline(
        F.array(
            *[
                F.struct(F.lit(m).alias("mode"), F.lit(a).alias("ahead"))
                for m, a in (("center", 40), ("prepend", 90), ("append", 150))
            ]
        )
    )
    requests = fx.view("fx_marker").select("trade_date", "initial_sysid", modes)
    requests = requests.select(
        "trade_date", "mode", (F.col("initial_sysid") + F.col("ahead")).alias("wanted_sysid")
    )
    return exploration.interval_window(fx.schedule, requests, lookback=1, lookforward=2)
