"""Windows and sequential operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.config import EngineConfig
from quotelake.operators import comparison, exploration, filtering, index_series, intervals
from quotelake.plans import quotes, reconciliation
from quotelake.registry.base import query

CELL = ["trade_date", "term", "strike", "cp", "idx"]
SERIES = ["trade_date", "term", "strike", "cp"]


@query("select trade_date, term, time, strike, cp, last_sysid, prev_sysid from o_series_prev")
def prev_sysid(fx):
    rows = reconciliation.long_measures(fx.view("fx_official_series"))
    found = comparison.prev_sysid(rows, SERIES)
    return found.select("trade_date", "term", "time", "strike", "cp", "last_sysid", "prev_sysid")


@query("select trade_date, term, strike, cp, idx, time, min_spread, ema from o_fold", rounded=("min_spread", "ema"))
def ema_spread(fx):
    rows = filtering.ema_spread(fx.long_quotes, SERIES, "idx")
    return rows.select(*CELL, "time", "min_spread", "ema")


FILTERED = [
    "time", "ema", "last_gamma", "min_gamma", "last_flag", "min_flag", "last_outlier", "min_outlier",
    "bid", "ask", "mid", "source", "gamma",
]


@query(
    f"select {', '.join([*CELL, *FILTERED])} from o_filtered",
    rounded=("ema", "bid", "ask", "mid"),
)
def filtered_quote(fx):
    return quotes.filtered_long(fx.book).select(*CELL, *FILTERED)


@query("select trade_date, term, strike, cp, idx, restart from o_steps")
def session_restart_flag(fx):
    flag = filtering.session_restart(SERIES, "idx", F.col("time"))
    return fx.long_quotes.select(*CELL, flag.alias("restart"))


def _computed(fx):
    from quotelake.registry.join_queries import spine_inputs

    variances = index_series.with_variances(spine_inputs(fx))
    closes = index_series.prior_close(fx.view("fx_official_index"))
    return index_series.with_computed_index(variances).join(
        closes.select("trade_date", "prior_close"), "trade_date", "left"
    )


@query("select trade_date, time, computed, original from o_original", rounded=("computed", "original"))
def index_locf(fx):
    return index_series.index_locf(_computed(fx)).select(
        "trade_date", "time", "computed", "original"
    )


@query(
    "select o.trade_date, o.time, o.original, p.published from o_original o join o_publish p on p.trade_date = o.trade_date and p.rn = o.rn",
    rounded=("original",),
)
def publish_filter(fx):
    series = index_series.index_locf(_computed(fx)).select(
        "trade_date", "time", "original", "prior_close"
    )
    return index_series.publish_filter(series).select("trade_date", "time", "original", "published")


@query(
    """select trade_date, term, series, cp, time, lag(time) over w as prev_diff, lead(time) over w as next_diff
from (select distinct trade_date, term, strike % 50 as series, cp, time from o_diffs) x window w as (partition by trade_date, term, series, cp order by time)"""
)
def next_prev_diff(fx):
    from quotelake.registry.comparison_queries import diffs_of

    rows = diffs_of(fx).withColumn("series", F.col("strike") % 50)
    return exploration.next_prev_diff(rows, ["trade_date", "term", "series", "cp"])


@query(
    """select trade_date, idx, time, lag(time) over w as prev_time, lead(time) over w as next_time from o_schedule window w as (partition by trade_date order by idx)"""
)
def adjacent_time(fx):
    return exploration.adjacent_time(fx.schedule).select(
        "trade_date", "idx", "time", "prev_time", "next_time"
    )


PLACED = "(select t.*, greatest(coalesce(s.idx, 0), 0) as idx from o_tt t left join o_schedule s on s.trade_date = t.trade_date and t.seqno > s.prev_sysid and t.seqno <= s.sysid)"
TICK_OK = "bid >= 0 and ask > bid"
TAGS = f"""(select *, case when valid and seqno = max(case when valid then seqno end) over g then 'LAST' end as l,
 case when valid and row_number() over (partition by trade_date, term, strike, cp, idx, valid order by ask - bid, seqno) = 1 then 'MIN' end as m
from (select *, {TICK_OK} as valid from {PLACED} p) v window g as (partition by trade_date, term, strike, cp, idx))"""


def _placed(fx):
    return intervals.assign_intervals(fx.term_ticks, fx.schedule).withColumn(
        "idx", F.greatest("idx", F.lit(0))
    )


@query(
    f"select seqno, idx, valid as is_valid, concat_ws(',', l, m) as tags from {TAGS} t", dates=()
)
def last_min_tags(fx):
    return exploration.last_min_tags(_placed(fx)).select(
        "seqno", "idx", "is_valid", F.array_join("tags", ",").alias("tags")
    )


STREAM = f"""select t.trade_date, t.term, t.strike, t.cp, t.seqno, 'tick' as kind, t.bid, t.ask, concat_ws(',', t.l, t.m) as tags, null as source,
 case when t.l is not null then f.last_outlier end as last_outlier, case when t.m is not null then f.min_outlier end as min_outlier
from {TAGS} t left join o_schedule s on s.trade_date = t.trade_date and s.idx = t.idx
left join o_filtered f on f.trade_date = t.trade_date and f.term = t.term and f.strike = t.strike and f.cp = t.cp
 and f.idx = case when t.seqno = s.sysid then t.idx else t.idx - 1 end
union all select trade_date, term, strike, cp, snapshot_sysid, 'snapshot', null, null, '', source, last_outlier, min_outlier from o_filtered"""


@query(STREAM)
def tick_snapshot_interleave(fx):
    verdicts = quotes.filtered_long(fx.book)
    found = exploration.tick_snapshot_interleave(
        exploration.last_min_tags(_placed(fx)), fx.schedule, verdicts
    )
    return found.drop("place", "tick_time", "is_valid", "error_codes")


HOUR = EngineConfig(step_seconds=3600)
CLOCK = "(cast(substr({c}, 1, 2) as integer) * 3600 + cast(substr({c}, 3, 2) as integer) * 60 + cast(substr({c}, 5, 2) as integer)) * cast(1000000 as bigint)"


@query(
    f"""select seqno, snapshot_idx, in_window, seqno = max(seqno) over g as is_last,
 coalesce(in_window and row_number() over (partition by trade_date, term, strike, cp, snapshot_idx, in_window order by ask - bid, seqno desc) = 1, false) as is_min
from (select t.*, s.idx as snapshot_idx, t.micros >= s.micros - 1800000000 as in_window
 from (select *, {CLOCK.format(c='tick_time')} + cast(substr(tick_time, 7, 6) as integer) as micros from {PLACED} p) t
 join (select *, {CLOCK.format(c='time')} as micros from o_schedule) s on s.trade_date = t.trade_date and t.seqno <= s.sysid and t.micros >= s.micros - 2400000000) x
window g as (partition by trade_date, term, strike, cp, snapshot_idx)""",
    dates=(),
)
def audit_window(fx):
    placed = intervals.assign_intervals(fx.term_ticks, fx.schedule)
    seen = exploration.audit_window(placed, fx.schedule, lookback=2400, window=1800, cfg=HOUR)
    return seen.select("seqno", "snapshot_idx", "in_window", "is_last", "is_min")


@query(
    """select trade_date, time, term, strike, contrib_raw, case when mx > 0 and coalesce(contrib, 0) > 0 then least(100.0e0, greatest(1.0e0, contrib / mx * 100)) else 0.0e0 end as share
from (select *, max(coalesce(contrib, 0)) over (partition by trade_date, time, term) as mx from fx_contrib) x""",
    rounded=("share",),
)
def contrib_share(fx):
    rows = index_series.contrib_share(fx.view("fx_contrib"))
    return rows.select("trade_date", "time", "term", "strike", "contrib_raw", "share")
