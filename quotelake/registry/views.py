"""SQL views the oracles are built from; independent of the Spark operators."""

from __future__ import annotations

import re

from quotelake.registry.fixtures import FX

VALID = "coalesce(bid >= 0 and ask > 0 and ask > bid, false)"

# One step of the quote filter as nested selects over rows that carry the state
# of the step before as p_ema, p_bid, p_ask, p_mid.
STEP = """
select *, case when from_last then last_bid when from_min then min_bid else p_bid end as bid,
 case when from_last then last_ask when from_min then min_ask else p_ask end as ask,
 case when from_last then last_mid when from_min then min_mid else p_mid end as mid,
 case when from_last then 'Q_Last_Valid' when from_min then 'Q_Min_Valid' else 'Replacement' end as source,
 case when from_last then last_gamma when from_min or min_bid is not null then min_gamma else last_gamma end as gamma
from (select *, last_bid is not null and not coalesce(last_flag, false) as from_last,
  not (last_bid is not null and not coalesce(last_flag, false)) and min_bid is not null and not coalesce(min_flag, false) as from_min
 from (select *,
   case when restart or p_ema is null then false when last_bid is null then null else not (l1 or l2 or l3 or l4) end as last_flag,
   case when restart or p_ema is null then false when min_bid is null then null else not (m1 or m2 or m3 or m4) end as min_flag
  from (select *,
    not restart and p_ema is not null and coalesce(last_spread <= last_gamma * ema, false) as l1,
    not restart and p_ema is not null and coalesce(last_spread <= 15, false) as l2,
    not restart and p_ema is not null and coalesce(last_bid > p_mid, false) as l3,
    not restart and p_ema is not null and coalesce(last_ask < p_mid and last_bid > 0, false) as l4,
    not restart and p_ema is not null and coalesce(min_spread <= min_gamma * ema, false) as m1,
    not restart and p_ema is not null and coalesce(min_spread <= 15, false) as m2,
    not restart and p_ema is not null and coalesce(min_bid > p_mid, false) as m3,
    not restart and p_ema is not null and coalesce(min_ask < p_mid and min_bid > 0, false) as m4
   from (select *,
     case when min_spread is null then p_ema when p_ema is null then min_spread else 0.95e0 * p_ema + (1 - 0.95e0) * min_spread end as ema,
     case when last_bid is null or last_bid = 0 then 1.2e0 when p_mid is null then 2.0e0 when last_mid <= p_mid + 1e-9 then 1.5e0 else 2.0e0 end as last_gamma,
     case when min_bid is null or min_bid = 0 then 1.2e0 when p_mid is null then 2.0e0 when min_mid <= p_mid + 1e-9 then 1.5e0 else 2.0e0 end as min_gamma
    from ({source}) s0) s1) s2) s3) s4"""

STEP_COLUMNS = (
    "trade_date, term, strike, cp, idx, time, snapshot_sysid, rn, restart, "
    "last_bid, last_ask, last_sysid, last_spread, last_mid, "
    "min_bid, min_ask, min_sysid, min_spread, min_mid"
)
STEP_RESULTS = (
    "ema, last_gamma, min_gamma, last_flag, min_flag, l1, l2, l3, l4, m1, m2, m3, m4, p_ema, p_mid, "
    "bid, ask, mid, source, gamma"
)


def _numbers(letter: str, exceptions: bool) -> str:
    parts = [f"case when {letter}{i} then '{i}' end" for i in range(1, 5)]
    if exceptions:
        parts += ["case when restart then '5' end",
                  "case when not restart and p_ema is null then '6' end"]
    return f"coalesce(nullif(concat_ws(',', {', '.join(parts)}), ''), '-')"


VIEWS = {name: text.replace("{", "").replace("}", "") for name, text in FX.items()} | {
    "o_parsed": """
select ts, trade_date, seqno, tick_time, prod_id, bid, ask, hh, mi, 'TXO' as product,
 cast(substr(prod_id, 4, 5) as integer) as strike,
 case when strpos('ABCDEFGHIJKL', substr(prod_id, 9, 1)) > 0 then 'Call' else 'Put' end as cp,
 2020 + cast(substr(prod_id, 10, 1) as integer) as year,
 cast((strpos('ABCDEFGHIJKLMNOPQRSTUVWX', substr(prod_id, 9, 1)) - 1) % 12 + 1 as integer) as month,
 cast((2020 + cast(substr(prod_id, 10, 1) as integer)) * 100
  + (strpos('ABCDEFGHIJKLMNOPQRSTUVWX', substr(prod_id, 9, 1)) - 1) % 12 + 1 as integer) as yyyymm
from fx_ticks where prod_id like 'TXO%' and length(prod_id) = 10""",
    "o_terms": """
select trade_date, yyyymm, case when r = 1 then 'Near' else 'Next' end as term
from (select trade_date, yyyymm, row_number() over (partition by trade_date order by yyyymm) as r,
  count(*) over (partition by trade_date) as n
 from (select distinct trade_date, yyyymm from o_parsed) d) x where r <= 2 and n >= 2""",
    "o_tt": "select p.*, t.term from o_parsed p join o_terms t using (trade_date, yyyymm)",
    "o_schedule": """
select s.trade_date, cast(row_number() over w - 1 as integer) as idx, s.time, s.sysid,
 coalesce(lag(s.sysid) over w, m.initial_sysid, 0) as prev_sysid
from fx_times s left join fx_marker m using (trade_date)
window w as (partition by s.trade_date order by s.sysid, s.time)""",
    "o_strikes": "select distinct trade_date, term, strike from o_tt",
    "o_grid": """
select k.trade_date, k.term, k.strike, c.cp, s.idx, s.time, s.sysid, s.prev_sysid
from o_strikes k join o_schedule s using (trade_date) cross join (values ('Call'), ('Put')) c(cp)""",
    "o_valid": f"select * from o_tt where {VALID}",
    "o_raw_asof": """
select g.*, t.bid as raw_bid, t.ask as raw_ask, t.seqno as raw_sysid
from o_grid g asof left join o_tt t on g.trade_date = t.trade_date and g.term = t.term
 and g.strike = t.strike and g.cp = t.cp and g.sysid >= t.seqno""",
    "o_last_asof": """
select g.*, t.bid as last_bid, t.ask as last_ask, t.seqno as last_sysid, t.tick_time as last_time, t.prod_id as last_prod_id
from o_raw_asof g asof left join o_valid t on g.trade_date = t.trade_date and g.term = t.term
 and g.strike = t.strike and g.cp = t.cp and g.sysid >= t.seqno""",
    "o_carry_asof": """
select g.*, t.bid as carry_bid, t.ask as carry_ask, t.seqno as carry_sysid
from o_last_asof g asof left join o_tt t on g.trade_date = t.trade_date and g.term = t.term
 and g.strike = t.strike and g.cp = t.cp and g.prev_sysid >= t.seqno""",
    # Candidates of the smallest spread: valid ticks of the interval and the carried quote.
    "o_candidates": """
select g.trade_date, g.term, g.strike, g.cp, g.idx, t.bid, t.ask, t.seqno
from o_grid g join o_valid t on g.trade_date = t.trade_date and g.term = t.term and g.strike = t.strike
 and g.cp = t.cp and t.seqno > g.prev_sysid and t.seqno <= g.sysid
union all
select trade_date, term, strike, cp, idx, carry_bid, carry_ask, carry_sysid from o_carry_asof
where carry_bid >= 0 and carry_ask > 0 and carry_ask > carry_bid""",
    "o_least": """
select * exclude (r) from (select *, row_number() over (partition by trade_date, term, strike, cp, idx
  order by round(ask - bid, 8), seqno desc) as r from o_candidates) x where r = 1""",
    "o_snap": """
select c.trade_date, c.term, c.strike, c.cp, c.idx, c.time, c.sysid as snapshot_sysid,
 raw_bid, raw_ask, raw_sysid, carry_bid, carry_ask, carry_sysid,
 last_bid, last_ask, last_sysid, last_time, last_prod_id,
 m.bid as min_bid, m.ask as min_ask, m.seqno as min_sysid,
 last_bid is not null as last_valid, m.bid is not null as min_valid,
 last_ask - last_bid as last_spread, (last_bid + last_ask) / 2 as last_mid,
 m.ask - m.bid as min_spread, (m.bid + m.ask) / 2 as min_mid
from o_carry_asof c left join o_least m using (trade_date, term, strike, cp, idx)""",
    "o_steps": """
select *, rn = 1 or time = '090000' as restart from (select *, row_number() over
 (partition by trade_date, term, strike, cp order by idx) as rn from o_snap) x""",
    "o_fold": f"""
select {STEP_COLUMNS}, {STEP_RESULTS} from ({STEP.format(source='''
 select *, cast(null as double) as p_ema, cast(null as double) as p_bid, cast(null as double) as p_ask,
  cast(null as double) as p_mid from o_steps where rn = 1''')}) a
union all
select {STEP_COLUMNS}, {STEP_RESULTS} from ({STEP.format(source='''
 select b.*, case when not b.restart then f.ema end as p_ema, case when not b.restart then f.bid end as p_bid,
  case when not b.restart then f.ask end as p_ask, case when not b.restart then f.mid end as p_mid
 from o_fold f join o_steps b on b.trade_date = f.trade_date and b.term = f.term and b.strike = f.strike
  and b.cp = f.cp and b.rn = f.rn + 1''')}) b""",
    "o_filtered": f"""
select *, case when last_flag is null then '-' when last_flag then 'V' else {_numbers('l', True)} end as last_outlier,
 case when min_flag is null then '-' when min_flag then 'V'
  when coalesce(min_sysid, 0) = coalesce(last_sysid, 0) and coalesce(min_sysid, 0) <> 0 then '-'
  else {_numbers('m', False)} end as min_outlier
from o_fold""",
    "o_wide": """
select trade_date, term, strike, time, max(snapshot_sysid) as snapshot_sysid, """
    + ", ".join(
        f"max(case when cp = '{cp}' then {m} end) as {p}_{m}"
        for cp, p in (("Call", "c"), ("Put", "p"))
        for m in ("bid", "ask", "source", "last_bid", "last_ask", "last_sysid", "last_outlier",
                  "min_bid", "min_ask", "min_sysid", "min_outlier", "ema", "gamma")
    )
    + " from o_filtered group by all",
    "o_wide_filled": "select * replace ("
    + ", ".join(
        f"coalesce({p}_{m}, 0) as {p}_{m}"
        for p in ("c", "p")
        for m in ("bid", "ask", "last_bid", "last_ask", "min_bid", "min_ask", "ema")
    )
    + ") from o_wide",
    # Index.
    "o_contrib_sum": """
select trade_date, time, term, sum(contrib) as contrib_sum, count(*) as contrib_rows
from fx_contrib group by all""",
    "o_spine": """
select s.trade_date, s.time, s.near_t, s.near_w, s.next_t, s.next_w,
 fn.tw_fwd as near_tw_fwd, fn.k0 as near_k0, fx.tw_fwd as next_tw_fwd, fx.k0 as next_k0,
 cn.contrib_sum as near_contrib_sum, coalesce(cn.contrib_rows, 0) as near_contrib_rows,
 cx.contrib_sum as next_contrib_sum, coalesce(cx.contrib_rows, 0) as next_contrib_rows
from fx_sigma s
left join fx_forward fn on fn.trade_date = s.trade_date and fn.time = s.time and fn.term = 'Near'
left join fx_forward fx on fx.trade_date = s.trade_date and fx.time = s.time and fx.term = 'Next'
left join o_contrib_sum cn on cn.trade_date = s.trade_date and cn.time = s.time and cn.term = 'Near'
left join o_contrib_sum cx on cx.trade_date = s.trade_date and cx.time = s.time and cx.term = 'Next'""",
    "o_variance": "select *, "
    + ", ".join(
        f"""case when {n}_t <= 0 or {n}_contrib_rows = 0 then -1.0e0
  when 2.0e0 / {n}_t * coalesce({n}_contrib_sum, 0) - 1.0e0 / {n}_t * ({n}_tw_fwd / {n}_k0 - 1) * ({n}_tw_fwd / {n}_k0 - 1) <= 0 then -1.0e0
  else 2.0e0 / {n}_t * coalesce({n}_contrib_sum, 0) - 1.0e0 / {n}_t * (({n}_tw_fwd / {n}_k0 - 1) * ({n}_tw_fwd / {n}_k0 - 1)) end as {n}_sigma2"""
        for n in ("near", "next")
    )
    + " from o_spine",
    "o_typed": "select *, "
    + ", ".join(
        f"case when {n}_sigma2 is null or {n}_sigma2 <= 0 then 'E' when {n}_contrib_rows < 2 then 'E,I' else 'A' end as {n}_type"
        for n in ("near", "next")
    )
    + """, case when near_sigma2 > 0 and next_sigma2 > 0 and near_w < 1
  then sqrt((near_t * near_sigma2 * near_w + next_t * next_sigma2 * next_w) * (31536000.0e0 / 2592000.0e0)) * 100
  when near_sigma2 > 0 then sqrt(near_sigma2) * 100 end as computed
from o_variance""",
    "o_close": """
select trade_date, coalesce(arg_max(published, time) filter (where published > 0),
 arg_max(original, time) filter (where original > 0)) as close from fx_official_index group by trade_date""",
    "o_prior": """
select trade_date, lag(trade_date) over (order by trade_date) as prior_date,
 lag(close) over (order by trade_date) as prior_close from o_close""",
    "o_original": """
select t.*, p.prior_close, coalesce(last_value(t.computed ignore nulls) over (partition by t.trade_date order by t.time
  rows between unbounded preceding and current row), p.prior_close) as original,
 row_number() over (partition by t.trade_date order by t.time) as rn
from o_typed t left join o_prior p using (trade_date)""",
    "o_publish_seed": """
select trade_date, 0 as rn, prior_close as prev, 0 as jumps, false as opened, cast(null as double) as published
from o_original where rn = 1""",
    "o_publish": """
select trade_date, rn, prev, jumps, opened, published from o_publish_seed
union all
select trade_date, rn,
 case when accept then r2 else prev end as prev,
 case when held then jumps + 1 when not early and opened and not usable then jumps else 0 end as jumps,
 opened or not early as opened,
 case when accept then r2 when held then prev when not early and opened and not usable and prev > 0 then prev else -1.0e0 end as published
from (select *, usable and not early and not held as accept from (select *,
  not early and opened and usable and is_jump and jumps + 1 < 4 as held from (
   select o.trade_date, o.rn, f.prev, f.jumps, f.opened, o.time < '090000' as early,
    coalesce(o.original > 0, false) as usable, round_even(o.original * 100, 0) / 100 as r2,
    coalesce(f.prev > 0 and abs(o.original - f.prev) / f.prev > 0.025, false) as is_jump
   from o_publish f join o_original o on o.trade_date = f.trade_date and o.rn = f.rn + 1) a) b) c""",
    "o_index": """
select o.trade_date, o.time, near_t, near_w, near_sigma2, near_type, next_t, next_w, next_sigma2, next_type,
 p.published, case when o.original > 0 then o.original else -1.0e0 end as original, near_contrib_rows, next_contrib_rows
from o_original o join o_publish p on p.trade_date = o.trade_date and p.rn = o.rn""",
}

# Long forms of the official and the computed wide fixture, and their differences.
MEASURES = {
    "ema": "EMA", "gamma": "Gamma", "bid": "Q_hat_Bid", "ask": "Q_hat_Ask",
    "last_bid": "Q_Last_Bid", "last_ask": "Q_Last_Ask", "min_bid": "Min_Bid", "min_ask": "Min_Ask",
}


def _long(view: str) -> str:
    return " union all ".join(
        f"select trade_date, term, time, strike, '{cp}' as cp, {p}_last_sysid as last_sysid, "
        + ", ".join(f"{p}_{m} as {m}" for m in MEASURES)
        + f" from {view}"
        for cp, p in (("Call", "c"), ("Put", "p"))
    )


VIEWS |= {
    "o_official_long": _long("fx_official_wide"),
    "o_ours_long": _long("fx_ours_wide"),
    "o_official_prev": """
select *, coalesce(lag(last_sysid) over (partition by trade_date, term, strike % 50, cp order by time, strike), 0) as prev_sysid
from o_official_long""",
    "o_matched_long": """
select o.trade_date, o.term, o.time, o.strike, o.cp, f.last_sysid as sysid, f.prev_sysid, """
    + ", ".join(f"o.{m} as {m}_ours, f.{m} as {m}_official" for m in MEASURES)
    + """ from o_ours_long o join o_official_prev f using (trade_date, term, time, strike, cp)""",
    "o_diffs": " union all ".join(
        f"select trade_date, term, time, strike, cp, sysid, prev_sysid, '{label}' as \"column\", "
        f"{m}_ours as ours, {m}_official as official from o_matched_long "
        f"where ({m}_ours is null) <> ({m}_official is null) or abs({m}_ours - {m}_official) > 1e-4"
        for m, label in MEASURES.items()
    ),
    "o_alert_rows": "select * from fx_alert_rows",
    "o_ours_series": _long("fx_ours_series"),
    "o_series_prev": f"""
select *, coalesce(lag(coalesce(last_sysid, 0)) over (partition by trade_date, term, strike, cp order by time), 0) as prev_sysid
from ({_long("fx_official_series")}) x""",
    "o_series_matched": """
select o.trade_date, o.term, o.time, o.strike, o.cp, f.last_sysid as sysid, f.prev_sysid, """
    + ", ".join(f"o.{m} as {m}_ours, f.{m} as {m}_official" for m in MEASURES)
    + """ from o_ours_series o join o_series_prev f using (trade_date, term, time, strike, cp)""",
    "o_series_diffs": " union all ".join(
        f"select trade_date, term, time, strike, cp, sysid, prev_sysid, '{label}' as \"column\", "
        f"{m}_ours as ours, {m}_official as official from o_series_matched "
        f"where ({m}_ours is null) <> ({m}_official is null) or abs({m}_ours - {m}_official) > 1e-4"
        for m, label in MEASURES.items()
    ),
    "o_series_first": " union all ".join(
        f"""select trade_date, term, strike, '{cp}' as cp, min(time) filter (where {p}_source is not null) as first_time,
 count(*) filter (where {p}_source is null) as times_without from fx_ours_series group by all"""
        for cp, p in (("Call", "c"), ("Put", "p"))
    ),
    "o_series_times": """
select trade_date, term, strike, cp, time, count(*) as diffs from o_series_diffs group by all""",
}

RECURSIVE = ("o_fold", "o_publish")


def _used(text: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\b(?:fx|o)_\w+", text)) if n in VIEWS]


def with_views(sql: str) -> str:
    """Put the views a statement needs in front of it, in order of use."""
    ordered: list[str] = []

    def visit(name: str, path: tuple = ()):
        if name in ordered or name in path:
            return
        for inner in _used(VIEWS[name]):
            visit(inner, (*path, name))
        ordered.append(name)

    for name in _used(sql):
        visit(name)
    if not ordered:
        return sql
    word = "with recursive" if any(n in RECURSIVE for n in ordered) else "with"
    return f"{word} " + ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in ordered) + "\n" + sql
