"""Views with the shape of the engine's inputs, made from the given tables.

Each text runs unchanged on Spark and on DuckDB. The snapshot step is one hour
here; every row of ``events`` becomes one quote tick.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from quotelake.functions.products import parse_product
from quotelake.operators import schedule, snapshots, terms
from quotelake.session import small_table

#: What a wide row compares, by side.
SERIES_VALUES = ", ".join(
    f"o.{side}_{name}"
    for side in ("c", "p")
    for name in ("ema", "gamma", "bid", "ask", "last_bid", "last_ask", "min_bid", "min_ask")
)

FX = {
    "fx_ticks": """
select ts, event_id + 1 as seqno, cast(ts as date) as trade_date, hour(ts) as hh, minute(ts) as mi,
 lpad(cast(hour(ts) as string), 2, '0') || lpad(cast(minute(ts) as string), 2, '0')
 || lpad(cast(cast(floor(second(ts)) as int) as string), 2, '0') || lpad(cast(k as string), 3, '0') || '000' as tick_time,
 case when user_id % 30 = 29 then 'TXF' else 'TXO' end
 || lpad(cast(20000 + 100*(user_id % 5) as string), 5, '0')
 || substr(case when (user_id % 10) < 5 then 'BCD' else 'NOP' end, cast((user_id % 30 - user_id % 10)/10 as int) + 1, 1) || '4' as prod_id,
 case when event_type = 'error' then -1.0e0 when event_type = 'view' and k < 40 then 0.0e0 else value end as bid,
 case when event_type = 'signup' and k < 30 then 0.0e0 else value + k*k/100.0e0 end as ask
from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from {events}) e""",
    "fx_times": """
select trade_date, lpad(cast(hh as string), 2, '0') || '0000' as time, max(seqno) as sysid
from {fx_ticks} group by trade_date, hh""",
    # The first tick of a day comes before its start marker.
    "fx_marker": """
select trade_date, '000000' as time, min(seqno) as initial_sysid from {fx_ticks} group by trade_date""",
    "fx_contrib": """
select cast(ts as date) as trade_date, lpad(cast(hour(ts) as string), 2, '0') || '0000' as time,
 case when user_id % 2 = 0 then 'Near' else 'Next' end as term,
 cast(20000 + 100*(user_id % 50) as int) as strike,
 case when event_type = 'error' then 'X' else cast(value as string) end as contrib_raw,
 case when event_type = 'error' then null else value/1.0e6 end as contrib
from {events} e where user_id % 7 <> 0""",
    "fx_forward": """
select distinct trade_date, time, term, 20000.0e0 + 10*(day(trade_date) % 7) as tw_fwd, 20000.0e0 as k0
from {fx_contrib} c where not (day(trade_date) % 10 = 0 and time >= '200000')""",
    "fx_sigma": """
select trade_date, time, near_t, near_t + 30/365.0e0 as next_t,
 case when day(trade_date) <= 2 then 1.0e0 else near_t*365.0e0/30 end as near_w,
 case when day(trade_date) <= 2 then 0.0e0 else 1 - near_t*365.0e0/30 end as next_w
from (select trade_date, time, (32 - day(trade_date))/365.0e0 as near_t from {fx_times} t) s""",
    # Official index: nothing published on every seventh day, nothing at all on the tenth.
    "fx_official_index": """
select trade_date, time, 0.02e0 + (sysid % 50)/1.0e4 as near_sigma2, 0.03e0 + (sysid % 70)/1.0e4 as next_sigma2,
 case when sysid % 11 = 0 then 'E' else 'A' end as near_type, case when sysid % 13 = 0 then 'E,I' else 'A' end as next_type,
 case when time < '090000' or day(trade_date) % 7 = 0 or day(trade_date) = 10 then -1.0e0 else 15 + (sysid % 1000)/100.0e0 end as published,
 case when day(trade_date) = 10 then -1.0e0 else 15 + (sysid % 1000)/100.0e0 + 0.004e0 end as original
from {fx_times} t""",
    "fx_our_index": """
select trade_date, time,
 case when time = '040000' then near_sigma2 + 0.00001e0 else near_sigma2 end as near_sigma2,
 case when time = '050000' then null else next_sigma2 end as next_sigma2,
 near_type, case when time = '070000' then 'E' else next_type end as next_type,
 case when time = '110000' then published + 0.02e0 else published end as published,
 case when day(trade_date) = 5 then original + 0.00005e0 else original end as original
from {fx_official_index} i where not (day(trade_date) = 9 and time = '130000')""",
    "fx_official_wide": """
select cast(ts as date) as trade_date, lpad(cast(hour(ts) as string), 2, '0') || '0000' as time,
 case when user_id % 2 = 0 then 'Near' else 'Next' end as term, cast(event_id as int) as strike,
 value as c_ema, value * 2 as p_ema, 1.2e0 as c_gamma, 1.5e0 as p_gamma, value as c_bid, value + k/100.0e0 as c_ask, value * 2 as p_bid, value * 2 + k/50.0e0 as p_ask,
 value as c_last_bid, value + k/100.0e0 as c_last_ask, value * 2 as p_last_bid, value * 2 + k/50.0e0 as p_last_ask,
 case when k % 9 = 0 then null else value end as c_min_bid, case when k % 9 = 0 then null else value + k/200.0e0 end as c_min_ask,
 value * 2 as p_min_bid, value * 2 + k/100.0e0 as p_min_ask,
 case when k % 3 = 0 then 'Q_Min_Valid' when k % 17 = 0 then 'Replacement' else 'Q_Last_Valid' end as c_source,
 case when k % 4 = 0 then null else 'Q_Last_Valid' end as p_source,
 case when k < 5 then '-' when k < 10 then 'V' when k < 60 then '2' else '1,2' end as c_last_outlier,
 case when k < 50 then '-' when k < 70 then 'V' else '1' end as c_min_outlier,
 case when k % 2 = 0 then '-' else '1,2' end as p_last_outlier, case when k % 5 = 0 then '1' else '-' end as p_min_outlier,
 event_id + 1 as c_last_sysid, event_id + 2 as p_last_sysid,
 case when k % 6 = 0 then event_id + 1 else event_id end as c_min_sysid, event_id + 2 as p_min_sysid,
 event_id + 3 as snapshot_sysid,
 case when k % 13 = 0 then value + 1 else value end as snapshot_call_bid, value + k/100.0e0 as snapshot_call_ask, value * 2 as snapshot_put_bid, case when k % 19 = 0 then null else value * 2 + k/50.0e0 end as snapshot_put_ask
from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from {events}) e""",
    "fx_ours_wide": """
select trade_date, time, term, strike, case when strike % 97 = 0 then null else c_ema end as c_ema, p_ema,
 case when strike % 53 = 0 then 2.0e0 else c_gamma end as c_gamma, p_gamma,
 case when strike % 31 = 0 then c_bid + 0.00005e0 else c_bid end as c_bid, c_ask, p_bid,
 case when strike % 101 = 0 then p_ask + 1 else p_ask end as p_ask,
 c_last_bid, c_last_ask, p_last_bid, case when strike % 103 = 0 then 0.0e0 else p_last_ask end as p_last_ask,
 c_min_bid, case when strike % 107 = 0 then null else c_min_ask end as c_min_ask, p_min_bid, p_min_ask,
 case when strike % 59 = 0 then 'Replacement' else c_source end as c_source, p_source,
 case when strike % 41 = 0 then 'V' else c_last_outlier end as c_last_outlier, c_min_outlier, p_last_outlier,
 case when strike % 43 = 0 then '-' else p_min_outlier end as p_min_outlier,
 c_last_sysid, p_last_sysid, c_min_sysid, p_min_sysid, snapshot_sysid
from {fx_official_wide} o where strike % 211 <> 0""",
    # The same rows as series: strikes that come again at other times of a day, some without
    # a sequence number or a source.
    "fx_series": """
select strike as row_id, cast(20000 + 50 * row_number() over (partition by trade_date, term, time order by strike) as int) as strike
from {fx_official_wide} o""",
    "fx_official_series": f"""
select o.trade_date, o.time, o.term, s.strike, {SERIES_VALUES}, o.c_source, o.p_source,
 case when o.strike % 5 = 0 then null else o.c_last_sysid end as c_last_sysid, o.p_last_sysid
from {{fx_official_wide}} o join {{fx_series}} s on o.strike = s.row_id""",
    "fx_ours_series": f"""
select o.trade_date, o.time, o.term, s.strike, {SERIES_VALUES},
 case when o.strike % 4 < 2 then null else o.c_source end as c_source, o.p_source, o.c_last_sysid, o.p_last_sysid
from {{fx_ours_wide}} o join {{fx_series}} s on o.strike = s.row_id""",
    # Sides and rows that one of two sources lacks.
    "fx_one_sided": """
select trade_date, time, strike, 'Call' as cp, c_bid as bid, c_ask as ask from {fx_official_wide} o where strike % 3 <> 0
union all select trade_date, time, strike, 'Put', p_bid, p_ask from {fx_official_wide} o where strike % 3 <> 1""",
    "fx_official_part": "select * from {fx_official_wide} o where strike % 307 <> 0",
    # Contribution lines of alert reports; three months, some lines cut short.
    "fx_alert_rows": """
select trade_date, time, case when term = 'Near' then '202402' when strike % 700 = 0 then '202404' else '202403' end as month,
 case when strike < 22000 then 'OTM' else 'ITM' end as moneyness, strike,
 count(*) as quotes, count(contrib) as counted,
 case when strike % 1100 = 0 then 5 when count(contrib) % 2 = 1 then 17 else 8 end as fields,
 cast(strike % 7 - 3 as string) || '.5%' as pct
from {fx_contrib} c group by trade_date, time, term, strike""",
}


class Fixture:
    """The input tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        if name not in FX:
            return self.table(name)
        text = FX[name]
        inputs = {n: self.view(n) for n in [*FX, "events"] if "{" + n + "}" in text}
        return self.spark.sql(text, **inputs)

    def tick_stream(self) -> DataFrame:
        """The ticks as a stream over the events file, with their timestamp."""
        source = self.spark.readStream.schema(self.table("events").schema)
        events = source.option("pathGlobFilter", "events.parquet").parquet(self.sf_dir)
        return self.spark.sql(FX["fx_ticks"], events=events)

    @cached_property
    def ticks(self) -> DataFrame:
        return self.view("fx_ticks").select(
            "trade_date", "seqno", "tick_time", "prod_id", "bid", "ask"
        )

    @cached_property
    def parsed(self) -> DataFrame:
        return parse_product(self.ticks)

    @cached_property
    def terms(self) -> DataFrame:
        return small_table(terms.near_next_terms(self.parsed))

    @cached_property
    def term_ticks(self) -> DataFrame:
        return terms.split_terms(self.parsed, self.terms)

    @cached_property
    def schedule(self) -> DataFrame:
        return small_table(
            schedule.number_schedule(self.view("fx_times"), self.view("fx_marker"))
        )

    @cached_property
    def strikes(self) -> DataFrame:
        return terms.quoted_strikes(self.term_ticks)

    @cached_property
    def book(self) -> DataFrame:
        return snapshots.snapshot_book(self.term_ticks, self.schedule)

    @cached_property
    def long_quotes(self) -> DataFrame:
        return snapshots.book_to_long(self.book)
