"""Streaming versions, run to the end of the given data and compared with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.functions.products import parse_product
from quotelake.operators.filtering import filtered_to_long, with_outlier_codes
from quotelake.registry.base import query
from quotelake.registry.views import VALID
from quotelake.session import new_path
from quotelake.streaming import filtered, runs, snapshots

STEPS = f"""
select date_trunc('hour', ts) as h, prod_id, struct_pack(b := arg_max(bid, seqno), a := arg_max(ask, seqno), s := max(seqno)) as raw,
 case when count(*) filter (where {VALID}) > 0 then struct_pack(b := arg_max(bid, seqno) filter (where {VALID}), a := arg_max(ask, seqno) filter (where {VALID}), s := max(seqno) filter (where {VALID})) end as valid
from o_parsed group by all"""
LEAST = f"""
select date_trunc('hour', ts) as h, prod_id, struct_pack(b := bid, a := ask, s := seqno) as least
from o_parsed where {VALID} qualify row_number() over (partition by date_trunc('hour', ts), prod_id order by round(ask - bid, 8), seqno desc) = 1"""
GRID = """
select prod_id, d, unnest(generate_series(first, d + interval 23 hour, interval 1 hour)) as h
from (select prod_id, date_trunc('day', h) as d, min(h) as first from steps group by all)"""
CARRIED = """
select *, lag(raw) over (partition by prod_id, d order by h) as carry
from (select prod_id, d, h, last_value(raw ignore nulls) over w as raw, last_value(valid ignore nulls) over w as valid, least
 from (select * from ({grid}) left join steps using (prod_id, h) left join ({least}) using (prod_id, h))
 window w as (partition by prod_id, d order by h))"""


@query(
    f"""with steps as ({STEPS}), carried as ({CARRIED.format(grid=GRID, least=LEAST)}),
picked as (select *, case when carry.b >= 0 and carry.a > 0 and carry.a > carry.b and (least is null or round(carry.a - carry.b, 8) < round(least.a - least.b, 8)) then carry else least end as m from carried)
select cast(h as varchar) as step_start, prod_id, raw.b as raw_bid, raw.a as raw_ask, raw.s as raw_sysid, carry.s as carry_sysid,
 valid.b as last_bid, valid.a as last_ask, valid.s as last_sysid, m.b as min_bid, m.a as min_ask, m.s as min_sysid
from picked where hour(h) >= 3""",
    dates=(),
)
def stream_snapshot(fx):
    """Ticks of the first ten days, then the rest, which the query goes on with; a row
    without a product closes the last day. Steps before three are carried in only."""
    ticks = fx.view("fx_ticks")
    source, beats = new_path(fx.spark, "stream-in"), new_path(fx.spark, "stream-beats")
    out, log = new_path(fx.spark, "stream-out"), new_path(fx.spark, "stream-log")
    beat = snapshots.heartbeat(parse_product(ticks.limit(1)), F.timestamp_seconds(F.lit(4_000_000_000)))
    read = lambda schema, path: fx.spark.readStream.schema(schema).parquet(path)
    early = F.col("trade_date") < "2024-01-11"
    for part, last in ((early, beat.limit(0)), (~early, beat)):
        ticks.where(part).write.mode("append").parquet(source)
        last.write.mode("append").parquet(beats)
        parsed = parse_product(read(ticks.schema, source)).unionByName(read(beat.schema, beats))
        steps = snapshots.stream_snapshot(parsed, "1 hour", "1 hour", opens="030000")
        runs.run_available(steps, out, log)
    return fx.spark.read.parquet(out).select(
        F.date_format("step_start", "yyyy-MM-dd HH:mm:ss").alias("step_start"),
        "prod_id", "raw_bid", "raw_ask", "raw_sysid", "carry_sysid", "last_bid", "last_ask", "last_sysid",
        "min_bid", "min_ask", "min_sysid",
    )


FILTERED = ["time", "ema", "last_outlier", "min_outlier", "bid", "ask", "source", "gamma"]


@query(
    f"select trade_date, term, strike, cp, idx, {', '.join(FILTERED)} from o_filtered",
    rounded=("ema",),
)
def stream_filtered_quote(fx):
    """Snapshots up to one noon, then the rest: the state of that day's series crosses
    the restart, that of the days before has expired by then."""
    source = new_path(fx.spark, "stream-in")
    out, log = new_path(fx.spark, "stream-out"), new_path(fx.spark, "stream-log")
    early = F.struct("trade_date", "time") < F.struct(F.lit("2024-01-11").cast("date"), F.lit("120000"))
    for part in (fx.book.where(early), fx.book.where(~early)):
        part.write.mode("append").parquet(source)
        book = fx.spark.readStream.schema(fx.book.schema).parquet(source)
        runs.run_available(filtered.stream_filtered_quote(book), out, log)
    done = with_outlier_codes(fx.spark.read.parquet(out))
    return filtered_to_long(done).select("trade_date", "term", "strike", "cp", "idx", *FILTERED)
