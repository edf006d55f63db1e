"""Sources and sinks: files are written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake import schemas
from quotelake.functions.times import display_time
from quotelake.operators import index_series, statistics
from quotelake.registry.base import query
from quotelake.registry.fixtures import Fixture
from quotelake.session import new_path
from quotelake.sources import alerts, calendar, folders, index_files, official, tick_store, ticks

TICK_LIST = ["trade_date", "seqno", "tick_time", "prod_id", "bid", "ask"]


def _tick_files(fx: Fixture, sep: str) -> str:
    """One folder per day; every fiftieth tick claims the following date."""
    path = new_path(fx.spark, "ticks")
    stray = F.col("seqno") % 50 == 0
    date = F.when(stray, F.date_add("trade_date", 1)).otherwise(F.col("trade_date"))
    rows = fx.ticks.withColumns(
        {
            "file_date": F.date_format(date, "yyyyMMdd"),
            "prod_id": F.concat(F.lit(" "), F.col("prod_id"), F.lit(" ")),
        }
    )
    # Two layouts in each folder: another order, spaces and a column of no use.
    ticks.write_ticks(rows.where("seqno % 3 <> 0"), path, sep)
    other = {"quantity": F.lit("7"), "file_date": F.concat(F.lit(" "), "file_date")}
    columns = ("seqno", "ask", "quantity", "tick_time", "bid", "prod_id", "file_date")
    ticks.write_ticks(rows.where("seqno % 3 = 0").withColumns(other), path, sep, columns, "append")
    return path


READ_TICKS = f"select {', '.join(TICK_LIST)} from fx_ticks where seqno % 50 <> 0"


@query(READ_TICKS)
def read_ticks(fx):
    return ticks.read_ticks(fx.spark, _tick_files(fx, "\t")).select(*TICK_LIST)


@query(READ_TICKS)
def read_ticks_flexible(fx):
    return ticks.read_ticks_flexible(fx.spark, _tick_files(fx, ",")).select(*TICK_LIST)


@query(
    """select trade_date, count(*) filter (where seqno % 50 <> 0) as kept,
 count(*) filter (where seqno % 50 = 0) as dropped from fx_ticks group by trade_date"""
)
def filter_exact_date(fx):
    texts = ticks.read_tick_texts(fx.spark, _tick_files(fx, "\t"))
    day = F.col("day").cast("string")
    counted = statistics.dropped_by_date(texts.withColumns({"file": day, "target_date": day}))
    return counted.select(F.to_date("file", "yyyyMMdd").alias("trade_date"), "kept", "dropped")


def _official_files(fx: Fixture) -> str:
    path = new_path(fx.spark, "official")
    marker = fx.view("fx_marker").select(
        "trade_date",
        F.explode(F.array(F.lit("Near"), F.lit("Next"))).alias("term"),
        F.lit("84500").alias("time"),
        "initial_sysid",
    )
    # As delivered: a second strike column, and the snapshot columns at the end.
    names = schemas.OFFICIAL_QUOTE_COLUMNS
    columns = [*names[:4], "p.strike", *names[4:10], *reversed(names[10:])]
    rows = fx.view("fx_official_wide").withColumn("p_strike", F.col("strike"))
    official.write_official(rows, marker, path, columns)
    return path


OFFICIAL_LIST = (
    "trade_date, term, time, strike, c_ema, p_ema, c_gamma, p_gamma, c_bid, c_ask, p_bid, p_ask, "
    "c_last_outlier, c_last_sysid, c_min_bid, p_source, snapshot_sysid"
)


@query(f"select {OFFICIAL_LIST} from fx_official_wide")
def read_quotes_wide(fx):
    rows = official.read_quotes_wide(fx.spark, _official_files(fx))
    return rows.select(*OFFICIAL_LIST.split(", "))


@query(
    """select trade_date, t.term, '084500' as time, initial_sysid from fx_marker
 cross join (values ('Near'), ('Next')) t(term)"""
)
def read_start_marker(fx):
    return official.read_start_marker(fx.spark, _official_files(fx))


def _index_files(fx: Fixture) -> str:
    path = new_path(fx.spark, "index-inputs")
    unused = {"unused": "unused"}
    contrib = fx.view("fx_contrib").withColumn("contrib", F.col("contrib_raw"))
    unpadded = F.col("time").cast("int").cast("string")
    index_files.write_tsv(
        contrib.withColumn("time", unpadded), unused | schemas.CONTRIB_COLUMNS, f"{path}/contrib",
        ["trade_date", "term"],
    )
    index_files.write_tsv(
        fx.view("fx_forward").withColumn("time", unpadded), unused | schemas.FORWARD_COLUMNS,
        f"{path}/forward", ["trade_date", "term"],
    )
    sigma = fx.view("fx_sigma").join(fx.view("fx_official_index"), ["trade_date", "time"])
    index_files.write_tsv(
        sigma.withColumn("time", unpadded), unused | schemas.SIGMA_COLUMNS, f"{path}/sigma", ["trade_date"]
    )
    rate = fx.view("fx_marker").select(
        "trade_date",
        (F.col("initial_sysid") % 7 / 1000).alias("near_r"),
        (F.col("initial_sysid") % 9 / 1000).alias("next_r"),
    )
    index_files.write_tsv(rate, unused | schemas.RATE_COLUMNS, f"{path}/rate", ["trade_date"])
    return path


@query(
    """select trade_date, 'contrib' as kind, term, time, strike, case when contrib_raw = 'X' then null else cast(contrib_raw as double) end as value from fx_contrib
union all select trade_date, 'forward', term, time, null, tw_fwd from fx_forward
union all select s.trade_date, 'sigma', null, s.time, null, s.near_t + i.near_sigma2 from fx_sigma s join fx_official_index i using (trade_date, time)
union all select trade_date, 'rate', null, null, null, (initial_sysid % 7) / 1000.0e0 + (initial_sysid % 9) / 1000.0e0 from fx_marker""",
    rounded=("value",),
)
def read_index_inputs(fx):
    inputs = index_files.read_index_inputs(fx.spark, _index_files(fx))
    none = F.lit(None)

    def shape(name: str, term, time, strike, value) -> DataFrame:
        return inputs[name].select(
            "trade_date", F.lit(name).alias("kind"), term.cast("string").alias("term"),
            time.cast("string").alias("time"), strike.cast("int").alias("strike"),
            value.alias("value"),
        )

    parts = [
        shape("contrib", F.col("term"), F.col("time"), F.col("strike"), F.col("contrib")),
        shape("forward", F.col("term"), F.col("time"), none, F.col("tw_fwd")),
        shape("sigma", none, F.col("time"), none, F.col("near_t") + F.col("near_sigma2")),
        shape("rate", none, none, none, F.col("near_r") + F.col("next_r")),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


SUMMARY_HEADER = (
    "date\ttime\tnearT\tnearSigma^2\tNo of nearSeries\tnearType\tnextT\tnextSigma^2\t"
    "No of nextSeries\tnextType\tvix\tori_vix"
)


def _alert_files(fx: Fixture) -> str:
    """One report per date and time, with its lines from the contributions."""
    path = new_path(fx.spark, "alerts")
    text = lambda c: c.cast("string")
    rows = fx.view("fx_alert_rows")
    quotes, counted = F.col("quotes"), F.col("counted")
    blank = F.lit("")
    before = [
        F.col("month"), F.col("time"), F.col("moneyness"), text(F.col("strike")),
        text(quotes), text(quotes + 1), text(quotes + 2), text(quotes + 3),
    ]
    after = [
        F.col("month"), F.col("time"), F.col("moneyness"), text(counted), text(counted + 1),
        text(counted + 2), text(counted + 3), text(quotes - counted), F.col("pct"),
    ]
    line = (
        F.when(F.col("fields") == 5, F.concat_ws("\t", *before[:5]))
        .when(F.col("fields") == 8, F.concat_ws("\t", *before))
        .otherwise(F.concat_ws("\t", *before, *after))
    )
    groups = rows.groupBy("trade_date", "time").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("month", "strike", line.alias("line")))),
                lambda x: x["line"],
            ),
            "\n",
        ).alias("lines"),
        F.sum("quotes").alias("quotes"),
        F.sum("counted").alias("counted"),
    )
    trigger = F.when(quotes % 2 == 0, "Index alert triggered by condition 1 & 3").otherwise(
        "Index alert triggered by condition 2"
    )
    date = F.date_format("trade_date", "yyyyMMdd")
    summary = lambda a, b: F.concat_ws(
        "\t", date, F.col("time"), F.lit("0.1"), text(a), text(b), F.lit("A"), blank, blank,
        text(a + 1), F.lit("E"), F.lit("20.5"), blank,
    )
    report = F.concat_ws(
        "\n",
        F.lit("Alert report"),
        trigger,
        F.lit("condition1: index moved: by a lot"),
        F.lit("condition2: series dropped"),
        F.lit("condition3: weight moved"),
        blank,
        F.lit(SUMMARY_HEADER),
        summary(quotes, counted),
        summary(quotes + 5, counted),
        blank,
        F.lit("month\ttime\tmoneyness\tstrike\tmid\tratio\tcontrib\tweight"),
        F.col("lines"),
    )
    name = F.concat(date, F.lit("_alert_report."), F.col("time"), F.lit(".tsv"))
    groups.select(report.alias("value"), name.alias("report")).repartition("report").write.partitionBy(
        "report"
    ).text(path)
    return path


def _reports(fx: Fixture) -> DataFrame:
    return alerts.parse_reports(alerts.read_report_texts(fx.spark, _alert_files(fx)))


REPORT_SUMS = """(select trade_date, time, cast(sum(quotes) as bigint) as quotes, cast(sum(counted) as bigint) as counted,
 count(*) as n from fx_alert_rows group by trade_date, time) r"""


REPORT_LINES = """(select trade_date, time, string_agg(line, '/' order by month, strike, line) as lines from (
 select *, concat_ws('|', month, time, moneyness, strike, quotes)
  || case when fields = 5 then '' else concat('|', concat_ws('|', quotes + 1, quotes + 2, quotes + 3)) end
  || case when fields < 17 then '' else concat('|', concat_ws('|', month, time, moneyness,
   counted, counted + 1, counted + 2, counted + 3, quotes - counted, pct)) end as line
 from fx_alert_rows) x group by trade_date, time) l"""


def _summary_sql(more: int) -> str:
    return f"""'date=' || strftime(trade_date, '%Y%m%d') || ';nearSeriesCount=' || counted || ';nearSigma2=' || (quotes + {more})
 || ';nearT=0.1;nearType=A;nextSeriesCount=' || (quotes + {more + 1}) || ';nextType=E;time=' || time || ';vix=20.5'"""


@query(
    f"""select trade_date, time, substr(time, 1, 2) || ':00:00' as time_display, case when quotes % 2 = 0 then '1,3' else '2' end as conditions,
 '1=index moved: by a lot;2=series dropped;3=weight moved' as descriptions,
 {_summary_sql(0)} as prev, {_summary_sql(5)} as "current", lines
from {REPORT_SUMS} join {REPORT_LINES} using (trade_date, time)"""
)
def read_alert_reports(fx):
    def shown(values):
        texts = F.transform(F.map_entries(values), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
        return F.array_join(F.array_sort(texts), ";")

    return _reports(fx).select(
        "trade_date", "time", "time_display",
        F.array_join(F.col("conditions").cast("array<string>"), ",").alias("conditions"),
        shown(F.col("descriptions")).alias("descriptions"),
        shown(F.col("summary.prev")).alias("prev"),
        shown(F.col("summary.current")).alias("current"),
        F.array_join(F.transform("rows", lambda x: F.array_join(x, "|")), "/").alias("lines"),
    )


@query(
    f"""select trade_date, time, c.condition, case c.condition when 1 then 'index moved: by a lot' when 2 then 'series dropped' else 'weight moved' end as description
 from {REPORT_SUMS} join (values (0, 1), (0, 3), (1, 2)) c(odd, condition) on quotes % 2 = c.odd"""
)
def alert_conditions(fx):
    return alerts.alert_conditions(_reports(fx))


@query(
    f"""select trade_date, time, m.moment, v.name, case v.name when 'date' then strftime(trade_date, '%Y%m%d') when 'time' then time
  when 'nearT' then '0.1' when 'nearSigma2' then cast(quotes + m.more as varchar) when 'nearSeriesCount' then cast(counted as varchar)
  when 'nearType' then 'A' when 'nextSeriesCount' then cast(quotes + m.more + 1 as varchar) when 'nextType' then 'E' else '20.5' end as value
 from {REPORT_SUMS} cross join (values ('prev', 0), ('current', 5)) m(moment, more)
 cross join (values ('date'), ('time'), ('nearT'), ('nearSigma2'), ('nearSeriesCount'), ('nearType'), ('nextSeriesCount'), ('nextType'), ('vix')) v(name)"""
)
def alert_summary(fx):
    return alerts.alert_summary(_reports(fx))


CONTRIBUTIONS = """
select trade_date, time, case when r = 1 then 'Near' else 'Next' end as term, line, moneyness, cast(strike as varchar) as strike,
 cast(quotes as varchar) as prev_mid, cast(quotes + 1 as varchar) as prev_spread_ratio, cast(quotes + 2 as varchar) as prev_contrib, cast(quotes + 3 as varchar) as prev_weight,
 case when changed then cast(counted as varchar) else '' end as curr_mid, case when changed then cast(counted + 1 as varchar) else '' end as curr_spread_ratio,
 case when changed then cast(counted + 2 as varchar) else '' end as curr_contrib, case when changed then cast(counted + 3 as varchar) else '' end as curr_weight,
 case when changed then cast(quotes - counted as varchar) else '' end as weight_diff, case when changed then pct else '' end as contrib_diff_pct,
 changed as has_changed
from (select *, fields = 17 as changed, dense_rank() over (partition by trade_date, time order by month) as r,
  cast(row_number() over (partition by trade_date, time order by month, strike) - 1 as integer) as line from fx_alert_rows) x
where r <= 2 and fields >= 8"""


@query(CONTRIBUTIONS)
def alert_contributions(fx):
    return alerts.alert_contributions(_reports(fx))


@query(
    f"""select trade_date, time, term, strike, contrib_diff_pct, move_rank from (select *, cast(row_number() over (partition by trade_date, time, term
  order by abs(coalesce(try_cast(replace(contrib_diff_pct, '%', '') as double), 0)) desc, line) as integer) as move_rank from ({CONTRIBUTIONS}) c) m
 where move_rank <= 5"""
)
def top_contrib_moves(fx):
    moves = alerts.top_contrib_moves(alerts.alert_contributions(_reports(fx)), n=5)
    return moves.select("trade_date", "time", "term", "strike", "contrib_diff_pct", "move_rank")


@query(
    f"""select r.trade_date, r.time, substr(r.time, 1, 2) || ':00:00' as time_display, case when quotes % 2 = 0 then '1,3' else '2' end as conditions, coalesce(near, '') as near, coalesce(next, '') as next
from {REPORT_SUMS} left join (select trade_date, time, string_agg(item, ' ' order by move_rank) filter (where term = 'Near') as near, string_agg(item, ' ' order by move_rank) filter (where term = 'Next') as next
 from (select *, strike || '/' || prev_mid || '/' || curr_mid || '/' || contrib_diff_pct as item, row_number() over (partition by trade_date, time, term
  order by abs(coalesce(try_cast(replace(contrib_diff_pct, '%', '') as double), 0)) desc, line) as move_rank from ({CONTRIBUTIONS}) c) m group by all) l using (trade_date, time)"""
)
def alert_list(fx):
    reports = _reports(fx)
    listed = alerts.alert_list(reports, alerts.alert_contributions(reports))
    items = lambda c: F.coalesce(
        F.array_join(
            F.transform(
                c,
                lambda x: F.concat_ws(
                    "/", x["strike"], x["prev_mid"], x["curr_mid"], x["contrib_diff_pct"]
                ),
            ),
            " ",
        ),
        F.lit(""),
    )
    return listed.select(
        "trade_date", "time", "time_display",
        F.array_join(F.col("conditions").cast("array<string>"), ",").alias("conditions"),
        items(F.col("near")).alias("near"),
        items(F.col("next")).alias("next"),
    )


def run_twice(write, rows: DataFrame, path: str) -> None:
    """All dates, then those of even days again: their files are replaced."""
    write(rows, path)
    write(rows.where(F.dayofmonth("trade_date") % 2 == 0), path)


WIDE_LIST = (
    "trade_date, term, time, strike, c_bid, c_ask, p_bid, p_ask, c_source, p_source, c_last_bid, "
    "c_last_sysid, c_last_outlier, p_min_ask, p_min_outlier, c_ema, p_ema, c_gamma, p_gamma, snapshot_sysid"
)


@query(f"select {WIDE_LIST} from fx_official_wide", rounded=("c_ema", "p_ema"))
def write_quotes_wide(fx):
    path = new_path(fx.spark, "wide")
    run_twice(official.write_quotes_wide, fx.view("fx_official_wide"), path)
    return official.read_computed_wide(fx.spark, path).select(*WIDE_LIST.split(", "))


@query(
    """select trade_date, time, printf('%.10f', near_sigma2) as near_sigma2, near_type, printf('%.10f', published) as published,
 strftime(trade_date, '%Y%m%d') as date_text, time || '00' as time_text, '' as blank, printf('%.2f', original) as original_text
from fx_official_index"""
)
def write_index(fx):
    path = new_path(fx.spark, "index")
    run_twice(index_files.write_index, fx.view("fx_official_index"), path)
    names = ["time", "near_sigma2", "next_sigma2", "near_type", "next_type", "published", "original"]
    inverse = {v: k for k, v in schemas.SIGMA_COLUMNS.items()}
    first = (
        fx.spark.read.schema(schemas.text_schema([inverse[n] for n in names]))
        .option("sep", "\t").option("header", True).csv(f"{path}/index")
        .toDF(*names, "trade_date")
    )
    second = (
        fx.spark.read.schema(schemas.text_schema(["date_text", "time_text", "blank", "original_text"]))
        .option("sep", "\t").option("header", False).csv(f"{path}/original")
        .withColumn("time", F.substring("time_text", 1, 6))
        .withColumn("blank", F.coalesce("blank", F.lit("")))
    )
    return first.join(second, ["trade_date", "time"]).select(
        "trade_date", "time", "near_sigma2", "near_type", "published",
        "date_text", "time_text", "blank", "original_text",
    )


DIFF_LIST = 'trade_date, time, term, strike, cp, "column", ours, official, sysid, prev_sysid'


@query(f"select {DIFF_LIST} from o_diffs")
def write_diffs(fx):
    from quotelake.registry.comparison_queries import diffs_of

    path = new_path(fx.spark, "diffs")
    run_twice(official.write_diffs, diffs_of(fx), path)
    return official.read_diffs(fx.spark, path)


@query(
    """select trade_date, term, strike, cp, time, last_bid, last_ask, last_valid, min_bid, min_ask, min_spread from o_snap""",
    rounded=("min_spread",),
)
def write_stage1(fx):
    path = new_path(fx.spark, "stage1")
    run_twice(official.write_stage1, fx.long_quotes, path)
    return fx.spark.read.parquet(path).select(
        "trade_date", "term", "strike", "cp", "time", "last_bid", "last_ask", "last_valid",
        "min_bid", "min_ask", "min_spread",
    )


def _store(fx) -> str:
    path = new_path(fx.spark, "tick-store")
    run_twice(tick_store.write_tick_store, fx.parsed, path)
    return path


@query("select trade_date, term, strike, cp, seqno, tick_time, bid, ask from o_tt")
def read_term_ticks(fx):
    """Near and next ticks from folders by expiry, of which the others are not opened."""
    found = tick_store.read_term_ticks(fx.spark, _store(fx))
    return found.select("trade_date", "term", "strike", "cp", "seqno", "tick_time", "bid", "ask")


REQUESTED = "t.trade_date = s.trade_date and s.trade_date = date '2024-01-05' and s.idx = 12 and t.term = 'Near' and t.strike = 20100 and t.cp = 'Call'"


@query(
    f"""select 'current' as part, t.trade_date, t.term, t.strike, t.cp, t.seqno, t.bid, t.ask from o_tt t join o_schedule s
 on {REQUESTED} and t.seqno > s.prev_sysid and t.seqno <= s.sysid
union all select 'prev', t.trade_date, t.term, t.strike, t.cp, t.seqno, t.bid, t.ask from o_tt t join o_schedule s
 on {REQUESTED} and t.seqno > s.prev_sysid - 500 and t.seqno <= s.prev_sysid"""
)
def request_ticks(fx):
    """Ticks of one snapshot of one series, read by the bounds of the question."""
    at = fx.schedule.where("trade_date = date '2024-01-05' and idx = 12").first()
    request = tick_store.TickRequest("2024-01-05", "Near", 20100, "Call", at["sysid"], at["prev_sysid"])
    found = tick_store.request_ticks(fx.spark, _store(fx), request)
    return found.select("part", "trade_date", "term", "strike", "cp", "seqno", "bid", "ask")


@query("select distinct trade_date from fx_times")
def list_dates(fx):
    path = new_path(fx.spark, "reports")
    name = F.concat(
        F.lit("validation_diff_"), F.date_format("trade_date", "yyyyMMdd"), F.lit(".csv")
    )
    rows = fx.view("fx_times").select("sysid", name.alias("report"))
    folders.by_file(rows, ["report"]).write.partitionBy("report").csv(path)
    return calendar.list_dates(calendar.report_files(fx.spark, path))


@query(
    """select c.trade_date, d.trade_date is not null as available
from (select cast(unnest(generate_series(min(trade_date) - interval 7 day, max(trade_date) + interval 7 day, interval 1 day)) as date) as trade_date from fx_times) c
left join (select distinct trade_date from fx_times) d using (trade_date)"""
)
def date_range_select(fx):
    days = calendar.calendar_around(fx.view("fx_times"))
    return calendar.date_range_select(days, fx.view("fx_times"))


@query(
    """select trade_date, cast(lag(trade_date) over (order by trade_date) as varchar) as prior_date
from (select distinct trade_date from fx_times) d"""
)
def prior_date(fx):
    return index_series.prior_date(fx.view("fx_times"))


@query("select distinct time, substr(time, 1, 2) || ':00:00' as shown from fx_times", dates=())
def display_times(fx):
    return fx.view("fx_times").select("time", display_time(F.col("time")).alias("shown")).distinct()
