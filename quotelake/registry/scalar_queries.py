"""Projections, filters, predicates and scalars on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.config import DEFAULT
from quotelake.functions import index_math, products, quotes, texts, times
from quotelake.operators import exploration, reshape
from quotelake.registry.base import query
from quotelake.registry.views import VALID



@query("select seqno, prod_id, product, strike, cp, year, month, yyyymm from o_parsed", dates=())
def parse_product(fx):
    return products.parse_product(fx.ticks).select(
        "seqno", "prod_id", "product", "strike", "cp", "year", "month", "yyyymm"
    )


@query(
    """select seqno, strike, substr(prod_id, 9) || 'W' as term_code, cp, yyyymm from o_parsed""",
    dates=(),
)
def parse_product_lenient(fx):
    longer = fx.ticks.withColumn("prod_id", F.concat(F.lit(" "), "prod_id", F.lit("W ")))
    return products.parse_product_lenient(longer).select(
        "seqno", "strike", "term_code", "cp", "yyyymm"
    )


@query("select seqno, prod_id as built_id from o_parsed", dates=())
def build_product_id(fx):
    built = products.build_product_id(F.col("strike"), F.col("cp"), F.col("yyyymm"))
    return fx.parsed.select("seqno", built.alias("built_id"))


@query("select distinct yyyymm from o_parsed", dates=())
def expiry_from_filename(fx):
    from quotelake.session import new_path
    from quotelake.sources.calendar import report_files
    from quotelake.sources.folders import by_file

    path = new_path(fx.spark, "by-expiry")
    code = F.substring("prod_id", 9, 2)
    name = F.concat(F.lit("quotes_TXO"), code, F.lit(".csv"))
    ids = fx.parsed.select("prod_id").distinct().select("prod_id", name.alias("file"))
    by_file(ids, ["file"]).write.partitionBy("file").csv(path)
    expiry = products.expiry_of_file(F.col("path"))
    files = report_files(fx.spark, path)
    return files.select(expiry.alias("yyyymm")).where("yyyymm is not null").distinct()


@query(f"select seqno, {VALID} as is_valid from fx_ticks", dates=())
def valid_quote(fx):
    return fx.ticks.select("seqno", quotes.valid_quote(F.col("bid"), F.col("ask")).alias("is_valid"))


# Missing prices are made from the ticks so that every reason occurs.
HOLES = """(select seqno, case when seqno % 17 = 0 then null else bid end as bid,
 case when seqno % 19 = 0 then null when seqno % 23 = 0 then -2.0e0 else ask end as ask from fx_ticks) h"""


def _with_holes(fx):
    s = F.col("seqno")
    return fx.ticks.select(
        "seqno",
        F.when(s % 17 != 0, F.col("bid")).alias("bid"),
        F.when(s % 19 == 0, F.lit(None)).when(s % 23 == 0, -2.0).otherwise(F.col("ask")).alias("ask"),
    )


@query(
    f"""select seqno, case when {VALID} then '' when coalesce(bid = 0, false) or coalesce(ask = 0, false) then '單邊報價(Bid=0或Ask=0)'
 when bid is null or ask is null then '缺少報價' when bid < 0 then '買價為負' when ask <= 0 then '賣價須大於0' else '賣價須大於買價' end as reason from {HOLES}""",
    dates=(),
)
def valid_quote_reason(fx):
    return _with_holes(fx).select("seqno", quotes.valid_quote_reason(F.col("bid"), F.col("ask")).alias("reason"))


@query(
    f"""select seqno, concat_ws(',', case when coalesce(bid, 0) < 0 then 'E1' end, case when coalesce(ask, 0) <= coalesce(bid, 0) then 'E2' end) as codes,
 not (coalesce(bid, 0) < 0 or coalesce(ask, 0) <= coalesce(bid, 0)) as is_valid from {HOLES}""",
    dates=(),
)
def tick_error_codes(fx):
    return exploration.with_validity(_with_holes(fx)).select(
        "seqno", F.array_join("error_codes", ",").alias("codes"), "is_valid"
    )


@query(
    f"select seqno, case when {VALID} then ask - bid end as spread, case when {VALID} then (bid + ask) / 2 end as mid from {HOLES}",
    rounded=("spread", "mid"), dates=(),
)
def derive_spread_mid(fx):
    return _with_holes(fx).select(
        "seqno", quotes.derive_spread(F.col("bid"), F.col("ask")).alias("spread"), quotes.derive_mid(F.col("bid"), F.col("ask")).alias("mid")
    )


TEXTS = """(select seqno, case seqno % 6 when 0 then 'null' when 1 then '' when 2 then 'nan' when 3 then 'X' when 4 then ' ' || cast(bid as string) else cast(bid as string) end as text, ask from {fx_ticks}) t"""


def _price_texts(fx):
    return fx.spark.sql(f"select * from {TEXTS}", fx_ticks=fx.view("fx_ticks"))


NUMBER = "case when seqno % 6 >= 4 then cast(trim(text) as double) end"


@query(
    f"""select seqno, {NUMBER} as price, {NUMBER} is not null and ask is not null as two_sided
from {TEXTS.replace('{', '').replace('}', '')}""",
    dates=(),
)
def null_normalise(fx):
    price = quotes.text_to_price(F.col("text"))
    return _price_texts(fx).select(
        "seqno", price.alias("price"), quotes.two_sided(price, F.col("ask")).alias("two_sided")
    )


@query(
    f"""select seqno, {NUMBER} as number, cast(trunc(coalesce({NUMBER}, 0)) as integer) as number_key
from {TEXTS.replace('{', '').replace('}', '')}""",
    dates=(),
)
def coerce_numeric(fx):
    number = quotes.text_to_price(F.col("text"))
    return _price_texts(fx).select(
        "seqno", number.alias("number"), F.coalesce(number, F.lit(0.0)).cast("int").alias("number_key")
    )


@query(
    """select seqno, case when substr(tick_time, 1, 1) = '0' then substr(tick_time, 2, 1) || ':' || substr(tick_time, 3, 2) || ':' || substr(tick_time, 5, 2) || '.' || substr(tick_time, 7, 3)
 else substr(tick_time, 1, 2) || ':' || substr(tick_time, 3, 2) || ':' || substr(tick_time, 5, 2) || '.' || substr(tick_time, 7, 3) end as shown from fx_ticks""",
    dates=(),
)
def format_tick_time(fx):
    short = F.regexp_replace("tick_time", "^0", "")
    return fx.ticks.select("seqno", times.format_tick_time(short).alias("shown"))


@query(
    """select seqno, cast(substr(tick_time, 1, 6) as integer) as time_int from fx_ticks""", dates=()
)
def time_to_int(fx):
    shown = times.display_time(F.substring("tick_time", 1, 6))
    return fx.ticks.select("seqno", times.time_to_int(shown).alias("time_int"))


SECONDS = "(cast(substr(tick_time, 1, 2) as integer) * 3600 + cast(substr(tick_time, 3, 2) as integer) * 60 + cast(substr(tick_time, 5, 2) as integer) - 15 + 86400) % 86400"


@query(
    f"""select seqno, lpad(cast(s // 3600 as varchar), 2, '0') || lpad(cast(s // 60 % 60 as varchar), 2, '0') || lpad(cast(s % 60 as varchar), 2, '0') as prev
from (select seqno, {SECONDS} as s from fx_ticks) x""",
    dates=(),
)
def prev_time(fx):
    return fx.ticks.select("seqno", times.prev_time(F.substring("tick_time", 1, 6)).alias("prev"))


# One step of the rules: the tick before in event order plays the previous state.
STEPS = """(select *, ask - bid as spread, (bid + ask) / 2 as mid, case when seqno % 13 = 0 then null else ema_raw end as ema,
 case when seqno % 11 = 0 then null else prev_raw end as prev_mid, case when seqno % 7 = 0 then null else ema_raw end as prev_ema, seqno % 29 = 0 as restart
 from (select seqno, case when seqno % 17 = 0 then null else bid end as bid, case when seqno % 17 = 0 then null else ask end as ask,
  mi / 4.0e0 as ema_raw, mi * 1.5e0 as prev_raw from {fx_ticks}) a) s"""
STEPS_SQL = STEPS.replace("{", "").replace("}", "")
GAMMA = "case when bid is null or bid = 0 or mid is null then 1.2e0 when prev_mid is null then 2.0e0 when mid <= prev_mid + 1e-9 then 1.5e0 else 2.0e0 end"


def _steps(fx):
    rows = fx.spark.sql(f"select * from {STEPS}", fx_ticks=fx.view("fx_ticks"))
    gamma = quotes.gamma_select(F.col("bid"), F.col("mid"), F.col("prev_mid"))
    test = quotes.outlier_test(
        F.col("spread"), F.col("bid"), F.col("ask"), F.col("ema"), F.col("prev_ema"),
        F.col("gamma"), F.col("prev_mid"), F.col("restart"),
    )
    return rows.withColumn("gamma", gamma).withColumn("test", test)


@query(f"select seqno, {GAMMA} as gamma from {STEPS_SQL}", dates=())
def gamma_select(fx):
    return _steps(fx).select("seqno", "gamma")


TESTED = f"""(select *, case when tested then coalesce(spread <= gamma * ema, false) else false end as cond_1,
 case when tested then coalesce(spread <= 15, false) else false end as cond_2, case when tested then coalesce(bid > prev_mid, false) else false end as cond_3,
 case when tested then coalesce(ask < prev_mid and bid > 0, false) else false end as cond_4, restart as cond_5, not restart and prev_ema is null as cond_6
from (select *, not restart and prev_ema is not null and not (spread is null and bid is null and ask is null) as tested
 from (select *, {GAMMA} as gamma from {STEPS_SQL}) g) h) t"""
FLAG = "case when cond_5 or cond_6 then false when not tested then null else not (cond_1 or cond_2 or cond_3 or cond_4) end"


@query(
    f"select seqno, {FLAG} as is_outlier, cond_1, cond_2, cond_3, cond_4, cond_5, cond_6 from {TESTED}",
    dates=(),
)
def outlier_test(fx):
    return _steps(fx).select("seqno", "test.*")


def _listed(n: int) -> str:
    parts = ", ".join(f"case when cond_{i} then '{i}' end" for i in range(1, n + 1))
    return f"coalesce(nullif(concat_ws(',', {parts}), ''), '-')"


CODE_LAST = f"case when {FLAG} is null then '-' when {FLAG} then 'V' else {_listed(6)} end"


@query(f"select seqno, {CODE_LAST} as code from {TESTED}", dates=())
def outlier_code_last(fx):
    conditions = [F.col(f"test.cond_{i}") for i in range(1, 7)]
    return _steps(fx).select(
        "seqno", quotes.outlier_code_last(F.col("test.is_outlier"), conditions).alias("code")
    )


@query(
    f"""select seqno, case when {FLAG} is null then '-' when {FLAG} then 'V' when seqno % 3 = 0 and seqno <> 0 then '-' else {_listed(4)} end as code from {TESTED}""",
    dates=(),
)
def outlier_code_min(fx):
    conditions = [F.col(f"test.cond_{i}") for i in range(1, 7)]
    other = F.when(F.col("seqno") % 3 == 0, F.col("seqno")).otherwise(F.col("seqno") - 1)
    code = quotes.outlier_code_min(F.col("test.is_outlier"), conditions, F.col("seqno"), other)
    return _steps(fx).select("seqno", code.alias("code"))


@query(
    """select strike, case when c_last_outlier = 'V' then true when c_last_outlier = '-' then null else false end as flag from fx_official_wide""",
    dates=(),
)
def outlier_code_to_flag(fx):
    flag = quotes.outlier_code_to_flag(F.concat(F.lit(" "), "c_last_outlier"))
    return fx.view("fx_official_wide").select("strike", flag.alias("flag"))


USE_LAST = "bid is not null and not coalesce(flag, false)"
USE_MIN = "seqno % 5 <> 0 and bid is not null and seqno % 4 <> 0"
CHOSEN = f"""(select *, {FLAG} as flag, bid + 0.5e0 as min_bid from {TESTED}) c"""


@query(
    f"""select seqno, case when {USE_LAST} then bid when {USE_MIN} then min_bid else prev_mid - 1 end as bid,
 case when {USE_LAST} then 'Q_Last_Valid' when {USE_MIN} then 'Q_Min_Valid' else 'Replacement' end as source from {CHOSEN}""",
    dates=(),
)
def source_select(fx):
    return _chosen(fx).select("seqno", "chosen.bid", "chosen.source")


def _chosen(fx):
    """The tick as last quote, a slightly better one as smallest-spread quote."""
    quote = lambda bid, ask: F.struct(
        bid.alias("bid"), ask.alias("ask"), ((bid + ask) / 2).alias("mid")
    )
    has_min = F.col("seqno") % 5 != 0
    held = F.struct(
        (F.col("prev_mid") - 1).alias("bid"), (F.col("prev_mid") + 1).alias("ask"),
        F.col("prev_mid").alias("mid"),
    )
    rows = _steps(fx).withColumns(
        {
            "last": quote(F.col("bid"), F.col("ask")),
            "least": quote(F.when(has_min, F.col("bid") + 0.5), F.when(has_min, F.col("ask"))),
            "held": held,
            "min_flag": F.col("seqno") % 4 == 0,
        }
    )
    return rows.withColumn(
        "chosen",
        quotes.source_select(
            F.col("last"), F.col("test.is_outlier"), F.col("least"), F.col("min_flag"), F.col("held")
        ),
    )


@query(
    f"""select seqno, case when {USE_LAST} then gamma when {USE_MIN} or (seqno % 5 <> 0 and bid is not null) then 1.7e0 else gamma end as reported from {CHOSEN}""",
    dates=(),
)
def reported_gamma(fx):
    reported = quotes.reported_gamma(
        F.col("chosen.source"), F.col("gamma"), F.lit(1.7), F.col("least.bid")
    )
    return _chosen(fx).select("seqno", reported.alias("reported"))


@query(
    "select trade_date, time, near_sigma2, next_sigma2 from o_variance",
    rounded=("near_sigma2", "next_sigma2"),
)
def variance_term(fx):
    return _variances(fx).select("trade_date", "time", "near_sigma2", "next_sigma2")


def _variances(fx):
    from quotelake.registry.join_queries import spine_inputs
    from quotelake.operators.index_series import with_variances

    return with_variances(spine_inputs(fx))


@query("select trade_date, time, computed from o_typed", rounded=("computed",))
def index_interpolate(fx):
    from quotelake.operators.index_series import with_computed_index

    return with_computed_index(_variances(fx)).select("trade_date", "time", "computed")


@query("select trade_date, time, near_type, next_type from o_typed")
def variance_type(fx):
    return _variances(fx).select("trade_date", "time", "near_type", "next_type")


@query("select seqno, round_even(ask * 100 / 8, 0) / 100 as published from fx_ticks", dates=())
def round_publish(fx):
    return fx.ticks.select("seqno", index_math.round_publish(F.col("ask") / 8).alias("published"))


@query(
    """select trade_date, time, kind, case when p > 0 then (n - p) / cast(p as double) end as ratio, kind <> 'index' and coalesce((n - p) / nullif(cast(p as double), 0) < -0.15, false) as dropped
from (select trade_date, time, kind, n, lag(n) over (partition by trade_date, kind order by time) as p
 from (select trade_date, time, term as kind, cast(contrib_rows as double) as n from o_contrib_sum
  union all select trade_date, time, 'index', original from fx_official_index)) x""",
    rounded=("ratio",),
)
def change_ratio(fx):
    """Change from one time to the next: series of either term, and the index."""
    from pyspark.sql import Window

    from quotelake.operators.index_series import contrib_sum

    terms = contrib_sum(fx.view("fx_contrib")).select(
        "trade_date", "time", F.col("term").alias("kind"), F.col("contrib_rows").cast("double").alias("n")
    )
    index = fx.view("fx_official_index").select(
        "trade_date", "time", F.lit("index").alias("kind"), F.col("original").alias("n")
    )
    before = F.lag("n").over(Window.partitionBy("trade_date", "kind").orderBy("time"))
    ratio = index_math.change_ratio(F.col("n"), before)
    fell = (F.col("kind") != "index") & F.coalesce(F.col("ratio") < -0.15, F.lit(False))
    changed = terms.unionByName(index).withColumn("ratio", ratio)
    return changed.select("trade_date", "time", "kind", "ratio", fell.alias("dropped"))


@query(
    """select trade_date, term, strike, cp, time, case when p_ema is null and min_spread is null then 'EMA = null'
 when p_ema is null then printf('EMA = spread = %.6f', round(ema, 6)) when min_spread is null then printf('EMA = previous EMA = %.6f', round(ema, 6))
 else printf('EMA = 0.95 * %.6f + 0.05 * %.6f = %.6f', round(p_ema, 6), round(min_spread, 6), round(ema, 6)) end as trace from o_fold"""
)
def ema_trace_text(fx):
    from pyspark.sql import Window

    from quotelake.operators.filtering import ema_spread

    series = ["trade_date", "term", "strike", "cp"]
    rows = ema_spread(fx.long_quotes, series, "idx")
    before = F.lag("ema").over(Window.partitionBy(*series).orderBy("idx"))
    known = F.when(F.col("time") != DEFAULT.session_open, before)
    trace = texts.ema_trace_text(known, F.col("min_spread"), F.col("ema"))
    return rows.select(*series, "time", trace.alias("trace"))


@query(
    f"""select seqno, case when cond_5 then 'first record: no outlier' when cond_6 then 'no previous EMA: no outlier' when {FLAG} is null then 'no quote'
 when {FLAG} then 'no condition passed: outlier' else 'condition ' || {_listed(4)} || ' passed: no outlier' end as outlier_text,
 case when bid is null then 'bid missing: gamma 1.2' when bid = 0 then 'bid zero: gamma 1.2' when prev_mid is null then 'no previous mid: gamma 2.0'
 when mid <= prev_mid + 1e-9 then printf('mid %.6f not above %.6f: gamma 1.5', round(mid, 6), round(prev_mid, 6)) else printf('mid %.6f above %.6f: gamma 2.0', round(mid, 6), round(prev_mid, 6)) end as gamma_text from {TESTED}""",
    dates=(),
)
def reason_text(fx):
    return _steps(fx).select(
        "seqno",
        texts.outlier_reason(F.col("test")).alias("outlier_text"),
        texts.gamma_reason(F.col("bid"), F.col("mid"), F.col("prev_mid")).alias("gamma_text"),
    )


@query(
    """select trade_date, time, term, strike, contrib_raw, 'first' as kind from (select *, dense_rank() over (partition by trade_date order by time) as d from fx_contrib) x where d <= 3
union all select trade_date, time, term, strike, contrib_raw, 'until' from fx_contrib where time <= '030000'
union all select trade_date, time, term, strike, contrib_raw, 'at' from fx_contrib where time = '090000'"""
)
def slice_times(fx):
    rows = fx.view("fx_contrib").select("trade_date", "time", "term", "strike", "contrib_raw")
    parts = {
        "first": reshape.slice_times(rows, ["trade_date"], first=3),
        "until": reshape.slice_times(rows, ["trade_date"], end_time="030000"),
        "at": reshape.slice_times(rows, ["trade_date"], at="090000"),
    }
    return reshape.union_terms([p.withColumn("kind", F.lit(k)) for k, p in parts.items()])


@query("select trade_date, time, published, original from fx_official_index where time >= '090000'")
def valid_hours(fx):
    rows = exploration.valid_hours(fx.view("fx_official_index"))
    return rows.select("trade_date", "time", "published", "original")


@query(
    """select 'same tick' as kind, trade_date, term, time, strike, c_min_outlier as code from fx_official_wide
 where c_min_outlier not in ('-', 'V') and c_min_sysid = c_last_sysid
union all select 'no quote', w.trade_date, w.term, w.time, w.strike, c_last_outlier from o_wide_filled w
 join (select trade_date, term, min(time) as time from o_wide_filled group by 1, 2) f on f.trade_date = w.trade_date and f.term = w.term and f.time = w.time
 where c_last_bid = 0 and c_last_ask = 0"""
)
def hypothesis_filter(fx):
    from quotelake.plans.quotes import filtered, wide_table

    keep = ["trade_date", "term", "time", "strike"]
    same = exploration.same_tick_code(fx.view("fx_official_wide")).select(
        F.lit("same tick").alias("kind"), *keep, F.col("c_min_outlier").alias("code")
    )
    wide = wide_table(filtered(fx.book))
    none = exploration.first_time_without_quote(wide).select(
        F.lit("no quote").alias("kind"), *keep, F.col("c_last_outlier").alias("code")
    )
    return same.unionByName(none)
