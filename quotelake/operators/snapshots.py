"""Order-book snapshots of every option series on the schedule.

Ticks are first folded to one row per (date, term, strike, interval), partly
on the map side, so a product with a third of all ticks shuffles no more rows
than any other. Only these folded rows and the grid meet in the one window per
strike that carries quotes forward; a strike has as many rows there as the day
has snapshots.

A *book* is the wide form: one row per (date, term, strike, snapshot) with a
struct ``call`` and a struct ``put``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig
from quotelake.functions.products import CALL_MONTHS, PUT_MONTHS
from quotelake.functions.quotes import derive_mid, derive_spread, is_true, valid_quote
from quotelake.functions.times import tick_clock
from quotelake.operators.intervals import assign_intervals
from quotelake.operators.schedule import schedule_entries, schedule_keys, strike_grid
from quotelake.session import bounded_broadcast, fits, written_once

SERIES = ["trade_date", "term", "strike"]
# Above every 64-bit sequence number.
SEQNO_RANGE = 10**19
SIDES = {"call": "Call", "put": "Put"}
QUOTE_FIELDS = [
    "raw_bid", "raw_ask", "raw_sysid", "carry_bid", "carry_ask", "carry_sysid",
    "last_bid", "last_ask", "last_sysid", "last_time", "last_prod_id",
    "min_bid", "min_ask", "min_spread", "min_sysid",
]


def with_spread_order(ticks: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Add ``spread_order``: smallest spread first, and of equal spreads the newest.

    Spread and sequence number share one exact decimal, which keeps the
    aggregation buffers at a fixed width (hash aggregation instead of sorting
    every tick). Unknown spreads come last.
    """
    units = F.round((F.col("ask") - F.col("bid")) * F.lit(10.0**cfg.spread_digits))
    ranked = units.try_cast("decimal(18,0)") * F.lit(str(SEQNO_RANGE)).cast("decimal(20,0)")
    unknown = F.lit("9" * 38).cast("decimal(38,0)")
    order = F.coalesce(ranked, unknown) - F.col("seqno").cast("decimal(19,0)")
    return ticks.withColumn("spread_order", order)


def newest(seqno: Column, prefix: str, **values: Column) -> list[Column]:
    """Aggregates taking each value from the row with the largest ``seqno``."""
    return [
        F.max(seqno).alias(f"{prefix}_seqno"),
        *[F.max_by(v, seqno).alias(f"{prefix}_{n}") for n, v in values.items()],
    ]


def least_spread(order: Column, prefix: str) -> list[Column]:
    """Aggregates taking the quote with the smallest spread order."""
    return [
        F.min(order).alias(f"{prefix}_order"),
        *[
            F.min_by(F.col(n), order).alias(f"{prefix}_{n}") for n in ("seqno", "bid", "ask")
        ],
    ]


def fold_ticks(placed: DataFrame, keys: list[str], cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Newest, newest valid and smallest-spread valid quote per group of ticks."""
    bid, ask, seqno = F.col("bid"), F.col("ask"), F.col("seqno")
    valid = F.col("valid_seqno").isNotNull()
    return (
        with_spread_order(placed, cfg)
        .withColumn("valid_seqno", F.when(valid_quote(bid, ask), seqno))
        .withColumn("valid_order", F.when(valid, F.col("spread_order")))
        .withColumn("clock", tick_clock(F.col("tick_time")).try_cast("bigint"))
        .groupBy(*keys)
        .agg(
            *newest(seqno, "raw", bid=bid, ask=ask),
            *newest(
                F.col("valid_seqno"), "valid",
                bid=bid, ask=ask, clock=F.col("clock"), yyyymm=F.col("yyyymm"),
            ),
            *least_spread(F.col("valid_order"), "least"),
        )
    )


FOLDED = {
    "raw": ("seqno", "bid", "ask"),
    "valid": ("seqno", "bid", "ask", "clock", "yyyymm"),
    "least": ("order", "seqno", "bid", "ask"),
}


def _by_side(folded: DataFrame) -> DataFrame:
    """Folded quotes as structs ``call_raw`` .. ``put_least``, null for the other side."""
    structs = []
    for side, cp in SIDES.items():
        for kind, fields in FOLDED.items():
            listed = ", ".join(f"'{f}', {kind}_{f}" for f in fields)
            structs.append(
                f"if(cp = '{cp}' and {kind}_seqno is not null, "
                f"named_struct('idx', idx, {listed}), null) as {side}_{kind}"
            )
    return folded.selectExpr(*SERIES, "idx", *structs)


def _template_cells(quotes: DataFrame, schedule: DataFrame, strikes: DataFrame) -> DataFrame:
    """Folded quotes and the grid of a strike template, as rows of one table."""
    grid = strike_grid(schedule, strikes, with_start=True)
    return quotes.withColumn("on_grid", F.lit(0)).unionByName(
        grid.withColumn("on_grid", F.lit(1)), allowMissingColumns=True
    )


def _quoted_cells(quotes: DataFrame, schedule: DataFrame) -> DataFrame:
    """Folded quotes and the grid of the strikes that have any.

    The first row of a strike unfolds its grid where it is, so no second pass
    over the ticks is needed to learn the strikes. Only these first rows take
    the list of snapshots from the (size-checked) broadcast side.
    """
    keys = schedule_keys(schedule)
    rank = F.row_number().over(Window.partitionBy(*SERIES).orderBy("idx"))
    q = quotes.withColumn("first", rank == 1).alias("q")
    e = F.broadcast(schedule_entries(schedule, with_start=True)).alias("e")
    condition = F.col("q.first")
    for k in keys:
        condition = condition & (F.col(f"q.{k}") == F.col(f"e.{k}"))
    kind = "array<struct<idx:int,time:string,sysid:bigint,prev_sysid:bigint>>"
    unfolded = q.join(e, condition, "left").selectExpr(
        *[f"q.{c}" for c in quotes.columns],
        f"explode(concat(cast(array(null) as {kind}), coalesce(entries, cast(array() as {kind})))) as cell",
    )
    structs = [c for c in quotes.columns if c not in (*SERIES, "idx")]
    return unfolded.selectExpr(
        *SERIES,
        "coalesce(cell.idx, idx) as idx",
        "cell.time as time",
        "cell.sysid as sysid",
        "if(cell is null, 0, 1) as on_grid",
        *[f"if(cell is null, {c}, null) as {c}" for c in structs],
    )


def snapshot_book(
    ticks: DataFrame,
    schedule: DataFrame,
    strikes: DataFrame | None = None,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Book of every template strike at every snapshot.

    Without a template the strikes are those quoted up to the last snapshot.
    """
    placed = assign_intervals(ticks, schedule, cfg)
    quotes = _by_side(fold_ticks(placed, [*SERIES, "cp", "idx"], cfg))
    if strikes is None and not fits(schedule, cfg.broadcast_bytes):
        strikes = quotes.select(*SERIES).distinct()
    if strikes is None:
        cells = _quoted_cells(quotes, schedule)
    else:
        cells = _template_cells(quotes, schedule, strikes)

    so_far = (
        Window.partitionBy(*SERIES)
        .orderBy("idx", "on_grid")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = {
        f"{side}_{kind}": F.last(f"{side}_{kind}", ignorenulls=True).over(so_far)
        for side in SIDES
        for kind in FOLDED
    }
    known = cells.withColumns(running).where("on_grid = 1")

    boundary = Window.partitionBy(*SERIES).orderBy("idx")
    carried = known.withColumns(
        {f"{side}_carry": F.lag(f"{side}_raw").over(boundary) for side in SIDES}
    )
    return carried.where("idx >= 0").selectExpr(
        *SERIES,
        "idx",
        "time",
        "sysid as snapshot_sysid",
        *[f"{_quote_struct(side, cp, cfg)} as {side}" for side, cp in SIDES.items()],
    )


def _quote_struct(side: str, cp: str, cfg: EngineConfig) -> str:
    """SQL text of a side's quotes at a snapshot.

    The folded smallest spread counts only if it is of this interval. The
    carried quote wins against it with a smaller spread; on a tie the newer
    one, which is never the carried one, stays.
    """
    raw, carry, valid, fresh = (f"{side}_{n}" for n in ("raw", "carry", "valid", "least"))
    in_interval = f"coalesce({fresh}.idx = idx, false)"
    carry_valid = (
        f"coalesce({carry}.bid >= 0 and {carry}.ask > 0 and {carry}.ask > {carry}.bid, false)"
    )
    spread = lambda q: f"round({q}.ask - {q}.bid, {cfg.spread_digits})"
    carry_wins = f"({carry_valid} and (not {in_interval} or {spread(carry)} < {spread(fresh)}))"
    least = lambda f: (
        f"case when {carry_wins} then {carry}.{f} when {in_interval} then {fresh}.{f} end"
    )
    month_code = f"substr('{CALL_MONTHS if cp == 'Call' else PUT_MONTHS}', {valid}.yyyymm % 100, 1)"
    fields = {
        "raw_bid": f"{raw}.bid",
        "raw_ask": f"{raw}.ask",
        "raw_sysid": f"{raw}.seqno",
        "carry_bid": f"{carry}.bid",
        "carry_ask": f"{carry}.ask",
        "carry_sysid": f"{carry}.seqno",
        "last_bid": f"{valid}.bid",
        "last_ask": f"{valid}.ask",
        "last_sysid": f"{valid}.seqno",
        "last_time": f"lpad(cast({valid}.clock as string), 12, '0')",
        "last_prod_id": (
            f"concat('{cfg.product}', lpad(cast(strike as string), 5, '0'), {month_code}, "
            f"cast({valid}.yyyymm div 100 % 10 as string))"
        ),
        "min_bid": least("bid"),
        "min_ask": least("ask"),
        "min_spread": f"({least('ask')}) - ({least('bid')})",
        "min_sysid": least("seqno"),
    }
    return "named_struct(" + ", ".join(f"'{n}', {text}" for n, text in fields.items()) + ")"


def book_to_long(book: DataFrame, with_derived: bool = True) -> DataFrame:
    """Call and Put as rows, with validity, spread and mid of both quotes."""
    keys = [*SERIES, "idx", "time", "snapshot_sysid"]
    side = F.explode(
        F.array(
            *[
                F.struct(F.lit(cp).alias("cp"), F.col(name).alias("q"))
                for name, cp in SIDES.items()
            ]
        )
    ).alias("side")
    long = book.select(*keys, side).select(*keys, "side.cp", "side.q.*")
    if not with_derived:
        return long
    derived = {}
    for q in ("last", "min"):
        bid, ask = F.col(f"{q}_bid"), F.col(f"{q}_ask")
        derived[f"{q}_valid"] = valid_quote(bid, ask)
        derived[f"{q}_spread"] = derive_spread(bid, ask)
        derived[f"{q}_mid"] = derive_mid(bid, ask)
    return long.withColumns(derived)


def long_to_book(long: DataFrame) -> DataFrame:
    """Inverse of :func:`book_to_long` for snapshots that arrive as rows."""
    fields = [f for f in QUOTE_FIELDS if f in long.columns]
    quote = F.struct(*fields)
    return long.groupBy(*SERIES, "idx", "time", "snapshot_sysid").agg(
        *[F.max(F.when(F.col("cp") == cp, quote)).alias(name) for name, cp in SIDES.items()]
    )


def asof_last(ticks: DataFrame, schedule: DataFrame) -> DataFrame:
    """Newest quote of each side of every quoted strike at each snapshot.

    Ticks and snapshot markers are one table, put in order of series and sequence number
    by range, where a marker takes the last tick before it; a tick with the marker's own
    number counts. Ranges cut a series wherever it is large, so a product with a third
    of all ticks lies in as many partitions as its rows need. A range starts with the
    newest quote that the ranges before it left, one row each. No bucket width and no
    broadcast is involved, however many snapshots there are.
    """
    sides = F.explode(F.array(*map(F.lit, SIDES.values()))).alias("cp")
    grid = strike_grid(schedule, ticks.select(*SERIES).distinct())
    series = [*SERIES, "cp"]
    quote = F.struct(
        F.col("bid").alias("raw_bid"), F.col("ask").alias("raw_ask"), F.col("seqno").alias("raw_sysid")
    )
    quotes = ticks.select(*series, "seqno", F.lit(0).alias("marker"), quote.alias("quote"))
    markers = grid.select(*SERIES, sides, F.col("sysid").alias("seqno"), F.lit(1).alias("marker"), "idx", "time")
    placed = (
        quotes.unionByName(markers, allowMissingColumns=True)
        .repartitionByRange(*series, "seqno", "marker", "idx")
        .withColumn("part", F.spark_partition_id())
    )
    in_part = Window.partitionBy("part", *series).orderBy("seqno", "marker", "idx")
    known = written_once(
        placed.withColumn("known", F.last("quote", ignorenulls=True).over(in_part))
        .withColumn("is_end", F.lead("marker").over(in_part).isNull())
        .where("marker = 1 or is_end")
        .select(*series, "part", "marker", "idx", "time", "known", "is_end")
    )
    earlier = Window.partitionBy(*series).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    left = known.where("is_end").select(
        *series, "part", F.last("known", ignorenulls=True).over(earlier).alias("left")
    )
    shown = known.where("marker = 1").join(left, [*series, "part"], "left")
    quoted = F.max("at.raw_sysid").over(Window.partitionBy(*SERIES)).isNotNull()
    return (
        shown.withColumn("at", F.coalesce("known", "left"))
        .withColumn("quoted", quoted)
        .where("quoted")
        .select(*series, "idx", "time", "at.*")
    )


def last_quote(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Newest quote per group of already placed ticks."""
    picked = newest(
        F.col("seqno"), "last",
        bid=F.col("bid"), ask=F.col("ask"),
        clock=tick_clock(F.col("tick_time")).try_cast("bigint"),
    )
    return (
        placed.groupBy(*keys)
        .agg(*picked)
        .withColumn("last_time", F.lpad(F.col("last_clock").cast("string"), 12, "0"))
        .withColumnRenamed("last_seqno", "last_sysid")
        .drop("last_clock")
    )


def min_spread_quote(
    ticks: DataFrame,
    schedule: DataFrame,
    strikes: DataFrame | None = None,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Smallest-spread valid quote per series and snapshot, carried quote included."""
    long = book_to_long(snapshot_book(ticks, schedule, strikes, cfg), with_derived=False)
    return long.select(
        *SERIES, "cp", "idx", "time", "min_bid", "min_ask", "min_spread", "min_sysid"
    )


def snapshot_at(
    ticks: DataFrame, target: DataFrame, strikes: DataFrame | None = None,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """One snapshot without validity rules: last and smallest-spread quote.

    ``target`` holds one ``(trade_date, sysid, prev_sysid)`` per date. The
    quotes of a series run from its last tick at or before ``prev_sysid``
    (included) to its last tick at or before ``sysid``; all are folded on the
    map side.
    """
    series = [*SERIES, "cp"]
    bid, ask, seqno = F.col("bid"), F.col("ask"), F.col("seqno")
    known = ticks.join(
        bounded_broadcast(target, cfg.broadcast_bytes), "trade_date"
    ).where("seqno <= sysid")
    earlier = seqno <= F.col("prev_sysid")
    folded = (
        with_spread_order(known, cfg)
        .withColumn("early_seqno", F.when(earlier, seqno))
        .withColumn("fresh_order", F.when(~earlier, F.col("spread_order")))
        .groupBy(*series)
        .agg(
            *newest(seqno, "last", bid=bid, ask=ask),
            *newest(
                F.col("early_seqno"), "carry",
                bid=bid, ask=ask, order=F.col("spread_order"),
            ),
            *least_spread(F.col("fresh_order"), "fresh"),
        )
    )
    from_carry = F.col("fresh_order").isNull() | (F.col("carry_order") < F.col("fresh_order"))
    pick = lambda n: F.when(
        is_true(from_carry), F.col(f"carry_{n}")
    ).otherwise(F.col(f"fresh_{n}"))
    result = folded.select(
        *series,
        "last_bid",
        "last_ask",
        F.col("last_seqno").alias("last_sysid"),
        pick("bid").alias("min_bid"),
        pick("ask").alias("min_ask"),
        (pick("ask") - pick("bid")).alias("min_spread"),
        pick("seqno").alias("min_sysid"),
    )
    if strikes is None:
        return result
    sides = F.explode(F.array(F.lit("Call"), F.lit("Put"))).alias("cp")
    return strikes.select("*", sides).join(result, series, "left")
