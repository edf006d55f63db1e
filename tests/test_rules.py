"""Literal cases of single rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotelake.config import EngineConfig
from quotelake.functions import compare, index_math, products, quotes, times
from quotelake.operators import exploration, filtering, index_series, reshape, schedule, snapshots
from quotelake.operators import comparison
from quotelake.schemas import OFFICIAL_QUOTE_COLUMNS
from quotelake.session import new_path, shared_dir
from quotelake.sources import alerts, official, ticks

DAY = dt.date(2025, 12, 1)


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.mark.parametrize(
    "prod_id, expected",
    [
        ("TXO22400A6", ("TXO", 22400, "Call", 202601)),
        (" TXO22400X5 ", ("TXO", 22400, "Put", 202512)),
        ("TXO22400L4", ("TXO", 22400, "Call", 202412)),
        ("TXO22400M4", ("TXO", 22400, "Put", 202401)),
        ("TXF22400A6", None),
        ("TXO2240AA6", None),
        ("TXO22400Y6", None),
        ("TXO22400A66", None),
        ("TXO22400AX", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_product(spark, prod_id, expected):
    df = spark.createDataFrame([(prod_id,)], "prod_id string")
    found = values(products.parse_product(df), "product", "strike", "cp", "yyyymm")
    assert found == ([] if expected is None else [expected])


def test_build_product_id_pads_the_strike(spark):
    df = spark.createDataFrame([(9800, "Put", 202601)], "strike int, cp string, yyyymm int")
    built = products.build_product_id(F.col("strike"), F.col("cp"), F.col("yyyymm"))
    assert values(df.select(built.alias("x")), "x") == [("TXO09800M6",)]


@pytest.mark.parametrize(
    "bid, ask, valid, reason",
    [
        (1.0, 2.0, True, ""),
        (0.0, 2.0, True, ""),
        (None, 2.0, False, quotes.REASON_MISSING),
        (0.0, None, False, quotes.REASON_ONE_SIDED),
        (-1.0, 2.0, False, quotes.REASON_NEGATIVE_BID),
        (1.0, 0.0, False, quotes.REASON_ONE_SIDED),
        (1.0, -3.0, False, quotes.REASON_ASK_NOT_POSITIVE),
        (2.0, 2.0, False, quotes.REASON_ASK_NOT_ABOVE_BID),
    ],
)
def test_valid_quote_reason(spark, bid, ask, valid, reason):
    df = spark.createDataFrame([(bid, ask)], "bid double, ask double").select(
        quotes.valid_quote(F.col("bid"), F.col("ask")).alias("v"),
        quotes.valid_quote_reason(F.col("bid"), F.col("ask")).alias("r"),
    )
    assert values(df, "v", "r") == [(valid, reason)]


@pytest.mark.parametrize(
    "bid, mid, prev, gamma",
    [
        (None, None, 1.0, 1.2),
        (0.0, 5.0, 1.0, 1.2),
        (1.0, None, 1.0, 1.2),
        (1.0, 5.0, None, 2.0),
        (1.0, 4.8 + 1e-12, 4.8, 1.5),
        (1.0, 4.9, 4.8, 2.0),
    ],
)
def test_gamma(spark, bid, mid, prev, gamma):
    df = spark.createDataFrame([(bid, mid, prev)], "b double, m double, p double")
    picked = quotes.gamma_select(F.col("b"), F.col("m"), F.col("p"))
    assert values(df.select(picked.alias("g")), "g") == [(gamma,)]


@pytest.mark.parametrize(
    "bid, ask, ema, prev_ema, prev_mid, restart, code",
    [
        (None, None, 5.0, None, None, True, "5"),
        (None, None, 5.0, None, 3.0, False, "6"),
        (None, None, 5.0, 5.0, 3.0, False, "-"),
        (100.0, 200.0, 5.0, 5.0, 150.0, False, "V"),
        (100.0, 115.0, 5.0, 5.0, 110.0, False, "2"),
        (100.0, 108.0, 5.0, 5.0, 90.0, False, "1,2,3"),
        (100.0, 200.0, 5.0, 5.0, 250.0, False, "4"),
        (0.0, 200.0, 5.0, 5.0, 250.0, False, "V"),
    ],
)
def test_outlier_code(spark, bid, ask, ema, prev_ema, prev_mid, restart, code):
    df = spark.createDataFrame(
        [(bid, ask, ema, prev_ema, prev_mid, restart)],
        "bid double, ask double, ema double, pe double, pm double, r boolean",
    )
    test = quotes.outlier_test(
        F.col("ask") - F.col("bid"), F.col("bid"), F.col("ask"), F.col("ema"), F.col("pe"),
        F.lit(2.0), F.col("pm"), F.col("r"),
    )
    made = df.select(test.alias("t")).select(
        quotes.outlier_code_last(
            F.col("t.is_outlier"), [F.col(f"t.cond_{i}") for i in range(1, 7)]
        ).alias("c")
    )
    assert values(made, "c") == [(code,)]


def test_times(spark):
    df = spark.createDataFrame([("84500107000",), ("134500107000",)], "t string").select(
        times.format_tick_time(F.col("t")).alias("shown")
    )
    assert values(df, "shown") == [("8:45:00.107",), ("13:45:00.107",)]
    one = spark.range(1).select(
        times.prev_time(F.lit("84500")).alias("a"), times.prev_time(F.lit("000000")).alias("b")
    )
    assert values(one, "a", "b") == [("084445", "235945")]


def ticks_of(spark, rows, cp="Call", strike=22400):
    """Ticks ``(seqno, bid, ask)`` of one series."""
    return spark.createDataFrame(
        [
            (DAY, "Near", strike, cp, 202512, seq, "084500000000", "TXO22400L5", bid, ask)
            for seq, bid, ask in rows
        ],
        "trade_date date, term string, strike int, cp string, yyyymm int, seqno bigint, "
        "tick_time string, prod_id string, bid double, ask double",
    )


def schedule_of(spark, sysids, initial):
    rows, prev = [], initial
    for idx, (time, sysid) in enumerate(sysids):
        rows.append((DAY, idx, time, sysid, prev))
        prev = sysid
    return spark.createDataFrame(
        rows, "trade_date date, idx int, time string, sysid bigint, prev_sysid bigint"
    )


def strikes_of(spark, *strikes):
    return spark.createDataFrame(
        [(DAY, "Near", s) for s in strikes], "trade_date date, term string, strike int"
    )


def test_worked_snapshot_example(spark):
    ticks = ticks_of(
        spark,
        [(20000, 100.0, 105.0), (25000, 101.0, 106.0), (35000, 102.0, 104.0), (50000, 103.0, 108.0)],
    )
    plan = schedule_of(spark, [("084515", 57695), ("084530", 60000)], 22934)
    long = snapshots.book_to_long(snapshots.snapshot_book(ticks, plan, strikes_of(spark, 22400)))
    call = long.where("cp = 'Call'").orderBy("idx")
    assert values(call, "last_sysid", "min_sysid") == [(50000, 35000), (50000, 50000)]
    put = long.where("cp = 'Put'")
    assert values(put, "last_sysid", "min_sysid") == [(None, None), (None, None)]


def test_spread_tie_takes_the_newest(spark):
    ticks = ticks_of(spark, [(10, 7.3, 7.7), (20, 7.4, 7.8), (30, 7.0, 9.0)])
    plan = schedule_of(spark, [("084515", 40)], 5)
    long = snapshots.book_to_long(snapshots.snapshot_book(ticks, plan, strikes_of(spark, 22400)))
    assert values(long.where("cp = 'Call'"), "min_sysid") == [(20,)]


def test_boundary_tick_belongs_to_its_snapshot_and_invalid_ticks_fall_back(spark):
    ticks = ticks_of(spark, [(10, 5.0, 6.0), (20, 5.0, 5.5), (25, -1.0, 3.0)])
    plan = schedule_of(spark, [("a", 20), ("b", 30), ("c", 40)], 5)
    long = snapshots.book_to_long(snapshots.snapshot_book(ticks, plan, strikes_of(spark, 22400)))
    got = values(
        long.where("cp = 'Call'").orderBy("idx"), "raw_sysid", "last_sysid", "min_sysid"
    )
    # Second interval: carried quote 20 is valid. Third: the carried quote 25 is not.
    assert got == [(20, 20, 20), (25, 20, 20), (25, 20, None)]


def test_worked_ema_example(spark):
    rows = [("x", i, f"08451{i}", s) for i, s in enumerate([None, 1.0, 1.2, None, 1.5])]
    rows += [("x", 5, "090000", 7.0), ("x", 6, "090015", None)]
    df = spark.createDataFrame(rows, "k string, idx int, time string, min_spread double")
    ema = [r["ema"] for r in filtering.ema_spread(df, ["k"], "idx").orderBy("idx").collect()]
    assert ema[0] is None
    assert ema[1:] == pytest.approx([1.0, 1.01, 1.01, 1.0345, 7.0, 7.0])


def publish(spark, points, prior):
    df = spark.createDataFrame(
        [(DAY, t, v, prior) for t, v in points],
        "trade_date date, time string, original double, prior_close double",
    )
    rows = index_series.publish_filter(df).orderBy("time").collect()
    return [r["published"] for r in rows]


def test_publish_filter_holds_jumps_and_forces_the_fourth(spark):
    points = [("084515", 20.0), ("090000", 20.0), ("090015", 20.4), ("090030", 25.0)]
    points += [("090045", 25.0), ("090100", 25.0), ("090115", 25.0), ("090130", 25.1)]
    assert publish(spark, points, 19.0) == [-1.0, 20.0, 20.4, 20.4, 20.4, 20.4, 25.0, 25.1]


def test_publish_filter_small_change_resets_the_count(spark):
    points = [("090000", 20.0), ("090015", 25.0), ("090030", 25.0), ("090045", 20.1)]
    points += [("090100", 25.0), ("090115", 25.0), ("090130", 25.0), ("090145", 25.0)]
    assert publish(spark, points, 19.0) == [20.0, 20.0, 20.0, 20.1, 20.1, 20.1, 20.1, 25.0]


def test_publish_filter_without_a_base(spark):
    points = [("090000", None), ("090015", None), ("090030", 30.125), ("090045", None)]
    assert publish(spark, points, None) == [-1.0, -1.0, 30.12, 30.12]
    # An unusable open keeps the prior close as base.
    points = [("090000", None), ("090015", None), ("090030", 19.1)]
    assert publish(spark, points, 19.0) == [-1.0, 19.0, 19.1]


def test_variance_and_fallbacks(spark):
    df = spark.createDataFrame(
        [(0.1, 0.002, 5, 20010.0, 20000.0), (0.0, 0.002, 5, 1.0, 1.0), (0.1, None, 0, 1.0, 1.0),
         (0.1, 0.0, 5, 2.0, 1.0), (0.1, 0.002, 5, None, None)],
        "t double, s double, n bigint, f double, k double",
    )
    v = index_math.variance_term(*[F.col(c) for c in "tsnfk"])
    got = [r["v"] for r in df.select(v.alias("v")).collect()]
    assert got[0] == pytest.approx(2 / 0.1 * 0.002 - 1 / 0.1 * 0.0005**2)
    assert got[1:] == [-1.0, -1.0, -1.0, None]
    mix = index_math.index_interpolate(*[F.lit(x) for x in (0.1, 1.0, 0.04, 0.2, 0.0, 0.05)])
    assert values(spark.range(1).select(mix.alias("m")), "m") == [(20.0,)]
    only_next = index_math.index_interpolate(*[F.lit(x) for x in (0.1, 0.5, -1.0, 0.2, 0.5, 0.05)])
    assert values(spark.range(1).select(only_next.alias("m")), "m") == [(None,)]


def test_halves_round_to_even_when_published(spark):
    df = spark.range(1).select(
        index_math.round_publish(F.lit(0.125)).alias("a"),
        index_math.round_half_up(F.lit(0.125)).alias("b"),
    )
    assert values(df, "a", "b") == [(0.12, 0.13)]


def test_difference_predicates(spark):
    df = spark.createDataFrame(
        [(1.0, 1.00005, "100.0", "100"), (1.0, None, "-", ""), (None, None, "V", "1")],
        "a double, b double, s string, t string",
    ).select(
        compare.float_diff(F.col("a"), F.col("b")).alias("f"),
        compare.string_diff(F.col("s"), F.col("t")).alias("g"),
    )
    assert values(df, "f", "g") == [(False, False), (True, False), (False, True)]


def test_page_is_clamped(spark):
    rows = spark.range(25)
    page = reshape.page_rows(rows, ["id"], page=9, per_page=10)
    got = page.collect()
    assert [r["id"] for r in got] == [20, 21, 22, 23, 24]
    assert {(r["page"], r["total"], r["total_pages"]) for r in got} == {(3, 25, 3)}
    assert [r["id"] for r in reshape.page_rows(rows, ["id"], 0, 10).collect()][:1] == [0]


def test_pages_are_slices_of_the_sorted_rows(spark):
    rows = spark.range(0, 1000, 1, 7).selectExpr("id * 37 % 1000 as x", "id % 3 as y")
    listed = sorted((r["y"], r["x"]) for r in rows.collect())
    for page in (1, 4, 11):
        # x is not in the order: it breaks the ties.
        got = reshape.page_rows(rows, ["y"], page, 90).collect()
        assert [(r["y"], r["x"]) for r in got] == listed[(page - 1) * 90 : page * 90]
    some = reshape.page_rows(rows, ["x"], 2, 90, only={"y": 1, "x": "all"}).collect()
    assert [r["x"] for r in some] == [x for y, x in listed if y == 1][90:180]


def test_columns_are_found_by_name_in_every_file(spark, tmp_path):
    day = tmp_path / "day=20240105"
    day.mkdir()
    head = "svel_i081_yymmdd\tsvel_i081_prod_id\tsvel_i081_time\t"
    bid, ask, number = (f"svel_i081_{n}" for n in ("best_buy_price1", "best_sell_price1", "seqno"))
    (day / "a.tsv").write_text(f"{head}{bid}\tqty\t{ask}\t{number}\n20240105\tA\t9\t1\t7\t2\t105\n")
    (day / "b.tsv").write_text(f" {number} \t{head}{ask}\t{bid}\n1000000000000001\t20240105\tB\t9\t4\t3\n")
    got = ticks.read_ticks(spark, str(tmp_path)).orderBy("prod_id").collect()
    assert [(r["prod_id"], r["bid"], r["ask"], r["seqno"]) for r in got] == [
        ("A", 1.0, 2.0, 105), ("B", 3.0, 4.0, 10**15 + 1),
    ]
    (day / "c.tsv").write_text(f"{head}{bid}\t{number}\n")
    with pytest.raises(ValueError, match="ask"):
        ticks.read_ticks(spark, str(tmp_path))


def test_second_strike_column_of_official_files(spark, tmp_path):
    folder = tmp_path / "trade_date=2024-01-05" / "term=Near"
    folder.mkdir(parents=True)
    names = list(OFFICIAL_QUOTE_COLUMNS)
    names[5:5] = ["strike"]
    values = {n: str(i) for i, n in enumerate(OFFICIAL_QUOTE_COLUMNS)} | {"strike": "22400"}
    lines = ["\t".join(names), "84500\t17", "\t".join(values[n] for n in names)]
    (folder / "a.tsv").write_text("\n".join(lines) + "\n")
    row = official.read_quotes_wide(spark, str(tmp_path)).first()
    assert (row["strike"], row["p_bid"], row["p_ask"], row["snapshot_sysid"]) == (22400, 5.0, 6.0, 35)
    start = official.read_start_marker(spark, str(tmp_path)).first()
    assert (start["time"], start["initial_sysid"]) == ("084500", 17)


def test_least_spread_of_large_sequence_numbers(spark):
    large = 2**63 - 1
    rows = [(1.0, 2.0, large - 1), (1.0, 2.0, large), (1.0, 3.0, 5)]
    df = snapshots.with_spread_order(spark.createDataFrame(rows, "bid double, ask double, seqno bigint"))
    assert [r["seqno"] for r in df.orderBy("spread_order").collect()] == [large, large - 1, 5]


def test_repeated_names_in_reports_have_their_last_value(spark):
    entries = "array(named_struct('name', 'a', 'value', '1'), named_struct('name', 'b', 'value', '2'), named_struct('name', 'a', 'value', '3'))"
    df = spark.range(1).select(alerts.last_per_name(F.expr(entries)).alias("m"))
    assert df.first()["m"] == {"b": "2", "a": "3"}


def test_a_cluster_must_name_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_empty_difference_report_has_a_header(spark):
    path = new_path(spark, "empty-diffs")
    empty = spark.createDataFrame(
        [],
        "trade_date date, time string, term string, strike int, cp string, column string, "
        "ours double, official double, sysid bigint, prev_sysid bigint",
    )
    official.write_diffs(empty, path)
    assert official.read_diffs(spark, path).count() == 0
    assert spark.read.option("header", True).csv(path).columns[0] == "Date"


def test_prev_sysid_starts_at_zero(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", None), (1, "c", 9)], "k int, time string, last_sysid bigint"
    )
    got = values(comparison.prev_sysid(df, ["k"]).orderBy("time"), "prev_sysid")
    assert got == [(0,), (5,), (0,)]


def test_schedule_numbers_from_the_marker(spark):
    times_df = spark.createDataFrame(
        [(DAY, "084515", 30), (DAY, "084530", 30), (DAY, "084545", 50)],
        "trade_date date, time string, sysid bigint",
    )
    marker = spark.createDataFrame([(DAY, 7)], "trade_date date, initial_sysid bigint")
    got = schedule.number_schedule(times_df, marker).orderBy("idx")
    assert values(got, "idx", "sysid", "prev_sysid") == [(0, 30, 7), (1, 30, 30), (2, 50, 30)]


def test_interval_window_modes(spark):
    plan = schedule_of(spark, [(str(i), 10 * (i + 1)) for i in range(10)], 0)
    asked = spark.createDataFrame(
        [(DAY, "center", 52), (DAY, "prepend", 48), (DAY, "append", 95), (DAY, "center", 1)],
        "trade_date date, mode string, wanted_sysid bigint",
    )
    got = exploration.interval_window(plan, asked, lookback=1, lookforward=2)
    assert sorted(values(got, "mode", "wanted_sysid", "range_start", "range_end")) == [
        ("append", 95, 90, 100), ("center", 1, 0, 30), ("center", 52, 30, 70),
        ("prepend", 48, 0, 40),
    ]


def test_last_and_min_tags_prefer_the_oldest_tie(spark):
    ticks = ticks_of(spark, [(1, 5.0, 6.0), (2, 6.0, 7.0), (3, -1.0, 2.0)]).withColumn(
        "idx", F.lit(0)
    )
    got = values(exploration.last_min_tags(ticks).orderBy("seqno"), "seqno", "tags", "error_codes")
    assert got == [(1, ["MIN"], []), (2, ["LAST"], []), (3, [], ["E1"])]


REPORT = "\n".join(
    [
        "Alert", "Index triggered by condition 1 & 3 & x", "condition1: a: b", "condition3: c", "",
        "date\ttime\tnearT\tnearSigma^2", "20251201\t090000\t0.1\t", "20251201\t090015\t\t0.5", "",
        "month\ttime\tmoneyness\tstrike",
        "202601\t090015\t OTM \t100\t1\t2\t3\t4",
        "202512\t090015\tITM\t200\t1\t2\t3\t4\t202512\tt\tm\t5\t6\t7\t8\t9\t-2.5%",
        "202603\t090015\tITM\t300\t1\t2\t3\t4",
        "202512\t090015\tshort",
        "",
    ]
)


def test_alert_report(spark):
    texts = spark.createDataFrame(
        [("file:/x/20251201_alert_report.090015.tsv", REPORT), ("file:/x/other.tsv", "x")],
        "path string, text string",
    )
    reports = alerts.parse_reports(texts)
    row = reports.collect()[0]
    assert (row["trade_date"], row["time_display"]) == (DAY, "09:00:15")
    assert row["conditions"] == [1, 3]
    assert row["descriptions"] == {"1": "a: b", "3": "c"}
    assert row["summary"]["prev"] == {"date": "20251201", "time": "090000", "nearT": "0.1"}
    assert row["summary"]["current"]["nearSigma2"] == "0.5"
    parts = alerts.alert_contributions(reports)
    assert sorted(values(parts, "term", "strike", "has_changed", "contrib_diff_pct")) == [
        ("Near", "200", True, "-2.5%"), ("Next", "100", False, ""),
    ]
    listed = alerts.alert_list(reports, parts).collect()[0]
    assert [x["strike"] for x in listed["near"]] == ["200"]


def test_configuration_is_frozen():
    with pytest.raises(AttributeError):
        EngineConfig().alpha = 0.5
