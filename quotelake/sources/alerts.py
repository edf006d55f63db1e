"""Alert reports: text files of several sections, one nested row per file.

A report holds the contributions of one moment, so its lines fit one row; the
files of all dates are parsed in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelake.functions.times import display_time

# Markers, header names and field places of the report format.
FILE_PATTERN = r"([0-9]{8})_alert_report\.([0-9]{6})\.tsv"
TRIGGER = "triggered by condition"
SUMMARY_HEADER = "date\ttime\tnearT"
CONTRIB_HEADER = "month\ttime\tmoneyness"
SUMMARY_NAMES = {
    "nearSigma^2": "nearSigma2",
    "No of nearSeries": "nearSeriesCount",
    "nextSigma^2": "nextSigma2",
    "No of nextSeries": "nextSeriesCount",
}
FIELDS_BEFORE = {
    "moneyness": 2, "strike": 3, "prev_mid": 4, "prev_spread_ratio": 5,
    "prev_contrib": 6, "prev_weight": 7,
}
FIELDS_AFTER = {
    "curr_mid": 11, "curr_spread_ratio": 12, "curr_contrib": 13, "curr_weight": 14,
    "weight_diff": 15, "contrib_diff_pct": 16,
}
CHANGED_FIELDS = 17
LEAST_FIELDS = 8


def read_report_texts(spark: SparkSession, path: str) -> DataFrame:
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return texts.select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def _first_line(lines: Column, start: str, after: Column | None = None) -> Column:
    """1-based place of the first line that starts with ``start``; 0 if there is none."""
    hits = F.transform(
        lines,
        lambda line, i: line.startswith(start) & (F.lit(True) if after is None else i >= after),
    )
    return F.array_position(hits, True).cast("int")


def parse_reports(texts: DataFrame) -> DataFrame:
    """One row per report: conditions, descriptions, summary and contributions."""
    named = texts.select(
        F.regexp_extract("path", FILE_PATTERN, 1).alias("date_text"),
        F.regexp_extract("path", FILE_PATTERN, 2).alias("time"),
        F.split(F.regexp_replace("text", r"\r|\n\z", ""), "\n").alias("lines"),
    ).where("time <> ''")
    lines = F.col("lines")
    placed = (
        named.withColumn("summary_at", _first_line(lines, SUMMARY_HEADER))
        .where("summary_at > 0")
        .withColumn(
            "contrib_at", _first_line(lines, CONTRIB_HEADER, F.col("summary_at") + 2)
        )
    )
    at, contrib_at = F.col("summary_at"), F.col("contrib_at")
    return placed.select(
        F.to_date("date_text", "yyyyMMdd").alias("trade_date"),
        "time",
        display_time(F.col("time")).alias("time_display"),
        _conditions(F.trim(F.get(lines, F.lit(1)))).alias("conditions"),
        _descriptions(lines, at).alias("descriptions"),
        F.struct(
            _summary_row(lines, at, 1).alias("prev"), _summary_row(lines, at, 2).alias("current")
        ).alias("summary"),
        F.when(
            contrib_at > 0,
            F.transform(
                F.filter(F.slice(lines, contrib_at + 1, F.size(lines)), lambda x: x != ""),
                lambda x: F.split(x, "\t"),
            ),
        ).alias("rows"),
    )


def _conditions(trigger: Column) -> Column:
    numbers = F.split(F.split_part(trigger, F.lit(TRIGGER), F.lit(2)), "&")
    digits = F.filter(F.transform(numbers, lambda n: F.trim(n)), lambda n: n.rlike("^[0-9]+$"))
    return F.when(trigger.contains(TRIGGER), F.transform(digits, lambda n: n.cast("int"))).otherwise(
        F.array().cast("array<int>")
    )


def last_per_name(entries: Column) -> Column:
    """Map of entries ``(name, value)``; a repeated name has its last value."""
    later = lambda i: F.transform(
        F.slice(entries, i + 2, F.size(entries)), lambda e: e["name"]
    )
    kept = F.filter(entries, lambda e, i: ~F.array_contains(later(i), e["name"]))
    return F.map_from_entries(kept)


def _descriptions(lines: Column, summary_at: Column) -> Column:
    between = F.transform(
        F.slice(lines, 3, F.greatest(summary_at - 3, F.lit(0))), lambda x: F.trim(x)
    )
    pattern = r"^condition\s*([0-9]+)\s*:(.*)$"
    listed = F.filter(between, lambda x: x.rlike(pattern))
    return last_per_name(
        F.transform(
            listed,
            lambda x: F.struct(
                F.regexp_extract(x, pattern, 1).alias("name"),
                F.trim(F.regexp_extract(x, pattern, 2)).alias("value"),
            ),
        )
    )


def _summary_row(lines: Column, summary_at: Column, offset: int) -> Column:
    """Header name -> value of one summary line; blanks are dropped."""
    cells = lambda place: F.transform(
        F.split(F.get(lines, place), "\t"), lambda x: F.trim(x)
    )
    header, values = cells(summary_at - 1), cells(summary_at - 1 + offset)
    known = F.create_map(*[F.lit(x) for pair in SUMMARY_NAMES.items() for x in pair])
    pairs = F.filter(
        F.arrays_zip(header.alias("name"), values.alias("value")),
        lambda p: p["name"].isNotNull() & (F.coalesce(p["value"], F.lit("")) != ""),
    )
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            F.coalesce(known[p["name"]], p["name"]).alias("name"), p["value"].alias("value")
        ),
    )
    return F.when(F.size(lines) > summary_at + 1, last_per_name(entries))


def alert_conditions(reports: DataFrame) -> DataFrame:
    """One row per report and triggered condition, with its description."""
    return reports.select(
        "trade_date", "time", "descriptions", F.explode("conditions").alias("condition")
    ).select(
        "trade_date",
        "time",
        "condition",
        F.col("descriptions")[F.col("condition").cast("string")].alias("description"),
    )


def alert_summary(reports: DataFrame) -> DataFrame:
    """One row per report, moment (prev, current) and named value."""
    moments = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("moment"), F.col("summary")[m].alias("values"))
                for m in ("prev", "current")
            ]
        )
    ).alias("m")
    return reports.select("trade_date", "time", moments).select(
        "trade_date",
        "time",
        "m.moment",
        F.explode("m.values").alias("name", "value"),
    )


def alert_contributions(reports: DataFrame) -> DataFrame:
    """Contributions before and after per strike of the two nearest months."""
    rows = reports.select(
        "trade_date", "time", F.posexplode("rows").alias("line", "fields")
    ).withColumn("month", F.col("fields")[0])
    number = F.when(F.col("month").rlike("^[0-9]+$"), F.col("month").try_cast("int"))
    # Ranked within one report, whose lines are few.
    by_month = Window.partitionBy("trade_date", "time").orderBy(F.col("number").asc_nulls_last())
    ranked = rows.withColumn("number", number).withColumn(
        "month_rank", F.when(F.col("number").isNotNull(), F.dense_rank().over(by_month))
    )
    fields = F.col("fields")
    changed = (F.size(fields) >= CHANGED_FIELDS) & (F.trim(F.get(fields, F.lit(8))) != "")
    changed = F.coalesce(changed, F.lit(False))
    text = lambda i: F.get(fields, F.lit(i))
    return ranked.where(
        (F.size(fields) >= LEAST_FIELDS) & F.col("month_rank").isin(1, 2)
    ).select(
        "trade_date",
        "time",
        F.when(F.col("month_rank") == 1, "Near").otherwise("Next").alias("term"),
        "line",
        *[
            (F.trim(text(i)) if name == "moneyness" else text(i)).alias(name)
            for name, i in FIELDS_BEFORE.items()
        ],
        *[
            F.when(changed, text(i)).otherwise("").alias(name)
            for name, i in FIELDS_AFTER.items()
        ],
        changed.alias("has_changed"),
    )


def percent_move(text: Column) -> Column:
    return F.coalesce(F.abs(F.replace(text, F.lit("%"), F.lit("")).try_cast("double")), F.lit(0.0))


def top_contrib_moves(contributions: DataFrame, n: int | None = None) -> DataFrame:
    """Contributions ranked by absolute percent move within report and term."""
    order = Window.partitionBy("trade_date", "time", "term").orderBy(
        F.desc(percent_move(F.col("contrib_diff_pct"))), "line"
    )
    ranked = contributions.withColumn("move_rank", F.row_number().over(order))
    return ranked if n is None else ranked.where(F.col("move_rank") <= n)


def alert_list(reports: DataFrame, contributions: DataFrame) -> DataFrame:
    """Reports in time order with their contributions, largest moves first."""
    ranked = top_contrib_moves(contributions)
    item = F.struct("move_rank", *[c for c in contributions.columns if c not in
                                   ("trade_date", "time", "term", "line")])
    lists = ranked.groupBy("trade_date", "time").agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("term") == t, item))).alias(t.lower())
            for t in ("Near", "Next")
        ]
    )
    return (
        reports.drop("rows")
        .join(lists, ["trade_date", "time"], "left")
        .orderBy("trade_date", "time")
    )
