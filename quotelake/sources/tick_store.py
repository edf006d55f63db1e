"""Parsed ticks in folders by date and expiry, in the order of their sequence numbers.

Folder names tell the expiries of a date, so the near and the next one are known without
reading a tick. A join with these terms prunes folders while it runs (dynamic partition
pruning). Files hold ranges of sequence numbers in order, so a question about a few
snapshots has its bounds as filters of the scan, which leaves out row groups and pages
by their statistics.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators.terms import near_next_terms
from quotelake.sources.folders import folder_files, replace_folders

KEYS = ["trade_date", "yyyymm"]
#: Bytes of a row group, the least that is skipped as a whole, and rows of a page.
GROUP_BYTES, PAGE_ROWS = 4 << 20, 5_000


def _by_seqno(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges of folder and sequence number, so that a large folder has many files."""
    return rows.repartitionByRange(*keys, "seqno").sortWithinPartitions(*keys, "seqno")


def write_tick_store(
    parsed: DataFrame,
    path: str,
    dates: list[str] | None = None,
    group_bytes: int = GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Parsed ticks as Parquet; dates that are written again replace their folders."""
    options = {"parquet.block.size": group_bytes, "parquet.page.row.count.limit": page_rows}
    replace_folders(parsed, KEYS, path, dates, "parquet", _by_seqno, **options)


def stored_expiries(spark: SparkSession, path: str) -> DataFrame:
    """``trade_date, yyyymm`` of every folder, by the folders' names alone."""
    found = [re.fullmatch(r"trade_date=([\d-]+)/yyyymm=(\d+)", f) for f in folder_files(spark, path)]
    rows = [(m[1], int(m[2])) for m in found if m]
    names = spark.createDataFrame(rows, "trade_date string, yyyymm int")
    return names.withColumn("trade_date", F.col("trade_date").cast("date"))


def read_tick_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_term_ticks(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """Ticks of the near and next expiry of each date, with their ``term``.

    ``dates`` (``YYYY-MM-DD``) limits the folders. The terms are two rows a date, made
    from folder names, which Spark holds in its file index too; they are broadcast, and
    their expiries prune the folders before any file is opened.
    """
    terms, ticks = near_next_terms(stored_expiries(spark, path)), read_tick_store(spark, path)
    if dates is not None:
        wanted = F.col("trade_date").isin([F.lit(d).cast("date") for d in dates])
        terms, ticks = terms.where(wanted), ticks.where(wanted)
    return ticks.join(F.broadcast(terms), KEYS)


@dataclass(frozen=True)
class TickRequest:
    """One snapshot of one series: its date, term, strike, side and sequence number, and
    that of the snapshot before. Bounds that are given replace the usual ones, which
    are ``(prev_sysid, sysid]`` and the ``before`` numbers up to ``prev_sysid``."""

    trade_date: str
    term: str
    strike: int
    cp: str
    sysid: int
    prev_sysid: int
    curr_start: int | None = None
    curr_end: int | None = None
    prev_start: int | None = None
    prev_end: int | None = None
    before: int = 500

    def parts(self) -> dict[str, tuple[int, int]]:
        given = lambda value, usual: usual if value is None else value
        return {
            "current": (given(self.curr_start, self.prev_sysid), given(self.curr_end, self.sysid)),
            "prev": (
                given(self.prev_start, self.prev_sysid - self.before),
                given(self.prev_end, self.prev_sysid),
            ),
        }


def request_ticks(spark: SparkSession, path: str, request: TickRequest) -> DataFrame:
    """Ticks of a request, ``part`` telling which of its two ranges they are of.

    Date, expiry, series and both ranges are filters of the scan: it opens one folder
    and reads the row groups whose sequence numbers can be in a range. A date without
    that term gives no rows; a tick in both ranges is there twice.
    """
    day = F.lit(request.trade_date).cast("date")
    terms = near_next_terms(stored_expiries(spark, path).where(F.col("trade_date") == day))
    expiry = [r["yyyymm"] for r in terms.where(F.col("term") == request.term).collect()]
    inside = {
        part: (F.col("seqno") > low) & (F.col("seqno") <= high)
        for part, (low, high) in request.parts().items()
    }
    of_series = (
        (F.col("trade_date") == day)
        & F.col("yyyymm").isin(expiry)
        & (F.col("strike") == request.strike)
        & (F.col("cp") == request.cp)
    )
    found = read_tick_store(spark, path).where(of_series).where(_any(list(inside.values())))
    parts = F.array_compact(F.array(*(F.when(c, F.lit(p)) for p, c in inside.items())))
    return found.select(F.explode(parts).alias("part"), F.lit(request.term).alias("term"), *found.columns)


def _any(conditions: list[Column]) -> Column:
    whole = conditions[0]
    for condition in conditions[1:]:
        whole = whole | condition
    return whole
