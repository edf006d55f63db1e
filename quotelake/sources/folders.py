"""Output in folders by date, of which a run replaces its own dates alone."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of rows whose key is null, as Spark names it.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def by_file(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bring the rows of a folder together before writing.

    A rebalance, so adaptive execution splits a large folder over several tasks
    and merges small ones, instead of every task writing into every folder.
    """
    return rows.hint("rebalance", *[F.col(k) for k in keys])


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_files(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """Names of the data files of each folder below ``path``, by the folder's place there."""
    root, files = _hadoop(spark, path)
    found = defaultdict(set)
    if files.exists(root):
        start = files.makeQualified(root).toString().rstrip("/") + "/"
        listed = files.listFiles(root, True)
        while listed.hasNext():
            folder, _, name = listed.next().getPath().toString().removeprefix(start).rpartition("/")
            if not any(part.startswith((".", "_")) for part in (*folder.split("/"), name)):
                found[folder].add(name)
    return dict(found)


def replace_folders(
    rows: DataFrame,
    keys: list[str],
    path: str,
    dates: list[str] | None = None,
    kind: str = "csv",
    layout: Callable[[DataFrame, list[str]], DataFrame] = by_file,
    **options,
) -> set[str]:
    """Write files of a ``kind`` into folders ``key=value/...``, spread over tasks by ``layout``.

    Every folder that gets rows is replaced as a whole (dynamic partition overwrite), and
    so are the other folders of a date that does; ``dates`` (texts as in the folders'
    names) are dates of the run that may have no rows any more. Folders of other dates
    keep their files. A run that fails before its files are in place leaves the old ones.
    Returns the folders written. Only names of files are looked at, no rows.
    """
    spark = rows.sparkSession
    before = folder_files(spark, path)
    writer = layout(rows, keys).write.mode("overwrite").partitionBy(*keys).format(kind)
    writer.option("partitionOverwriteMode", "dynamic").options(**options).save(path)
    after = folder_files(spark, path)
    fresh = {folder for folder, names in after.items() if names != before.get(folder)}
    day = lambda folder: folder.split("/")[0]
    run = {day(folder) for folder in fresh} | {f"{keys[0]}={d}" for d in dates or ()}
    for folder in before.keys() - fresh:
        if day(folder) in run:
            place, files = _hadoop(spark, f"{path}/{folder}")
            files.delete(place, True)
    return fresh
