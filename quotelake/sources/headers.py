"""Delimited files whose columns are found by the names in each file's own header."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.schemas import text_schema


def file_headers(
    spark: SparkSession, path: str, wanted: tuple[str, list[str]] | None = None
) -> list[tuple[str, list[str]]]:
    """Each different first line with the files that begin with it.

    ``wanted`` is a folder column and the values of it that are read. A pass over the lines without parsing any; what comes to the driver is one name
    per file, which Spark's own file index holds too.
    """
    texts = spark.read.text(path)
    if wanted is not None and wanted[0] in texts.columns:
        texts = texts.where(F.col(wanted[0]).cast("string").isin(wanted[1]))
    lines = texts.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
    )
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    layouts = first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return [(row["header"], row["files"]) for row in layouts.orderBy("header").collect()]


def names_of(header: str, sep: str) -> list[str]:
    return [name.strip().strip('"').strip() for name in header.lstrip("\ufeff").split(sep)]


def exact_names(columns: dict[str, str]) -> Callable[[list[str]], dict[str, int]]:
    """Finds columns by their full file names; of a repeated name the first counts."""

    def locate(names: list[str]) -> dict[str, int]:
        return {column: names.index(name) for name, column in columns.items() if name in names}

    return locate


def read_by_header(
    spark: SparkSession,
    path: str,
    sep: str,
    required: list[str],
    locate: Callable[[list[str]], dict[str, int]],
    first_fields: tuple[str, ...] = (),
    wanted: tuple[str, list[str]] | None = None,
) -> DataFrame:
    """The ``required`` columns as texts, with the folder columns of ``path``.

    ``locate`` gives the place of each column in a header. Files may hold more
    columns, in any order of their own; one without a required column is an error.
    ``first_fields`` name the first fields of a row, whatever their header.
    """
    parts = []
    for header, files in file_headers(spark, path, wanted):
        names = names_of(header, sep)
        places = locate(names)
        missing = [c for c in required if c not in places]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in {files[0]}")
        fields = [f"field_{i}" for i in range(len(names))]
        raw = (
            spark.read.schema(text_schema(fields))
            .option("sep", sep).option("header", True).option("basePath", path).csv(files)
        )
        folders = [c for c in raw.columns if c not in fields]
        parts.append(
            raw.select(
                *folders,
                *(F.col(fields[places[c]]).alias(c) for c in required),
                *(F.col(fields[i]).alias(c) for i, c in enumerate(first_fields)),
            )
        )
    if not parts:
        # Only files without a line: nothing to bind, nothing to read.
        return spark.read.schema(text_schema([*required, *first_fields])).csv(path)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
