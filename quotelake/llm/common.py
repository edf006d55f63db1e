"""Helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.session import new_path, shared_dir

#: Spark's setting to remove shuffle files at the end of an execution.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other letter stays as it is."""
    return F.translate(text, UPPER, LOWER)


def or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: what follows reads the table again if executors are lost. The
    shuffle files behind the table go as soon as it is written.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Remove a table of ``written`` whose successor is written."""
    spark, folders = df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        inside = files.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))).toString()
        if files.makeQualified(path).toString().startswith(inside.rstrip("/") + "/"):
            files.delete(path, True)


def unused_name(name: str, columns: list[str]) -> str:
    """``name``, or with underscores put before it, so that no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once per row.

    The optimizer moves a projected expression to where it is used, which inside a
    lambda or after an explode means once per element. It leaves the output of a
    generator alone, here one with one row.
    """
    value = F.struct(*(c.alias(n) for n, c in columns.items()))
    kept = df.select("*", F.explode(F.array(value)).alias("__computed"))
    return kept.select(*df.columns, *(F.col(f"__computed.{n}").alias(n) for n in columns))
