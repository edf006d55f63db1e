"""Registry of queries and of the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.registry.fixtures import Fixture
from quotelake.registry.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DECIMALS = 6


def query(sql: str | None = None, rounded: tuple = (), dates: tuple = ("trade_date",)):
    """Register a query under its function's name.

    Dates leave as texts and ``rounded`` columns with six decimals, in the
    query and in its SQL alike.
    """

    def register(build: Callable[[Fixture], DataFrame]):
        name = build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(Fixture(spark, sf_dir))
            kinds = {f.name: f.dataType for f in df.schema.fields}
            shown = {c: F.round(c, DECIMALS) for c in rounded}
            shown |= {
                c: F.col(c).cast("string") for c, t in kinds.items() if isinstance(t, T.DateType)
            }
            return df.withColumns(shown) if shown else df

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _shown(sql, rounded, dates)
        return build

    return register


def _shown(sql: str, rounded: tuple, dates: tuple) -> str:
    replaced = [f"cast({d} as varchar) as {d}" for d in dates]
    replaced += [f"round({c}, {DECIMALS}) as {c}" for c in rounded]
    outer = f"select * replace ({', '.join(replaced)})" if replaced else "select *"
    return with_views(f"{outer} from (\n{sql.strip()}\n) shown")
