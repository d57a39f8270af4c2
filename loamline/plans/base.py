"""What the modules of registered queries share."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamline.sources import adapters

#: The day at which reports are drawn up; no query reads the clock.
AS_OF = datetime.date(2024, 2, 15)


def frames(*names: str) -> Callable[[Callable[..., DataFrame]], Callable[[SparkSession, str], DataFrame]]:
    """A query from a function of the named adapters' rows."""

    def wrap(f: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
            return f(*[adapters.rows(spark, sf_dir, n) for n in names])

        return query

    return wrap


def sql(names: str, body: str, **ctes: str) -> str:
    """An oracle: adapters' rows and further steps as WITH clauses before ``body``."""
    parts = [adapters.duckdb_with(*names.split())] if names else []
    parts += [f"{k} AS ({v})" for k, v in ctes.items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body
