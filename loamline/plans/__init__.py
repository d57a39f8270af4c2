"""The registered queries and the DuckDB SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamline.plans import archive, joins, kpis, marts, quality, seats

MODULES = (marts, joins, seats, quality, kpis, archive)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in MODULES for name, (q, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
