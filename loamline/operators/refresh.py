"""The marts as a graph: each names what it is built from, and a refresh follows from that."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loamline.operators import detection, identity, marts, quality, seats

#: Rows of the log that refreshes append to.
LOGGED = "mart string, row_count long, started_at timestamp, finished_at timestamp"


@dataclass(frozen=True)
class Node:
    """A table, the names of the tables or sources that it is built from, and what builds it of these in order; ``mart`` tells whether the log names it."""

    needs: tuple[str, ...]
    build: Callable[..., DataFrame]
    mart: bool = True


def _all_days(events: DataFrame, metrics: DataFrame, as_of: datetime.date) -> DataFrame:
    return marts.dim_date([x.agg(F.min("activity_date")) for x in (events, metrics, marts.api_requests(events))], as_of)


def graph(spark: SparkSession, log: str, as_of: datetime.date, *, floor: datetime.date, least_sessions: int = 2) -> dict[str, Node]:
    """All marts over the sources events, metrics, utilization, roster and manual_alias; findings are appended to the log at ``log`` as the cycle of ``as_of``."""

    def findings(events: DataFrame, metrics: DataFrame, roster: DataFrame, manual: DataFrame, intervals: DataFrame) -> DataFrame:
        found = detection.detect(events, metrics, roster, manual, floor=floor, intervals=intervals, least_sessions=least_sessions)
        detection.append_cycle(spark, log, as_of, found)
        return detection.open_findings(*detection.read_log(spark, log))

    e, m = "events", "metrics"
    return {
        "segments": Node(("utilization",), marts.utilization_segments, mart=False), "intervals": Node(("roster",), seats.seat_intervals, mart=False),
        "derived_alias": Node((e, m), identity.derived_alias, mart=False),
        "fact_session": Node((e, m), marts.fact_session), "fact_session_daily": Node((e, m), marts.fact_session_daily), "fact_api_usage": Node((e,), marts.fact_api_usage),
        "fact_edit_decision": Node((m,), marts.fact_edit_decision), "fact_tool_outcome": Node((e,), marts.fact_tool_outcome), "fact_api_error_rate": Node((e,), marts.fact_api_error_rate),
        "fact_usage_window": Node(("segments",), marts.fact_usage_window), "fact_utilization_hourly": Node(("segments",), marts.utilization_hourly),
        "bridge_agent": Node((e,), marts.bridge_agent), "bridge_hook": Node((e,), marts.bridge_hook), "bridge_server": Node((e,), marts.bridge_server),
        "bridge_plugin": Node((e,), marts.bridge_plugin), "bridge_skill": Node((e,), marts.bridge_skill), "dim_model": Node((e, m), marts.dim_model),
        "dim_user": Node((e, m, "manual_alias", "derived_alias"), marts.dim_user), "dim_date": Node((e, m), lambda e, m: _all_days(e, m, as_of)),
        "dim_seat": Node(("intervals",), lambda i: i.withColumn("is_current", F.col("valid_to").isNull())), "dim_seat_current": Node(("intervals",), seats.current_seats),
        "fact_seat_day": Node(("intervals",), lambda i: seats.seat_days(i, as_of)), "seat_config_convergence": Node((e, m), quality.config_convergence),
        "dq_finding_current": Node((e, m, "roster", "manual_alias", "intervals"), findings),
    }


def refresh(spark: SparkSession, nodes: Mapping[str, Node], sources: Mapping[str, DataFrame], root: str, *, at_once: int = 4) -> DataFrame:
    """Write every node under ``root`` once all that it is built from is written, append (mart, row_count, started_at, finished_at) to the log there, and return these rows.

    What several marts share is a node, so it is computed once and read back. ``at_once`` tables are written at a time; rows are counted as they are written.
    A name that is neither a node nor a source is an error before anything is written.
    """
    missing = {n for x in nodes.values() for n in x.needs} - set(nodes) - set(sources)
    if missing:
        raise ValueError(f"neither a table nor a source: {', '.join(sorted(missing))}")
    order = TopologicalSorter({name: [n for n in x.needs if n in nodes] for name, x in nodes.items()})
    order.prepare()
    tables = dict(sources)

    def write(name: str) -> tuple[str, int, datetime.datetime, datetime.datetime]:
        begun, seen = datetime.datetime.now(datetime.UTC), Observation()
        rows = nodes[name].build(*[tables[n] for n in nodes[name].needs])
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}")
        tables[name] = spark.read.schema(rows.schema).parquet(f"{root}/{name}")
        return name, seen.get["n"], begun, datetime.datetime.now(datetime.UTC)

    log = []
    with ThreadPoolExecutor(at_once) as pool:
        while order.is_active():
            ready = order.get_ready()
            log += pool.map(write, ready)
            order.done(*ready)
    told = spark.createDataFrame([x for x in log if nodes[x[0]].mart], LOGGED)
    told.coalesce(1).write.mode("append").parquet(f"{root}/_refresh_log")
    return told
