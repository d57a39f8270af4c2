"""The detection cycle: all detectors run over the same rows, and their findings go to one log that is only appended to."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.operators import identity, marts, quality, seats
from loamline.sources.commits import Commits
from loamline.sources.shared import written

col = F.col
LOG = "cycle date, finding_type string, subject string, kind string, row_count long, details string"
#: One row per cycle, so that a cycle that found nothing is known too.
CYCLES = "cycle date, findings long"


def detect(
    events: DataFrame, metrics: DataFrame, roster: DataFrame, manual: DataFrame, *, floor: datetime.date, intervals: DataFrame | None = None, least_sessions: int = 2
) -> DataFrame:
    """Findings of all detectors: (finding_type, subject, kind, row_count, details).

    Seat history and days with telemetry are derived once, into tables that the detectors share. Empty inputs give no findings.
    """
    history = intervals if intervals is not None else written(seats.seat_intervals(roster), "intervals")
    days = written(marts.telemetry_days(events, metrics), "days")
    uncovered = written(seats.uncovered_days(days, history), "uncovered")
    found = [
        quality.cumulative_rows(metrics), quality.unknown_email(events, metrics), quality.multi_email_session(events, metrics), quality.cost_divergence(marts.fact_api_usage(events), metrics, floor),
        quality.telemetry_after_close(uncovered), quality.emitter_without_seat(uncovered), quality.reopened_within_cadence(history, roster), quality.assignment_without_tier(roster),
        quality.multi_subscription(roster), quality.boundary_basis(history),
        quality.unresolved_identity(days, identity.derived_alias(events, metrics, least_sessions=least_sessions), manual, roster), quality.owner_mismatch(events, metrics),
    ]
    return reduce(DataFrame.unionByName, found)


def append_cycle(spark: SparkSession, root: str, cycle: datetime.date, findings: DataFrame | Callable[[], DataFrame]) -> bool:
    """Append a cycle's findings to the log by one commit; a cycle that is in, or is older than the last one, changes nothing and gives False.

    ``findings`` may be a function, called only if the cycle is new: detectors write tables of their own before they find anything.
    """
    commits = Commits(spark, root)
    if commits.state().batches.get("cycles", 0) >= cycle.toordinal():
        return False
    findings = findings() if callable(findings) else findings
    rows = written(findings.select(F.lit(cycle).alias("cycle"), "finding_type", "subject", "kind", "row_count", "details"), "findings")
    told = rows.agg(F.count("*").alias("findings")).select(F.lit(cycle).alias("cycle"), "findings")
    commits.commit(commits.write("findings", rows, "cycle") + commits.write("cycles", told, "cycle"), batch=("cycles", cycle.toordinal()))
    return True


def read_log(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The log's findings, and its cycles."""
    commits = Commits(spark, root)
    state = commits.state()
    return commits.read("findings", LOG, state=state), commits.read("cycles", CYCLES, state=state)


def open_findings(log: DataFrame, cycles: DataFrame) -> DataFrame:
    """Findings of the last cycle as it told them, with first sight and the start of their present streak; none if the last cycle found nothing."""
    last = F.broadcast(cycles.agg(F.max("cycle").alias("cycle")))  # one row
    now = log.join(last, "cycle").select("finding_type", "subject", "kind", "row_count", "details")
    return quality.current_findings(log, cycles).join(now, ["finding_type", "subject"])


def open_defects(found: DataFrame) -> DataFrame:
    """Open defects by type; gauges are no defects."""
    return found.where(col("kind") == "defect").groupBy("finding_type").agg(F.count("*").alias("defects"), F.min("standing_since").alias("oldest"))
