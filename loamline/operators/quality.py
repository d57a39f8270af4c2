"""Detectors of data-quality conditions: (finding_type, subject, kind, row_count, details)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions.columns import email_bucket, is_corporate, latest
from loamline.operators.marts import counter_delta

col = F.col
DATASET = "(dataset)"


def _finding(df: DataFrame, name: str, kind: str, subject: Column, count: Column, **details: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("finding_type"), subject.alias("subject"), F.lit(kind).alias("kind"), count.cast("bigint").alias("row_count"),
        F.to_json(F.struct(*[v.alias(k) for k, v in details.items()])).alias("details") if details else F.lit("{}").alias("details"),
    )


def cumulative_rows(metrics: DataFrame) -> DataFrame:
    n = metrics.where(col("value_kind") == "sum_cumulative").agg(F.count("*").alias("n")).where("n > 0")
    return _finding(n, "cumulative_value_kind", "gauge", F.lit(DATASET), col("n"))


def unknown_email(events: DataFrame, metrics: DataFrame) -> DataFrame:
    rows = events.select("user_email").unionAll(metrics.select("user_email")).where(col("user_email").isNull())
    return _finding(rows.agg(F.count("*").alias("n")).where("n > 0"), "unknown_email", "defect", F.lit(DATASET), col("n"))


def multi_email_session(events: DataFrame, metrics: DataFrame) -> DataFrame:
    keys = ["session_id", "activity_date"]
    rows = counter_delta(metrics).select(*keys, "user_email").unionAll(events.select(*keys, "user_email")).where(col("session_id").isNotNull() & col("user_email").isNotNull())
    one = rows.groupBy(*keys).agg(F.sort_array(F.collect_set("user_email")).alias("all")).where(F.size("all") > 1)
    corp, own = F.filter("all", lambda e: is_corporate(e)), F.filter("all", lambda e: ~is_corporate(e))
    return _finding(one, "multi_email_session", "gauge", F.concat_ws("|", "session_id", "activity_date"), F.size("all"), corp_emails=corp, personal_emails=own, all_emails=col("all"))


def cost_divergence(api_usage: DataFrame, metrics: DataFrame, floor: datetime.date) -> DataFrame:
    """Costs of two sources apart by more than 1 % and by more than 0.01."""
    a = api_usage.where(col("activity_date") >= F.lit(floor)).agg(F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("a"))
    own = counter_delta(metrics).where((col("metric_name") == "cost.usage") & col("session_id").isNotNull() & (col("activity_date") >= F.lit(floor)))
    both = a.crossJoin(own.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("b")))  # one row each
    gap = F.abs(col("a") - col("b"))
    found = both.where((gap > 0.01) & (gap / F.greatest(col("b"), F.lit(0.01)) > 0.01))
    return _finding(found, "cost_divergence", "defect", F.lit(DATASET), F.lit(None), promoted_usd=F.round("a", 4), counter_usd=F.round("b", 4), abs_diff_usd=F.round(gap, 4))


def telemetry_after_close(uncovered: DataFrame) -> DataFrame:
    g = uncovered.where(col("closed_on").isNotNull()).groupBy("user_email").agg(F.count("*").alias("n"), F.max("closed_on").alias("c"), F.min("activity_date").alias("a"), F.max("activity_date").alias("b"))
    return _finding(g, "telemetry_after_close", "defect", col("user_email"), col("n"), closed_on=col("c"), first_day=col("a"), last_day=col("b"))


def emitter_without_seat(uncovered: DataFrame) -> DataFrame:
    g = uncovered.where(col("closed_on").isNull()).groupBy("user_email").agg(F.count("*").alias("n"), F.min("activity_date").alias("a"), F.max("activity_date").alias("b"))
    return _finding(g, "emitter_without_seat", "defect", col("user_email"), col("n"), first_day=col("a"), last_day=col("b"))


def reopened_within_cadence(intervals: DataFrame, drops: DataFrame) -> DataFrame:
    """A seat that closed and reopened with exactly one drop between."""
    by = Window.partitionBy("user_email").orderBy("valid_from")
    c = intervals.withColumns({"_seen": F.lead("first_seen_on").over(by), "_from": F.lead("valid_from").over(by)}).where(col("valid_to").isNotNull() & col("_seen").isNotNull())
    # drops are numbered, so the count between two dates is a difference of two look-ups in a table of dates
    n = drops.select("as_of_date").distinct().withColumn("k", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("as_of_date")))
    a, b = F.broadcast(n.toDF("last_seen_on", "k1")), F.broadcast(n.toDF("_seen", "k2"))
    found = c.join(a, "last_seen_on").join(b, "_seen").where(col("k2") - col("k1") == 2)
    return _finding(found, "reopened_within_cadence", "defect", F.concat_ws("|", "user_email", "valid_to"), F.lit(1), closed_on=col("valid_to"), reopened_on=col("_from"))


def assignment_without_tier(roster: DataFrame) -> DataFrame:
    g = roster.where(col("assignment_date").isNotNull() & col("seat_tier").isNull()).groupBy("user_email")
    g = g.agg(F.count("*").alias("n"), F.max("assignment_date").alias("d"), F.min("as_of_date").alias("a"), F.max("as_of_date").alias("b"))
    return _finding(g, "assignment_without_tier", "defect", col("user_email"), col("n"), assignment_date=col("d"), first_drop=col("a"), last_drop=col("b"))


def multi_subscription(roster: DataFrame) -> DataFrame:
    tiers = F.transform(F.array_sort(F.collect_list(F.struct("subscription_seq", "seat_tier"))), lambda x: x["seat_tier"])
    g = roster.groupBy("user_email", "as_of_date").agg(F.count("*").alias("n"), tiers.alias("tiers")).where("n > 1")
    return _finding(g, "multi_subscription", "defect", F.concat_ws("|", "user_email", "as_of_date"), col("n"), tiers=col("tiers"))


def boundary_basis(intervals: DataFrame) -> DataFrame:
    g = intervals.agg(F.count_if(col("valid_from_basis") == "observation-dated").alias("o"), F.count("*").alias("n")).where("n > 0")
    return _finding(g, "boundary_basis", "gauge", F.lit(DATASET), col("o"), total=col("n"), share=F.round(col("o") / col("n"), 4))


def unresolved_identity(days: DataFrame, derived: DataFrame, manual: DataFrame, roster: DataFrame) -> DataFrame:
    """Personal addresses with telemetry that no rule, no ruling and no roster knows."""
    t = days.where(~is_corporate(col("user_email")))
    for known, c in ((derived, "personal_email"), (manual, "personal_email"), (roster, "user_email")):
        t = t.join(known.select(col(c).alias("user_email")), "user_email", "left_anti")
    g = t.groupBy("user_email").agg(F.count("*").alias("n"), F.min("activity_date").alias("a"), F.max("activity_date").alias("b"))
    return _finding(g, "unresolved_identity", "defect", col("user_email"), col("n"), first_day=col("a"), last_day=col("b"))


def owner_mismatch(events: DataFrame, metrics: DataFrame) -> DataFrame:
    """Sessions whose process owner is not the local part of their corporate address."""
    rows = events.select("session_id", "user_email", "process_owner").unionAll(metrics.select("session_id", "user_email", "process_owner"))
    owner, local = F.lower(F.trim("process_owner")), F.split_part(F.lower(F.trim(col("user_email"))), F.lit("@"), F.lit(1))
    rows = rows.where(col("session_id").isNotNull() & is_corporate(col("user_email")) & (owner != "") & (owner != local))
    g = rows.groupBy("session_id", "user_email").agg(F.count("*").alias("n"), F.sort_array(F.collect_set(owner)).alias("owners"))
    return _finding(g, "owner_mismatch", "gauge", F.concat_ws("|", "session_id", "user_email"), col("n"), owners=col("owners"))


def config_convergence(events: DataFrame, metrics: DataFrame) -> DataFrame:
    """Whether each user's latest process stamp is the latest one on disk, with when each was seen; NULL while either is missing.

    Signals without an address share the unknown bucket.
    """
    s = events.select("user_email", col("event_time").alias("t"), "stamp", "disk_stamp").unionAll(metrics.select("user_email", "ts", "stamp", "disk_stamp"))
    when = lambda c: F.max(F.when(col(c).isNotNull(), col("t")))
    g = s.groupBy(email_bucket(col("user_email")).alias("user_email"), col("user_email").isNull().alias("is_unknown")).agg(
        F.max("t").alias("last_seen"), F.max("t").cast("date").alias("last_seen_date"), latest(col("stamp"), col("t")).alias("stamp"), when("stamp").alias("stamp_seen_at"),
        latest(col("disk_stamp"), col("t")).alias("disk_stamp"), when("disk_stamp").alias("disk_stamp_seen_at"),
    )
    return g.withColumn("is_converged", col("stamp") == col("disk_stamp"))


def current_findings(log: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """Findings of the last cycle with first sight and the start of their present streak of cycles.

    ``log``: (cycle date, finding_type, subject). Cycles are numbered, so an island keeps one difference. ``held`` names all cycles;
    without it those that found nothing are unknown.
    """
    cycles = (log if held is None else held).select("cycle").distinct().withColumn("n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("cycle")))
    rows = log.select("cycle", "finding_type", "subject").distinct().join(F.broadcast(cycles), "cycle")
    key = Window.partitionBy("finding_type", "subject").orderBy("n")
    rows = rows.withColumns({"island": col("n") - F.row_number().over(key), "first_seen": F.min("cycle").over(Window.partitionBy("finding_type", "subject"))})
    streak = rows.groupBy("finding_type", "subject", "first_seen", "island").agg(F.min("cycle").alias("standing_since"), F.max("n").alias("_last"), F.count("*").alias("cycles"))
    last = cycles.agg(F.max("n").alias("_end"))
    return streak.join(F.broadcast(last), col("_last") == col("_end")).select("finding_type", "subject", "first_seen", "standing_since", "cycles")


def status_pivot(events: DataFrame, codes: list[str]) -> DataFrame:
    """Events per day by code with totals of accepted (the first code) and rejected ones."""
    p = events.groupBy("activity_date").pivot("code", codes).agg(F.count(F.lit(1)))
    zero = [F.coalesce(c, F.lit(0)).alias(f"n_{c}") for c in codes]
    rest = sum((F.coalesce(c, F.lit(0)) for c in codes[1:]), F.lit(0))
    return p.select("activity_date", *zero, F.coalesce(codes[0], F.lit(0)).alias("accepted"), rest.cast("bigint").alias("rejected"))


def silence_run(accepted: DataFrame, since: datetime.date, until: datetime.date) -> DataFrame:
    """Per subject the days counted back from ``until`` with a known count of 0; a missing day ends the run.

    ``accepted``: (subject, day, n). The calendar comes from the window, not from the data.
    """
    days = accepted.select("subject").distinct().select("subject", F.explode(F.sequence(F.lit(since), F.lit(until))).alias("day"))
    known = days.join(accepted, ["subject", "day"], "left")
    stop = F.max(F.when(col("n").isNull() | (col("n") > 0), col("day")))
    return known.groupBy("subject").agg(F.coalesce(F.datediff(F.lit(until), stop), F.lit((until - since).days + 1)).alias("silent_days"))
