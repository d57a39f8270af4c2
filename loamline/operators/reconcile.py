"""Copying and comparing two stores of the same telemetry, and corrections of a store."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions.columns import is_corporate
from loamline.sources.commits import Commits

col = F.col
#: A watermark later than any row.
NEVER = datetime.datetime(2200, 1, 1)


def watermarks(target: DataFrame) -> DataFrame:
    """When each key began to write to the target."""
    return target.where(col("user_email").isNotNull()).groupBy("user_email").agg(F.min("event_time").alias("watermark"))


def sweep_targets(source: DataFrame, target: DataFrame) -> DataFrame:
    """Keys that never wrote to the target, with a watermark later than any row."""
    keys = source.where(col("user_email").isNotNull()).select("user_email").distinct()
    return keys.join(target.select("user_email"), "user_email", "left_anti").withColumn("watermark", F.lit(NEVER))


def to_copy(source: DataFrame, marks: DataFrame, floor: datetime.datetime) -> DataFrame:
    """Source rows from the floor up to their key's watermark; keys that moved by the floor have none."""
    late = marks.where(col("watermark") > F.lit(floor))
    return source.join(late, "user_email").where((col("event_time") >= F.lit(floor)) & (col("event_time") < col("watermark"))).drop("watermark")


def census(source: DataFrame, marks: DataFrame, floor: datetime.datetime) -> DataFrame:
    """Rows and keys by what becomes of them, in one pass."""
    kind = (
        F.when(col("user_email").isNull(), "no address").when(col("watermark").isNull(), "held, not moved").when(col("event_time") >= col("watermark"), "held, above")
        .when(col("event_time") >= F.lit(floor), "to copy").otherwise("below floor")
    )
    return source.join(marks, "user_email", "left").groupBy(kind.alias("fate")).agg(F.count("*").alias("rows"), F.count_distinct("user_email").alias("seats"))


def shortfall(source: DataFrame, target: DataFrame) -> DataFrame:
    """Per key the sum over days of what the target has fewer."""
    n = lambda df, c: df.where(col("user_email").isNotNull()).groupBy("user_email", "activity_date").agg(F.count("*").alias(c))
    j = n(source, "s").join(n(target, "t"), ["user_email", "activity_date"], "left")
    return j.groupBy("user_email").agg(F.sum(F.greatest(col("s") - F.coalesce("t", F.lit(0)), F.lit(0))).alias("missing"))


def dual_sessions(source: DataFrame, target: DataFrame, marks: DataFrame) -> DataFrame:
    """Sessions that went on writing to the source after their key had moved, and are in the target too."""
    late = source.join(marks, "user_email").where(col("event_time") >= col("watermark")).select("session_id").distinct()
    return late.join(target.select("session_id"), "session_id", "left_semi")


def quiet(log: DataFrame, time: str, now: datetime.datetime, *, hours: float = 24) -> DataFrame:
    """Hours since the last write, and whether that is quiet enough."""
    age = (F.lit(int(now.replace(tzinfo=datetime.UTC).timestamp() * 1e6)) - F.unix_micros(F.max(time))) / 3.6e9
    return log.agg(age.alias("quiet_hours")).withColumn("may_go", F.coalesce(col("quiet_hours") >= hours, F.lit(False)))


def mismatches(source: DataFrame, target: DataFrame) -> DataFrame:
    """Keys whose counts differ."""
    a = source.groupBy("user_email").agg(F.count("*").alias("source_rows"))
    b = target.groupBy("user_email").agg(F.count("*").alias("target_rows"))
    j = a.withColumnRenamed("user_email", "e1").join(b.withColumnRenamed("user_email", "e2"), col("e1").eqNullSafe(col("e2")), "full")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return j.where(zero("source_rows") != zero("target_rows")).select(F.coalesce("e1", "e2").alias("user_email"), zero("source_rows").alias("source_rows"), zero("target_rows").alias("target_rows"))


def map_legacy(df: DataFrame, since: datetime.datetime, until: datetime.datetime) -> DataFrame:
    """Rows of the older schema: renamed, values lifted out of a JSON column, within a window."""
    rows = df.where((col("ts") >= F.lit(since)) & (col("ts") < F.lit(until)))
    return rows.select(col("event_id").alias("legacy_id"), col("ts").cast("timestamp").alias("event_time"), col("event_type").alias("event_name"), F.get_json_object("props", "$.k").cast("int").alias("k"), "value")


def backfill(staged: DataFrame, existing: DataFrame, *, scopes: list[str], scope: str = "scope_name") -> DataFrame:
    """Staged rows without the named scopes, of corporate or no address, of sessions that do not exist yet.

    A row without a scope or a session stays.
    """
    s = staged.where(~F.coalesce(col(scope).isin(*scopes), F.lit(False))).where(col("user_email").isNull() | is_corporate(col("user_email")))
    return s.join(existing.where(col("session_id").isNotNull()).select("session_id"), "session_id", "left_anti")


def purge(raw: DataFrame, condition, cutoff: datetime.datetime) -> tuple[DataFrame, DataFrame]:
    """What stays of ``raw``, and one audit row with the count and the domains of what goes."""
    gone = F.coalesce(condition & (col("event_time") < F.lit(cutoff)), F.lit(False))
    domain = F.split_part(col("user_email"), F.lit("@"), F.lit(2))
    audit = raw.where(gone).agg(F.count("*").alias("purged"), F.concat_ws(",", F.sort_array(F.collect_set(domain))).alias("domains"))
    return raw.where(~gone), audit


def load_backfill(spark: SparkSession, root: str, run: str, staged: DataFrame, existing: DataFrame, *, scopes: list[str]) -> int | None:
    """Load a backfill into the table ``backfilled`` under ``root`` by one commit that carries the run's name.

    A run that is in already loads nothing and gives None, whatever is staged; one that died left nothing that is visible.
    """
    commits = Commits(spark, root)
    if run in commits.state().batches:
        return None
    return commits.commit(commits.write("backfilled", backfill(staged, existing, scopes=scopes), "activity_date"), batch=(run, 0))


def purge_facts(events: DataFrame, metrics: DataFrame, condition: Column, cutoff: datetime.datetime, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What stays of both facts, and one finding in the log's form with the rows of each that go before the cut-off and their distinct domains.

    A condition that is NULL keeps the row. Nothing to purge is a finding of 0 rows.
    """
    early = {"events": (events, "event_time"), "metrics": (metrics, "ts")}
    gone = {k: F.coalesce(condition & (col(time) < F.lit(cutoff)), F.lit(False)) for k, (_, time) in early.items()}
    kept = [df.where(~gone[k]) for k, (df, _) in early.items()]
    parts = [df.where(gone[k]).select(F.lit(k).alias("fact"), F.split_part(col("user_email"), F.lit("@"), F.lit(2)).alias("domain")) for k, (df, _) in early.items()]
    n = parts[0].unionAll(parts[1]).groupBy("fact", "domain").agg(F.count("*").alias("n"))
    total = lambda k: F.coalesce(F.sum(F.when(col("fact") == k, col("n"))), F.lit(0))
    told = n.agg(total("events").alias("events"), total("metrics").alias("metrics"), F.sort_array(F.collect_set("domain")).alias("domains"))
    finding = told.select(
        F.lit(name).alias("finding_type"), F.lit("(dataset)").alias("subject"), F.lit("gauge").alias("kind"), (col("events") + col("metrics")).alias("row_count"),
        F.to_json(F.struct("events", "metrics", "domains")).alias("details"),
    )
    return kept[0], kept[1], finding


def overlap_sessions(staged: DataFrame, existing: DataFrame, since: datetime.datetime) -> DataFrame:
    """Sessions since a time that do not exist yet."""
    return staged.where(col("event_time") >= F.lit(since)).select("session_id").distinct().join(existing.select("session_id"), "session_id", "left_anti")
