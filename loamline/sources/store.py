"""The store of both facts with their ledger and quarantine: ingest and replay, each one commit."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loamline.operators import otlp
from loamline.sources.commits import Commits, Part
from loamline.sources.shared import written

col = F.col
#: Each signal's table, what decodes it and its time.
FACTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame], str]] = {"logs": ("events", otlp.explode_logs, "event_time"), "metrics": ("metrics", otlp.explode_metrics, "ts")}
LEDGER = "batch_hash string, signal string, dt date"
QUARANTINE = "signal string, dt date, payload_id string, reason string, text_hash string, bytes long"
PAYLOAD = "signal string, dt date, payload_id string, json string"


def facts(payloads: DataFrame, signal: str) -> DataFrame:
    """Rows of one signal's fact with their day."""
    _, explode, time = FACTS[signal]
    rows = otlp.promote(explode(payloads.where(col("signal") == signal).select("payload_id", "json")), otlp.CATALOGUE, signal)
    return rows.drop("attrs", "own", "resource").withColumn("day", F.to_date(time))


def schema_of(spark: SparkSession, signal: str) -> StructType:
    return facts(spark.createDataFrame([], PAYLOAD), signal).schema


def read_facts(spark: SparkSession, root: str, signal: str) -> DataFrame:
    """Visible rows of one signal's fact."""
    return Commits(spark, root).read(FACTS[signal][0], schema_of(spark, signal))


def prepared(payloads: DataFrame, denied: list[str], content: list[str]) -> DataFrame:
    """Both signals' payloads redacted and hashed, and of those that may not be ingested the reason with digest and size of what they were; a signal that no fact takes is an error."""
    known = F.assert_true(col("signal").isin(*FACTS), F.concat(F.lit("no fact takes the signal "), F.coalesce("signal", F.lit("NULL"))))
    said = otlp.told(payloads.where(known.isNull()), col("signal"), denied, content)
    reason = F.when(col("json").isNull(), F.lit("no text")).when(col("_told.digest").isNull() & F.try_parse_json("json").isNull(), col("_told.fault"))
    said = said.withColumn("reason", reason).withColumns({"json": otlp.cleaned(), "text_hash": F.when(col("reason").isNotNull(), F.sha2("json", 256)), "bytes": F.when(col("reason").isNotNull(), F.octet_length("json").cast("long"))})
    return said.withColumn("batch_hash", F.coalesce("_told.digest", otlp.batch_hash(col("json")))).drop("_told")


def ingest(spark: SparkSession, root: str, payloads: DataFrame, denied: list[str], content: list[str], *, horizon_days: int = 7, batch: tuple[str, int] | None = None) -> int | None:
    """Store payloads (signal, dt, payload_id, json) that were not stored before: rows of both facts, their hashes and the quarantine in one commit.

    A payload counts once within the horizon of its day. Text that is no payload goes to the quarantine with the reason, as a digest. A
    batch of a stream that is in already changes nothing; the commit's number, None without one.
    """
    commits = Commits(spark, root)
    state = commits.state()
    if batch and state.batches.get(batch[0], -1) >= batch[1]:
        return None
    clean = written(prepared(payloads.select("signal", "dt", "payload_id", "json"), denied, content), "batch")  # redacted and hashed once
    good = clean.where("reason IS NULL").dropDuplicates(["batch_hash"])
    days = good.agg(F.min("dt").alias("first"), F.max("dt").alias("last")).first()
    if days["first"]:
        reach = datetime.timedelta(days=horizon_days)
        seen = commits.read("ledger", LEDGER, days["first"] - reach, days["last"] + reach, state)
        good = written(good.join(seen.select("batch_hash"), "batch_hash", "left_anti").select("signal", "dt", "payload_id", "json", "batch_hash"), "fresh")
    bad = clean.where("reason IS NOT NULL").select("signal", "dt", "payload_id", "reason", "text_hash", "bytes")
    parts = [p for s in FACTS for p in commits.write(FACTS[s][0], facts(good, s), "day")] if days["first"] else []
    parts += commits.write("ledger", good.select("batch_hash", "signal", "dt"), "dt") if days["first"] else []
    parts += commits.write("quarantine", bad, "dt")
    return commits.commit(parts, batch=batch)


def replay(spark: SparkSession, root: str, archive: DataFrame, denied: list[str], content: list[str], since: datetime.datetime, until: datetime.datetime, signals: tuple[str, ...] = ("logs", "metrics")) -> int:
    """Derive the rows of a half-open window of event time anew from archived payloads, for each of ``signals``, and claim their hashes anew, in one commit.

    The window is by event time while the archive is by arrival, so ``archive`` holds all payloads that may reach into it. Only parts with rows of
    the window's days are written again; until the manifest is there readers see the old rows.
    """
    commits = Commits(spark, root)
    state = commits.state()
    clean = written(prepared(archive.where(col("signal").isin(*signals)).select("signal", "dt", "payload_id", "json"), denied, content).where("reason IS NULL").dropDuplicates(["batch_hash"]), "archive")
    adds: list[Part] = []
    drops: list[Part] = []
    for signal in signals:
        table, _, time = FACTS[signal]
        old = state.parts(table, since.date(), until.date())
        inside = (col(time) >= F.lit(since)) & (col(time) < F.lit(until))
        kept = commits.of(old, schema_of(spark, signal)).where(~F.coalesce(inside, F.lit(False)))
        adds += commits.write(table, kept.unionByName(facts(clean, signal).where(inside)), "day")
        drops += old
    ledger = state.parts("ledger")
    claimed = clean.select("batch_hash", "signal", "dt")
    cleared = commits.of(ledger, LEDGER).join(claimed.select("batch_hash"), "batch_hash", "left_anti")
    adds += commits.write("ledger", cleared.select("batch_hash", "signal", "dt").unionByName(claimed), "dt")
    return commits.commit(adds, drops + ledger)
