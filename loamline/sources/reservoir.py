"""The payload archive: files by signal and day, compaction, ingest, replay, retention."""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.operators import otlp
from loamline.sources.shared import written

col = F.col
DAY_KEYS = ["signal", "dt"]


def write_raw(payloads: DataFrame, root: str) -> None:
    """Payload texts, one a line, gzipped, under signal=/dt=."""
    lines = payloads.select(*DAY_KEYS, F.to_json(F.struct("payload_id", "json")).alias("value"))
    lines.write.partitionBy(*DAY_KEYS).option("compression", "gzip").mode("append").text(root)


def read_raw(spark: SparkSession, root: str, signals: list[str], since: datetime.date, until: datetime.date) -> DataFrame:
    """Payloads of signals in an inclusive window of days; other partitions are not listed."""
    rows = spark.read.schema("value string, signal string, dt date").text(root)
    rows = rows.where(col("signal").isin(*signals) & col("dt").between(F.lit(since), F.lit(until)))
    return rows.select(*DAY_KEYS, F.from_json("value", "payload_id string, json string").alias("v")).select(*DAY_KEYS, "v.payload_id", "v.json")


def listed(spark: SparkSession, root: str, *, suffix: str = "") -> DataFrame:
    """The files of an archive as (signal, dt, name, path, bytes, modified), from its folders: nothing of what they hold is read.

    Filters on signal and dt leave other partitions unlisted. A folder that is not there holds none.
    """
    path, fs = _files(spark, root)
    files = spark.read.format("binaryFile").load(root).drop("content") if fs.exists(path(root)) else None
    if files is None or "dt" not in files.columns:
        return spark.createDataFrame([], "signal string, dt date, name string, path string, bytes long, modified timestamp")
    out = files.select(col("signal").cast("string").alias("signal"), col("dt").cast("date").alias("dt"), F.element_at(F.split("path", "/"), -1).alias("name"), "path", col("length").alias("bytes"), col("modificationTime").alias("modified"))
    return out.where(col("name").endswith(suffix)) if suffix else out


def compaction_plan(
    raw: DataFrame, compacted: DataFrame, today: datetime.date, since: datetime.date | None = None, until: datetime.date | None = None, *, rebuild: bool = False
) -> DataFrame:
    """Past partitions within bounds that have files in ``raw`` and none in ``compacted`` (or all of them), told from listings."""
    past = raw.where(col("dt") < F.lit(today))
    past = past.where(col("dt") >= F.lit(since)) if since else past
    past = (past.where(col("dt") <= F.lit(until)) if until else past).select(*DAY_KEYS).distinct()
    return past if rebuild else past.join(compacted.select(*DAY_KEYS).distinct(), DAY_KEYS, "left_anti")


def compact(raw: DataFrame, plan: DataFrame, path: str) -> None:
    """Each planned partition as zstd Parquet, texts unchanged; only planned partitions are overwritten.

    Spark splits a large day over several tasks (and files) and gathers small ones, by bytes.
    """
    rows = raw.join(F.broadcast(plan), DAY_KEYS, "left_semi").hint("rebalance", *DAY_KEYS)
    rows.write.partitionBy(*DAY_KEYS).mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(path)


def prefer_compacted(raw: DataFrame, compacted: DataFrame) -> DataFrame:
    """Compacted partitions, and raw ones only where there is none compacted."""
    return compacted.unionByName(raw.join(F.broadcast(compacted.select(*DAY_KEYS).distinct()), DAY_KEYS, "left_anti"))


def _scrubbed(payloads: DataFrame, signal: str, denied: list[str], content: list[str]) -> DataFrame:
    """Payloads with redacted ``json``, ``gate_leaks`` and ``changed``: whether redaction changes the canonical text."""
    cleaned = otlp.redact(payloads.withColumn("_old", col("json")), signal, denied, content)
    # a cut leaves an item less, so other texts have other canonical texts: nothing has to be hashed
    return cleaned.withColumn("changed", ~col("json").eqNullSafe(col("_old"))).drop("_old")


def scrub(payloads: DataFrame, signal: str, denied: list[str], content: list[str]) -> tuple[DataFrame, DataFrame]:
    """Payloads whose canonical text redaction changes, and a report of scanned, rewritten and leaks."""
    cleaned = _scrubbed(payloads, signal, denied, content)
    report = cleaned.agg(F.count("*").alias("scanned"), F.count_if("changed").alias("rewritten"), F.sum("gate_leaks").alias("leaks"))
    return cleaned.where("changed").drop("changed", "gate_leaks"), report


def scrub_archive(
    spark: SparkSession, root: str, signal: str, denied: list[str], content: list[str], since: datetime.date, until: datetime.date, *, execute: bool = False
) -> DataFrame:
    """Redact a window of one signal's archive in place: (dt, files, payloads, dirty_files, rewritten, leaks) of each day.

    Without ``execute`` nothing is written. With it the files that hold a payload to change, and no others, are written anew beside the archive and
    then swapped in. A swap that was interrupted is finished by ``finish_swap``, which this calls first. What is no JSON is left to the quarantine.
    """
    if execute:
        finish_swap(spark, root)
    lines = spark.read.schema("value string, signal string, dt date").text(root).where((col("signal") == signal) & col("dt").between(F.lit(since), F.lit(until)))
    rows = lines.select(*DAY_KEYS, col("_metadata.file_path").alias("file"), F.from_json("value", "payload_id string, json string").alias("v")).select(*DAY_KEYS, "file", "v.payload_id", "v.json")
    told = _scrubbed(rows.withColumn("_text", col("json")), signal, denied, content)
    told = told.withColumns({"changed": col("changed") & col("json").isNotNull(), "json": F.coalesce("json", "_text")}).drop("_text")
    told = written(told, "scrubbed") if execute else told
    files = told.groupBy("dt", "file").agg(F.count("*").alias("payloads"), F.count_if("changed").alias("rewritten"), F.sum("gate_leaks").alias("leaks"))
    files = written(files, "files")
    dirty = files.where("rewritten > 0").select("file")
    if execute and not dirty.isEmpty():
        staged = f"{root.rstrip('/')}/_staged-{uuid.uuid4().hex}"
        again = told.join(dirty, "file", "left_semi")
        write_raw(again.select(*DAY_KEYS, "payload_id", "json").repartition(*DAY_KEYS), staged)
        _swap(spark, root, staged, [r["file"] for r in dirty.toLocalIterator()])
    total = lambda c: F.sum(c).alias(c)
    return files.groupBy("dt").agg(F.count("*").alias("files"), total("payloads"), F.count_if(col("rewritten") > 0).alias("dirty_files"), total("rewritten"), total("leaks"))


def _swap(spark: SparkSession, root: str, staged: str, drops: list[str]) -> None:
    """Put staged files in the place of others: what is to happen is written down first, so that it can be finished by anyone."""
    path, fs = _files(spark, root)
    plan = f"{root.rstrip('/')}/_swap.json"
    draft = path(plan + ".draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"staged": staged, "drops": drops}).encode()))
    out.close()
    fs.rename(draft, path(plan))
    finish_swap(spark, root)


def finish_swap(spark: SparkSession, root: str) -> bool:
    """Finish a swap that was written down: drop the old files, move the new ones in. False if there is none."""
    path, fs = _files(spark, root)
    plan = path(f"{root.rstrip('/')}/_swap.json")
    if not fs.exists(plan):
        return False
    stream = fs.open(plan)
    told = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    for name in told["drops"]:
        fs.delete(path(name), False)
    found = fs.listFiles(path(told["staged"]), True) if fs.exists(path(told["staged"])) else None
    moves = []
    while found is not None and found.hasNext():
        at = found.next().getPath()
        if at.getName().startswith("part-"):
            moves.append(at)
    for at in moves:
        day = at.getParent()
        to = path(f"{root.rstrip('/')}/{day.getParent().getName()}/{day.getName()}/{at.getName()}")
        fs.mkdirs(to.getParent())
        fs.rename(at, to)
    fs.delete(path(told["staged"]), True)
    fs.delete(plan, False)
    return True


def _files(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path, path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def ingest(payloads: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New payloads with their hash, and the ledger rows to add; a payload seen before is left out. Payloads are hashed once, into a table that both are read from."""
    hashed = payloads.withColumn("batch_hash", otlp.batch_hash(col("json")))
    fresh = written(hashed.join(ledger.select("batch_hash"), "batch_hash", "left_anti").dropDuplicates(["batch_hash"]), "fresh")
    return fresh, fresh.select("batch_hash")


def trim(df: DataFrame, time: str, now: datetime.datetime, keep: datetime.timedelta) -> DataFrame:
    """Rows not older than ``keep``."""
    return df.where(col(time) >= F.lit(now - keep))


def write_time(day: Column, name: Column) -> Column:
    """When an archive file was written, told by its partition's day and its name, <HHMMSS>-<anything>; NULL if the name tells no time."""
    clock = F.regexp_extract(name, r"^([0-9]{6})-", 1)
    return F.try_to_timestamp(F.concat(day.cast("string"), F.lit(" "), clock), F.lit("yyyy-MM-dd HHmmss"))


def inventory_diff(source: DataFrame, target: DataFrame, floor: datetime.date | None = None) -> DataFrame:
    """Per partition of the source from ``floor`` on: names, those the target lacks, the newest write of either told from names, and names that tell none.

    Both are listings (signal, dt, name). Partitions that only the target has are not looked at.
    """
    mine = source.where(col("dt") >= F.lit(floor)) if floor else source
    theirs = target.where(col("dt") >= F.lit(floor)) if floor else target
    both = mine.select(*DAY_KEYS, "name", F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(theirs.select(*DAY_KEYS, "name", F.lit(0).alias("s"), F.lit(1).alias("t")))
    names = both.groupBy(*DAY_KEYS, "name").agg(F.max("s").alias("s"), F.max("t").alias("t"))
    at, here, lacking = write_time(col("dt"), col("name")), col("s") == 1, (col("s") == 1) & (col("t") == 0)
    out = names.groupBy(*DAY_KEYS).agg(
        F.count_if(here).alias("names"), F.count_if(lacking).alias("missing"), F.min(F.when(lacking, col("name"))).alias("first_name"), F.count_if(col("t") == 1).alias("target_names"),
        F.max(F.when(here, at)).alias("newest_source"), F.max(F.when(col("t") == 1, at)).alias("newest_target"), F.count_if(at.isNull()).alias("untimed"),
    )
    return out.where("names > 0")
