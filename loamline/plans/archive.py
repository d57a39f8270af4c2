"""Queries of payload decoding, redaction, the archive, profiles, reconciliation and streams, with their oracles."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from loamline.operators import marts, otlp, profile, quality, reconcile, refresh
from loamline.plans.base import AS_OF, frames, sql
from loamline.plans.marts import QUERIES as MART_QUERIES
from loamline.plans.marts import rounded
from loamline.plans.quality import QUERIES as QUALITY_QUERIES
from loamline.plans.quality import FLOOR as COST_FLOOR
from loamline.plans.quality import LEAST
from loamline.plans.seats import LATE
from loamline.plans.seats import QUERIES as SEAT_QUERIES
from loamline.sources import payloads, reservoir, store
from loamline.sources.commits import Commits
from loamline.sources.shared import workspace, written
from loamline.streaming import ingest

E, M = "events", "metrics"
col = F.col
DENIED, CONTENT = ["secret.token"], ["prompt.text"]
FLOOR = datetime.datetime(2024, 1, 3)
OWN_EMAIL = "lower(user_email)"


# --- payloads --------------------------------------------------------------------------------


def _points(m):
    return otlp.promote(otlp.explode_metrics(payloads.metric_payloads(m)), otlp.CATALOGUE, "metrics")


def _lines(e):
    return otlp.promote(otlp.explode_logs(payloads.log_payloads(e)), otlp.CATALOGUE, "logs")


@frames(M)
def explode_metrics(m):
    return _points(m).select("event_id", "metric_name", "metric_type", "value_kind", "ts", "value", "count", "k", "tool_name", "user_email", "session_id").withColumn("count", F.coalesce("count", F.lit(-1)))


@frames(E)
def explode_logs(e):
    return _lines(e).select("event_id", "event_name", "event_time", "severity", "k", "success_bool", F.round("cost_usd", 6).alias("cost_usd"), "user_email", "session_id")


@frames(E)
def promote_typed(e):
    """Values that do not fit their column's type become NULL."""
    wrong = (otlp.Entry("logs", "event.id", "promoted", "event_id", "bigint"), otlp.Entry("logs", "model", "promoted", "model_number", "int"), otlp.Entry("logs", "k", "promoted", "k_number", "double"))
    out = otlp.promote(otlp.explode_logs(payloads.log_payloads(e)), wrong, "logs", otlp.DERIVED)
    return out.select("event_id", "k_number", col("model_number").isNull().alias("no_number"), "family")


@frames(E)
def rate_limits(e):
    snapshot = F.to_json(
        F.struct(F.create_map(
            F.lit("five_hour"), F.struct(col("k").cast("string").alias("used_percentage"), (F.unix_micros("event_time") / 1e6 + col("k") * 10 - 100).cast("string").alias("resets_at")),
            F.lit("seven_day_x"), F.struct(F.when(col("k") % 2 == 0, "n/a").otherwise(F.lit("12.5")).alias("used_percentage"), F.lit("0").alias("resets_at")),
        ).alias("rate_limits"))
    )
    out = otlp.rate_limit_points(e.select("event_id", "event_time", snapshot.alias("snapshot")), "snapshot", "event_time")
    return out.select("event_id", "usage_window", "metric_name", F.round("value", 3).alias("value"))


@frames(E)
def batch_hashes(e):
    """Payloads written with their keys in another order are the same batch."""
    p = payloads.log_payloads(e).select("payload_id", "json")
    turned = p.withColumn("j", F.regexp_replace("json", r'^\{"resourceLogs":\[\{"schemaUrl":("[^"]*"),(.*)\}\]\}$', r'{"resourceLogs":[{$2,"schemaUrl":$1}]}'))
    both = turned.select("payload_id", otlp.batch_hash(col("json")).alias("batch_hash"), otlp.batch_hash(col("j")).alias("b"), (col("json") != col("j")).alias("turned"))
    return both.select("payload_id", "batch_hash", (col("batch_hash") == col("b")).alias("same_when_turned"), "turned")


def recs(e, m):
    return otlp.records(payloads.metric_payloads(m), payloads.log_payloads(e))


def walked(e, m):
    """Every attribute of both signals' payloads."""
    return otlp.all_attrs(both_payloads(e, m))


@frames(E, M)
def key_path_counts(e, m):
    return profile.path_fill(otlp.key_paths(recs(e, m)))


#: Payloads in SQL: one per user, day and thousand events of a signal.
LOG_FLAT = f"SELECT concat('l-', user_id, '-', activity_date, '-', event_id // {payloads.BATCH}) AS pid, * FROM e"
MET_FLAT = f"SELECT concat('m-', user_id, '-', activity_date, '-', event_id // {payloads.BATCH}) AS pid, * FROM m"
NAMES = "SELECT DISTINCT 'logs' AS signal, activity_date AS dt, pid FROM lf UNION ALL SELECT DISTINCT 'metrics', activity_date, pid FROM mf"
LISTED, KEYED = '{"values":[{"stringValue":"x"}]}', '{"values":[{"key":"inner","value":{"stringValue":"y"}}]}'
SCALARS = {
    "k": "CAST(k AS VARCHAR)", "event.id": "CAST(event_id AS VARCHAR)", "success": "CASE WHEN success_bool THEN 'true' ELSE 'false' END", "cost": "CAST(cost_usd AS VARCHAR)", "prompt.text": "CASE k % 7 WHEN 0 THEN 'said' WHEN 1 THEN '' END",
    "model": "model", "k5": "CAST(k % 5 AS VARCHAR)", "service": "service_name",
}
NESTED = {"list": f"CASE WHEN k % 11 = 0 THEN '{LISTED}' END", "object": f"CASE WHEN k % 13 = 0 THEN '{KEYED}' END"}
TAGGED = {"list": f"CASE WHEN k % 11 = 0 THEN '{{\"arrayValue\":{LISTED}}}' END", "object": f"CASE WHEN k % 13 = 0 THEN '{{\"kvlistValue\":{KEYED}}}' END", "inner": "CASE WHEN k % 13 = 0 THEN 'y' END"}
POINTS = {"k": "CAST(k AS VARCHAR)", "tool": "tool_name", "event.id": "CAST(event_id AS VARCHAR)"}
RESOURCES = {"user.email": "' ' || upper(user_email)", "session.id": "session_id", "os.type": "'os'", "secret.token": "'bait'"}


def pairs(of: dict[str, str]) -> str:
    """(path, v) of each row in SQL."""
    return "unnest([" + ", ".join(f"{{'path': '{k}', 'v': {v}}}" for k, v in of.items()) + "]) AS x"


BLOCKS = "SELECT DISTINCT pid, 'logs' AS signal, session_id, user_email FROM lf UNION ALL SELECT DISTINCT pid, 'metrics', session_id, user_email FROM mf"
#: Attributes of all records: pv(pid, signal, name, path, v, session_id, user_email).
RECORDS = f"""SELECT pid, signal, name, x.path AS path, x.v AS v, session_id, user_email FROM (SELECT pid, 'logs' AS signal, event_name AS name, session_id, user_email, {pairs(SCALARS | NESTED)} FROM lf
    UNION ALL SELECT pid, 'metrics', metric_name, session_id, user_email, {pairs(POINTS)} FROM mf UNION ALL SELECT pid, 'resource', '*', session_id, user_email, {pairs(RESOURCES)} FROM bl) WHERE x.v IS NOT NULL"""
POPULATION = "SELECT 'logs' AS signal, event_name AS name, count(*) AS population FROM lf GROUP BY 2 UNION ALL SELECT 'metrics', metric_name, count(*) FROM mf GROUP BY 2 UNION ALL SELECT 'resource', '*', count(*) FROM bl"
#: Every key with a value anywhere: av(pid, signal, path, v).
ANYWHERE = f"""SELECT pid, signal, x.path AS path, x.v AS v FROM (SELECT pid, 'logs' AS signal, {pairs(SCALARS | TAGGED)} FROM lf UNION ALL SELECT pid, 'metrics', {pairs(POINTS)} FROM mf
    UNION ALL SELECT pid, signal, {pairs(RESOURCES)} FROM bl UNION ALL SELECT pid, signal, {pairs({"scope.tag": "'t'", "secret.token": "'bait'"})} FROM bl) WHERE x.v IS NOT NULL"""
PROFILING = {"lf": LOG_FLAT, "mf": MET_FLAT, "bl": BLOCKS, "pv": RECORDS, "po": POPULATION, "av": ANYWHERE}


def catalogued(entries) -> str:
    """The catalogue in SQL: ca(signal, path, status)."""
    return "SELECT * FROM (VALUES " + ", ".join(f"('{x.signal}', '{x.path}', '{x.status}')" for x in entries) + ") AS t(signal, path, status)"


DECIDED = "SELECT pv.*, coalesce(a.status, b.status) AS status FROM pv LEFT JOIN ca a ON a.signal = pv.signal AND a.path = pv.path LEFT JOIN ca b ON b.signal = 'resource' AND b.path = pv.path"

def _tagged(key: str, tag: str, value: str, there: str = "") -> str:
    """An attribute's canonical JSON in SQL; NULL where its value is."""
    one = f"""concat('{{"key":"{key}","value":{{"{tag}":', {value}, '}}}}')"""
    return f"CASE WHEN {there} THEN {one} END" if there else one


_quoted = lambda v: f"""concat('"', {v}, '"')"""
#: The canonical text of each log payload: keys in order, no spaces, numbers without idle zeros.
CANONICAL = """SELECT pid, concat('{"resourceLogs":[{"resource":{"attributes":[', concat_ws(',', EMAIL, SESSION, OS, TOKEN), ']},"schemaUrl":"https://schema.example/1","scopeLogs":[{"logRecords":[',
        string_agg(concat('{"attributes":[', concat_ws(',', ATTRIBUTES), ']', ',"body":{"stringValue":"app.', event_name, '"},"flags":', k % 2, ',"severityText":"INFO","timeUnixNano":"', epoch_us(event_time), '123"}'), ',' ORDER BY epoch_us(event_time), event_id),
        '],"scope":{"attributes":[', TAG, ',', TOKEN, '],"name":"logger"}}]}]}') AS json FROM lf GROUP BY pid, user_email, session_id"""
for _name, _sql in {
    "EMAIL": _tagged("user.email", "stringValue", """'" ' || upper(user_email) || '"'""", "user_email IS NOT NULL"), "SESSION": _tagged("session.id", "stringValue", _quoted("session_id")), "OS": _tagged("os.type", "stringValue", """'"os"'"""),
    "TOKEN": _tagged("secret.token", "stringValue", """'"bait"'"""), "TAG": _tagged("scope.tag", "stringValue", """'"t"'"""),
    "ATTRIBUTES": ", ".join([
        _tagged("k", "intValue", _quoted("k")), _tagged("event.id", "intValue", _quoted("event_id")), _tagged("success", "boolValue", "CASE WHEN success_bool THEN 'true' ELSE 'false' END"),
        _tagged("cost", "doubleValue", "CASE WHEN cost_usd = floor(cost_usd) THEN CAST(CAST(cost_usd AS BIGINT) AS VARCHAR) ELSE CAST(cost_usd AS VARCHAR) END"), _tagged("prompt.text", "stringValue", """CASE k % 7 WHEN 0 THEN '"said"' ELSE '""' END""", "k % 7 < 2"),
        _tagged("model", "stringValue", _quoted("model"), "model IS NOT NULL"), _tagged("k5", "intValue", _quoted("k % 5")), _tagged("service", "stringValue", _quoted("service_name")),
        _tagged("list", "arrayValue", f"'{LISTED}'", "k % 11 = 0"), _tagged("object", "kvlistValue", f"'{KEYED}'", "k % 13 = 0"),
    ]),
}.items():
    CANONICAL = CANONICAL.replace(_name, _sql)

KEYED_AS = "array<struct<key:string,value:struct<intValue:string,arrayValue:string,kvlistValue:string>>>"
HEAD = "schemaUrl:string,resource:struct<attributes:array<struct<key:string>>>"
SCOPED = "scope:struct<attributes:array<struct<key:string>>>"
AS_READ = {
    "logs": f"struct<resourceLogs:array<struct<{HEAD},scopeLogs:array<struct<{SCOPED},items:array<struct<timeUnixNano:string,flags:int,attributes:{KEYED_AS}>>>>>>>".replace("items", "logRecords"),
    "metrics": f"struct<resourceMetrics:array<struct<{HEAD},scopeMetrics:array<struct<{SCOPED},metrics:array<struct<name:string,summary:struct<dataPoints:array<struct<timeUnixNano:string,sum:double,attributes:{KEYED_AS}>>>>>>>>>>",
}


@frames(E, M)
def redacted(e, m):
    """What is left of each log record and each summary point, read back with a schema of its own, beside the payload's leaks."""
    keys = lambda c: F.concat_ws(",", F.transform(c, lambda a: a["key"]))
    pick = lambda key, tag: F.get(F.filter("x.attributes", lambda a: a["key"] == key), F.lit(0))["value"][tag]
    out = None
    for signal, p in (("logs", payloads.log_payloads(e)), ("metrics", payloads.metric_payloads(m))):
        clean = otlp.redact(p, signal, DENIED, CONTENT).withColumn("p", F.from_json("json", AS_READ[signal]))
        r = clean.select("payload_id", "gate_leaks", F.explode(f"p.resource{signal.title()}").alias("r")).withColumn("s", F.explode(f"r.scope{signal.title()}"))
        r = r.withColumn("x", F.explode("s.logRecords")) if signal == "logs" else r.withColumn("y", F.explode("s.metrics")).where("y.summary IS NOT NULL").withColumn("x", F.explode("y.summary.dataPoints"))
        one = r.select(
            "payload_id", "gate_leaks", col("r.schemaUrl").alias("schema_url"), keys("r.resource.attributes").alias("resource_keys"), keys("s.scope.attributes").alias("scope_keys"), col("x.timeUnixNano").alias("nanos"),
            pick("event.id", "intValue").cast("bigint").alias("event_id"), (col("x.flags") if signal == "logs" else F.lit(-1)).alias("flags"), keys("x.attributes").alias("record_keys"),
            F.coalesce(pick("list", "arrayValue"), F.lit("")).alias("listed"), F.coalesce(pick("object", "kvlistValue"), F.lit("")).alias("keyed"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def _present(*of: str) -> str:
    """Keys whose value is there, comma-joined, in SQL."""
    listed = SCALARS | NESTED
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {listed[k]} IS NOT NULL THEN '{k}' END" for k in of) + ")"


REDACTED = f"""SELECT pid AS payload_id, count(*) FILTER (k % 7 = 0) OVER (PARTITION BY pid) AS gate_leaks, 'https://schema.example/1' AS schema_url, concat_ws(',', CASE WHEN user_email IS NOT NULL THEN 'user.email' END, 'session.id', 'os.type') AS resource_keys,
        'scope.tag' AS scope_keys, concat(epoch_us(event_time), '123') AS nanos, event_id, CAST(k % 2 AS INT) AS flags, {_present("k", "event.id", "success", "cost", "model", "k5", "service", "list", "object")} AS record_keys,
        CASE WHEN k % 11 = 0 THEN '{LISTED}' ELSE '' END AS listed, CASE WHEN k % 13 = 0 THEN '{KEYED}' ELSE '' END AS keyed FROM lf
    UNION ALL SELECT pid, 0, 'https://schema.example/1', concat_ws(',', CASE WHEN user_email IS NOT NULL THEN 'user.email' END, 'session.id', 'os.type'), 'scope.tag', concat(epoch_us(ts), '123'), event_id, -1, 'k,tool,event.id', '', '' FROM mf WHERE k % 5 = 2"""


@frames(E, M)
def leak_audit(e, m):
    r = recs(e, m)
    return otlp.redaction_leaks(otlp.key_paths(r), profile.catalogue_frame(e, otlp.CATALOGUE))


# --- archive ---------------------------------------------------------------------------------


def both_payloads(e, m):
    return payloads.metric_payloads(m).unionByName(payloads.log_payloads(e))


FIRST, LAST = datetime.date(2024, 1, 1), datetime.date(2024, 1, 30)


def _stored(e, m):
    """An archive of both signals' payloads with the days up to the tenth compacted."""
    spark = e.sparkSession
    raw_root, small = workspace(spark, "raw"), workspace(spark, "compacted")
    reservoir.write_raw(both_payloads(e, m), raw_root)
    raw = reservoir.read_raw(spark, raw_root, ["logs", "metrics"], FIRST, LAST)
    plan = reservoir.compaction_plan(reservoir.listed(spark, raw_root), reservoir.listed(spark, small), datetime.date(2024, 1, 10))
    reservoir.compact(raw, plan, small)
    return raw, spark.read.schema("payload_id string, json string, signal string, dt date").parquet(small).select(raw.columns), raw_root, small


@frames(E, M)
def compacted_days(e, m):
    raw, small, raw_root, small_root = _stored(e, m)
    spark = e.sparkSession
    plan = reservoir.compaction_plan(reservoir.listed(spark, raw_root), reservoir.listed(spark, small_root), datetime.date(2024, 1, 20), datetime.date(2024, 1, 3), datetime.date(2024, 1, 18))
    whole = reservoir.prefer_compacted(raw.withColumn("kind", F.lit("raw")), small.withColumn("kind", F.lit("compacted")))
    each = whole.groupBy("signal", "dt", "kind").agg(F.count("*").alias("payloads"), F.bit_xor(F.xxhash64("json")).alias("texts"))
    first = raw.groupBy("signal", "dt").agg(F.bit_xor(F.xxhash64("json")).alias("raw_texts"))
    out = each.join(plan.select("signal", "dt", F.lit(True).alias("planned")), ["signal", "dt"], "left").join(first, ["signal", "dt"])
    return out.select("signal", "dt", "kind", "payloads", F.coalesce("planned", F.lit(False)).alias("planned"), (col("texts") == col("raw_texts")).alias("unchanged"))


@frames(E, M)
def read_window(e, m):
    root = workspace(e.sparkSession, "raw")
    reservoir.write_raw(both_payloads(e, m), root)
    some = reservoir.read_raw(e.sparkSession, root, ["logs", "metrics"], datetime.date(2024, 1, 5), datetime.date(2024, 1, 9))
    return some.groupBy("signal", "dt").agg(F.count("*").alias("payloads"), F.count_distinct("payload_id").alias("ids"))


@frames(E, M)
def scrub_report(e, m):
    """Days that were redacted when they came in are scanned again and stay as they are."""
    out = None
    for signal, p in (("logs", payloads.log_payloads(e)), ("metrics", payloads.metric_payloads(m))):
        early = otlp.redact(p.where("dt < DATE '2024-01-10'"), signal, DENIED, CONTENT).drop("gate_leaks")
        report = reservoir.scrub(early.unionByName(p.where("dt >= DATE '2024-01-10'")), signal, DENIED, CONTENT)[1].withColumn("signal", F.lit(signal))
        out = report if out is None else out.unionByName(report)
    return out


#: Texts that no fact can take: one is cut off, one repeats a key, one is null; each of some days.
BROKEN = ("concat('{\"resourceLogs\":[', payload_id)", "concat('{\"resourceLogs\":[],\"resourceLogs\":[\"', payload_id, '\"]}')", "CAST(NULL AS STRING)")


def with_broken(p):
    """``p`` and beside each payload of every fifth day three texts that are none."""
    some = p.where("dayofmonth(dt) % 5 = 0")
    for n, text in enumerate(BROKEN):
        p = p.unionByName(some.select("signal", "dt", F.concat("payload_id", F.lit(f"-broken{n}")).alias("payload_id"), F.expr(text).alias("json")))
    return p


def stored_rows(spark, root):
    """Rows of both facts, hashes and quarantined texts by table and day."""
    facts = None
    for signal, (table, _, _) in store.FACTS.items():
        rows = store.read_facts(spark, root, signal).groupBy("day").agg(F.count("*").alias("rows"), F.sum("k").alias("k")).select(F.lit(table).alias("fact"), "day", "rows", "k")
        facts = rows if facts is None else facts.unionByName(rows)
    commits = Commits(spark, root)
    hashes = commits.read("ledger", store.LEDGER).groupBy("dt").agg(F.count("*").alias("rows"), F.count_distinct("batch_hash").alias("k")).select(F.lit("ledger").alias("fact"), col("dt").alias("day"), "rows", "k")
    bad = commits.read("quarantine", store.QUARANTINE).groupBy("dt", "reason").agg(F.count("*").alias("rows")).select(F.concat(F.lit("quarantine, "), "reason").alias("fact"), col("dt").alias("day"), "rows", F.lit(0).cast("long").alias("k"))
    return facts.unionByName(hashes).unionByName(bad)


#: The same in SQL over e and m, lf and mf; points of k % 5 = 2 are summaries, which the fact does not take.
STORED_FACTS = """SELECT 'events' AS fact, activity_date AS day, count(*) AS rows, CAST(sum(k) AS BIGINT) AS k FROM e GROUP BY 2 UNION ALL SELECT 'metrics', activity_date, count(*), CAST(sum(k) AS BIGINT) FROM m WHERE k % 5 <> 2 GROUP BY 2
    UNION ALL SELECT 'ledger', dt, count(*), count(*) FROM pl GROUP BY 2"""
STORED = STORED_FACTS + """ UNION ALL SELECT 'quarantine, ' || reason, dt, TIMES * count(*), 0 FROM pl, (VALUES ('no JSON'), ('repeated key'), ('no text')) AS t(reason) WHERE day(dt) % 5 = 0 GROUP BY reason, dt"""


@frames(E)
def ingested(e):
    p = written(payloads.log_payloads(e), "payloads")
    ledger = p.where("dt < DATE '2024-01-04'").select(otlp.batch_hash(col("json")).alias("batch_hash"))
    fresh, more = reservoir.ingest(p.unionAll(p.where("dt = DATE '2024-01-09'")), ledger)
    return fresh.select("payload_id", "dt", "batch_hash").join(more.withColumn("in_ledger", F.lit(True)), "batch_hash", "left").drop("batch_hash")


@frames(E, M)
def ingested_facts(e, m):
    """Both signals, a part of them twice, with texts among them that are no payloads."""
    spark, root = e.sparkSession, workspace(e.sparkSession, "store")
    p = with_broken(written(both_payloads(e, m), "payloads"))
    store.ingest(spark, root, p.where("dt <= DATE '2024-01-12'"), DENIED, CONTENT, horizon_days=60)
    store.ingest(spark, root, p.where("dt > DATE '2024-01-06'"), DENIED, CONTENT, horizon_days=60)
    return stored_rows(spark, root).withColumn("rows", F.when(col("fact").startswith("quarantine") & col("day").between(F.lit("2024-01-07").cast("date"), F.lit("2024-01-12").cast("date")), F.floor(col("rows") / 2)).otherwise(col("rows")))


@frames(E, M)
def replayed(e, m):
    """A store that lost and spoilt rows of both signals in a window gets them again from the archive."""
    spark, root = e.sparkSession, workspace(e.sparkSession, "store")
    p = written(both_payloads(e, m), "payloads")
    store.ingest(spark, root, p.where("dt < DATE '2024-01-12'"), DENIED, CONTENT)
    commits = Commits(spark, root)
    spoilt = [part for s in store.FACTS for part in commits.write(store.FACTS[s][0], store.facts(p.where("dt >= DATE '2024-01-12'"), s).where("k > 20").withColumn("k", col("k") + 1), "day")]
    commits.commit(spoilt)  # rows without hashes, some missing, all wrong
    late = datetime.datetime(2024, 3, 1)
    store.replay(spark, root, p, DENIED, CONTENT, datetime.datetime(2024, 1, 12), late)
    store.ingest(spark, root, p, DENIED, CONTENT, horizon_days=60)  # all hashes are there: nothing comes twice
    return stored_rows(spark, root)


@frames(E, M)
def archive_scrub(e, m):
    """An archive of both signals of which the days before the tenth came in clean, scrubbed by execution, then looked at again."""
    spark, root = e.sparkSession, workspace(e.sparkSession, "raw")
    out = None
    for signal, p in (("logs", payloads.log_payloads(e)), ("metrics", payloads.metric_payloads(m))):
        reservoir.write_raw(otlp.redact(p.where("dt < DATE '2024-01-10'"), signal, DENIED, CONTENT).repartition("dt"), root)
        reservoir.write_raw(p.where("dt >= DATE '2024-01-10'").repartition("dt"), root)
    before = written(reservoir.listed(spark, root).select(*reservoir.DAY_KEYS, "name"), "listing")
    for signal in ("logs", "metrics"):
        first = written(reservoir.scrub_archive(spark, root, signal, DENIED, CONTENT, FIRST, LAST, execute=True), "report")
        again = reservoir.scrub_archive(spark, root, signal, DENIED, CONTENT, FIRST, LAST).select("dt", col("payloads").alias("left"), col("rewritten").alias("still"))
        one = first.join(again, "dt").select(F.lit(signal).alias("signal"), "dt", "files", "dirty_files", "payloads", "rewritten", "leaks", "left", "still")
        out = one if out is None else out.unionByName(one)
    kept = before.join(reservoir.listed(spark, root), [*reservoir.DAY_KEYS, "name"], "left_semi").groupBy(*reservoir.DAY_KEYS).agg(F.count("*").alias("kept_files"))
    return out.join(kept, reservoir.DAY_KEYS, "left").withColumn("kept_files", F.coalesce("kept_files", F.lit(0)))


@frames(E, M)
def inventory(e, m):
    """Listings of a source and a target whose files are named by the second and the payload; some names tell no time."""
    names = both_payloads(e, m).select("signal", "dt", "payload_id").withColumn("n", F.length("payload_id"))
    clock = F.concat(F.lpad((col("n") % 24).cast("string"), 2, "0"), F.lit("0930-"), "payload_id", F.lit(".json.gz"))
    named = names.select("signal", "dt", "n", F.when(col("n") % 5 == 0, F.concat(F.lit("odd-"), "payload_id")).otherwise(clock).alias("name"))
    return reservoir.inventory_diff(named, named.where("n % 2 = 0 AND signal = 'logs'"), datetime.date(2024, 1, 4))


@frames(E, M, "utilization", "roster", "manual_alias")
def refresh_log(e, m, u, r, a):
    spark = e.sparkSession
    sources = {name: written(x, name) for name, x in ((E, e), (M, m), ("utilization", u), ("roster", r))} | {"manual_alias": a}  # adapted once for all marts
    nodes = refresh.graph(spark, workspace(spark, "findings"), AS_OF, floor=COST_FLOOR, least_sessions=LEAST)
    log = refresh.refresh(spark, nodes, sources, workspace(spark, "marts"))
    return log.select("mart", "row_count", (col("finished_at") >= col("started_at")).alias("in_order"))


#: Row counts of the marts by the oracles of their own queries.
MARTS = {
    "fact_session": "a1_fact_session", "fact_session_daily": "a2_fact_session_daily", "fact_api_usage": "a3_fact_api_usage", "fact_edit_decision": "a4_fact_edit_decision", "fact_tool_outcome": "a5_fact_tool_outcome",
    "fact_api_error_rate": "a6_fact_api_error_rate", "fact_usage_window": "a7_fact_usage_window", "fact_utilization_hourly": "a8_utilization_hourly", "bridge_agent": "b1_bridge_agent", "bridge_hook": "b2_bridge_hook",
    "bridge_server": "b3_bridge_server", "bridge_plugin": "b4_bridge_plugin", "bridge_skill": "b5_bridge_skill", "dim_model": "d2_dim_model", "dim_user": "d1_dim_user", "dim_date": "d3_d4_dim_date", "dim_seat": "d5_dim_seat",
    "dim_seat_current": "d6_dim_seat_current", "dq_finding_current": "w5_detection_log", "seat_config_convergence": "q13_config_convergence",
}
_SQL = MART_QUERIES | SEAT_QUERIES | QUALITY_QUERIES
_DAYS = SEAT_QUERIES["a10_fact_seat_day"][1].replace(f"DATE '{LATE}'", f"DATE '{AS_OF}'")
REFRESHED = " UNION ALL ".join(f"SELECT '{mart}' AS mart, (SELECT count(*) FROM ({_SQL[q][1]})) AS row_count, true AS in_order" for mart, q in MARTS.items())
REFRESHED += f" UNION ALL SELECT 'fact_seat_day', (SELECT CAST(sum(seats) AS BIGINT) FROM ({_DAYS})), true"


# --- profiles --------------------------------------------------------------------------------


@frames(E, M)
def record_profile(e, m):
    return rounded(profile.record_profile(recs(e, m)), "share", digits=6)


PROFILE = """SELECT t.signal, t.name, t.path, records, sessions, seats, least(cardinality, 500) AS cardinality, top3, round(records / population, 6) AS share
    FROM (SELECT signal, name, path, count(*) AS records, count(DISTINCT session_id) AS sessions, count(DISTINCT user_email) AS seats, count(DISTINCT v) AS cardinality FROM pv GROUP BY 1, 2, 3) t
    JOIN po p ON p.name = t.name AND p.signal = t.signal
    JOIN (SELECT signal, name, path, array_to_string(array_agg(v ORDER BY n DESC, v), ',') AS top3 FROM (SELECT *, row_number() OVER (PARTITION BY signal, name, path ORDER BY n DESC, v) AS r
        FROM (SELECT signal, name, path, v, count(*) AS n FROM pv GROUP BY 1, 2, 3, 4)) WHERE r <= 3 GROUP BY 1, 2, 3) x ON x.name = t.name AND x.path = t.path AND x.signal = t.signal"""


@frames(E, M)
def swept(e, m):
    paths = otlp.key_paths(recs(e, m))
    return profile.sweep(paths, profile.catalogue_frame(e, [x for x in otlp.CATALOGUE if x.path != "tool"])).groupBy("signal", "path", "finding").agg(F.count("*").alias("names"))


@frames(E, M)
def candidates(e, m):
    r = recs(e, m)
    p = profile.promotion_candidates(rounded(profile.path_shares(r), "share", digits=6), profile.catalogue_frame(e, otlp.CATALOGUE))
    return p.select("signal", "name", "path", "records", "share", F.coalesce("status", F.lit("unclassified")).alias("status"))


@frames(E, M)
def drifts(e, m):
    r, c = written(recs(e, m), "records"), profile.catalogue_frame(e, [*otlp.CATALOGUE, otlp.Entry("logs", "success", "kept", basis="constant"), otlp.Entry("logs", "cost", "kept", basis="collinear", partner="k5")])
    constant = profile.drift_constant(r.select("signal", F.explode("attrs").alias("path", "value")), c).select(F.lit("constant").alias("drift"), "path", col("values").alias("evidence"))
    collinear = profile.drift_collinear(r, c, "logs").where("broken > 0").select(F.lit("collinear").alias("drift"), "path", col("broken").alias("evidence"))
    thin = profile.drift_thin(r, c).select(F.lit("thin").alias("drift"), "path", col("seats").alias("evidence"))
    return constant.unionByName(collinear).unionByName(thin)


PROFILED = ["user_email", "prompt_id", "model", "tool_name", "effort", "error_type", "agent_name", "cc_version"]


# --- two stores ------------------------------------------------------------------------------


def flipped(e):
    """A target store: each user's rows from a day of their own on; users of every eleventh number never moved."""
    return e.where("user_id % 11 <> 0").where(F.expr("event_time >= timestamp_micros(1704067200000000 + (user_id % 20) * 86400000000)"))


FLIPPED = "SELECT * FROM e WHERE user_id % 11 <> 0 AND event_time >= make_timestamp(1704067200000000 + (user_id % 20) * 86400000000)"
MARKS = "SELECT user_email, min(event_time) AS watermark FROM t WHERE user_email IS NOT NULL GROUP BY 1"


@frames(E)
def x_copy(e):
    return reconcile.to_copy(e, reconcile.watermarks(flipped(e)), FLOOR).groupBy("user_email").agg(F.count("*").alias("rows"), F.max("event_time").alias("last"))


@frames(E)
def x_verify(e):
    t = flipped(e)
    copied = t.unionByName(reconcile.to_copy(e, reconcile.watermarks(t), FLOOR).select(t.columns))
    return reconcile.mismatches(e.where(col("event_time") >= F.lit(FLOOR)), copied.where(col("event_time") >= F.lit(FLOOR)))


@frames(E)
def purged(e):
    kept, audit = reconcile.purge(e, ~col("user_email").endswith("@corp.example"), datetime.datetime(2024, 1, 15))
    return audit.crossJoin(kept.agg(F.count("*").alias("kept")))  # one row each


@frames(E)
def loaded_once(e):
    """A backfill loaded, then once more with all rows staged: the second run of its name adds nothing."""
    spark, root = e.sparkSession, workspace(e.sparkSession, "backfill")
    staged = e.select("event_id", "session_id", "user_email", "activity_date", "k").withColumn("scope_name", F.when(col("k") % 3 > 0, F.concat(F.lit("sc"), col("k") % 3)))
    first = reconcile.load_backfill(spark, root, "backfill-1", staged, e.where("k < 30"), scopes=["sc2"])
    again = reconcile.load_backfill(spark, root, "backfill-1", staged, e.where("k < 0"), scopes=[])
    rows = Commits(spark, root).read("backfilled", staged.schema)
    return rows.groupBy("activity_date").agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("ids")).withColumns({"first_run": F.lit(first is not None), "second_run": F.lit(again is not None)})


@frames(E, M)
def purged_facts(e, m):
    kept_e, kept_m, finding = reconcile.purge_facts(e, m, ~col("user_email").endswith("@corp.example"), datetime.datetime(2024, 1, 15), "purged_domains")
    detail = F.from_json("details", "events long, metrics long, domains array<string>").alias("d")
    told = finding.select("finding_type", "subject", "kind", "row_count", detail).select("*", "d.events", "d.metrics", F.concat_ws(",", "d.domains").alias("domains")).drop("d")
    return told.crossJoin(kept_e.agg(F.count("*").alias("kept_events"))).crossJoin(kept_m.agg(F.count("*").alias("kept_metrics")))  # one row each


# --- streams ---------------------------------------------------------------------------------


def by_day(p):
    """Payloads gathered by day, so that an archive has a few files a day, by bytes, and not one of each task."""
    return p.hint("rebalance", *reservoir.DAY_KEYS)


@frames(E, M)
def streamed(e, m):
    """The archive of both signals' payloads, ingested as a stream; days that arrive twice are stored once, broken texts are set aside."""
    spark = e.sparkSession
    root, sink, checkpoint = (workspace(spark, n) for n in ("raw", "sink", "stream"))
    p = with_broken(written(both_payloads(e, m), "payloads"))
    reservoir.write_raw(by_day(p), root)
    reservoir.write_raw(by_day(p.where("dt = DATE '2024-01-09'")), root)
    ingest.continuous_ingest(ingest.payload_stream(spark, root), sink, checkpoint, DENIED, CONTENT).awaitTermination()
    return stored_rows(spark, sink)


@frames(E)
def deduped(e):
    """Payloads of an archive in which some days arrived twice, as a stream keeps them: each once."""
    spark = e.sparkSession
    root, sink, checkpoint = (workspace(spark, n) for n in ("raw", "sink", "stream"))
    p = written(payloads.log_payloads(e), "payloads")
    reservoir.write_raw(by_day(p), root)
    reservoir.write_raw(by_day(p.where("dt > DATE '2024-01-25'")), root)
    first = ingest.dedupe(ingest.payload_stream(spark, root).withColumn("arrived", col("dt").cast("timestamp")), "arrived", horizon="60 days")
    first.select("payload_id", "dt").writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink).awaitTermination()
    return spark.read.schema("payload_id string, dt date").parquet(sink)


@frames(E)
def leaks_of_batches(e):
    """The leak counts that micro-batches report, added up."""
    spark = e.sparkSession
    root, sink, checkpoint = (workspace(spark, n) for n in ("raw", "sink", "stream"))
    reservoir.write_raw(payloads.log_payloads(e), root)
    clean = ingest.observed_leaks(ingest.payload_stream(spark, root), "logs", DENIED, CONTENT).select("payload_id")
    seen = ingest.tallied(spark, lambda: clean.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
    return spark.createDataFrame([(seen.get("leaks", 0), seen.get("payloads", 0))], "leaks long, payloads long")


@frames(E)
def refreshed(e):
    """What has arrived is ingested, then a mart is refreshed from the stored rows."""
    spark = e.sparkSession
    root, sink, checkpoint = (workspace(spark, n) for n in ("raw", "sink", "stream"))
    reservoir.write_raw(payloads.log_payloads(e), root)

    def refresh():
        rows = store.read_facts(spark, sink, "logs").withColumn("activity_date", col("day"))
        return marts.refresh_all({"fact_api_error_rate": marts.fact_api_error_rate(rows)}, workspace(spark, "marts"))

    log = ingest.run_available(lambda: ingest.continuous_ingest(ingest.payload_stream(spark, root), sink, checkpoint, DENIED, CONTENT), refresh)
    return log.select("mart", "row_count", (col("finished_at") >= col("started_at")).alias("in_order"))


@frames(E)
def throttled(e):
    return ingest.throttle_batch(e, "session_id", "event_time", gap_us=3_600_000_000).groupBy("key").agg(F.count("*").alias("accepted"), F.max("us").alias("last_us"))


@frames(E)
def throttled_stream(e):
    """The same as a stream that stops and goes on: each week's rows arrive after the last, and state is what the checkpoint holds."""
    spark = e.sparkSession
    root, sink, checkpoint = (workspace(spark, n) for n in ("times", "sink", "stream"))
    times = written(e.where("event_time IS NOT NULL").select(col("session_id").alias("key"), F.unix_micros("event_time").alias("us")).withColumn("week", F.floor(col("us") / (7 * 86_400_000_000))), "weeks")
    for (week,) in times.select("week").distinct().orderBy("week").collect():  # weeks, of which there are few
        times.where(col("week") == week).drop("week").write.mode("append").parquet(root)
        kept = ingest.throttle_stream(spark.readStream.schema(times.drop("week").schema).parquet(root), gap_us=3_600_000_000)
        kept.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink).awaitTermination()
    return spark.read.schema(kept.schema).parquet(sink).groupBy("key").agg(F.count("*").alias("accepted"), F.max("us").alias("last_us"))


THROTTLE = """SELECT session_id AS key, us, us AS last, 1 AS n FROM (SELECT session_id, min(us) AS us FROM ts GROUP BY 1)
    UNION ALL SELECT f.key, x.us, x.us, f.n + 1 FROM f, LATERAL (SELECT min(us) AS us FROM ts WHERE ts.session_id = f.key AND ts.us >= f.last + 3600000000) x WHERE x.us IS NOT NULL"""
THROTTLED = sql(E, "SELECT key, count(*) AS accepted, max(us) AS last_us FROM f GROUP BY 1", ts="SELECT session_id, epoch_us(event_time) AS us FROM e WHERE event_time IS NOT NULL", f=THROTTLE)

QUERIES = {
    "p4_explode_metrics": (
        explode_metrics,
        sql(
            M,
            f"""SELECT event_id, metric_name, CASE k % 5 WHEN 0 THEN 'gauge' WHEN 1 THEN 'histogram' ELSE 'sum' END AS metric_type, CASE k % 5 WHEN 0 THEN 'gauge_last' WHEN 1 THEN 'hist_sum' ELSE value_kind END AS value_kind, ts, value,
            CASE WHEN k % 5 = 1 THEN k ELSE -1 END AS count, k, tool_name, {OWN_EMAIL} AS user_email, session_id FROM m WHERE k % 5 <> 2""",
        ),
    ),
    "p5_p11_p12_explode_logs": (
        explode_logs,
        sql(E, f"SELECT event_id, event_name, event_time, 'INFO' AS severity, k, success_bool, round(cost_usd, 6) AS cost_usd, {OWN_EMAIL} AS user_email, session_id FROM e"),
    ),
    "p8_promote": (promote_typed, sql(E, "SELECT event_id, CAST(k AS DOUBLE) AS k_number, true AS no_number, CASE WHEN k % 7 = 0 THEN 'said' ELSE coalesce(model, service_name) END AS family FROM e")),
    "p13_rate_limits": (
        rate_limits,
        sql(
            E,
            """SELECT event_id, '5h' AS usage_window, 'usage.utilization' AS metric_name, CAST(k AS DOUBLE) AS value FROM e UNION ALL SELECT event_id, '5h', 'usage.reset_in_seconds', CAST(greatest(0, k * 10 - 100) AS DOUBLE) FROM e
            UNION ALL SELECT event_id, '7d_x', unnest(['usage.utilization', 'usage.reset_in_seconds']), unnest([12.5, 0.0]) FROM e WHERE k % 2 <> 0""",
        ),
    ),
    "p14_batch_hash": (batch_hashes, sql(E, f"SELECT pid AS payload_id, sha256(json) AS batch_hash, true AS same_when_turned, true AS turned FROM ({CANONICAL})", lf=LOG_FLAT)),
    "p15_p16_p17_c1_key_paths": (key_path_counts, sql("events metrics", "SELECT signal, path, count(DISTINCT pid) AS payloads FROM pv GROUP BY 1, 2", **PROFILING)),
    "r1_r2_r3_redaction": (redacted, sql("events metrics", REDACTED, lf=LOG_FLAT, mf=MET_FLAT)),
    "r4_redaction_leaks": (leak_audit, sql("events metrics", "SELECT path, count(DISTINCT pid) AS payloads FROM pv WHERE path IN ('secret.token', 'prompt.text') GROUP BY 1", **PROFILING)),
    "s1_read_window": (
        read_window,
        sql("events metrics", "SELECT signal, dt, count(*) AS payloads, count(*) AS ids FROM pl WHERE dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' GROUP BY 1, 2", lf=LOG_FLAT, mf=MET_FLAT, pl=NAMES),
    ),
    "s2_s3_s4_compaction": (
        compacted_days,
        sql(
            "events metrics",
            """SELECT signal, dt, CASE WHEN dt < DATE '2024-01-10' THEN 'compacted' ELSE 'raw' END AS kind, count(*) AS payloads, dt >= DATE '2024-01-10' AND dt <= DATE '2024-01-18' AS planned, true AS unchanged FROM pl GROUP BY 1, 2""",
            lf=LOG_FLAT, mf=MET_FLAT, pl=NAMES,
        ),
    ),
    "s5_scrub": (
        scrub_report,
        sql(
            "events metrics",
            """SELECT 'logs' AS signal, count(DISTINCT pid) AS scanned, count(DISTINCT pid) FILTER (activity_date >= DATE '2024-01-10') AS rewritten, count(*) FILTER (k % 7 = 0 AND activity_date >= DATE '2024-01-10') AS leaks FROM lf
            UNION ALL SELECT 'metrics', count(DISTINCT pid), count(DISTINCT pid) FILTER (activity_date >= DATE '2024-01-10'), 0 FROM mf""",
            lf=LOG_FLAT, mf=MET_FLAT,
        ),
    ),
    "s6_replay": (replayed, sql("events metrics", STORED_FACTS, lf=LOG_FLAT, mf=MET_FLAT, pl=NAMES)),
    "s7_p14_ingest_facts": (ingested_facts, sql("events metrics", STORED.replace("TIMES", "1"), lf=LOG_FLAT, mf=MET_FLAT, pl=NAMES)),
    "s7_ingest": (ingested, sql(E, "SELECT DISTINCT pid AS payload_id, activity_date AS dt, true AS in_ledger FROM lf WHERE activity_date >= DATE '2024-01-04'", lf=LOG_FLAT)),
    "s8_retention": (
        frames(E)(lambda e: reservoir.trim(e.select("event_id", "event_time"), "event_time", datetime.datetime(2024, 1, 30), datetime.timedelta(days=7))),
        sql(E, "SELECT event_id, event_time FROM e WHERE event_time >= TIMESTAMP '2024-01-23'"),
    ),
    "s12_legacy_mapping": (
        lambda spark, d: reconcile.map_legacy(spark.read.parquet(f"{d}/events.parquet"), datetime.datetime(2024, 1, 5), datetime.datetime(2024, 1, 12)),
        "SELECT event_id AS legacy_id, ts AS event_time, event_type AS event_name, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'",
    ),
    "s13_backfill": (
        frames(E)(lambda e: reconcile.backfill(e.withColumn("scope_name", F.when(col("k") % 3 > 0, F.concat(F.lit("sc"), col("k") % 3))), e.where("k < 30"), scopes=["sc2"]).select("event_id")),
        sql(E, "SELECT event_id FROM e WHERE k % 3 <> 2 AND (user_email IS NULL OR user_email LIKE '%@corp.example') AND session_id NOT IN (SELECT session_id FROM e WHERE k < 30)"),
    ),
    "s14_purge": (
        purged,
        sql(
            E,
            """SELECT (SELECT count(*) FROM e WHERE user_email NOT LIKE '%@corp.example' AND event_time < TIMESTAMP '2024-01-15') AS purged, 'mail.example' AS domains,
            (SELECT count(*) FROM e WHERE NOT coalesce(user_email NOT LIKE '%@corp.example' AND event_time < TIMESTAMP '2024-01-15', false)) AS kept""",
        ),
    ),
    "s13_load_once": (
        loaded_once,
        sql(
            E,
            """SELECT activity_date, count(*) AS rows, count(*) AS ids, true AS first_run, false AS second_run FROM e WHERE k % 3 <> 2 AND (user_email IS NULL OR user_email LIKE '%@corp.example')
            AND session_id NOT IN (SELECT session_id FROM e WHERE k < 30) GROUP BY 1""",
        ),
    ),
    "s14_purge_facts": (
        purged_facts,
        sql(
            "events metrics",
            """SELECT 'purged_domains' AS finding_type, '(dataset)' AS subject, 'gauge' AS kind, ge + gm AS row_count, ge AS events, gm AS metrics, 'mail.example' AS domains, ne - ge AS kept_events, nm - gm AS kept_metrics
            FROM (SELECT count(*) AS ne, count(*) FILTER (user_email NOT LIKE '%@corp.example' AND event_time < TIMESTAMP '2024-01-15') AS ge FROM e),
            (SELECT count(*) AS nm, count(*) FILTER (user_email NOT LIKE '%@corp.example' AND ts < TIMESTAMP '2024-01-15') AS gm FROM m)""",
        ),
    ),
    "s15_overlap_sessions": (
        frames(E)(lambda e: reconcile.overlap_sessions(e, e.where("k < 40"), datetime.datetime(2024, 1, 20))),
        sql(E, "SELECT DISTINCT session_id FROM e WHERE event_time >= TIMESTAMP '2024-01-20' AND session_id NOT IN (SELECT session_id FROM e WHERE k < 40)"),
    ),
    "s16_refresh_all": (refresh_log, REFRESHED),
    "s17_inventory_diff": (
        inventory,
        sql(
            "events metrics",
            """SELECT signal, dt, count(*) AS names, count(*) FILTER (lacking) AS missing, min(name) FILTER (lacking) AS first_name, count(*) FILTER (NOT lacking) AS target_names, max(wt) AS newest_source, max(wt) FILTER (NOT lacking) AS newest_target,
            count(*) FILTER (wt IS NULL) AS untimed FROM (SELECT signal, dt, NOT (n % 2 = 0 AND signal = 'logs') AS lacking, CASE WHEN n % 5 = 0 THEN 'odd-' || pid ELSE lpad(CAST(n % 24 AS VARCHAR), 2, '0') || '0930-' || pid || '.json.gz' END AS name,
            CASE WHEN n % 5 <> 0 THEN dt + INTERVAL (n % 24) HOUR + INTERVAL 570 SECOND END AS wt FROM (SELECT *, length(pid) AS n FROM pl WHERE dt >= DATE '2024-01-04')) GROUP BY 1, 2""",
            lf=LOG_FLAT, mf=MET_FLAT, pl=NAMES,
        ),
    ),
    "s5_scrub_archive": (
        archive_scrub,
        sql(
            "events metrics",
            """SELECT signal, dt, 1 AS files, CASE WHEN dirty THEN 1 ELSE 0 END AS dirty_files, n AS payloads, CASE WHEN dirty THEN n ELSE 0 END AS rewritten, CASE WHEN dirty THEN leaks ELSE 0 END AS leaks, n AS left, 0 AS still, CASE WHEN dirty THEN 0 ELSE 1 END AS kept_files
            FROM (SELECT pl.signal, pl.dt, pl.dt >= DATE '2024-01-10' AS dirty, count(*) AS n, coalesce(any_value(l.leaks), 0) AS leaks FROM pl
            LEFT JOIN (SELECT 'logs' AS signal, activity_date AS dt, count(*) FILTER (k % 7 = 0) AS leaks FROM lf GROUP BY 2) l ON l.signal = pl.signal AND l.dt = pl.dt GROUP BY 1, 2, 3)""",
            lf=LOG_FLAT, mf=MET_FLAT, pl=NAMES,
        ),
    ),
    "c2_l2_value_samples": (
        frames(E, M)(lambda e, m: profile.value_samples(walked(e, m), top=3)),
        sql(
            "events metrics",
            """SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY signal, path) AS cardinality, CAST(row_number() OVER (PARTITION BY signal, path ORDER BY n DESC, value) AS INT) AS rank
            FROM (SELECT signal, path, v AS value, count(*) AS n FROM av GROUP BY 1, 2, 3)) WHERE rank <= 3""",
            **PROFILING,
        ),
    ),
    "l1_top_values": (frames(E, M)(lambda e, m: profile.top_values(walked(e, m), "k")), sql("events metrics", "SELECT v AS value, count(*) AS n FROM av WHERE path = 'k' GROUP BY 1 ORDER BY n DESC, value LIMIT 50", **PROFILING)),
    "c3_record_profile": (record_profile, sql("events metrics", PROFILE, **PROFILING)),
    "c4_seat_reach": (
        frames(E, M)(lambda e, m: profile.seat_reach(recs(e, m))),
        sql("events metrics", "SELECT signal, path, v AS value, count(DISTINCT user_email) AS seats FROM pv WHERE (signal, path) IN (SELECT (signal, path) FROM pv GROUP BY signal, path HAVING count(DISTINCT v) <= 25) GROUP BY 1, 2, 3", **PROFILING),
    ),
    "c5_c6_sweep": (
        swept,
        sql(
            "events metrics",
            "SELECT signal, path, coalesce(status, 'unclassified') AS finding, count(DISTINCT name) AS names FROM de WHERE status IS NULL OR status = 'denied' GROUP BY 1, 2, 3",
            **PROFILING, ca=catalogued(x for x in otlp.CATALOGUE if x.path != "tool"), de=DECIDED,
        ),
    ),
    "c7_promotion_candidates": (
        candidates,
        sql(
            "events metrics",
            """SELECT de.signal, de.name, path, count(*) AS records, round(count(*) / any_value(population), 6) AS share, coalesce(any_value(status), 'unclassified') AS status FROM de JOIN po ON po.signal = de.signal AND po.name = de.name
            WHERE de.signal <> 'resource' AND path NOT IN (SELECT path FROM pv WHERE signal = 'resource') AND (status IS NULL OR status = 'kept') GROUP BY 1, 2, 3""",
            **PROFILING, ca=catalogued(otlp.CATALOGUE), de=DECIDED,
        ),
    ),
    "c8_c9_c10_basis_drift": (
        drifts,
        sql(
            "events metrics",
            "SELECT 'constant' AS drift, 'success' AS path, 2 AS evidence UNION ALL SELECT 'collinear', 'cost', count(*) FROM (SELECT k % 5 FROM e GROUP BY 1 HAVING count(DISTINCT cost_usd) > 1) UNION ALL SELECT 'thin', 'os.type', count(DISTINCT user_email) FROM (SELECT user_email FROM e UNION SELECT user_email FROM m)",
        ),
    ),
    "c11_column_profile": (
        frames(E)(lambda e: profile.column_profile(e, PROFILED)),
        sql(
            E,
            " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(100.0 * count({c}) / count(*), 4) AS non_null_pct, count(DISTINCT {c}) AS \"distinct\", round(100.0 * count(DISTINCT {c}) / count({c}), 4) AS unique_pct FROM e" for c in PROFILED),
        ),
    ),
    "c12_signal_profile": (
        frames(E)(lambda e: profile.signal_profile(e, "event_name", "event_time")),
        sql(E, "SELECT event_name, count(*) AS rows, CAST(min(event_time) AS DATE) AS first_day, CAST(max(event_time) AS DATE) AS last_day, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM e GROUP BY 1"),
    ),
    "c13_unknown_literals": (
        frames(M)(lambda m: profile.unknown_literals(m, "metric_name", ["commit.count", "cost.usage", "active_time.total"])),
        sql(M, "SELECT metric_name, count(*) AS rows FROM m WHERE metric_name NOT IN ('commit.count', 'cost.usage', 'active_time.total') GROUP BY 1"),
    ),
    "x1_watermarks": (frames(E)(lambda e: reconcile.watermarks(flipped(e))), sql(E, "SELECT * FROM w", t=FLIPPED, w=MARKS)),
    "x2_bounded_copy": (
        x_copy,
        sql(E, f"SELECT e.user_email, count(*) AS rows, max(event_time) AS last FROM e JOIN w ON w.user_email = e.user_email WHERE watermark > TIMESTAMP '{FLOOR}' AND event_time >= TIMESTAMP '{FLOOR}' AND event_time < watermark GROUP BY 1", t=FLIPPED, w=MARKS),
    ),
    "x3_census": (
        frames(E)(lambda e: reconcile.census(e, reconcile.watermarks(flipped(e)), FLOOR)),
        sql(
            E,
            f"""SELECT CASE WHEN e.user_email IS NULL THEN 'no address' WHEN watermark IS NULL THEN 'held, not moved' WHEN event_time >= watermark THEN 'held, above' WHEN event_time >= TIMESTAMP '{FLOOR}' THEN 'to copy' ELSE 'below floor' END AS fate,
            count(*) AS rows, count(DISTINCT e.user_email) AS seats FROM e LEFT JOIN w ON w.user_email = e.user_email GROUP BY 1""",
            t=FLIPPED, w=MARKS,
        ),
    ),
    "x4_shortfall": (
        frames(E)(lambda e: reconcile.shortfall(e, flipped(e))),
        sql(
            E,
            """SELECT a.user_email, CAST(sum(greatest(s - coalesce(n, 0), 0)) AS BIGINT) AS missing FROM (SELECT user_email, activity_date, count(*) AS s FROM e WHERE user_email IS NOT NULL GROUP BY 1, 2) a
            LEFT JOIN (SELECT user_email, activity_date, count(*) AS n FROM t GROUP BY 1, 2) b ON a.user_email = b.user_email AND a.activity_date = b.activity_date GROUP BY 1""",
            t=FLIPPED,
        ),
    ),
    "x5_sweep_targets": (
        frames(E)(lambda e: reconcile.sweep_targets(e, flipped(e))),
        sql(E, "SELECT DISTINCT user_email, TIMESTAMP '2200-01-01' AS watermark FROM e WHERE user_email IS NOT NULL AND user_email NOT IN (SELECT user_email FROM t WHERE user_email IS NOT NULL)", t=FLIPPED),
    ),
    "x6_dual_sessions": (
        frames(E)(lambda e: reconcile.dual_sessions(e, flipped(e).where("k % 2 = 0"), reconcile.watermarks(flipped(e)))),
        sql(E, "SELECT DISTINCT session_id FROM e JOIN w ON w.user_email = e.user_email WHERE event_time >= watermark AND session_id IN (SELECT session_id FROM t WHERE k % 2 = 0)", t=FLIPPED, w=MARKS),
    ),
    "x7_write_quiet": (
        frames(E)(lambda e: rounded(reconcile.quiet(e, "event_time", datetime.datetime(2024, 2, 1)), "quiet_hours")),
        sql(E, "SELECT round((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(event_time))) / 3.6e9, 4) AS quiet_hours, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(event_time))) / 3.6e9 >= 24 AS may_go FROM e"),
    ),
    "x8_verify_copy": (
        x_verify,
        sql(
            E,
            f"""SELECT user_email, s AS source_rows, n AS target_rows FROM (SELECT user_email, count(*) AS s, count(*) FILTER (c) AS n FROM (SELECT e.user_email, user_id % 11 <> 0 AND (event_time >= make_timestamp(1704067200000000 + (user_id % 20) * 86400000000)
            OR (w.watermark > TIMESTAMP '{FLOOR}' AND event_time < w.watermark)) AS c FROM e LEFT JOIN w ON w.user_email = e.user_email WHERE event_time >= TIMESTAMP '{FLOOR}') GROUP BY 1) WHERE s <> n""",
            t=FLIPPED, w=MARKS,
        ),
    ),
    "st1_continuous_ingest": (streamed, sql("events metrics", STORED.replace("TIMES", "1"), lf=LOG_FLAT, mf=MET_FLAT, pl=NAMES)),
    "st2_dedupe": (deduped, sql(E, "SELECT DISTINCT pid AS payload_id, activity_date AS dt FROM lf", lf=LOG_FLAT)),
    "st4_leak_counts": (leaks_of_batches, sql(E, "SELECT count(*) FILTER (k % 7 = 0) AS leaks, count(DISTINCT pid) AS payloads FROM lf", lf=LOG_FLAT)),
    "st5_refresh_after_ingest": (
        refreshed,
        sql(E, "SELECT 'fact_api_error_rate' AS mart, count(DISTINCT activity_date) AS row_count, true AS in_order FROM e WHERE event_name IN ('api_request', 'api_error')"),
    ),
    "st3_throttle": (throttled, THROTTLED),
    "st3_throttle_stream": (throttled_stream, THROTTLED),
}
