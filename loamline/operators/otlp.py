"""Decoding of nested telemetry payloads into rows, and their redaction.

A payload is one JSON text. Its known shape is a typed tree; attribute values that are lists or
objects stay JSON text. Maps need spark.sql.mapKeyDedupPolicy=LAST_WIN: the last of equal keys counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions import columns as C
from loamline.functions import plain, spans
from loamline.sources.shared import small_batches

col = F.col

VALUE = "struct<stringValue:string,intValue:string,doubleValue:double,boolValue:boolean,arrayValue:string,kvlistValue:string>"
ATTRS = f"array<struct<key:string,value:{VALUE}>>"
POINT = f"struct<timeUnixNano:string,asDouble:double,asInt:string,sum:double,count:string,attributes:{ATTRS}>"
OTHER = f"struct<dataPoints:array<struct<attributes:{ATTRS}>>>"
METRIC = f"struct<name:string,unit:string,gauge:struct<dataPoints:array<{POINT}>>,sum:struct<aggregationTemporality:string,dataPoints:array<{POINT}>>,histogram:struct<aggregationTemporality:string,dataPoints:array<{POINT}>>,exponentialHistogram:{OTHER},summary:{OTHER}>"
SCOPE = "struct<name:string,version:string>"
RESOURCE = f"struct<attributes:{ATTRS}>"
METRICS = f"resourceMetrics array<struct<resource:{RESOURCE},scopeMetrics:array<struct<scope:{SCOPE},metrics:array<{METRIC}>>>>>"
RECORD = f"struct<timeUnixNano:string,severityText:string,body:{VALUE},traceId:string,spanId:string,droppedAttributesCount:int,attributes:{ATTRS}>"
LOGS = f"resourceLogs array<struct<resource:{RESOURCE},scopeLogs:array<struct<scope:{SCOPE},logRecords:array<{RECORD}>>>>>"
SCHEMAS = {"metrics": METRICS, "logs": LOGS}


@dataclass(frozen=True)
class Entry:
    """What is decided about one attribute: promoted to a column, kept in the archive, or denied."""

    signal: str
    path: str
    status: str
    column: str = ""
    kind: str = "string"
    name: str = "*"
    basis: str = ""
    partner: str = ""


@dataclass(frozen=True)
class Derived:
    """A column that the first of several attributes fills that is there and is not empty, 0 or false."""

    signal: str
    column: str
    paths: tuple[str, ...]
    kind: str = "string"


#: Own attributes come before those of resources.
DERIVED = (Derived("logs", "family", ("prompt.text", "model", "service")), Derived("metrics", "family", ("tool",)), Derived("resource", "family", ("os.type",)))


#: Decisions for the attributes that the payload adapter writes.
CATALOGUE = (
    Entry("metrics", "k", "promoted", "k", "int"), Entry("metrics", "tool", "promoted", "tool_name"), Entry("metrics", "event.id", "promoted", "event_id", "bigint"),
    Entry("resource", "user.email", "promoted", "user_email"), Entry("resource", "session.id", "promoted", "session_id"), Entry("resource", "os.type", "kept", basis="thin"),
    Entry("resource", "secret.token", "denied"), Entry("logs", "k", "promoted", "k", "int"), Entry("logs", "event.id", "promoted", "event_id", "bigint"),
    Entry("logs", "success", "promoted", "success_bool", "boolean"), Entry("logs", "cost", "promoted", "cost_usd", "double"), Entry("logs", "prompt.text", "denied"), Entry("logs", "model", "kept", basis="collinear", partner="k5"),
    Entry("logs", "k5", "kept", basis="collinear", partner="model"), Entry("logs", "service", "kept", basis="constant"),
)


def any_value(v: Column) -> Column:
    """The display string of a tagged value: string, integer, double, boolean, list, object in this order."""
    return F.coalesce(v["stringValue"], v["intValue"], v["doubleValue"].cast("string"), v["boolValue"].cast("string"), v["arrayValue"], v["kvlistValue"])


def flatten_attrs(attrs: Column) -> Column:
    """A list of attributes as a map; the last of equal keys wins, null keys go."""
    named = F.filter(F.coalesce(attrs, F.array().cast(ATTRS)), lambda a: a["key"].isNotNull())
    return F.map_from_entries(F.transform(named, lambda a: F.struct(a["key"].alias("key"), any_value(a["value"]).alias("value"))))


def merge_attrs(resource: Column, record: Column) -> Column:
    """Attributes of the record over those of its resource."""
    return F.map_concat(resource, record)


def decode(payloads: DataFrame, signal: str) -> DataFrame:
    """``payloads`` (json) with its typed tree ``p``; only fields that later steps use are parsed out."""
    return payloads.withColumn("p", F.from_json("json", SCHEMAS[signal]))


def explode_metrics(payloads: DataFrame) -> DataFrame:
    """One row per data point: name, kind, time, value, count and merged attributes."""
    r = decode(payloads, "metrics").select(*[c for c in payloads.columns if c != "json"], F.explode("p.resourceMetrics").alias("r"))
    s = r.withColumn("resource", flatten_attrs(col("r.resource.attributes"))).withColumn("s", F.explode("r.scopeMetrics")).withColumn("m", F.explode("s.metrics"))
    kinds = [F.when(col(f"m.{k}").isNotNull(), F.struct(F.lit(k).alias("kind"), (col(f"m.{k}.aggregationTemporality") if k != "gauge" else F.lit(None).cast("string")).alias("temporality"), col(f"m.{k}.dataPoints").alias("points"))) for k in ("gauge", "sum", "histogram")]
    d = s.withColumn("kind", F.explode(F.array_compact(F.array(*kinds)))).withColumn("d", F.explode("kind.points"))
    value = F.when(col("kind.kind") == "histogram", col("d.sum")).otherwise(F.coalesce("d.asDouble", col("d.asInt").cast("double")))
    return d.select(
        *[c for c in payloads.columns if c != "json"], col("m.name").alias("metric_name"), col("kind.kind").alias("metric_type"), C.value_kind(col("kind.kind"), col("kind.temporality")).alias("value_kind"),
        nanos_ts(col("d.timeUnixNano")).alias("ts"), value.alias("value"), F.when(col("kind.kind") == "histogram", col("d.count").cast("bigint")).alias("count"), col("s.scope.name").alias("scope_name"),
        "resource", flatten_attrs(col("d.attributes")).alias("own"),
    ).withColumn("attrs", merge_attrs(col("resource"), col("own")))


def nanos_ts(text: Column) -> Column:
    """Epoch nanoseconds as text to a timestamp, cut to microseconds."""
    return F.timestamp_micros(F.floor(text.cast("decimal(20,0)") / 1000).cast("bigint"))


def explode_logs(payloads: DataFrame, prefix: str = "app.") -> DataFrame:
    """One row per log record, its event name without the prefix."""
    r = decode(payloads, "logs").select(*[c for c in payloads.columns if c != "json"], F.explode("p.resourceLogs").alias("r"))
    s = r.withColumn("resource", flatten_attrs(col("r.resource.attributes"))).withColumn("s", F.explode("r.scopeLogs")).withColumn("l", F.explode("s.logRecords"))
    rows = s.select(
        *[c for c in payloads.columns if c != "json"], nanos_ts(col("l.timeUnixNano")).alias("event_time"), col("l.severityText").alias("severity"), any_value(col("l.body")).alias("body"),
        col("l.traceId").alias("trace_id"), F.coalesce("l.droppedAttributesCount", F.lit(0)).alias("dropped"), col("s.scope.name").alias("scope_name"), "resource", flatten_attrs(col("l.attributes")).alias("own"),
    ).withColumn("attrs", merge_attrs(col("resource"), col("own")))
    return rows.withColumn("event_name", event_name(col("attrs"), col("body"), prefix))


def event_name(attrs: Column, name: Column, prefix: str) -> Column:
    return F.regexp_replace(F.coalesce(F.element_at(attrs, "event.name"), name), "^" + prefix.replace(".", r"\."), "")


def promote(rows: DataFrame, catalogue: tuple[Entry, ...], signal: str, derived: tuple[Derived, ...] = ()) -> DataFrame:
    """Promoted attributes of a signal and of resources as typed columns, then derived ones; a value that does not fit is NULL.

    The sources of a derived column are the signal's own in order, then those of resources.
    """
    own = [e for e in catalogue if e.status == "promoted" and e.signal in (signal, "resource")]
    typed = lambda v, kind: C.to_bool(v) if kind == "boolean" else v.try_cast(kind)
    out = rows.withColumns({e.column: typed(F.element_at("attrs", e.path), e.kind) for e in own})
    found: dict[str, tuple[str, list[str]]] = {}
    for d in sorted((d for d in derived if d.signal in (signal, "resource")), key=lambda d: d.signal == "resource"):
        found.setdefault(d.column, (d.kind, []))[1].extend(d.paths)
    if found:
        out = out.withColumns({c: typed(C.first_truthy(col("attrs"), list(dict.fromkeys(paths))), kind) for c, (kind, paths) in found.items()})
    return out.withColumn("user_email", C.normalize_email(col("user_email"))) if any(e.column == "user_email" for e in own) else out


def batch_hash(json: Column) -> Column:
    """A digest of the payload in canonical form, keys sorted and no spaces, or of its text where it has no such form."""
    return F.sha2(F.coalesce(F.to_json(F.try_parse_json(json)), json), 256)


def rate_limit_points(rows: DataFrame, snapshot: str, at: str) -> DataFrame:
    """A utilization and a countdown point for each window of a snapshot; percentages that are no numbers are left out."""
    names = {"five_hour": "5h", "seven_day": "7d"}
    limits = F.from_json(snapshot, "struct<rate_limits:map<string,struct<used_percentage:string,utilization:string,resets_at:string>>>")["rate_limits"]
    each = rows.select(*[c for c in rows.columns if c != snapshot], F.explode(limits).alias("name", "w"))
    label = F.coalesce(*[F.when(col("name") == k, F.lit(v)) for k, v in names.items()], F.when(col("name").startswith("seven_day_"), F.concat(F.lit("7d"), F.expr("substr(name, 10)"))), col("name"))
    pct = F.coalesce("w.used_percentage", "w.utilization").try_cast("double")
    left = F.greatest(F.lit(0.0), col("w.resets_at").try_cast("double") - F.unix_micros(at) / 1e6)
    each = each.withColumns({"usage_window": label, "_pct": pct, "_left": left}).where(col("_pct").isNotNull())
    points = F.array(F.struct(F.lit("usage.utilization").alias("metric_name"), col("_pct").alias("value")), F.struct(F.lit("usage.reset_in_seconds").alias("metric_name"), col("_left").alias("value")))
    out = each.withColumn("p", F.explode(points)).select(*[c for c in rows.columns if c != snapshot], "usage_window", "p.metric_name", "p.value")
    return out.where(col("value").isNotNull())


NONE = "array<struct<signal:string,name:string,attributes:" + ATTRS + ">>"


def records(metrics: DataFrame, logs: DataFrame) -> DataFrame:
    """(payload_id, signal, name, attrs, resource) of resource blocks (named *), data points of all five kinds and log records alike.

    Points of a metric without a name are left out; a record without a name is called ∅. A payload is decoded once.
    """
    out = None
    for df, signal in ((metrics, "metrics"), (logs, "logs")):
        some = lambda a: F.coalesce(a, F.array().cast(NONE))
        one = lambda signal, name, attrs: F.struct(F.lit(signal).alias("signal"), name.alias("name"), attrs.alias("attributes"))
        if signal == "metrics":
            kinds = ("gauge", "sum", "histogram", "exponentialHistogram", "summary")
            points = lambda m: F.flatten(F.array(*[some(F.transform(m[k]["dataPoints"], lambda d: one("metrics", m["name"], d["attributes"]))) for k in kinds]))
            inner = lambda s: F.flatten(F.transform(F.filter(s["metrics"], lambda m: m["name"].isNotNull()), points))
        else:
            inner = lambda s: F.transform(s["logRecords"], lambda x: one("logs", any_value(x["body"]), x["attributes"]))
        r = decode(df, signal).select("payload_id", F.explode(f"p.resource{signal.title()}").alias("r"))
        own = F.flatten(F.transform(f"r.scope{signal.title()}", lambda s: some(inner(s))))  # noqa: B023
        listed = F.concat(F.array(one("resource", F.lit("*"), col("r.resource.attributes"))), some(own))
        each = r.select("payload_id", flatten_attrs(col("r.resource.attributes")).alias("resource"), F.explode(listed).alias("x"))
        each = each.select("payload_id", "x.signal", col("x.name").alias("name"), flatten_attrs(col("x.attributes")).alias("attrs"), "resource")
        if signal == "logs":
            named = F.coalesce(event_name(col("attrs"), col("name"), "app."), F.lit("∅"))
            each = each.withColumn("name", F.when(col("signal") == "logs", named).otherwise(col("name")))
        out = each if out is None else out.unionByName(each)
    return out


def key_paths(recs: DataFrame) -> DataFrame:
    """Distinct paths of each payload."""
    return recs.select("payload_id", "signal", "name", F.explode(F.map_keys("attrs")).alias("path")).distinct()


# --- attributes of whole texts ---------------------------------------------------------------
# Attributes stand at any depth, under names that no schema lists: they are found by a scan of each payload's text.


def all_attrs(payloads: DataFrame) -> DataFrame:
    """(payload_id, signal, path, value) of every key with a value anywhere in a payload: of resources, scopes, records and inside objects.

    A text whose brackets do not close has none. Half surrogate pairs, which no UTF-8 holds, come out as question marks. A text without
    escapes whose every "key" is one of an attribute of a single scalar is read in the JVM, all others are scanned.
    """

    @F.arrow_udf("array<struct<path:string,value:string>>")
    def found(texts: pa.Array) -> pa.Array:
        listed = [[{"path": k, "value": v} for k, v in spans.pairs(t)] if t else [] for t in texts.to_pylist()]
        return pa.array(listed, pa.list_(pa.struct([("path", pa.string()), ("value", pa.string())])))

    one = r'\{"key":"([^"]*)","value":\{"(?:stringValue|intValue|doubleValue|boolValue)":("[^"]*"|[^"{}\[\],:\s]+)\}\}'
    part = lambda n: F.regexp_extract_all("json", F.lit(one), F.lit(n))
    bare = lambda v: F.when(v.startswith('"'), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)
    keys = (F.length("json") - F.length(F.replace("json", F.lit('"key"'), F.lit("")))) / len('"key"')
    p = payloads.select("payload_id", "signal", "json", F.coalesce((F.instr("json", "\\") == 0) & alone(col("json")), F.lit(False)).alias("_may"))
    p = p.withColumns({"_paths": F.when(col("_may"), part(1)), "_values": F.when(col("_may"), part(2))})
    p = p.withColumn("_simple", F.coalesce(F.size("_paths") == keys, F.lit(False)))
    p = p.withColumn("_found", found(F.when(~col("_simple"), col("json"))))
    told = F.zip_with("_paths", "_values", lambda k, v: F.struct(k.alias("path"), bare(v).alias("value")))
    return p.select("payload_id", "signal", F.explode(F.when(col("_simple"), told).otherwise(col("_found"))).alias("x")).select("payload_id", "signal", "x.path", "x.value")


def alone(json: Column) -> Column:
    """Whether nothing follows the value of a JSON text: readers stop at its end, but not inside a list."""
    return F.try_parse_json(F.concat(F.lit("["), json, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"text":'), json, F.lit("}"))).isNotNull()


# --- redaction and quarantine ----------------------------------------------------------------


def told(payloads: DataFrame, signal: Column, denied: list[str], content: list[str], *, digests: bool = True) -> DataFrame:
    """``payloads`` with ``_told``: the redacted ``json``, ``gate_leaks``, a ``digest`` of its canonical form and the ``fault`` of texts without.

    A text is parsed once for all of this. Those that ``plain`` is not certain of are scanned for what to cut, and have no digest: then
    the JVM is to be asked for the canonical form, and ``fault`` says what is wrong should there be none.
    """
    small_batches(payloads.sparkSession)
    keys, gate = frozenset(denied), frozenset(content) - frozenset(denied)

    @F.arrow_udf("struct<json:string,gate_leaks:bigint,digest:string,fault:string,ask:boolean>")
    def read(texts: pa.Array, signals: pa.Array) -> pa.Array:
        reader, out = plain.Reader(keys, gate), ([], [], [], [], [])
        for text, signal in zip(texts.to_pylist(), signals.to_pylist(), strict=True):
            cut, digest, ask = (None, 0), None, False
            if text is not None:
                sure = tree = None
                named = reader.named(text, signal)
                if "\\" not in text:
                    try:
                        tree = reader.tree(text)
                        sure = reader.cut(text, tree, signal) if named else (text, 0)
                    except ValueError:
                        ask = not named  # the JVM's reader stops where the first value ends
                        sure = (text if ask else None, 0)
                    except RecursionError:
                        pass
                cut = sure or spans.without(text, keys, gate if signal == "logs" else frozenset())
                if digests and sure and tree is not None:
                    digest = reader.digest(cut[0], tree)
            told = (*cut, digest, spans.fault(text) if digests and text is not None and digest is None else None, ask)
            for column, x in zip(out, told, strict=True):
                column.append(x)
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_())
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["json", "gate_leaks", "digest", "fault", "ask"])

    return payloads.withColumn("_told", read(col("json"), signal))


def cleaned() -> Column:
    """The redacted text that was told. Where only the JVM's reader might take it, since it stops at the end of the first value, it is asked."""
    return F.when(~col("_told.ask") | F.try_parse_json("_told.json").isNotNull(), col("_told.json"))


def redact(payloads: DataFrame, signal: str, denied: list[str], content: list[str]) -> DataFrame:
    """``payloads`` with redacted ``json`` and ``gate_leaks``, the content values that had to go.

    Denied attributes are cut out of the text, the rest stays byte for byte. A text that is no JSON becomes NULL, since nothing
    tells what it holds. Only texts that name such a key, or might in escapes, or have no canonical form are changed.
    """
    said = told(payloads, F.lit(signal), denied, content, digests=False)
    return said.withColumns({"json": cleaned(), "gate_leaks": col("_told.gate_leaks")}).drop("_told")


def quarantined(payloads: DataFrame, text: str = "json") -> DataFrame:
    """``payloads`` with ``reason``: why a text may not be ingested, NULL where it may.

    Without a canonical form nothing tells whether a payload came before: it is no JSON, or repeats a key, or is beyond what a VARIANT holds.
    """

    @F.arrow_udf("string")
    def why(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else spans.fault(t) for t in texts.to_pylist()], pa.string())

    odd = F.try_parse_json(text).isNull()
    reason = F.when(col(text).isNull(), F.lit("no text")).when(odd, why(F.when(odd, col(text))))
    return payloads.withColumn("reason", reason)


def redaction_leaks(paths: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Denied keys that are still there, by how many payloads carry them."""
    denied = F.broadcast(catalogue.where("status = 'denied'").select("path").distinct())
    fill = paths.join(denied, "path", "left_semi").groupBy("path").agg(F.count_distinct("payload_id").alias("payloads"))  # other keys are dropped before any is shuffled
    return fill.orderBy(col("payloads").desc(), "path")
