"""Telemetry payloads as JSON texts, built from event and metric rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

col = F.col


#: Records that one payload holds at most: a user's busy day makes several payloads.
BATCH = 1000

LISTED = "struct<values:array<struct<stringValue:string>>>"
KEYED = "struct<values:array<struct<key:string,value:struct<stringValue:string>>>>"


def _attr(key: str, kind: str, value: Column) -> Column:
    """An attribute with its tagged value, NULL if there is no value."""
    kinds = {"stringValue": "string", "intValue": "string", "doubleValue": "double", "boolValue": "boolean", "arrayValue": LISTED, "kvlistValue": KEYED}
    tags = [(value.cast(t) if k == kind else F.lit(None).cast(t)).alias(k) for k, t in kinds.items()]
    return F.when(value.isNotNull(), F.struct(F.lit(key).alias("key"), F.struct(*tags).alias("value")))


def _attrs(*a: Column) -> Column:
    return F.array_compact(F.array(*a))


def _resource() -> Column:
    return F.struct(
        _attrs(_attr("user.email", "stringValue", F.concat(F.lit(" "), F.upper("user_email"))), _attr("session.id", "stringValue", col("session_id")), _attr("os.type", "stringValue", F.lit("os")),
               _attr("secret.token", "stringValue", F.lit("bait"))).alias("attributes")
    )


def _scope(name: str) -> Column:
    """A scope with attributes of its own, one of them denied."""
    return F.struct(F.lit(name).alias("name"), _attrs(_attr("scope.tag", "stringValue", F.lit("t")), _attr("secret.token", "stringValue", F.lit("bait"))).alias("attributes"))


def _nanos(t: Column) -> Column:
    return F.concat(F.unix_micros(t).cast("string"), F.lit("123"))


def _payloads(rows: DataFrame, signal: str, scope: str, item: Callable[[Column], Column], of: list[str], items: str, block: str, scoped: str) -> DataFrame:
    """``item`` of each row's columns ``of``, gathered into a payload per user, day and ``BATCH`` consecutive event ids.

    Items are made when rows are together: as trees they take many times the room of what they are made from.
    """
    batch = F.floor(col("event_id") / BATCH).cast("bigint")
    g = rows.groupBy("user_id", "user_email", "session_id", "activity_date", batch.alias("batch")).agg(F.collect_list(F.struct(*of)).alias("rows"))
    one = F.struct(_scope(scope).alias("scope"), F.array_sort(F.transform("rows", item)).alias(items))
    tree = F.struct(F.lit("https://schema.example/1").alias("schemaUrl"), _resource().alias("resource"), F.array(one).alias(scoped))
    body = F.to_json(F.struct(F.array(tree).alias(block)))
    return g.select(F.lit(signal).alias("signal"), col("activity_date").alias("dt"), F.concat_ws("-", F.lit(signal[0]), "user_id", "activity_date", "batch").alias("payload_id"), body.alias("json"))


def metric_payloads(metrics: DataFrame) -> DataFrame:
    """Payloads of data points, (signal, dt, payload_id, json): sums, and of every fifth k a gauge, a histogram or a summary beside it."""

    def metric(x: Column) -> Column:
        attrs = _attrs(_attr("k", "intValue", x["k"]), _attr("tool", "stringValue", x["tool_name"]), _attr("event.id", "intValue", x["event_id"]))
        nanos = _nanos(x["ts"]).alias("timeUnixNano")
        temporality = F.when(x["value_kind"] == "sum_delta", "AGGREGATION_TEMPORALITY_DELTA").otherwise("AGGREGATION_TEMPORALITY_CUMULATIVE").alias("aggregationTemporality")
        number = F.array(F.struct(nanos, x["value"].alias("asDouble"), attrs.alias("attributes"))).alias("dataPoints")
        spread = F.array(F.struct(nanos, x["value"].alias("sum"), x["k"].cast("string").alias("count"), attrs.alias("attributes"))).alias("dataPoints")
        kind = lambda k, s: F.when(k, s)
        five = x["k"] % 5
        return F.struct(
            x["metric_name"].alias("name"), kind(five > 2, F.struct(temporality, number)).alias("sum"), kind(five == 0, F.struct(number)).alias("gauge"), kind(five == 1, F.struct(temporality, spread)).alias("histogram"),
            kind(five == 2, F.struct(spread)).alias("summary"),
        )

    return _payloads(metrics, "metrics", "meter", metric, ["event_id", "ts", "metric_name", "value_kind", "value", "k", "tool_name"], "metrics", "resourceMetrics", "scopeMetrics")


def log_payloads(events: DataFrame) -> DataFrame:
    """Payloads of log records; every seventh record carries content that must not be there, some hold lists and objects."""

    def record(x: Column) -> Column:
        body = F.struct(F.concat(F.lit("app."), x["event_name"]).alias("stringValue"))
        text = F.when(x["k"] % 7 == 0, "said").when(x["k"] % 7 == 1, "")
        listed = F.when(x["k"] % 11 == 0, F.struct(F.array(F.struct(F.lit("x").alias("stringValue"))).alias("values")))
        keyed = F.when(x["k"] % 13 == 0, F.struct(F.array(F.struct(F.lit("inner").alias("key"), F.struct(F.lit("y").alias("stringValue")).alias("value"))).alias("values")))
        attrs = _attrs(
            _attr("k", "intValue", x["k"]), _attr("event.id", "intValue", x["event_id"]), _attr("success", "boolValue", x["success_bool"]), _attr("cost", "doubleValue", x["cost_usd"]), _attr("prompt.text", "stringValue", text),
            _attr("model", "stringValue", x["model"]), _attr("k5", "intValue", x["k"] % 5), _attr("service", "stringValue", x["service_name"]), _attr("list", "arrayValue", listed), _attr("object", "kvlistValue", keyed),
        )
        return F.struct(_nanos(x["event_time"]).alias("timeUnixNano"), F.lit("INFO").alias("severityText"), body.alias("body"), (x["k"] % 2).alias("flags"), attrs.alias("attributes"))

    return _payloads(events, "logs", "logger", record, ["event_id", "event_time", "event_name", "k", "success_bool", "cost_usd", "model", "service_name"], "logRecords", "resourceLogs", "scopeLogs")
