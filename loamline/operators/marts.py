"""Staging filters, dimensions, facts and bridges of the star schema."""

from __future__ import annotations

import datetime
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from loamline.functions import columns as C

col = F.col


# --- staging ---------------------------------------------------------------------------------


def counter_delta(metrics: DataFrame) -> DataFrame:
    """Additive sum points only: cumulative ones would count twice."""
    return metrics.where(col("value_kind") == "sum_delta")


def api_requests(events: DataFrame) -> DataFrame:
    return events.where(col("event_name") == "api_request")


def telemetry_days(events: DataFrame, metrics: DataFrame) -> DataFrame:
    """Distinct (user_email, activity_date) of both signals, without unknown addresses."""
    both = events.select("user_email", "activity_date").union(metrics.select("user_email", "activity_date"))
    return both.where(col("user_email").isNotNull()).distinct()


def signals(events: DataFrame, metrics: DataFrame, *more: str) -> DataFrame:
    """Rows of both signals under one time column ``t``."""
    shared = ["session_id", "user_email", "cc_version", "terminal_type", "os_type", "service_name", "user_account_id", "organization_id", *more]
    return metrics.select(*shared, col("ts").alias("t")).unionByName(events.select(*shared, col("event_time").alias("t")))


# --- dimensions ------------------------------------------------------------------------------


def dim_user(events: DataFrame, metrics: DataFrame, manual: DataFrame, derived: DataFrame) -> DataFrame:
    """One row per address with the address that access is scoped by.

    A manual alias outranks a derived one; a manual row without an address keeps the person's own.
    """
    seen = signals(events, metrics)
    one = seen.groupBy(C.email_bucket(col("user_email")).alias("user_email"), col("user_email").isNull().alias("is_unknown")).agg(
        F.min("t").alias("first_seen"), F.min("t").cast("date").alias("first_seen_date"), F.max("t").alias("last_seen"), F.max("t").cast("date").alias("last_seen_date"),
        F.min("user_account_id").alias("user_account_id"), F.min("organization_id").alias("organization_id"), C.latest(col("cc_version"), col("t")).alias("last_cc_version"),
    )
    m = manual.select(col("personal_email").alias("user_email"), col("corporate_email").alias("m_to"), F.lit(True).alias("is_manual"))
    d = derived.select(col("personal_email").alias("user_email"), col("corporate_email").alias("d_to"))
    scoped = F.when(col("is_manual"), F.coalesce("m_to", "user_email")).otherwise(F.coalesce("d_to", "user_email"))
    return one.join(m, "user_email", "left").join(d, "user_email", "left").withColumn("scope_email", scoped).drop("m_to", "d_to", "is_manual")


def dim_model(events: DataFrame, metrics: DataFrame) -> DataFrame:
    ids = events.select("model").union(metrics.select("model")).where(col("model").isNotNull()).distinct()
    m = col("model")
    return ids.select(m.alias("model_id"), C.model_family(m).alias("family"), C.model_version(m).alias("version"), C.is_long_context(m).alias("is_long_context"))


def dim_date(starts: list[DataFrame], as_of: datetime.date) -> DataFrame:
    """A dense calendar from the earliest date of one-column frames to ``as_of``."""
    first = starts[0].toDF("d")
    for s in starts[1:]:
        first = first.union(s.toDF("d"))
    days = first.agg(F.min("d").alias("d")).select(F.explode(F.sequence("d", F.lit(as_of))).alias("date"))
    return days.select(
        "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"), F.weekofyear("date").alias("iso_week"), (F.weekday("date") + 1).alias("iso_day"),
        F.date_trunc("week", "date").cast("date").alias("week_start"), F.date_format(F.date_trunc("week", "date"), "yyyy-MM-dd").alias("week_label"),
        F.trunc("date", "month").alias("month_start"), F.date_format("date", "yyyy-MM").alias("month_label"), (F.weekday("date") >= 5).alias("is_weekend"),
    )


# --- facts -----------------------------------------------------------------------------------


def fact_session(events: DataFrame, metrics: DataFrame) -> DataFrame:
    sig = signals(events, metrics).where(col("session_id").isNotNull())
    one = sig.groupBy("session_id").agg(
        C.email_bucket(C.earliest(col("user_email"), col("t"))).alias("user_email"), F.min("t").alias("started_at"),
        *[C.latest(col(c), col("t")).alias(c) for c in ("cc_version", "terminal_type", "os_type", "service_name")],
        F.round((F.unix_micros(F.max("t")) - F.unix_micros(F.min("t"))) / 1e6).cast("bigint").alias("duration_s"),
    )
    starts = metrics.where((col("metric_name") == "session.count") & col("session_id").isNotNull()).groupBy("session_id").agg(C.latest(col("start_type"), col("ts")).alias("start_type"))
    return one.join(starts, "session_id", "left")


def fact_session_daily(events: DataFrame, metrics: DataFrame) -> DataFrame:
    """Per session and day: counters of one signal, prompts of the other, met by a full outer join."""
    total = lambda cond: F.sum(F.when(cond, col("value")))
    name, kind, time = col("metric_name"), col("type_label"), col("time_label")
    m = counter_delta(metrics).where(col("session_id").isNotNull()).groupBy("session_id", "activity_date").agg(
        C.preferred(col("user_email")).alias("m_email"), total(name == "commit.count").alias("commits"), total(name == "pull_request.count").alias("prs"),
        total((name == "lines_of_code.count") & (kind == "added")).alias("loc_added"), total((name == "lines_of_code.count") & (kind == "removed")).alias("loc_removed"),
        total((name == "active_time.total") & (time == "user")).alias("active_user_s"), total((name == "active_time.total") & (time == "cli")).alias("active_cli_s"),
    )
    p = events.where(col("session_id").isNotNull() & col("prompt_id").isNotNull()).groupBy("session_id", "activity_date").agg(
        C.preferred(col("user_email")).alias("p_email"), F.count_distinct("prompt_id").alias("prompts")
    )
    numbers = ["commits", "prs", "loc_added", "loc_removed", "active_user_s", "active_cli_s"]
    return m.join(p, ["session_id", "activity_date"], "full").select(
        "session_id", C.email_bucket(C.prefer_corporate(col("m_email"), col("p_email"))).alias("user_email"), "activity_date", F.coalesce("prompts", F.lit(0)).alias("prompts"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in numbers], (F.coalesce("active_user_s", F.lit(0.0)) + F.coalesce("active_cli_s", F.lit(0.0))).alias("active_total_s"),
    )


def fact_api_usage(events: DataFrame) -> DataFrame:
    """NULL models, efforts and sources form groups of their own."""
    sums = ["input_tokens", "output_tokens", "cache_creation_tokens", "cache_read_tokens", "cost_usd"]
    return api_requests(events).where(col("session_id").isNotNull()).groupBy("session_id", "activity_date", "model", "effort", "query_source").agg(
        C.email_bucket(F.min("user_email")).alias("user_email"), *[F.sum(c).alias(c) for c in sums], F.count("*").alias("request_count"), F.max("event_time").alias("last_event_ts")
    )


def fact_edit_decision(metrics: DataFrame) -> DataFrame:
    rows = counter_delta(metrics).where((col("metric_name") == "code_edit_tool.decision") & col("session_id").isNotNull())
    keys = ["session_id", "activity_date", "tool_name", "language", "decision", "decision_source"]
    return rows.groupBy(*keys).agg(C.email_bucket(F.min("user_email")).alias("user_email"), F.sum("value").alias("decisions"))


def fact_tool_outcome(events: DataFrame) -> DataFrame:
    """Calls, successes and exact percentiles, rounded half to even.

    Between whole numbers both percentiles are whole twentieths, so rounding to those first takes the interpolation's error away before halves are told.
    """
    rows = events.where((col("event_name") == "tool_result") & col("session_id").isNotNull())
    rows = rows.withColumns({"decision_source": F.coalesce("decision_source", F.lit("unknown")), "error_type": F.coalesce("error_type", F.lit("none"))})
    p = lambda q: F.rint(F.rint(F.percentile(col("duration_ms").cast("double"), F.lit(q)) * 20) / 20).cast("bigint")
    return rows.groupBy("session_id", "activity_date", "tool_name", "decision_source", "error_type").agg(
        F.count("*").alias("calls"), F.count_if("success_bool").alias("successes"), p(0.5).alias("p50_ms"), p(0.95).alias("p95_ms")
    )


def fact_api_error_rate(events: DataFrame) -> DataFrame:
    rows = events.where(col("event_name").isin("api_request", "api_error"))
    bad = F.count_if(col("event_name") == "api_error")
    rate = F.round(F.lit(100).cast("decimal(20,6)") * bad.cast("decimal(20,0)") / F.nullif(F.count("*"), F.lit(0)).cast("decimal(20,0)"), 2)
    return rows.groupBy("activity_date").agg(F.count_if(col("event_name") == "api_request").alias("requests"), bad.alias("errors"), rate.cast("double").alias("error_rate_pct"))


def utilization_segments(utilization: DataFrame) -> DataFrame:
    """Samples with their window's end (to 5 minutes) and the segment between resets.

    A reset is a fall below four fifths of the sample before, by 5 points at least.
    """
    u = utilization.where((col("metric_name") == "usage.utilization") & (col("value_kind") == "gauge_last")).alias("u")
    r = utilization.where((col("metric_name") == "usage.reset_in_seconds") & col("value").between(0, 604800)).alias("r")
    same = col("u.user_email").eqNullSafe(col("r.user_email")) & col("u.usage_window").eqNullSafe(col("r.usage_window")) & (col("u.ts") == col("r.ts"))
    end = F.unix_micros("u.ts") + (col("r.value") * 1e6).cast("bigint")
    five = 300_000_000
    samples = u.join(r, same).select(
        "u.user_email", col("u.usage_window").alias("window_type"), "u.ts", col("u.value").alias("util_pct"), F.timestamp_micros(F.floor(end / five).cast("bigint") * five).alias("window_end")
    )
    of = Window.partitionBy("user_email", "window_type", "window_end").orderBy("ts", "util_pct")
    before = F.lag("util_pct").over(of)
    reset = (col("util_pct") < 0.8 * before) & (before - col("util_pct") >= 5)
    flagged = samples.withColumn("_reset", F.when(reset, 1).otherwise(0))
    # equal times share a segment: the default RANGE frame of the running sum by time
    return flagged.withColumn("segment_no", 1 + F.sum("_reset").over(Window.partitionBy("user_email", "window_type", "window_end").orderBy("ts"))).drop("_reset")


def fact_usage_window(segments: DataFrame) -> DataFrame:
    keys = ["user_email", "window_type", "window_end", "segment_no"]
    seg = segments.groupBy(*keys).agg(
        F.min("ts").alias("first_sample_ts"), F.max("ts").alias("last_sample_ts"), F.count("*").alias("sample_count"), C.latest(col("util_pct"), col("ts")).alias("end_pct"),
        F.max("util_pct").alias("peak_pct"), F.min(F.struct(-col("util_pct"), "ts"))["ts"].alias("peak_ts"),
    )
    # only the two plain windows have a known length
    length = F.when(col("window_type") == "5h", F.expr("INTERVAL '5' HOUR")).when(col("window_type") == "7d", F.expr("INTERVAL '168' HOUR")).otherwise(F.expr("INTERVAL '0' HOUR"))
    hours = (F.unix_micros("peak_ts") - F.unix_micros("first_sample_ts")) / 3.6e9
    return seg.select(
        C.email_bucket(col("user_email")).alias("user_email"), *keys[1:], "end_pct", "peak_pct", "peak_ts", "first_sample_ts", "last_sample_ts", "sample_count",
        (col("window_end") - length).alias("window_start"), (F.max("segment_no").over(Window.partitionBy(*keys[:3])) > 1).alias("is_reset_split"),
        F.try_divide(col("peak_pct"), F.nullif(hours, F.lit(0.0))).alias("pace_pct_per_hour"),
    )


def utilization_hourly(segments: DataFrame) -> DataFrame:
    return segments.groupBy(C.email_bucket(col("user_email")).alias("user_email"), "window_type", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.avg("util_pct").alias("avg_pct"), F.max("util_pct").alias("max_pct")
    )


def hour_profile(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(F.hour("hour").alias("hour_of_day"), "window_type").agg(F.avg("avg_pct").alias("avg_pct"))


# --- bridges ---------------------------------------------------------------------------------


def bridge_agent(events: DataFrame) -> DataFrame:
    """Invocations know an agent by its name, completions by its type; both meet under one name."""
    done = col("event_name") == "subagent_completed"
    rows = events.where(col("session_id").isNotNull() & col("event_name").isin("api_request", "subagent_completed"))
    rows = rows.withColumn("agent_name", F.when(done, col("agent_type")).otherwise(col("agent_name"))).where(col("agent_name").isNotNull())
    return rows.groupBy("session_id", "agent_name").agg(
        F.count_if(~done).alias("invocations"), F.count_if(done).alias("completions"), F.count_if(done & col("subagent_is_async")).alias("async_completions"),
        F.coalesce(F.sum(F.when(done, col("subagent_tool_uses"))), F.lit(0)).alias("tool_uses"), F.coalesce(F.sum(F.when(done, col("subagent_total_tokens"))), F.lit(0)).alias("total_tokens"),
    )


def bridge_hook(events: DataFrame) -> DataFrame:
    rows = events.where((col("event_name") == "hook_execution") & col("session_id").isNotNull() & col("hook_name").isNotNull())
    return rows.groupBy("session_id", "hook_name", F.coalesce("hook_event", F.lit("unknown")).alias("hook_event")).agg(
        F.count("*").alias("executions"), *[F.sum(c).alias(c) for c in ("total_duration_ms", "num_hooks", "num_success")]
    )


def bridge_server(events: DataFrame) -> DataFrame:
    """Connections by server full-joined with requests, which know the server by its slug only.

    A slug is that of any session's server: a session may call a server without a connection of its own. Calls are
    counted by session and slug before they meet the names.
    """
    links = events.where((col("event_name") == "server_connection") & col("server_name").isNotNull())
    conn = links.where(col("session_id").isNotNull()).groupBy("session_id", "server_name").agg(
        F.count("*").alias("connections"), F.count_if(col("server_status") == "failed").alias("failures"), C.latest(col("transport"), col("event_time")).alias("transport"),
        C.latest(col("server_scope"), col("event_time")).alias("server_scope"),
    )
    names = links.select("server_name", C.slug(col("server_name")).alias("server_slug")).distinct()
    calls = events.where((col("event_name") == "api_request") & col("session_id").isNotNull() & col("server_slug").isNotNull())
    calls = calls.groupBy("session_id", "server_slug").agg(F.count("*").alias("calls"))
    used = calls.join(names, "server_slug").select("session_id", "server_name", "calls")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return conn.join(used, ["session_id", "server_name"], "full").select("session_id", "server_name", zero("connections"), zero("failures"), "transport", "server_scope", zero("calls"))


def bridge_plugin(events: DataFrame) -> DataFrame:
    rows = events.where((col("event_name") == "plugin_loaded") & col("session_id").isNotNull() & col("plugin_name").isNotNull())
    known = lambda c: F.coalesce(c, F.lit("unknown")).alias(c)
    return rows.groupBy("session_id", "plugin_name", known("plugin_scope"), known("plugin_version"), known("marketplace_name")).agg(F.count("*").alias("loads"))


def bridge_skill(events: DataFrame) -> DataFrame:
    """Activations of two event kinds; the latest source and trigger come from one of them."""
    rows = events.where(col("event_name").isin("skill_activated", "api_request") & col("session_id").isNotNull() & col("skill_name").isNotNull())
    own = lambda c: C.latest(F.when(col("event_name") == "skill_activated", col(c)), col("event_time")).alias(c)
    return rows.groupBy("session_id", "skill_name").agg(F.count("*").alias("activations"), own("skill_source"), own("skill_trigger"))


# --- refresh ---------------------------------------------------------------------------------


def refresh_all(marts: dict[str, DataFrame], root: str, *, at_once: int = 4) -> DataFrame:
    """Write every mart under ``root`` and return (mart, row_count, started_at, finished_at), one row each.

    Marts do not read one another, so ``at_once`` of them are written at a time; rows are counted as they are written.
    """

    def write(name: str) -> tuple[str, int, datetime.datetime, datetime.datetime]:
        begun, seen = datetime.datetime.now(datetime.UTC), Observation()
        marts[name].observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}")
        return name, seen.get["n"], begun, datetime.datetime.now(datetime.UTC)

    with ThreadPoolExecutor(at_once) as pool:
        log = list(pool.map(write, sorted(marts)))
    spark = next(iter(marts.values())).sparkSession
    return spark.createDataFrame(log, "mart string, row_count long, started_at timestamp, finished_at timestamp")
