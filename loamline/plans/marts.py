"""Queries of staging, dimensions, facts, bridges and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamline.operators import identity, marts
from loamline.plans.base import AS_OF, frames, sql

E, M, U = "events", "metrics", "utilization"

#: Derived aliases in SQL, for the oracles that need them.
ALIAS = """SELECT personal_email, corporate_email, shared_sessions FROM (
    SELECT p.user_email AS personal_email, c.user_email AS corporate_email, count(DISTINCT p.session_id) AS shared_sessions, count(*) OVER (PARTITION BY p.user_email) AS n
    FROM se p JOIN se c ON p.session_id = c.session_id WHERE p.user_email NOT LIKE '%@corp.example' AND c.user_email LIKE '%@corp.example' GROUP BY 1, 2) WHERE n = 1 AND shared_sessions >= 2"""
SEEN = "SELECT DISTINCT session_id, user_email FROM (SELECT session_id, user_email FROM e UNION ALL SELECT session_id, user_email FROM m) WHERE user_email IS NOT NULL"
SIG = """SELECT session_id, user_email, cc_version, terminal_type, os_type, service_name, user_account_id, organization_id, ts AS t FROM m
    UNION ALL SELECT session_id, user_email, cc_version, terminal_type, os_type, service_name, user_account_id, organization_id, event_time FROM e"""
LAST = "max(struct_pack(t := {t}, v := {c})) FILTER ({c} IS NOT NULL)"


def last(c: str, t: str = "t") -> str:
    """The value of the latest time, the largest of ties, in DuckDB."""
    return f"(max(struct_pack(t := {t}, v := {c})) FILTER (WHERE {c} IS NOT NULL)).v"


SEGMENTS = """SELECT user_email, window_type, window_end, ts, util_pct, CAST(1 + sum(CASE WHEN prev IS NOT NULL AND util_pct < 0.8 * prev AND prev - util_pct >= 5 THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_email, window_type, window_end ORDER BY ts) AS BIGINT) AS segment_no
    FROM (SELECT *, lag(util_pct) OVER (PARTITION BY user_email, window_type, window_end ORDER BY ts, util_pct) AS prev FROM (
        SELECT x.user_email, x.usage_window AS window_type, x.ts, x.value AS util_pct, make_timestamp(((epoch_us(x.ts) + CAST(y.value * 1000000 AS BIGINT)) // 300000000) * 300000000) AS window_end
        FROM u x JOIN u y ON x.user_email IS NOT DISTINCT FROM y.user_email AND x.usage_window IS NOT DISTINCT FROM y.usage_window AND x.ts = y.ts
        WHERE x.metric_name = 'usage.utilization' AND y.metric_name = 'usage.reset_in_seconds' AND y.value BETWEEN 0 AND 604800))"""
WINDOWS = """SELECT *, max(segment_no) OVER (PARTITION BY user_email, window_type, window_end) > 1 AS is_reset_split FROM (
    SELECT user_email, window_type, window_end, segment_no, arg_max(util_pct, struct_pack(t := ts, v := util_pct)) AS end_pct, max(util_pct) AS peak_pct,
        arg_min(ts, struct_pack(p := -util_pct, t := ts)) AS peak_ts, min(ts) AS first_sample_ts, max(ts) AS last_sample_ts, count(*) AS sample_count FROM seg GROUP BY ALL)"""
HOURLY = "SELECT coalesce(user_email, '(unknown)') AS user_email, window_type, date_trunc('hour', ts) AS hour, avg(util_pct) AS avg_pct, max(util_pct) AS max_pct FROM seg GROUP BY ALL"
DAILY = """SELECT coalesce(a.session_id, b.session_id) AS session_id, coalesce(CASE WHEN a.em LIKE '%@corp.example' THEN a.em WHEN b.em LIKE '%@corp.example' THEN b.em ELSE coalesce(a.em, b.em) END, '(unknown)') AS user_email,
        coalesce(a.activity_date, b.activity_date) AS activity_date, coalesce(prompts, 0) AS prompts, coalesce(commits, 0) AS commits, coalesce(prs, 0) AS prs, coalesce(loc_added, 0) AS loc_added,
        coalesce(loc_removed, 0) AS loc_removed, coalesce(au, 0) AS active_user_s, coalesce(ac, 0) AS active_cli_s
    FROM (SELECT session_id, activity_date, arg_min(user_email, struct_pack(c := CASE WHEN user_email LIKE '%@corp.example' THEN 0 ELSE 1 END, e := user_email)) AS em,
            sum(value) FILTER (metric_name = 'commit.count') AS commits, sum(value) FILTER (metric_name = 'pull_request.count') AS prs,
            sum(value) FILTER (metric_name = 'lines_of_code.count' AND type_label = 'added') AS loc_added, sum(value) FILTER (metric_name = 'lines_of_code.count' AND type_label = 'removed') AS loc_removed,
            sum(value) FILTER (metric_name = 'active_time.total' AND time_label = 'user') AS au, sum(value) FILTER (metric_name = 'active_time.total' AND time_label = 'cli') AS ac
        FROM m WHERE value_kind = 'sum_delta' AND session_id IS NOT NULL GROUP BY ALL) a
    FULL JOIN (SELECT session_id, activity_date, arg_min(user_email, struct_pack(c := CASE WHEN user_email LIKE '%@corp.example' THEN 0 ELSE 1 END, e := user_email)) AS em, count(DISTINCT prompt_id) AS prompts
        FROM e WHERE prompt_id IS NOT NULL AND session_id IS NOT NULL GROUP BY ALL) b ON a.session_id = b.session_id AND a.activity_date = b.activity_date"""


def rounded(df, *names, digits=4):
    """Doubles rounded, so that the order of summation does not show."""
    return df.withColumns({n: F.round(n, digits) for n in names})


@frames(E, M)
def fact_session_daily(e, m):
    return rounded(marts.fact_session_daily(e, m), "commits", "prs", "loc_added", "loc_removed", "active_user_s", "active_cli_s", "active_total_s")


def _daily_rounded(source: str) -> str:
    r = ", ".join(f"round({c}, 4) AS {c}" for c in ("commits", "prs", "loc_added", "loc_removed", "active_user_s", "active_cli_s"))
    return f"SELECT session_id, user_email, activity_date, prompts, {r}, round(active_user_s + active_cli_s, 4) AS active_total_s FROM {source}"


@frames(E, M, "manual_alias")
def dim_user(e, m, manual):
    return marts.dim_user(e, m, manual, identity.derived_alias(e, m))


DIM_USER = f"""SELECT i.*, CASE WHEN a.personal_email IS NOT NULL THEN coalesce(a.corporate_email, i.user_email) ELSE coalesce(d.corporate_email, i.user_email) END AS scope_email
    FROM (SELECT coalesce(user_email, '(unknown)') AS user_email, user_email IS NULL AS is_unknown, min(t) AS first_seen, CAST(min(t) AS DATE) AS first_seen_date, max(t) AS last_seen,
        CAST(max(t) AS DATE) AS last_seen_date, min(user_account_id) AS user_account_id, min(organization_id) AS organization_id, {last('cc_version')} AS last_cc_version FROM sig GROUP BY 1, 2) i
    LEFT JOIN a ON a.personal_email = i.user_email LEFT JOIN al d ON d.personal_email = i.user_email"""
MODELS = """SELECT model AS model_id, CASE WHEN model ILIKE '%large%' THEN 'large' WHEN model ILIKE '%medium%' THEN 'medium' WHEN model ILIKE '%small%' THEN 'small' ELSE 'other' END AS family,
    regexp_replace(regexp_replace(model, '\\[1m\\]$', ''), '^acme-(large|medium|small)-', '', 'i') AS version, contains(model, '[1m]') AS is_long_context
    FROM (SELECT model FROM e UNION SELECT model FROM m) WHERE model IS NOT NULL"""
API = """SELECT session_id, activity_date, model, effort, query_source, coalesce(min(user_email), '(unknown)') AS user_email, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
    CAST(sum(cache_creation_tokens) AS BIGINT) AS cache_creation_tokens, CAST(sum(cache_read_tokens) AS BIGINT) AS cache_read_tokens, round(sum(cost_usd), 6) AS cost_usd, count(*) AS request_count, max(event_time) AS last_event_ts
    FROM e WHERE event_name = 'api_request' AND session_id IS NOT NULL GROUP BY session_id, activity_date, model, effort, query_source"""
DATES = f"""SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, CAST(weekofyear(d) AS INT) AS iso_week, CAST(isodow(d) AS INT) AS iso_day,
    CAST(date_trunc('week', d) AS DATE) AS week_start, strftime(date_trunc('week', d), '%Y-%m-%d') AS week_label, CAST(date_trunc('month', d) AS DATE) AS month_start, strftime(d, '%Y-%m') AS month_label, isodow(d) >= 6 AS is_weekend
    FROM (SELECT unnest(generate_series(least((SELECT min(activity_date) FROM e), (SELECT min(activity_date) FROM m), (SELECT min(activity_date) FROM e WHERE event_name = 'api_request')), DATE '{AS_OF}', INTERVAL 1 DAY)) AS d)"""

AGENTS = """SELECT session_id, agent AS agent_name, count(*) FILTER (event_name = 'api_request') AS invocations, count(*) FILTER (event_name = 'subagent_completed') AS completions,
    count(*) FILTER (event_name = 'subagent_completed' AND subagent_is_async) AS async_completions, CAST(coalesce(sum(subagent_tool_uses) FILTER (event_name = 'subagent_completed'), 0) AS BIGINT) AS tool_uses,
    CAST(coalesce(sum(subagent_total_tokens) FILTER (event_name = 'subagent_completed'), 0) AS BIGINT) AS total_tokens
    FROM (SELECT *, agent_name AS agent FROM e WHERE event_name = 'api_request' UNION ALL SELECT *, agent_type FROM e WHERE event_name = 'subagent_completed') WHERE agent IS NOT NULL GROUP BY 1, 2"""
HOOKS = """SELECT session_id, hook_name, coalesce(hook_event, 'unknown') AS hook_event, count(*) AS executions, CAST(sum(total_duration_ms) AS BIGINT) AS total_duration_ms, CAST(sum(num_hooks) AS BIGINT) AS num_hooks,
    CAST(sum(num_success) AS BIGINT) AS num_success FROM e WHERE event_name = 'hook_execution' AND hook_name IS NOT NULL GROUP BY 1, 2, 3"""
SERVERS = f"""SELECT coalesce(a.session_id, b.session_id) AS session_id, coalesce(a.server_name, b.server_name) AS server_name, coalesce(connections, 0) AS connections, coalesce(failures, 0) AS failures, transport, server_scope, coalesce(calls, 0) AS calls
    FROM (SELECT session_id, server_name, count(*) AS connections, count(*) FILTER (server_status = 'failed') AS failures, {last("transport", "event_time")} AS transport, {last("server_scope", "event_time")} AS server_scope
        FROM e WHERE event_name = 'server_connection' AND server_name IS NOT NULL GROUP BY 1, 2) a
    FULL JOIN (SELECT session_id, s.server_name, count(*) AS calls FROM e JOIN (SELECT DISTINCT server_name, replace(replace(replace(server_name, ' ', '_'), '.', '_'), ':', '_') AS slug FROM e WHERE event_name = 'server_connection' AND server_name IS NOT NULL) s
        ON e.server_slug = s.slug WHERE event_name = 'api_request' GROUP BY 1, 2) b ON a.session_id = b.session_id AND a.server_name = b.server_name"""
PLUGINS = """SELECT session_id, plugin_name, coalesce(plugin_scope, 'unknown') AS plugin_scope, coalesce(plugin_version, 'unknown') AS plugin_version, coalesce(marketplace_name, 'unknown') AS marketplace_name, count(*) AS loads
    FROM e WHERE event_name = 'plugin_loaded' AND plugin_name IS NOT NULL GROUP BY 1, 2, 3, 4, 5"""
SKILLS = f"""SELECT session_id, skill_name, count(*) AS activations, {last("own_source", "event_time")} AS skill_source, {last("own_trigger", "event_time")} AS skill_trigger
    FROM (SELECT *, CASE WHEN event_name = 'skill_activated' THEN skill_source END AS own_source, CASE WHEN event_name = 'skill_activated' THEN skill_trigger END AS own_trigger FROM e WHERE event_name IN ('skill_activated', 'api_request'))
    WHERE skill_name IS NOT NULL GROUP BY 1, 2"""

QUERIES = {
    "f1_counter_delta": (
        frames(M)(lambda m: marts.counter_delta(m).groupBy("metric_name").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))),
        sql(M, "SELECT metric_name, count(*) AS n, round(sum(value), 4) AS total FROM m WHERE value_kind = 'sum_delta' GROUP BY 1"),
    ),
    "f2_api_request": (
        frames(E)(lambda e: marts.api_requests(e).select("event_id", "session_id", "model", "input_tokens", "cost_usd")),
        sql(E, "SELECT event_id, session_id, model, input_tokens, cost_usd FROM e WHERE event_name = 'api_request'"),
    ),
    "f3_telemetry_day": (
        frames(E, M)(marts.telemetry_days),
        sql("events metrics", "SELECT user_email, activity_date FROM e WHERE user_email IS NOT NULL UNION SELECT user_email, activity_date FROM m WHERE user_email IS NOT NULL"),
    ),
    "d1_dim_user": (dim_user, sql("events metrics manual_alias", DIM_USER, sig=SIG, se=SEEN, al=ALIAS)),
    "d2_dim_model": (frames(E, M)(marts.dim_model), sql("events metrics", MODELS)),
    "d3_d4_dim_date": (
        frames(E, M)(lambda e, m: marts.dim_date([e.agg(F.min("activity_date")), m.agg(F.min("activity_date")), marts.api_requests(e).agg(F.min("activity_date"))], AS_OF)),
        sql("events metrics", DATES),
    ),
    "a1_fact_session": (
        frames(E, M)(marts.fact_session),
        sql(
            "events metrics",
            f"""SELECT s.*, st.start_type FROM (SELECT session_id, coalesce((min(struct_pack(t := t, v := user_email)) FILTER (WHERE user_email IS NOT NULL)).v, '(unknown)') AS user_email, min(t) AS started_at,
            {last('cc_version')} AS cc_version, {last('terminal_type')} AS terminal_type, {last('os_type')} AS os_type, {last('service_name')} AS service_name,
            CAST(round((epoch_us(max(t)) - epoch_us(min(t))) / 1e6) AS BIGINT) AS duration_s FROM sig WHERE session_id IS NOT NULL GROUP BY 1) s
            LEFT JOIN (SELECT session_id, {last('start_type', 'ts')} AS start_type FROM m WHERE metric_name = 'session.count' GROUP BY 1) st ON s.session_id = st.session_id""",
            sig=SIG,
        ),
    ),
    "a2_fact_session_daily": (fact_session_daily, sql("events metrics", _daily_rounded("d"), d=DAILY)),
    "a3_fact_api_usage": (frames(E)(lambda e: rounded(marts.fact_api_usage(e), "cost_usd", digits=6)), sql(E, API)),
    "a4_fact_edit_decision": (
        frames(M)(lambda m: rounded(marts.fact_edit_decision(m), "decisions")),
        sql(
            M,
            """SELECT session_id, activity_date, tool_name, language, decision, decision_source, coalesce(min(user_email), '(unknown)') AS user_email, round(sum(value), 4) AS decisions
            FROM m WHERE metric_name = 'code_edit_tool.decision' AND value_kind = 'sum_delta' GROUP BY 1, 2, 3, 4, 5, 6""",
        ),
    ),
    "a5_fact_tool_outcome": (
        frames(E)(marts.fact_tool_outcome),
        sql(
            E,
            """SELECT session_id, activity_date, tool_name, coalesce(decision_source, 'unknown') AS decision_source, coalesce(error_type, 'none') AS error_type, count(*) AS calls, count(*) FILTER (success_bool) AS successes,
            CAST(round_even(round(quantile_cont(CAST(duration_ms AS DOUBLE), 0.5) * 20) / 20, 0) AS BIGINT) AS p50_ms, CAST(round_even(round(quantile_cont(CAST(duration_ms AS DOUBLE), 0.95) * 20) / 20, 0) AS BIGINT) AS p95_ms
            FROM e WHERE event_name = 'tool_result' GROUP BY 1, 2, 3, 4, 5""",
        ),
    ),
    "a6_fact_api_error_rate": (
        frames(E)(marts.fact_api_error_rate),
        sql(
            E,
            """SELECT activity_date, count(*) FILTER (event_name = 'api_request') AS requests, count(*) FILTER (event_name = 'api_error') AS errors,
            CAST(round(CAST(100.0 * count(*) FILTER (event_name = 'api_error') / count(*) AS DECIMAL(20, 8)), 2) AS DOUBLE) AS error_rate_pct FROM e WHERE event_name IN ('api_request', 'api_error') GROUP BY 1""",
        ),
    ),
    "w1_w2_utilization_segments": (frames(U)(marts.utilization_segments), sql(U, "SELECT * FROM seg", seg=SEGMENTS)),
    "a7_fact_usage_window": (
        frames(U)(lambda u: rounded(marts.fact_usage_window(marts.utilization_segments(u)), "pace_pct_per_hour")),
        sql(
            U,
            """SELECT coalesce(user_email, '(unknown)') AS user_email, window_type, window_end, segment_no, end_pct, peak_pct, peak_ts, first_sample_ts, last_sample_ts, sample_count,
            window_end - CASE window_type WHEN '5h' THEN INTERVAL 5 HOUR WHEN '7d' THEN INTERVAL 168 HOUR ELSE INTERVAL 0 HOUR END AS window_start, is_reset_split,
            round(peak_pct / nullif((epoch_us(peak_ts) - epoch_us(first_sample_ts)) / 3.6e9, 0), 4) AS pace_pct_per_hour FROM w""",
            seg=SEGMENTS, w=WINDOWS,
        ),
    ),
    "a8_utilization_hourly": (
        frames(U)(lambda u: rounded(marts.utilization_hourly(marts.utilization_segments(u)), "avg_pct")),
        sql(U, "SELECT user_email, window_type, hour, round(avg_pct, 4) AS avg_pct, max_pct FROM h", seg=SEGMENTS, h=HOURLY),
    ),
    "a9_hour_profile": (
        frames(U)(lambda u: rounded(marts.hour_profile(marts.utilization_hourly(marts.utilization_segments(u))), "avg_pct")),
        sql(U, "SELECT CAST(hour(hour) AS INT) AS hour_of_day, window_type, round(avg(avg_pct), 4) AS avg_pct FROM h GROUP BY 1, 2", seg=SEGMENTS, h=HOURLY),
    ),
    "b1_bridge_agent": (frames(E)(marts.bridge_agent), sql(E, AGENTS)),
    "b2_bridge_hook": (frames(E)(marts.bridge_hook), sql(E, HOOKS)),
    "b3_bridge_server": (frames(E)(marts.bridge_server), sql(E, SERVERS)),
    "b4_bridge_plugin": (frames(E)(marts.bridge_plugin), sql(E, PLUGINS)),
    "b5_bridge_skill": (frames(E)(marts.bridge_skill), sql(E, SKILLS)),
}
