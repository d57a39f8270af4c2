"""Telemetry, roster and hierarchy rows derived from the given tables.

Each text is a query that Spark and DuckDB read alike; ``{ts}`` and the like stand for the few spots where
the two differ. Spark's side is used by ``rows``; the oracles put the same texts into WITH clauses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = {"ts": "CAST(ts AS TIMESTAMP)", "us": "unix_micros(CAST(ts AS TIMESTAMP))", "od": "CAST(o_orderdate AS DATE)", "div": "div"}
DUCKDB = {"ts": "ts", "us": "epoch_us(ts)", "od": "CAST(o_orderdate AS DATE)", "div": "//"}

EMAIL = """CASE WHEN user_id % 17 = 0 THEN NULL
    WHEN user_id % 2 = 1 AND user_id % 3 = 0 THEN concat('u', user_id, '@mail.example')
    ELSE concat('u', user_id, '@corp.example') END"""
SESSION = "concat('s', CAST(floor(user_id / 2) AS BIGINT), '-', CAST(ts AS DATE))"
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

#: Log records: identity, tokens, tools, hooks, agents, plugins, servers and stamps.
EVENTS = f"""
SELECT *, CASE WHEN k % 7 = 0 THEN NULL ELSE concat('p', k % 23) END AS prompt_id,
    CASE k % 5 WHEN 0 THEN 'acme-large-4-1[1m]' WHEN 1 THEN 'acme-medium-4' WHEN 2 THEN 'ACME-Small-3-5' WHEN 3 THEN NULL ELSE 'local-7b' END AS model,
    concat('tool', k % 4) AS tool_name, CAST(floor(value * 10) AS BIGINT) AS duration_ms, k % 3 <> 0 AS success_bool,
    CAST(k * 10 AS BIGINT) AS input_tokens, CAST(k * 3 AS BIGINT) AS output_tokens, CAST(k * 7 AS BIGINT) AS cache_read_tokens, CAST(k * 2 AS BIGINT) AS cache_creation_tokens,
    CAST(floor(value * 10) AS DOUBLE) / 1000 AS cost_usd, CASE k % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'low' ELSE NULL END AS effort, CASE WHEN k % 4 = 0 THEN 'main' ELSE 'side' END AS query_source,
    CASE WHEN k % 7 = 0 THEN NULL WHEN k % 2 = 0 THEN 'config' ELSE 'user' END AS decision_source, CASE WHEN k % 3 = 0 AND k % 7 <> 0 THEN 'timeout' ELSE NULL END AS error_type,
    CASE WHEN k % 5 = 0 THEN NULL ELSE concat('agent', k % 3) END AS agent_name, CASE WHEN k % 6 = 0 THEN NULL ELSE concat('agent', k % 4) END AS agent_type, k % 2 = 0 AS subagent_is_async, CAST(k % 9 AS BIGINT) AS subagent_tool_uses,
    CAST(k * 11 AS BIGINT) AS subagent_total_tokens, CASE WHEN k % 13 = 0 THEN NULL ELSE concat('hook', k % 4) END AS hook_name, CASE WHEN k % 7 = 0 THEN NULL ELSE concat('on', k % 2) END AS hook_event,
    CAST(floor(value) AS BIGINT) AS total_duration_ms, CAST(k % 6 AS BIGINT) AS num_hooks, CAST(k % 4 AS BIGINT) AS num_success,
    CASE WHEN k % 5 = 0 THEN NULL ELSE concat('srv.', k % 3, ' x') END AS server_name, CASE WHEN k % 4 = 1 THEN NULL ELSE concat('srv_', k % 3, '_x') END AS server_slug,
    CASE k % 3 WHEN 0 THEN 'project' WHEN 1 THEN 'user' ELSE NULL END AS server_scope, CASE WHEN k % 4 = 0 THEN 'failed' ELSE 'connected' END AS server_status,
    CASE WHEN k % 2 = 0 THEN 'stdio' ELSE 'http' END AS transport, CASE WHEN k % 11 = 0 THEN NULL ELSE concat('plug', k % 3) END AS plugin_name, CASE WHEN k % 2 = 0 THEN 'user' ELSE NULL END AS plugin_scope, CASE WHEN k % 7 = 0 THEN NULL ELSE concat('1.', k % 2) END AS plugin_version,
    CASE WHEN k % 5 < 2 THEN NULL ELSE concat('market', k % 2) END AS marketplace_name,
    concat('skill', k % 4) AS skill_name, CASE WHEN k % 6 = 0 THEN NULL ELSE concat('from', k % 2) END AS skill_source, CASE WHEN k % 4 = 3 THEN NULL ELSE concat('by', k % 3) END AS skill_trigger,
    CASE WHEN k % 8 = 0 THEN NULL ELSE concat('v', k % 9) END AS cc_version, CASE WHEN k % 6 = 0 THEN NULL ELSE concat('term', k % 2) END AS terminal_type,
    concat('os', k % 3) AS os_type, 'dev-cli' AS service_name, CASE WHEN k % 10 = 0 THEN NULL ELSE concat('acc', user_id) END AS user_account_id, concat('org', user_id % 2) AS organization_id,
    CASE WHEN k % 9 = 0 THEN 'root' WHEN k % 5 = 1 THEN NULL ELSE concat('U', user_id) END AS process_owner,
    CASE WHEN k % 4 = 0 THEN NULL ELSE concat('st', k % 3) END AS stamp, CASE WHEN k % 6 = 0 THEN NULL ELSE concat('st', k % 2) END AS disk_stamp
FROM (
    SELECT event_id, user_id, {{ts}} AS event_time, CAST(ts AS DATE) AS activity_date, value, {K} AS k, {EMAIL} AS user_email, {SESSION} AS session_id,
        CASE event_id % 11 WHEN 0 THEN 'subagent_completed' WHEN 1 THEN 'hook_execution' WHEN 2 THEN 'plugin_loaded' ELSE
            CASE event_type WHEN 'view' THEN 'api_request' WHEN 'click' THEN 'tool_result' WHEN 'error' THEN 'api_error' WHEN 'signup' THEN 'skill_activated' ELSE 'server_connection' END
        END AS event_name
    FROM {{events}}
) AS x"""

#: Data points: names, kinds and labels, with the same identity.
METRICS = f"""
SELECT *, CASE k % 3 WHEN 0 THEN 'added' WHEN 1 THEN 'removed' ELSE NULL END AS type_label, CASE k % 2 WHEN 0 THEN 'user' ELSE 'cli' END AS time_label,
    CASE WHEN k % 4 = 0 THEN 'reject' ELSE 'accept' END AS decision, CASE WHEN k % 2 = 0 THEN 'config' ELSE 'user' END AS decision_source,
    concat('lang', k % 3) AS language, concat('tool', k % 4) AS tool_name, CASE k % 5 WHEN 0 THEN 'acme-large-4-1[1m]' WHEN 3 THEN NULL ELSE 'acme-medium-5' END AS model,
    CASE WHEN k % 8 = 0 THEN NULL ELSE concat('v', k % 9) END AS cc_version, CASE WHEN k % 6 = 0 THEN NULL ELSE concat('term', k % 2) END AS terminal_type,
    concat('os', k % 3) AS os_type, 'dev-cli' AS service_name, CASE WHEN k % 10 = 0 THEN NULL ELSE concat('acc', user_id) END AS user_account_id, concat('org', user_id % 2) AS organization_id,
    CASE WHEN k % 5 = 0 THEN NULL ELSE concat('start', k % 3) END AS start_type, CASE WHEN k % 4 = 0 THEN NULL ELSE concat('st', k % 3) END AS stamp,
    CASE WHEN k % 6 = 0 THEN NULL ELSE concat('st', k % 2) END AS disk_stamp, CASE WHEN k % 9 = 0 THEN 'root' ELSE NULL END AS process_owner
FROM (
    SELECT event_id, user_id, {{ts}} AS ts, CAST(ts AS DATE) AS activity_date, value, {K} AS k, {EMAIL} AS user_email, {SESSION} AS session_id,
        CASE event_id % 7 WHEN 0 THEN 'commit.count' WHEN 1 THEN 'pull_request.count' WHEN 2 THEN 'lines_of_code.count' WHEN 3 THEN 'active_time.total'
            WHEN 4 THEN 'code_edit_tool.decision' WHEN 5 THEN 'session.count' ELSE 'cost.usage' END AS metric_name,
        CASE WHEN event_id % 41 = 0 THEN 'sum_cumulative' ELSE 'sum_delta' END AS value_kind
    FROM {{events}}
) AS x"""

#: Utilization gauges and their countdowns: two points per event at one time.
UTILIZATION = f"""
SELECT concat('u', user_id % 15, '@corp.example') AS user_email, {{ts}} AS ts, CASE user_id % 2 WHEN 0 THEN '5h' ELSE '7d' END AS usage_window, point.metric_name AS metric_name,
    'gauge_last' AS value_kind,
    CASE WHEN point.metric_name = 'usage.utilization' THEN CAST({K} AS DOUBLE)
        ELSE CAST(CASE WHEN event_id % 97 = 0 THEN 700000 ELSE 18000 - (({{us}} - {{us}} % 1000000) {{div}} 1000000) % 18000 END AS DOUBLE) END AS value
FROM {{events}} AS ev CROSS JOIN (SELECT 'usage.utilization' AS metric_name UNION ALL SELECT 'usage.reset_in_seconds' AS metric_name) AS point"""

#: Yearly licence snapshots, one row per person and subscription, moved on by 23 years to meet the events.
ROSTER = """
SELECT make_date(CAST(extract(year FROM {od}) AS INT) + 23, 12, 31) AS as_of_date, concat('u', o_custkey, '@corp.example') AS user_email, 1 AS subscription_seq,
    CASE WHEN min(o_orderpriority) < '2' THEN 'Premium' WHEN min(o_orderpriority) < '3' THEN 'Standard' ELSE NULL END AS seat_tier,
    CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE make_date(CAST(extract(year FROM {od}) AS INT) + 23, CAST(extract(month FROM min({od})) AS INT), 1) END AS assignment_date,
    CASE WHEN o_custkey % 2 = 0 THEN 'OrgA' ELSE 'OrgB' END AS org_name,
    CASE WHEN count(*) % 5 = 0 THEN NULL ELSE 'Product seat' END AS subscription_raw, CASE WHEN count(*) % 5 = 0 THEN 'Product seat' ELSE NULL END AS revoked_raw,
    CASE WHEN count(*) % 5 = 0 THEN make_date(CAST(extract(year FROM {od}) AS INT) + 22, 6, 1 + CAST(o_custkey % 27 AS INT)) ELSE NULL END AS revoke_date
FROM {orders} GROUP BY extract(year FROM {od}), o_custkey"""

#: People and managers: a tree over customers with chains of up to 40 people, some with an unknown manager, some listed twice, and three around a cycle.
PEOPLE = """
SELECT concat('u', c_custkey, '@corp.example') AS email, CASE WHEN c_custkey = 0 THEN NULL WHEN c_custkey % 97 = 0 THEN 'nobody@corp.example'
    WHEN c_custkey % 10 = 3 AND c_custkey % 400 > 10 THEN concat('u', c_custkey - 10, '@corp.example')
    ELSE concat('u', CAST(floor(c_custkey / 4) AS BIGINT), '@corp.example') END AS manager_email, c_mktsegment AS title, c_custkey AS person_id
FROM {customer}
UNION ALL
SELECT concat('u', c_custkey, '@corp.example') AS email, concat('u', CAST(floor(c_custkey / 4) AS BIGINT), '@corp.example') AS manager_email, 'Zz duplicate' AS title, c_custkey AS person_id
FROM {customer} WHERE c_custkey % 50 = 7
UNION ALL
SELECT concat('x', c_custkey, '@corp.example') AS email, concat('x', CASE WHEN c_custkey = 3 THEN 2 ELSE 3 - c_custkey END, '@corp.example') AS manager_email, 'Zz cycle' AS title, c_custkey AS person_id
FROM {customer} WHERE c_custkey IN (1, 2, 3)"""

#: Hand-made links of personal to corporate addresses; one is a suppression.
MANUAL_ALIAS = """
SELECT 'u3@mail.example' AS personal_email, 'u2@corp.example' AS corporate_email UNION ALL SELECT 'u9@mail.example', CAST(NULL AS {string}) UNION ALL SELECT 'u15@mail.example', 'u140@corp.example'"""

TEXTS = {"events": EVENTS, "metrics": METRICS, "utilization": UTILIZATION, "roster": ROSTER, "people": PEOPLE, "manual_alias": MANUAL_ALIAS}


def rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter's rows as a lazy DataFrame; only the columns that a query uses are computed."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("events", "orders", "customer") if "{" + t + "}" in TEXTS[name]}
    text = TEXTS[name]
    for k, v in (SPARK | {"string": "STRING"}).items():
        text = text.replace("{" + k + "}", v)
    return spark.sql(text, **tables)


def duckdb_with(*names: str) -> str:
    """WITH clauses for the named adapters in DuckDB's dialect."""
    parts = []
    for name in names:
        text = TEXTS[name]
        for k, v in (DUCKDB | {"string": "VARCHAR", "events": "events", "orders": "orders", "customer": "customer"}).items():
            text = text.replace("{" + k + "}", v)
        parts.append(f"{_ALIAS[name]} AS ({text})")
    return ", ".join(parts)


_ALIAS = {"events": "e", "metrics": "m", "utilization": "u", "roster": "r", "people": "h", "manual_alias": "a"}
