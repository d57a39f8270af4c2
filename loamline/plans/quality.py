"""Queries of the data-quality detectors and their oracles."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from loamline.operators import detection, identity, marts, quality, seats
from loamline.plans.base import AS_OF, frames, sql
from loamline.plans.marts import ALIAS, SEEN, last
from loamline.plans.seats import DAYS, STEPS, UNCOVERED
from loamline.sources import adapters
from loamline.sources.shared import workspace, written

E, M, R = "events", "metrics", "roster"
col = F.col
FLOOR = datetime.date(2024, 1, 10)
#: Sessions that make an alias for the detector of unresolved identities.
LEAST = 12
#: Days of the detection cycles; each sees what had arrived by then.
CYCLES = (datetime.date(2024, 1, 8), datetime.date(2024, 1, 18), AS_OF)


def found(df, **details):
    """A finding with the named details lifted out of its JSON, for comparison."""
    kinds = {"list": "array<string>", "text": "string", "num": "double"}
    out = df.select("finding_type", "subject", "kind", "row_count", *[F.from_json("details", f"{k} {kinds[t]}")[k].alias(k) for k, t in details.items()])
    lists = [k for k, t in details.items() if t == "list"]
    return out.withColumns({k: F.concat_ws(",", k) for k in lists})


def head(name: str, kind: str, subject: str, count: str) -> str:
    return f"SELECT '{name}' AS finding_type, {subject} AS subject, '{kind}' AS kind, CAST({count} AS BIGINT) AS row_count"


def findings_log(e):
    """A cycle per day; a user's condition is present on days on which the user had the event."""
    return e.select(col("activity_date").alias("cycle"), col("event_name").alias("finding_type"), col("user_id").cast("string").alias("subject"))


LOG = "SELECT DISTINCT activity_date AS cycle, event_name AS finding_type, CAST(user_id AS VARCHAR) AS subject FROM e"
CURRENT = """SELECT finding_type, subject, first_seen, min(cycle) AS standing_since, count(*) AS cycles FROM (
    SELECT *, n - row_number() OVER (PARTITION BY finding_type, subject ORDER BY n) AS island, min(cycle) OVER (PARTITION BY finding_type, subject) AS first_seen
    FROM (SELECT *, dense_rank() OVER (ORDER BY cycle) AS n FROM lg)) GROUP BY finding_type, subject, first_seen, island HAVING max(cycle) = (SELECT max(cycle) FROM lg)"""
CODES = ["api_request", "api_error", "tool_result"]

QUERIES = {
    "q1_cumulative_rows": (
        frames(M)(lambda m: found(quality.cumulative_rows(m))),
        sql(M, head("cumulative_value_kind", "gauge", "'(dataset)'", "count(*)") + " FROM m WHERE value_kind = 'sum_cumulative' HAVING count(*) > 0"),
    ),
    "q2_unknown_email": (
        frames(E, M)(lambda e, m: found(quality.unknown_email(e, m))),
        sql("events metrics", head("unknown_email", "defect", "'(dataset)'", "count(*)") + " FROM (SELECT user_email FROM e UNION ALL SELECT user_email FROM m) WHERE user_email IS NULL HAVING count(*) > 0"),
    ),
    "q3_multi_email_session": (
        frames(E, M)(lambda e, m: found(quality.multi_email_session(e, m), corp_emails="list", personal_emails="list", all_emails="list")),
        sql(
            "events metrics",
            head("multi_email_session", "gauge", "concat(session_id, '|', activity_date)", "len(al)")
            + """, array_to_string(list_filter(al, lambda x: x LIKE '%@corp.example'), ',') AS corp_emails, array_to_string(list_filter(al, lambda x: x NOT LIKE '%@corp.example'), ',') AS personal_emails, array_to_string(al, ',') AS all_emails
            FROM (SELECT session_id, activity_date, list_sort(list(DISTINCT user_email)) AS al FROM (SELECT session_id, activity_date, user_email FROM e UNION ALL SELECT session_id, activity_date, user_email FROM m WHERE value_kind = 'sum_delta')
            WHERE user_email IS NOT NULL GROUP BY 1, 2) WHERE len(al) > 1""",
        ),
    ),
    "q4_cost_divergence": (
        frames(E, M)(lambda e, m: found(quality.cost_divergence(marts.fact_api_usage(e), m, FLOOR), promoted_usd="num", counter_usd="num", abs_diff_usd="num").drop("row_count")),
        sql(
            "events metrics",
            "SELECT 'cost_divergence' AS finding_type, '(dataset)' AS subject, 'defect' AS kind"
            + f""", round(a, 4) AS promoted_usd, round(b, 4) AS counter_usd, round(abs(a - b), 4) AS abs_diff_usd FROM (SELECT (SELECT sum(cost_usd) FROM e WHERE event_name = 'api_request' AND activity_date >= DATE '{FLOOR}') AS a,
            (SELECT sum(value) FROM m WHERE metric_name = 'cost.usage' AND value_kind = 'sum_delta' AND activity_date >= DATE '{FLOOR}') AS b) WHERE abs(a - b) > 0.01 AND abs(a - b) / greatest(b, 0.01) > 0.01""",
        ),
    ),
    "q5_telemetry_after_close": (
        frames(R, E, M)(lambda r, e, m: found(quality.telemetry_after_close(seats.uncovered_days(marts.telemetry_days(e, m), seats.seat_intervals(r))), closed_on="text", first_day="text", last_day="text")),
        sql(
            "roster events metrics",
            head("telemetry_after_close", "defect", "user_email", "count(*)")
            + ", CAST(max(closed_on) AS VARCHAR) AS closed_on, CAST(min(activity_date) AS VARCHAR) AS first_day, CAST(max(activity_date) AS VARCHAR) AS last_day FROM ud WHERE closed_on IS NOT NULL GROUP BY user_email",
            **STEPS, td=DAYS, ud=UNCOVERED,
        ),
    ),
    "q6_emitter_without_seat": (
        frames(R, E, M)(lambda r, e, m: found(quality.emitter_without_seat(seats.uncovered_days(marts.telemetry_days(e, m), seats.seat_intervals(r))), first_day="text", last_day="text")),
        sql(
            "roster events metrics",
            head("emitter_without_seat", "defect", "user_email", "count(*)") + ", CAST(min(activity_date) AS VARCHAR) AS first_day, CAST(max(activity_date) AS VARCHAR) AS last_day FROM ud WHERE closed_on IS NULL GROUP BY user_email",
            **STEPS, td=DAYS, ud=UNCOVERED,
        ),
    ),
    "q7_reopened_within_cadence": (
        frames(R)(lambda r: found(quality.reopened_within_cadence(seats.seat_intervals(r), r), closed_on="text", reopened_on="text")),
        sql(
            R,
            head("reopened_within_cadence", "defect", "concat(user_email, '|', valid_to)", "1")
            + """, CAST(valid_to AS VARCHAR) AS closed_on, CAST(nf AS VARCHAR) AS reopened_on FROM (SELECT *, lead(first_seen_on) OVER w AS ns, lead(valid_from) OVER w AS nf FROM i WINDOW w AS (PARTITION BY user_email ORDER BY valid_from)) c
            WHERE valid_to IS NOT NULL AND ns IS NOT NULL AND (SELECT count(*) FROM dr WHERE dr.as_of_date > c.last_seen_on AND dr.as_of_date < c.ns) = 1""",
            **STEPS,
        ),
    ),
    "q8_assignment_without_tier": (
        frames(R)(lambda r: found(quality.assignment_without_tier(r), assignment_date="text", first_drop="text", last_drop="text")),
        sql(
            R,
            head("assignment_without_tier", "defect", "user_email", "count(*)")
            + """, CAST(max(assignment_date) AS VARCHAR) AS assignment_date, CAST(min(as_of_date) AS VARCHAR) AS first_drop, CAST(max(as_of_date) AS VARCHAR) AS last_drop
            FROM r WHERE assignment_date IS NOT NULL AND seat_tier IS NULL GROUP BY user_email""",
        ),
    ),
    "q9_multi_subscription": (
        frames(R)(lambda r: found(quality.multi_subscription(r.unionAll(r.where("length(user_email) = 15").withColumn("subscription_seq", F.lit(2)))), tiers="list")),
        sql(
            R,
            head("multi_subscription", "defect", "concat(user_email, '|', as_of_date)", "count(*)")
            + """, coalesce(array_to_string(array_agg(seat_tier ORDER BY q), ','), '') AS tiers FROM (SELECT *, subscription_seq AS q FROM r UNION ALL SELECT *, 2 FROM r WHERE length(user_email) = 15) GROUP BY user_email, as_of_date HAVING count(*) > 1""",
        ),
    ),
    "q10_boundary_basis": (
        frames(R)(lambda r: found(quality.boundary_basis(seats.seat_intervals(r)), total="num", share="num")),
        sql(
            R,
            head("boundary_basis", "gauge", "'(dataset)'", "count(*) FILTER (valid_from_basis = 'observation-dated')")
            + ", CAST(count(*) AS DOUBLE) AS total, round(count(*) FILTER (valid_from_basis = 'observation-dated') / count(*), 4) AS share FROM i",
            **STEPS,
        ),
    ),
    "q11_unresolved_identity": (
        frames(E, M, "manual_alias", R)(lambda e, m, a, r: found(quality.unresolved_identity(marts.telemetry_days(e, m), identity.derived_alias(e, m, least_sessions=LEAST), a, r), first_day="text", last_day="text")),
        sql(
            "events metrics manual_alias roster",
            head("unresolved_identity", "defect", "user_email", "count(*)")
            + """, CAST(min(activity_date) AS VARCHAR) AS first_day, CAST(max(activity_date) AS VARCHAR) AS last_day FROM td WHERE user_email NOT LIKE '%@corp.example' AND user_email NOT IN (SELECT personal_email FROM al)
            AND user_email NOT IN (SELECT personal_email FROM a) AND user_email NOT IN (SELECT user_email FROM r) GROUP BY user_email""",
            td=DAYS, se=SEEN, al=ALIAS.replace(">= 2", ">= 12"),
        ),
    ),
    "q12_owner_mismatch": (
        frames(E, M)(lambda e, m: found(quality.owner_mismatch(e, m), owners="list")),
        sql(
            "events metrics",
            head("owner_mismatch", "gauge", "concat(session_id, '|', user_email)", "count(*)")
            + """, array_to_string(list_sort(list(DISTINCT o)), ',') AS owners FROM (SELECT session_id, user_email, lower(trim(process_owner)) AS o FROM (SELECT session_id, user_email, process_owner FROM e UNION ALL SELECT session_id, user_email, process_owner FROM m))
            WHERE user_email LIKE '%@corp.example' AND o <> '' AND o <> split_part(lower(trim(user_email)), '@', 1) GROUP BY session_id, user_email""",
        ),
    ),
    "q13_config_convergence": (
        frames(E, M)(quality.config_convergence),
        sql(
            "events metrics",
            f"""SELECT *, stamp = disk_stamp AS is_converged FROM (SELECT coalesce(user_email, '(unknown)') AS user_email, user_email IS NULL AS is_unknown, {last('stamp')} AS stamp, {last('disk_stamp')} AS disk_stamp, max(t) AS last_seen,
            CAST(max(t) AS DATE) AS last_seen_date, max(t) FILTER (stamp IS NOT NULL) AS stamp_seen_at, max(t) FILTER (disk_stamp IS NOT NULL) AS disk_stamp_seen_at
            FROM (SELECT user_email, event_time AS t, stamp, disk_stamp FROM e UNION ALL SELECT user_email, ts, stamp, disk_stamp FROM m) GROUP BY 1, 2)""",
        ),
    ),
    "w5_current_findings": (frames(E)(lambda e: quality.current_findings(findings_log(e))), sql(E, CURRENT, lg=LOG)),
    "k22_open_defects": (
        frames(E)(lambda e: quality.current_findings(findings_log(e)).groupBy("finding_type").agg(F.count("*").alias("defects"), F.min("standing_since").alias("oldest"))),
        sql(E, "SELECT finding_type, count(*) AS defects, min(standing_since) AS oldest FROM cu GROUP BY 1", lg=LOG, cu=CURRENT),
    ),
    "w7_status_pivot": (
        frames(E)(lambda e: quality.status_pivot(e.select("activity_date", col("event_name").alias("code")), CODES)),
        sql(
            E,
            """SELECT activity_date, count(*) FILTER (event_name = 'api_request') AS n_api_request, count(*) FILTER (event_name = 'api_error') AS n_api_error, count(*) FILTER (event_name = 'tool_result') AS n_tool_result,
            count(*) FILTER (event_name = 'api_request') AS accepted, count(*) FILTER (event_name IN ('api_error', 'tool_result')) AS rejected FROM e GROUP BY 1""",
        ),
    ),
    "w6_silence_run": (
        frames(E)(lambda e: quality.silence_run(e.groupBy(col("user_id").cast("string").alias("subject"), col("activity_date").alias("day")).agg(F.count_if(col("k") >= 70).alias("n")), datetime.date(2024, 1, 1), datetime.date(2024, 1, 30))),
        sql(
            E,
            """SELECT subject, coalesce(DATE '2024-01-30' - max(day) FILTER (n IS NULL OR n > 0), 30) AS silent_days FROM (SELECT s.subject, d.day, x.n FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS subject FROM e) s
            CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day) d LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS subject, activity_date AS day, count(*) FILTER (k >= 70) AS n FROM e GROUP BY 1, 2) x
            ON x.subject = s.subject AND x.day = d.day) GROUP BY 1""",
        ),
    ),
}


# --- the cycle of all detectors --------------------------------------------------------------


@frames(E, M, R, "manual_alias")
def logged(e, m, r, a):
    """The open findings of a log to which three cycles were appended, the second of them twice."""
    spark, root = e.sparkSession, workspace(e.sparkSession, "findings")
    e, m, r = written(e, E), written(m, M), written(r, R)
    intervals = written(seats.seat_intervals(r), "intervals")  # no drop lies between the cycles
    for day in sorted((*CYCLES, CYCLES[1])):
        past = col("activity_date") <= F.lit(day)
        arrived = e.where(past), m.where(past)
        detection.append_cycle(spark, root, day, lambda arrived=arrived: detection.detect(*arrived, r, a, floor=FLOOR, intervals=intervals, least_sessions=LEAST))
    return detection.open_findings(*detection.read_log(spark, root)).drop("details")


def until(text: str, day: datetime.date) -> str:
    """An oracle over what had arrived by ``day``."""
    for name in (E, M):
        whole = adapters.duckdb_with(name)
        alias, rows = whole.split(" AS ", 1)
        text = text.replace(whole, f"{alias} AS (SELECT * FROM {rows} AS arrived WHERE activity_date <= DATE '{day}')")
    return text


#: Nobody has two subscriptions in one drop of the given tables, so Q9 has a query on rows of its own.
DETECTORS = [q for q in QUERIES if q[0] == "q" and q not in ("q9_multi_subscription", "q13_config_convergence")]
_CYCLE = "SELECT DATE '{day}' AS cycle, finding_type, subject, kind, {count} AS row_count FROM ({text})"
LOGGED = " UNION ALL ".join(_CYCLE.format(day=day, text=until(QUERIES[q][1], day), count="NULL" if q == "q4_cost_divergence" else "row_count") for day in CYCLES for q in DETECTORS)
OPEN = f"WITH lg AS ({LOGGED}), cu AS ({CURRENT}), fo AS (SELECT cu.*, kind, row_count FROM cu JOIN lg ON lg.finding_type = cu.finding_type AND lg.subject = cu.subject AND lg.cycle = DATE '{CYCLES[-1]}')"
QUERIES |= {
    "w5_detection_log": (logged, OPEN + " SELECT * FROM fo"),
    "k22_detected_defects": (
        lambda spark, d: detection.open_defects(logged(spark, d)),
        OPEN + " SELECT finding_type, count(*) AS defects, min(standing_since) AS oldest FROM fo WHERE kind = 'defect' GROUP BY 1",
    ),
}
