"""Join forms and set operations in use, each as a query of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamline.functions import columns as C
from loamline.operators import marts, seats
from loamline.plans.base import AS_OF, frames, sql
from loamline.plans.marts import API, DAILY
from loamline.plans.seats import CURRENT, STEPS

E, M, U, R = "events", "metrics", "utilization", "roster"
col = F.col


@frames(E)
def inner_by_slug(e):
    """Tool calls that name a connected server by its slug."""
    servers = e.where("event_name = 'server_connection' AND server_name IS NOT NULL").select("session_id", C.slug(col("server_name")).alias("server_slug")).distinct()
    return e.where("event_name = 'tool_result'").join(servers, ["session_id", "server_slug"]).groupBy("server_slug").agg(F.count("*").alias("calls"))


@frames(U)
def null_safe_pairs(u):
    a = u.where("metric_name = 'usage.utilization'").alias("a")
    b = u.where("metric_name = 'usage.reset_in_seconds'").alias("b")
    on = col("a.user_email").eqNullSafe(col("b.user_email")) & col("a.usage_window").eqNullSafe(col("b.usage_window")) & (col("a.ts") == col("b.ts"))
    return a.join(b, on).groupBy("a.usage_window").agg(F.count("*").alias("pairs"), F.sum((col("b.value") > 604800).cast("int")).alias("impossible"))


@frames(E, M)
def by_session_or_user(e, m):
    """One fact related to users through its session instead of its own address."""
    owner = marts.fact_session(e, m).select("session_id", col("user_email").alias("owner"))
    usage = marts.fact_api_usage(e)
    return usage.join(owner, "session_id").groupBy("owner").agg(F.sum("request_count").alias("requests"), F.sum((col("owner") != col("user_email")).cast("bigint")).alias("elsewhere"))


OWNER = """SELECT session_id, coalesce((min(struct_pack(t := t, v := user_email)) FILTER (WHERE user_email IS NOT NULL)).v, '(unknown)') AS owner
    FROM (SELECT session_id, user_email, ts AS t FROM m UNION ALL SELECT session_id, user_email, event_time FROM e) GROUP BY 1"""


def _early(e):
    return e.where("user_email IS NOT NULL AND activity_date < DATE '2024-01-05'").select("user_email", "tool_name")


def _late(e):
    return e.where("user_email IS NOT NULL AND activity_date > DATE '2024-01-27'").select("user_email", "tool_name")


EARLY = "SELECT user_email, tool_name FROM e WHERE user_email IS NOT NULL AND activity_date < DATE '2024-01-05'"
LATE = "SELECT user_email, tool_name FROM e WHERE user_email IS NOT NULL AND activity_date > DATE '2024-01-27'"

QUERIES = {
    "j1_inner_slug": (
        inner_by_slug,
        sql(
            E,
            """SELECT e.server_slug, count(*) AS calls FROM e JOIN (SELECT DISTINCT session_id, regexp_replace(server_name, '[ .:]', '_', 'g') AS s FROM e WHERE event_name = 'server_connection' AND server_name IS NOT NULL) c
            ON e.session_id = c.session_id AND e.server_slug = c.s WHERE e.event_name = 'tool_result' GROUP BY 1""",
        ),
    ),
    "j3_full_outer": (
        frames(E, M)(lambda e, m: marts.fact_session_daily(e, m).agg(F.count("*").alias("days"), F.count_if(col("prompts") == 0).alias("no_prompts"), F.count_if(col("commits") == 0).alias("no_commits"))),
        sql("events metrics", "SELECT count(*) AS days, count(*) FILTER (prompts = 0) AS no_prompts, count(*) FILTER (commits = 0) AS no_commits FROM d", d=DAILY),
    ),
    "j4_null_safe_self_join": (
        null_safe_pairs,
        sql(
            U,
            """SELECT a.usage_window, count(*) AS pairs, CAST(sum(CASE WHEN b.value > 604800 THEN 1 ELSE 0 END) AS BIGINT) AS impossible FROM u a JOIN u b ON a.user_email IS NOT DISTINCT FROM b.user_email
            AND a.usage_window IS NOT DISTINCT FROM b.usage_window AND a.ts = b.ts WHERE a.metric_name = 'usage.utilization' AND b.metric_name = 'usage.reset_in_seconds' GROUP BY 1""",
        ),
    ),
    "j5_semi": (
        frames(E)(lambda e: marts.fact_api_usage(e).join(e.where("event_name = 'api_error'").select("session_id"), "session_id", "left_semi").groupBy("user_email").agg(F.sum("request_count").alias("requests"))),
        sql(E, "SELECT user_email, CAST(sum(request_count) AS BIGINT) AS requests FROM ap WHERE session_id IN (SELECT session_id FROM e WHERE event_name = 'api_error') GROUP BY 1", ap=API),
    ),
    "j6_anti": (
        frames(E, M, R)(lambda e, m, r: marts.telemetry_days(e, m).select("user_email").distinct().join(r.where("seat_tier = 'Premium'").select("user_email"), "user_email", "left_anti").join(e.where("k = 5").select("user_email"), "user_email", "left_anti")),
        sql(
            "events metrics roster",
            f"""SELECT DISTINCT user_email FROM (SELECT user_email FROM e UNION SELECT user_email FROM m) x WHERE user_email IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r WHERE r.user_email = x.user_email AND seat_tier = 'Premium')
            AND NOT EXISTS (SELECT 1 FROM e l WHERE l.k = 5 AND l.user_email = x.user_email)""",
        ),
    ),
    "j10_lateral_generator": (
        frames(R)(lambda r: seats.seat_days(seats.current_seats(seats.seat_intervals(r)).select("user_email", "seat_tier", "org_name", col("held_since").alias("valid_from"), F.lit(None).cast("date").alias("valid_to")), AS_OF).groupBy("user_email").agg(F.count("*").alias("days"))),
        sql(R, f"SELECT user_email, count(*) AS days FROM (SELECT user_email, unnest(generate_series(held_since, DATE '{AS_OF}', INTERVAL 1 DAY)) FROM c WHERE held_since <= DATE '{AS_OF}') GROUP BY 1", **STEPS, c=CURRENT),
    ),
    "j11_role_playing_join": (
        by_session_or_user,
        sql(
            "events metrics",
            "SELECT owner, CAST(sum(request_count) AS BIGINT) AS requests, CAST(sum(CASE WHEN owner <> user_email THEN 1 ELSE 0 END) AS BIGINT) AS elsewhere FROM ap JOIN ow ON ap.session_id = ow.session_id GROUP BY 1",
            ap=API, ow=OWNER,
        ),
    ),
    "o1_union_all": (
        frames(E, M)(lambda e, m: marts.signals(e, m).groupBy("os_type").agg(F.count("*").alias("n"), F.max("t").alias("last"))),
        sql("events metrics", "SELECT os_type, count(*) AS n, max(t) AS last FROM (SELECT os_type, ts AS t FROM m UNION ALL SELECT os_type, event_time FROM e) GROUP BY 1"),
    ),
    "o2_union_distinct": (
        frames(E, M)(lambda e, m: e.select("session_id", "user_email").union(m.select("session_id", "user_email")).distinct()),
        sql("events metrics", "SELECT session_id, user_email FROM e UNION SELECT session_id, user_email FROM m"),
    ),
    "o3_intersect": (frames(E)(lambda e: _early(e).intersect(_late(e))), sql(E, f"({EARLY}) INTERSECT ({LATE})")),
    "o4_except_intersect": (
        frames(E)(lambda e: _late(e).subtract(_early(e)).intersect(e.where("user_email IS NOT NULL AND event_name = 'api_error'").select("user_email", "tool_name"))),
        sql(E, f"(({LATE}) EXCEPT ({EARLY})) INTERSECT (SELECT user_email, tool_name FROM e WHERE user_email IS NOT NULL AND event_name = 'api_error')"),
    ),
}
