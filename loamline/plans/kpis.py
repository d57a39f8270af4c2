"""Queries of the measures and their oracles."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from loamline.operators import identity, kpis, marts, seats
from loamline.plans.base import AS_OF, frames, sql
from loamline.plans.marts import AGENTS, ALIAS, API, DAILY, DIM_USER, HOOKS, PLUGINS, SEEN, SEGMENTS, SERVERS, SIG, SKILLS, WINDOWS, rounded
from loamline.plans.seats import CURRENT, DAYS, STEPS

E, M, U, R = "events", "metrics", "utilization", "roster"
col = F.col
NOW = (datetime.date(2024, 1, 16), datetime.date(2024, 1, 30))
BEFORE = (datetime.date(2024, 1, 1), datetime.date(2024, 1, 15))
IN = f"BETWEEN DATE '{NOW[0]}' AND DATE '{NOW[1]}'"
PRICES = {"Premium": 125.0}
ACTIVE_USERS = "count(DISTINCT user_email) FILTER (user_email <> '(unknown)')"
EDITS = """SELECT session_id, activity_date, tool_name, decision, coalesce(min(user_email), '(unknown)') AS user_email, sum(value) AS decisions FROM m
    WHERE metric_name = 'code_edit_tool.decision' AND value_kind = 'sum_delta' GROUP BY session_id, activity_date, tool_name, language, decision, decision_source"""
SESSIONS = """SELECT session_id, coalesce((min(struct_pack(t := t, v := user_email)) FILTER (WHERE user_email IS NOT NULL)).v, '(unknown)') AS user_email, min(t) AS started_at,
    CAST(round((epoch_us(max(t)) - epoch_us(min(t))) / 1e6) AS BIGINT) AS duration_s FROM sig GROUP BY 1"""
SEAT_DAYS = f"""SELECT DISTINCT user_email FROM i WHERE valid_from <= DATE '{NOW[1]}' AND (valid_to IS NULL OR valid_to > DATE '{NOW[0]}')"""
PAID = "SELECT user_email FROM sd WHERE user_email IN (SELECT user_email FROM c)"


def doubles(df, *names):
    """Counts that can be NULL, as doubles."""
    return df.withColumns({n: col(n).cast("double") for n in names})


def users(e, m, a):
    return marts.dim_user(e, m, a, identity.derived_alias(e, m))


def paid(r, e, m, a):
    i = seats.seat_intervals(r)
    return kpis.seat_use(seats.seat_days(i, AS_OF), seats.current_seats(i), users(e, m, a), marts.fact_session_daily(e, m), NOW)


#: Cohorts of one day against the day before: few people are active on every day.
DAY, DAY_BEFORE = datetime.date(2024, 1, 25), datetime.date(2024, 1, 24)


@frames(E, M, "manual_alias")
def day_cohorts(e, m, a):
    people = users(e, m, a).where("NOT is_unknown")
    return kpis.cohorts(people, marts.fact_session_daily(e, m), (DAY, DAY), (DAY_BEFORE, DAY_BEFORE), people)


@frames(E, M)
def fresh(e, m):
    """The log of refreshes is told from the events: one a day, at the day's last."""
    log = e.groupBy("activity_date").agg(F.max("event_time").alias("finished_at"))
    return rounded(kpis.freshness(marts.signals(e, m), log, marts.dim_date([e.agg(F.min("activity_date"))], NOW[1]), datetime.datetime(2024, 2, 2)), "hours")


@frames(R)
def oldest_by_tier(r):
    return kpis.oldest_held(seats.current_seats(seats.seat_intervals(r)), AS_OF, "seat_tier", "org_name")


@frames(E, M)
def change(e, m):
    daily = marts.fact_session_daily(e, m)

    def measure(window):
        return kpis.within(daily, window).agg(
            F.round(F.sum("commits"), 4).alias("commits"), kpis.ratio(F.count_if(col("prompts") > 0), F.count("*")).alias("prompted"), F.count_distinct("user_email").alias("actives")
        )

    return rounded(kpis.period_over_period(measure, NOW, {"commits": "pct", "prompted": "points", "actives": "diff"}), "prompted", "prior_prompted", "change_commits", "change_prompted", digits=6)


def measured(window):
    return f"""SELECT round(sum(commits), 4) AS commits, count(*) FILTER (prompts > 0) / count(*) AS prompted, count(DISTINCT user_email) AS actives FROM d WHERE activity_date BETWEEN DATE '{window[0]}' AND DATE '{window[1]}'"""


@frames(E, M)
def drill(e, m):
    bridges = {"agents": (marts.bridge_agent(e), "agent_name"), "hooks": (marts.bridge_hook(e), "hook_name"), "servers": (marts.bridge_server(e), "server_name"), "plugins": (marts.bridge_plugin(e), "plugin_name"), "skills": (marts.bridge_skill(e), "skill_name")}
    out = kpis.session_drill(marts.fact_session(e, m), marts.fact_api_usage(e), marts.fact_edit_decision(m), bridges)
    lists = ["models", "efforts", *bridges]
    return doubles(rounded(out.withColumns({c: F.concat_ws(",", c) for c in lists}), "cost_usd", "acceptance_rate"), "tokens", "requests")


def listed(name: str, source: str, column: str) -> str:
    return f"LEFT JOIN (SELECT session_id, array_to_string(list_sort(list(DISTINCT {column})), ',') AS {name} FROM ({source}) WHERE {column} IS NOT NULL GROUP BY 1) x_{name} ON x_{name}.session_id = s.session_id"


#: Bridges with their SQL, the column that they name and what they count.
BRIDGES = {
    "agent": (marts.bridge_agent, AGENTS, "invocations"), "hook": (marts.bridge_hook, HOOKS, "executions"), "server": (marts.bridge_server, SERVERS, "calls"), "plugin": (marts.bridge_plugin, PLUGINS, "loads"),
    "skill": (marts.bridge_skill, SKILLS, "activations"),
}


@frames(E, M)
def capabilities(e, m):
    out, s = None, marts.fact_session(e, m)
    for name, (bridge, _, amount) in BRIDGES.items():
        one = kpis.capability_use(bridge(e), s, name, amount)
        out = one if out is None else out.unionByName(one)
    return rounded(out, "sessions_pct")


CAPABILITIES = " UNION ALL ".join(
    f"""SELECT '{n}' AS capability, count(*) FILTER (u) AS sessions_using, round(100.0 * count(*) FILTER (u) / count(*), 4) AS sessions_pct, count(DISTINCT user_email) FILTER (u) AS users_using,
    (SELECT CAST(sum({amount}) AS BIGINT) FROM ({w})) AS intensity FROM (SELECT *, session_id IN (SELECT session_id FROM ({w})) AS u FROM s)"""
    for n, (_, w, amount) in BRIDGES.items()
)
PERIOD = """SELECT coalesce(a.period_start, b.period_start) AS period_start, * EXCLUDE (period_start) FROM (SELECT CAST(date_trunc('{p}', activity_date) AS DATE) AS period_start, count(DISTINCT user_email) FILTER (user_email <> '(unknown)') AS actives,
        sum(commits) AS commits, sum(prs) AS prs, sum(loc_added + loc_removed) AS loc, sum(prompts) AS prompts FROM d GROUP BY 1) a
    FULL JOIN (SELECT CAST(date_trunc('{p}', activity_date) AS DATE) AS period_start, sum(input_tokens) AS input_tokens, sum(output_tokens) AS output_tokens FROM e WHERE event_name = 'api_request' GROUP BY 1) b ON a.period_start = b.period_start"""


def periods(period: str, end: str):
    """A query and its oracle of all measures per period."""
    counts, sums = ["actives", "prompts", "input_tokens", "output_tokens"], ["commits", "prs", "loc"]

    @frames(E, M)
    def query(e, m):
        out = kpis.by_period(marts.fact_session_daily(e, m), marts.fact_api_usage(e), period, NOW[1])
        return doubles(rounded(out, *sums, *[f"{c}_per_user" for c in sums]), *counts)

    whole = [f"CAST(CASE WHEN w THEN {c} END AS DOUBLE) AS {c}" for c in counts] + [f"CASE WHEN w THEN round({c}, 4) END AS {c}, CASE WHEN w THEN round({c} / actives, 4) END AS {c}_per_user" for c in sums]
    return query, sql("events metrics", f"SELECT period_start, {', '.join(whole)} FROM (SELECT *, {end} <= DATE '{NOW[1]}' AS w FROM pr)", d=DAILY, pr=PERIOD.replace("{p}", period))


def over_before(period: str, step: str, **back: int):
    """A query and its oracle of actives against the period before."""

    @frames(E, M)
    def query(e, m):
        each = kpis.by_period(marts.fact_session_daily(e, m), marts.fact_api_usage(e), period, datetime.date(2024, 3, 1))
        return doubles(rounded(kpis.over_previous(each, "actives", **back), "change"), "actives", "previous", "change")

    return query, sql(
        "events metrics",
        f"SELECT a.period_start, CAST(a.actives AS DOUBLE) AS actives, CAST(b.actives AS DOUBLE) AS previous, round((a.actives - b.actives) / b.actives, 4) AS change FROM pr a LEFT JOIN pr b ON b.period_start + {step} = a.period_start",
        d=DAILY, pr=PERIOD.replace("{p}", period),
    )


QUERIES = {
    "k1_activity": (
        frames(E, M, "manual_alias")(lambda e, m, a: kpis.activity(kpis.within(marts.fact_session_daily(e, m), NOW), users(e, m, a))),
        sql(
            "events metrics manual_alias",
            f"""SELECT count(DISTINCT coalesce(du.scope_email, d.user_email)) FILTER (d.user_email <> '(unknown)') AS active_users, count(DISTINCT activity_date) AS active_days, count(DISTINCT session_id) AS sessions,
            CAST(sum(prompts) AS BIGINT) AS prompts FROM d LEFT JOIN du ON d.user_email = du.user_email WHERE activity_date {IN}""",
            d=DAILY, sig=SIG, se=SEEN, al=ALIAS, du=DIM_USER,
        ),
    ),
    "k2_tokens": (
        frames(E)(lambda e: rounded(kpis.tokens(kpis.within(marts.fact_api_usage(e), NOW)), "value_consumed")),
        sql(
            E,
            f"""SELECT CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(input_tokens + output_tokens + cache_creation_tokens + cache_read_tokens) AS BIGINT) AS total_tokens,
            count(*) AS requests, round(sum(cost_usd), 4) AS value_consumed FROM e WHERE event_name = 'api_request' AND activity_date {IN}""",
        ),
    ),
    "k3_delivery": (
        frames(E, M)(lambda e, m: rounded(kpis.delivery(kpis.within(marts.fact_session_daily(e, m), NOW)), "commits", "prs", "loc", "commits_per_user", "prs_per_user", "loc_per_user")),
        sql(
            "events metrics",
            f"""SELECT round(sum(commits), 4) AS commits, round(sum(prs), 4) AS prs, round(sum(loc_added + loc_removed), 4) AS loc, round(sum(commits) / {ACTIVE_USERS}, 4) AS commits_per_user, round(sum(prs) / {ACTIVE_USERS}, 4) AS prs_per_user,
            round(sum(loc_added + loc_removed) / {ACTIVE_USERS}, 4) AS loc_per_user FROM d WHERE activity_date {IN}""",
            d=DAILY,
        ),
    ),
    "k4_session_time": (
        frames(E, M)(lambda e, m: rounded(kpis.session_time(marts.fact_session(e, m), marts.fact_session_daily(e, m)), "avg_session_s", "user_hours_per_day", "cli_hours_per_day")),
        sql(
            "events metrics",
            """SELECT round((SELECT avg(duration_s) FROM s), 4) AS avg_session_s, round(sum(active_user_s) / 3600 / count(DISTINCT activity_date), 4) AS user_hours_per_day,
            round(sum(active_cli_s) / 3600 / count(DISTINCT activity_date), 4) AS cli_hours_per_day FROM d""",
            d=DAILY, sig=SIG, s=SESSIONS,
        ),
    ),
    "k5_cache_hit": (
        frames(E)(lambda e: rounded(kpis.cache_hit(marts.fact_api_usage(e)), "cache_hit_ratio", digits=8)),
        sql(E, "SELECT round(sum(cache_read_tokens) / (sum(cache_read_tokens) + sum(input_tokens) + sum(cache_creation_tokens)), 8) AS cache_hit_ratio FROM e WHERE event_name = 'api_request'"),
    ),
    "k6_acceptance": (
        frames(M)(lambda m: rounded(kpis.acceptance(marts.fact_edit_decision(m)), "edit_decisions", "rejected", "acceptance_rate")),
        sql(
            M,
            "SELECT round(sum(decisions), 4) AS edit_decisions, round(sum(decisions) FILTER (decision = 'reject'), 4) AS rejected, round(sum(decisions) FILTER (decision = 'accept') / sum(decisions), 4) AS acceptance_rate FROM ed",
            ed=EDITS,
        ),
    ),
    "k7_reliability": (
        frames(E)(lambda e: rounded(kpis.reliability(marts.fact_tool_outcome(e), marts.fact_api_error_rate(e)), "success_rate", "mean_p95_ms", "error_rate_pct")),
        sql(
            E,
            """SELECT round((SELECT count(*) FILTER (success_bool) / count(*) FROM e WHERE event_name = 'tool_result'), 4) AS success_rate, round((SELECT avg(p) FROM (SELECT round_even(round(quantile_cont(CAST(duration_ms AS DOUBLE), 0.95) * 20) / 20, 0) AS p
            FROM e WHERE event_name = 'tool_result' GROUP BY session_id, activity_date, tool_name, coalesce(decision_source, 'unknown'), coalesce(error_type, 'none'))), 4) AS mean_p95_ms,
            round((SELECT 100.0 * count(*) FILTER (event_name = 'api_error') / count(*) FROM e WHERE event_name IN ('api_error', 'api_request')), 4) AS error_rate_pct""",
        ),
    ),
    "k8_k9_limits": (
        frames(U)(lambda u: rounded(kpis.limits(marts.fact_usage_window(marts.utilization_segments(u))), "limit_hit_rate", "intensity")),
        sql(
            U,
            """SELECT window_type, round(count(*) FILTER (peak >= 90) / count(*), 4) AS limit_hit_rate, round(avg(closing), 4) AS intensity FROM (SELECT user_email, window_type, window_end, max(peak_pct) AS peak, max(end_pct) AS closing FROM w GROUP BY 1, 2, 3) GROUP BY 1""",
            seg=SEGMENTS, w=WINDOWS,
        ),
    ),
    "k10_peak_utilization": (
        frames(U)(lambda u: rounded(kpis.peak_utilization(marts.fact_usage_window(marts.utilization_segments(u))), "mean_peak")),
        sql(U, "SELECT window_type, round(avg(p), 4) AS mean_peak FROM (SELECT user_email, window_type, max(peak_pct) AS p FROM w GROUP BY 1, 2) GROUP BY 1", seg=SEGMENTS, w=WINDOWS),
    ),
    "k11_k12_k13_seat_use": (
        frames(R, E, M, "manual_alias")(lambda r, e, m, a: rounded(paid(r, e, m, a), "instrumented_share", "seat_utilization")),
        sql(
            "roster events metrics manual_alias",
            f"""SELECT count(*) AS paid_seats, count(*) FILTER (k) AS instrumented, round(count(*) FILTER (k) / count(*), 4) AS instrumented_share, count(*) FILTER (ac) AS active_seats, round(count(*) FILTER (ac) / count(*), 4) AS seat_utilization,
            count(*) - count(*) FILTER (ac) AS idle_seats FROM (SELECT user_email, user_email IN (SELECT user_email FROM du WHERE first_seen_date <= DATE '{NOW[1]}') AS k, user_email IN (SELECT user_email FROM d WHERE activity_date {IN}) AS ac FROM pd)""",
            **STEPS, c=CURRENT, sd=SEAT_DAYS, pd=PAID, d=DAILY, sig=SIG, se=SEEN, al=ALIAS, du=DIM_USER,
        ),
    ),
    "k14_cohorts": (
        day_cohorts,
        sql(
            "events metrics manual_alias",
            f"""SELECT user_email, CASE WHEN user_email NOT IN (SELECT user_email FROM d WHERE activity_date = DATE '{DAY}') THEN 'idle' WHEN first_seen_date >= DATE '{DAY}' THEN 'new'
            WHEN user_email IN (SELECT user_email FROM d WHERE activity_date = DATE '{DAY_BEFORE}') THEN 'retained' ELSE 'reactivated' END AS cohort FROM du WHERE NOT is_unknown""",
            d=DAILY, sig=SIG, se=SEEN, al=ALIAS, du=DIM_USER,
        ),
    ),
    "k15_roster_mismatch": (
        frames(R, E, M, "manual_alias")(lambda r, e, m, a: kpis.roster_mismatch(users(e, m, a), seats.current_seats(seats.seat_intervals(r)), NOW[1])),
        sql(
            "roster events metrics manual_alias",
            f"SELECT count(*) FILTER (user_email NOT IN (SELECT user_email FROM c) OR scope_email <> user_email) AS roster_mismatches FROM du WHERE first_seen_date <= DATE '{NOW[1]}'",
            **STEPS, c=CURRENT, sig=SIG, se=SEEN, al=ALIAS, du=DIM_USER,
        ),
    ),
    "k15_off_roster": (
        frames(E, M, R)(lambda e, m, r: kpis.off_roster(marts.telemetry_days(e, m), r.where("seat_tier IS NOT NULL"), e)),
        sql(
            "events metrics roster",
            "SELECT (SELECT count(DISTINCT user_email) FROM td WHERE user_email NOT IN (SELECT user_email FROM r WHERE seat_tier IS NOT NULL)) AS off_roster_actives, (SELECT count(*) FROM e WHERE user_email IS NULL) AS unattributed_events",
            td=DAYS,
        ),
    ),
    "k16_weekly": periods("week", "period_start + 6"),
    "k16_monthly": periods("month", "period_start + INTERVAL 1 MONTH - INTERVAL 1 DAY"),
    "k17_over_previous": over_before("week", "7", days=7),
    "k17_month_over_month": over_before("month", "INTERVAL 1 MONTH", months=1),
    "k18_capability_use": (capabilities, sql("events metrics", CAPABILITIES, sig=SIG, s=SESSIONS)),
    "k19_seat_value": (
        frames(R, E, M, "manual_alias")(
            lambda r, e, m, a: rounded(kpis.seat_value(seats.seat_days(seats.seat_intervals(r), AS_OF), seats.current_seats(seats.seat_intervals(r)), users(e, m, a), marts.fact_api_usage(e), PRICES, NOW, standard=25.0), "seat_cost", "value", "value_ratio")
        ),
        sql(
            "roster events metrics manual_alias",
            f"""SELECT n AS instrumented_seats, mc AS monthly_cost, round(mc * 15 / 30, 4) AS seat_cost, round(v, 4) AS value, round(v / (mc * 15 / 30), 4) AS value_ratio FROM (SELECT count(*) AS n, CAST(sum(CASE WHEN seat_tier = 'Premium' THEN 125 ELSE 25 END) AS DOUBLE) AS mc,
            (SELECT sum(cost_usd) FROM e WHERE event_name = 'api_request' AND activity_date {IN}) AS v FROM c WHERE user_email IN (SELECT user_email FROM sd) AND user_email IN (SELECT user_email FROM du WHERE first_seen_date <= DATE '{NOW[1]}'))""",
            **STEPS, c=CURRENT, sd=SEAT_DAYS, sig=SIG, se=SEEN, al=ALIAS, du=DIM_USER,
        ),
    ),
    "k20_period_over_period": (
        change,
        sql(
            "events metrics",
            """SELECT n.commits, round(n.prompted, 6) AS prompted, n.actives, b.commits AS prior_commits, round(b.prompted, 6) AS prior_prompted, b.actives AS prior_actives, round((n.commits - b.commits) / b.commits, 6) AS change_commits,
            round(100 * (n.prompted - b.prompted), 6) AS change_prompted, n.actives - b.actives AS change_actives FROM n, b""",
            d=DAILY, n=measured(NOW), b=measured(BEFORE),
        ),
    ),
    "k21_freshness": (
        fresh,
        sql(
            "events metrics",
            f"""SELECT last_signal, round(hours, 4) AS hours, CASE WHEN hours IS NULL THEN 'None' WHEN hours <= 24 THEN 'Fresh' WHEN hours <= 168 THEN 'Late' ELSE 'Stale' END AS status,
            (SELECT max(event_time) FROM e) AS last_refresh, CAST(DATE '2024-02-02' - DATE '{NOW[1]}' AS INT) AS calendar_lag_days
            FROM (SELECT max(t) AS last_signal, (epoch_us(TIMESTAMP '2024-02-02') - epoch_us(max(t))) / 3.6e9 AS hours FROM (SELECT ts AS t FROM m UNION ALL SELECT event_time FROM e))""",
        ),
    ),
    "k23_user_page": (
        frames(E, M, "manual_alias")(
            lambda e, m, a: doubles(
                rounded(kpis.user_page(marts.fact_session_daily(e, m), marts.fact_api_usage(e), marts.fact_edit_decision(m), users(e, m, a)), "commits", "prs", "cost_usd", "acceptance_rate"),
                "active_days", "sessions", "prompts", "tokens", "requests",
            )
        ),
        sql(
            "events metrics manual_alias",
            """SELECT du.user_email, first_seen_date, last_seen_date, CAST(active_days AS DOUBLE) AS active_days, CAST(sessions AS DOUBLE) AS sessions, CAST(prompts AS DOUBLE) AS prompts, commits, prs, CAST(tokens AS DOUBLE) AS tokens,
            CAST(requests AS DOUBLE) AS requests, cost_usd, acceptance_rate FROM du
            LEFT JOIN (SELECT user_email, count(DISTINCT activity_date) AS active_days, count(DISTINCT session_id) AS sessions, CAST(sum(prompts) AS BIGINT) AS prompts, round(sum(commits), 4) AS commits, round(sum(prs), 4) AS prs FROM d GROUP BY 1) x ON x.user_email = du.user_email
            LEFT JOIN (SELECT user_email, CAST(sum(input_tokens + output_tokens) AS BIGINT) AS tokens, CAST(sum(request_count) AS BIGINT) AS requests, round(sum(cost_usd), 4) AS cost_usd FROM ap GROUP BY 1) y ON y.user_email = du.user_email
            LEFT JOIN (SELECT user_email, round(sum(decisions) FILTER (decision = 'accept') / sum(decisions), 4) AS acceptance_rate FROM ed GROUP BY 1) z ON z.user_email = du.user_email""",
            d=DAILY, sig=SIG, se=SEEN, al=ALIAS, du=DIM_USER, ap=API.replace("round(sum(cost_usd), 6)", "sum(cost_usd)"), ed=EDITS,
        ),
    ),
    "k24_session_drill": (
        drill,
        sql(
            "events metrics",
            "SELECT s.session_id, user_email, started_at, duration_s, CAST(tokens AS DOUBLE) AS tokens, CAST(requests AS DOUBLE) AS requests, cost_usd, acceptance_rate, coalesce(models, '') AS models, coalesce(efforts, '') AS efforts, coalesce(agents, '') AS agents, coalesce(hooks, '') AS hooks, coalesce(servers, '') AS servers, coalesce(plugins, '') AS plugins, coalesce(skills, '') AS skills FROM s "
            + "LEFT JOIN (SELECT session_id, CAST(sum(input_tokens + output_tokens) AS BIGINT) AS tokens, count(*) AS requests, round(sum(cost_usd), 4) AS cost_usd FROM e WHERE event_name = 'api_request' GROUP BY 1) y ON y.session_id = s.session_id "
            + "LEFT JOIN (SELECT session_id, round(sum(decisions) FILTER (decision = 'accept') / sum(decisions), 4) AS acceptance_rate FROM ed GROUP BY 1) z ON z.session_id = s.session_id "
            + " ".join(
                [
                    listed("models", "SELECT * FROM e WHERE event_name = 'api_request'", "model"), listed("efforts", "SELECT * FROM e WHERE event_name = 'api_request'", "effort"), listed("agents", AGENTS, "agent_name"), listed("hooks", HOOKS, "hook_name"),
                    listed("servers", SERVERS, "server_name"), listed("plugins", PLUGINS, "plugin_name"), listed("skills", SKILLS, "skill_name"),
                ]
            ),
            ed=EDITS,
            sig=SIG, s=SESSIONS,
        ),
    ),
    "k25_oldest_held": (
        oldest_by_tier,
        sql(R, f"SELECT seat_tier, org_name, CAST(DATE '{AS_OF}' - min(held_since) AS INT) AS days_held, count(*) AS seats FROM c GROUP BY 1, 2", **STEPS, c=CURRENT),
    ),
    "k25_untracked_worklist": (
        frames(R, E, M)(lambda r, e, m: kpis.held_longest(seats.current_seats(seats.seat_intervals(r)), marts.telemetry_days(e, m), AS_OF)),
        sql("roster events metrics", f"SELECT *, CAST(DATE '{AS_OF}' - held_since AS INT) AS days_held FROM c WHERE user_email NOT IN (SELECT user_email FROM td)", **STEPS, c=CURRENT, td=DAYS),
    ),
}
