"""Measures over the marts: each takes frames and a window, and gives one row or one per group."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.columns import UNKNOWN

col = F.col
Window = tuple[datetime.date, datetime.date]


def within(df: DataFrame, window: Window, day: str = "activity_date") -> DataFrame:
    """Rows of an inclusive window of days; reaches the scan as a filter on the day."""
    return df.where(col(day).between(F.lit(window[0]), F.lit(window[1])))


def ratio(a: Column, b: Column) -> Column:
    """NULL instead of a division by zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def activity(daily: DataFrame, scope: DataFrame) -> DataFrame:
    """Active users by scoping address, active days, sessions and prompts."""
    own = daily.join(scope.select("user_email", "scope_email"), "user_email", "left")
    who = F.coalesce("scope_email", "user_email")
    return own.agg(
        F.count_distinct(F.when(col("user_email") != UNKNOWN, who)).alias("active_users"), F.count_distinct("activity_date").alias("active_days"),
        F.count_distinct("session_id").alias("sessions"), F.sum("prompts").alias("prompts"),
    )


def tokens(usage: DataFrame) -> DataFrame:
    return usage.agg(
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
        (F.sum("input_tokens") + F.sum("output_tokens") + F.sum("cache_creation_tokens") + F.sum("cache_read_tokens")).alias("total_tokens"),
        F.sum("request_count").alias("requests"), F.sum("cost_usd").alias("value_consumed"),
    )


def delivery(daily: DataFrame) -> DataFrame:
    users = F.count_distinct(F.when(col("user_email") != UNKNOWN, col("user_email")))
    loc = F.sum(col("loc_added") + col("loc_removed"))
    return daily.agg(
        F.sum("commits").alias("commits"), F.sum("prs").alias("prs"), loc.alias("loc"), ratio(F.sum("commits"), users).alias("commits_per_user"), ratio(F.sum("prs"), users).alias("prs_per_user"),
        ratio(loc, users).alias("loc_per_user"),
    )


def session_time(sessions: DataFrame, daily: DataFrame) -> DataFrame:
    a = sessions.agg(F.avg("duration_s").alias("avg_session_s"))
    days = F.count_distinct("activity_date")
    hours = daily.agg(ratio(F.sum("active_user_s") / 3600, days).alias("user_hours_per_day"), ratio(F.sum("active_cli_s") / 3600, days).alias("cli_hours_per_day"))
    return a.crossJoin(hours)  # one row each


def cache_hit(usage: DataFrame) -> DataFrame:
    read = F.sum("cache_read_tokens")
    return usage.agg(ratio(read, read + F.sum("input_tokens") + F.sum("cache_creation_tokens")).alias("cache_hit_ratio"))


def acceptance(decisions: DataFrame) -> DataFrame:
    yes = F.sum(F.when(col("decision") == "accept", col("decisions")))
    return decisions.agg(F.sum("decisions").alias("edit_decisions"), F.sum(F.when(col("decision") == "reject", col("decisions"))).alias("rejected"), ratio(yes, F.sum("decisions")).alias("acceptance_rate"))


def reliability(outcomes: DataFrame, errors: DataFrame) -> DataFrame:
    o = outcomes.agg(ratio(F.sum("successes"), F.sum("calls")).alias("success_rate"), F.avg("p95_ms").alias("mean_p95_ms"))
    e = errors.agg((100 * ratio(F.sum("errors"), F.sum("errors") + F.sum("requests"))).alias("error_rate_pct"))
    return o.crossJoin(e)  # one row each


def limits(windows: DataFrame, *, limit: float = 90) -> DataFrame:
    """Per window type: the share of windows that reach the limit, and the mean of windows' closing maxima."""
    one = windows.groupBy("user_email", "window_type", "window_end").agg(F.max("peak_pct").alias("peak"), F.max("end_pct").alias("closing"))
    return one.groupBy("window_type").agg(ratio(F.count_if(col("peak") >= limit), F.count("*")).alias("limit_hit_rate"), F.avg("closing").alias("intensity"))


def peak_utilization(windows: DataFrame) -> DataFrame:
    one = windows.groupBy("user_email", "window_type").agg(F.max("peak_pct").alias("peak"))
    return one.groupBy("window_type").agg(F.avg("peak").alias("mean_peak"))


def seat_use(seat_days: DataFrame, current: DataFrame, users: DataFrame, daily: DataFrame, window: Window) -> DataFrame:
    """Paid, instrumented and active seats, utilization and idle seats (NULL without seats)."""
    paid = within(seat_days, window, "seat_date").select("user_email").distinct().join(current.select("user_email"), "user_email", "left_semi")
    known = users.where(col("first_seen_date") <= F.lit(window[1])).select("user_email", F.lit(1).alias("known"))
    active = within(daily, window).select("user_email").distinct().withColumn("active", F.lit(1))
    j = paid.join(known, "user_email", "left").join(active, "user_email", "left")
    n, i, a = F.count("*"), F.count("known"), F.count("active")
    return j.agg(
        n.alias("paid_seats"), i.alias("instrumented"), ratio(i, n).alias("instrumented_share"), a.alias("active_seats"), ratio(a, n).alias("seat_utilization"),
        F.when(n > 0, F.greatest(n - a, F.lit(0))).alias("idle_seats"),
    )


def cohorts(instrumented: DataFrame, daily: DataFrame, window: Window, before: Window, first: DataFrame) -> DataFrame:
    """New, retained, reactivated and idle people; the four add up to the instrumented ones.

    Each person's days are told in one pass: whether any lies in either window.
    """
    seen = daily.groupBy("user_email").agg(
        F.bool_or(col("activity_date").between(F.lit(window[0]), F.lit(window[1]))).alias("now"), F.bool_or(col("activity_date").between(F.lit(before[0]), F.lit(before[1]))).alias("then")
    )
    people = instrumented.select("user_email").distinct().join(seen, "user_email", "left").join(first.select("user_email", "first_seen_date"), "user_email", "left")
    cohort = F.when(~F.coalesce("now", F.lit(False)), "idle").when(col("first_seen_date") >= F.lit(window[0]), "new").when(col("then"), "retained").otherwise("reactivated")
    return people.select("user_email", cohort.alias("cohort"))


def off_roster(days: DataFrame, roster: DataFrame, events: DataFrame) -> DataFrame:
    """Active people no snapshot lists, and events without an address."""
    off = days.select("user_email").distinct().join(roster.select("user_email"), "user_email", "left_anti").agg(F.count("*").alias("off_roster_actives"))
    return off.crossJoin(events.agg(F.count_if(col("user_email").isNull()).alias("unattributed_events")))  # one row each


def roster_mismatch(users: DataFrame, current: DataFrame, as_of: datetime.date) -> DataFrame:
    """Addresses, the unknown one too, first seen by ``as_of`` that hold no current seat themselves; one linked to another's seat is among them."""
    known = users.where(col("first_seen_date") <= F.lit(as_of))
    seats = current.select("user_email").distinct().withColumn("_seat", F.lit(True))
    return known.join(seats, "user_email", "left").agg(F.count_if(col("_seat").isNull() | (col("scope_email") != col("user_email"))).alias("roster_mismatches"))


def by_period(daily: DataFrame, usage: DataFrame, period: str, anchor: datetime.date) -> DataFrame:
    """Actives, delivery, tokens and ratios per active user by week or month; a period that the anchor cuts is NULL."""
    start = F.date_trunc(period, "activity_date").cast("date").alias("period_start")
    total = lambda *names: [F.sum(c).alias(c) for c in names]
    g = daily.groupBy(start).agg(
        F.count_distinct(F.when(col("user_email") != UNKNOWN, col("user_email"))).alias("actives"), *total("commits", "prs", "prompts"), F.sum(col("loc_added") + col("loc_removed")).alias("loc")
    )
    t = usage.groupBy(start).agg(*total("input_tokens", "output_tokens"))
    g = g.join(t, "period_start", "full")
    g = g.withColumns({f"{c}_per_user": ratio(col(c), col("actives")) for c in ("commits", "prs", "loc")})
    end = F.date_sub(F.add_months("period_start", 1), 1) if period == "month" else F.date_add("period_start", 6)
    whole = end <= F.lit(anchor)
    return g.select("period_start", *[F.when(whole, col(c)).alias(c) for c in g.columns if c != "period_start"])


def over_previous(periods: DataFrame, value: str, *, months: int = 0, days: int = 0) -> DataFrame:
    """Change against the period before by self-join; a missing one gives NULL."""
    shifted = F.add_months("period_start", months) if months else F.date_add("period_start", days)
    before = periods.select(shifted.alias("period_start"), col(value).alias("previous"))
    return periods.select("period_start", value).join(before, "period_start", "left").withColumn("change", ratio(col(value) - col("previous"), col("previous")))


def capability_use(bridge: DataFrame, sessions: DataFrame, name: str, amount: str) -> DataFrame:
    """How many sessions and users use one kind of extension, and how often in all: the sum of the bridge's ``amount``.

    The intensities of several bridges stack: each is a row of its own under its capability.
    """
    used = bridge.groupBy("session_id").agg(F.sum(amount).alias("u"))
    s = sessions.join(used, "session_id", "left")
    n = F.count("u")
    one = s.agg(F.lit(name).alias("capability"), n.alias("sessions_using"), ratio(100 * n, F.count("*")).alias("sessions_pct"), F.count_distinct(F.when(col("u").isNotNull(), col("user_email"))).alias("users_using"))
    return one.crossJoin(used.agg(F.coalesce(F.sum("u"), F.lit(0)).alias("intensity")))  # one row each


def seat_value(seat_days: DataFrame, current: DataFrame, users: DataFrame, usage: DataFrame, prices: dict[str, float], window: Window, *, standard: float) -> DataFrame:
    """Monthly cost of the instrumented seats by tier (others at ``standard``), prorated by days / 30, against the value consumed.

    A seat is instrumented if its holder has a seat in the window and now, and was first seen by the window's end.
    """
    days = (window[1] - window[0]).days + 1
    current = current.join(within(seat_days, window, "seat_date").select("user_email").distinct(), "user_email", "left_semi")
    seen = users.where(col("first_seen_date") <= F.lit(window[1])).select("user_email").distinct()
    price = F.coalesce(*[F.when(col("seat_tier") == t, F.lit(p)) for t, p in prices.items()], F.lit(standard))
    cost = current.join(seen, "user_email", "left_semi").agg(F.count("*").alias("instrumented_seats"), F.coalesce(F.sum(price), F.lit(0.0)).alias("monthly_cost"))
    value = within(usage, window).agg(F.sum("cost_usd").alias("value"))
    return cost.crossJoin(value).withColumn("seat_cost", col("monthly_cost") * days / 30).withColumn("value_ratio", ratio(col("value"), col("seat_cost")))  # one row each


def period_over_period(measure: Callable[[Window], DataFrame], window: Window, kinds: dict[str, str]) -> DataFrame:
    """A one-row measure against the window of equal length before it: NULL unless both are there.

    kinds: pct (relative change), points (difference of ratios, times 100) or diff for each measure.
    """
    length = window[1] - window[0] + datetime.timedelta(days=1)
    now, then = measure(window), measure((window[0] - length, window[1] - length))
    both = now.crossJoin(then.select(*[col(c).alias(f"prior_{c}") for c in then.columns]))  # one row each
    change = {"pct": lambda a, b: ratio(a - b, b), "points": lambda a, b: 100 * (a - b), "diff": lambda a, b: a - b}
    return both.select(*now.columns, *[c for c in both.columns if c.startswith("prior_")], *[change[k](col(c), col(f"prior_{c}")).alias(f"change_{c}") for c, k in kinds.items()])


def freshness(signals: DataFrame, refreshes: DataFrame, calendar: DataFrame, now: datetime.datetime) -> DataFrame:
    """Hours since the last signal with a status by 24 and 168 hours, the last refresh of any mart, and the days that the calendar trails ``now``.

    ``refreshes``: the log (finished_at); ``calendar``: (date).
    """
    hours = (F.lit(int(now.replace(tzinfo=datetime.UTC).timestamp() * 1e6)) - F.unix_micros(F.max("t"))) / 3.6e9
    last = signals.agg(F.max("t").alias("last_signal"), hours.alias("hours")).withColumn("status", F.when(col("hours").isNull(), "None").when(col("hours") <= 24, "Fresh").when(col("hours") <= 168, "Late").otherwise("Stale"))
    last = last.crossJoin(refreshes.agg(F.max("finished_at").alias("last_refresh")))  # one row each
    return last.crossJoin(calendar.agg(F.datediff(F.lit(now.date()), F.max("date")).alias("calendar_lag_days")))


def user_page(daily: DataFrame, usage: DataFrame, decisions: DataFrame, users: DataFrame) -> DataFrame:
    """One row per developer."""
    d = daily.groupBy("user_email").agg(
        F.count_distinct("activity_date").alias("active_days"), F.count_distinct("session_id").alias("sessions"), F.sum("prompts").alias("prompts"), F.sum("commits").alias("commits"), F.sum("prs").alias("prs")
    )
    u = usage.groupBy("user_email").agg(F.sum(col("input_tokens") + col("output_tokens")).alias("tokens"), F.sum("request_count").alias("requests"), F.sum("cost_usd").alias("cost_usd"))
    c = decisions.groupBy("user_email").agg(ratio(F.sum(F.when(col("decision") == "accept", col("decisions"))), F.sum("decisions")).alias("acceptance_rate"))
    return users.select("user_email", "first_seen_date", "last_seen_date").join(d, "user_email", "left").join(u, "user_email", "left").join(c, "user_email", "left")


def session_drill(sessions: DataFrame, usage: DataFrame, decisions: DataFrame, bridges: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per session with tokens, requests, cost, acceptance and sorted lists of what it used."""
    names = lambda df, c, out: df.where(col(c).isNotNull()).groupBy("session_id").agg(F.sort_array(F.collect_set(c)).alias(out))
    u = usage.groupBy("session_id").agg(F.sum(col("input_tokens") + col("output_tokens")).alias("tokens"), F.sum("request_count").alias("requests"), F.sum("cost_usd").alias("cost_usd"))
    d = decisions.groupBy("session_id").agg(ratio(F.sum(F.when(col("decision") == "accept", col("decisions"))), F.sum("decisions")).alias("acceptance_rate"))
    out = sessions.select("session_id", "user_email", "started_at", "duration_s").join(u, "session_id", "left").join(d, "session_id", "left")
    out = out.join(names(usage, "model", "models"), "session_id", "left").join(names(usage, "effort", "efforts"), "session_id", "left")
    for name, (df, c) in bridges.items():
        out = out.join(names(df, c, name), "session_id", "left")
    return out


def held_longest(current: DataFrame, days: DataFrame, as_of: datetime.date) -> DataFrame:
    """Seats never tracked, longest held first, with the days since they opened."""
    return current.join(days.select("user_email"), "user_email", "left_anti").withColumn("days_held", F.datediff(F.lit(as_of), "held_since")).orderBy(col("days_held").desc(), "user_email")


def oldest_held(current: DataFrame, as_of: datetime.date, *by: str) -> DataFrame:
    """Per group the days since its oldest seat opened, and how many seats it has."""
    return current.groupBy(*by).agg(F.datediff(F.lit(as_of), F.min("held_since")).alias("days_held"), F.count("*").alias("seats"))
