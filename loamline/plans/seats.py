"""Queries of seat history, identity and scoping, and their oracles."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from loamline.functions.columns import as_of_from_path
from loamline.operators import identity, marts, seats
from loamline.plans.base import AS_OF, frames, sql
from loamline.plans.marts import ALIAS, DIM_USER, SEEN, SIG
from loamline.sources.shared import workspace

E, M, R = "events", "metrics", "roster"
col = F.col

DROPS = "SELECT as_of_date, lag(as_of_date) OVER (ORDER BY as_of_date) AS prev_as_of, lead(as_of_date) OVER (ORDER BY as_of_date) AS next_as_of FROM (SELECT DISTINCT as_of_date FROM r)"
#: Seat history in SQL, told of each opening by itself: sg, who stands in which drop; op, the drops in which a seat opens, as those that do not go on from
#: the drop before; i, each opening with the next one of the person, the last drop before that, and the first drop without.
STEPS = {
    "dr": DROPS,
    "sg": """SELECT a.user_email, a.as_of_date, a.seat_tier, a.org_name, a.assignment_date, EXISTS (SELECT 1 FROM r x WHERE x.user_email = a.user_email AND x.as_of_date = a.as_of_date AND x.subscription_raw LIKE 'Product %') AS holds,
        (SELECT max(x.revoke_date) FROM r x WHERE x.user_email = a.user_email AND x.as_of_date = a.as_of_date AND x.revoked_raw LIKE 'Product %') AS revoked_on FROM r a WHERE a.subscription_seq = 1""",
    "op": """SELECT x.*, CASE WHEN x.assignment_date IS DISTINCT FROM p.assignment_date THEN x.assignment_date END AS told FROM (SELECT sg.*, prev_as_of FROM sg JOIN dr ON dr.as_of_date = sg.as_of_date) x
        ASOF LEFT JOIN sg p ON p.user_email = x.user_email AND p.as_of_date < x.as_of_date
        WHERE NOT EXISTS (SELECT 1 FROM sg q WHERE q.user_email = x.user_email AND q.as_of_date = x.prev_as_of AND q.seat_tier IS NOT DISTINCT FROM x.seat_tier AND q.org_name IS NOT DISTINCT FROM x.org_name)""",
    "i": """SELECT user_email, seat_tier, org_name, coalesce(told, as_of_date) AS valid_from, CASE WHEN u THEN greatest(coalesce(told, as_of_date), ended) WHEN v THEN greatest(coalesce(told, as_of_date), opened) WHEN gone IS NOT NULL THEN greatest(coalesce(told, as_of_date), gone) END AS valid_to,
        CASE WHEN told IS NULL THEN 'observation-dated' ELSE 'source-dated' END AS valid_from_basis, CASE WHEN u THEN 'revoke-dated' WHEN v THEN 'succession-dated' WHEN gone IS NOT NULL THEN 'observation-dated' END AS valid_to_basis, as_of_date AS first_seen_on, seen AS last_seen_on
        FROM (SELECT *, coalesce(holds AND ended <= coalesce(opened, ended), false) AS u, coalesce(opened <= coalesce(gone, opened), false) AS v FROM (
            SELECT t.*, coalesce(y.told, y.as_of_date) AS opened, CASE WHEN NOT y.holds THEN y.revoked_on END AS ended, (SELECT min(dr.as_of_date) FROM dr WHERE dr.as_of_date > t.seen) AS gone
            FROM (SELECT x.*, (SELECT max(s.as_of_date) FROM sg s WHERE s.user_email = x.user_email AND s.as_of_date >= x.as_of_date AND (x.nxt IS NULL OR s.as_of_date < x.nxt)) AS seen
                FROM (SELECT a.*, (SELECT min(b.as_of_date) FROM op b WHERE b.user_email = a.user_email AND b.as_of_date > a.as_of_date) AS nxt FROM op a) x) t
            LEFT JOIN op y ON y.user_email = t.user_email AND y.as_of_date = t.nxt))
        WHERE NOT coalesce(CASE WHEN u THEN greatest(coalesce(told, as_of_date), ended) WHEN v THEN greatest(coalesce(told, as_of_date), opened) WHEN gone IS NOT NULL THEN greatest(coalesce(told, as_of_date), gone) END <= coalesce(told, as_of_date), false)""",
}
DAYS = "SELECT user_email, activity_date FROM e WHERE user_email IS NOT NULL UNION SELECT user_email, activity_date FROM m WHERE user_email IS NOT NULL"
UNCOVERED = """SELECT t.user_email, t.activity_date, (SELECT max(i.valid_to) FROM i WHERE i.user_email = t.user_email AND i.valid_to <= t.activity_date) AS closed_on FROM td t
    WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.user_email = t.user_email AND i.valid_from <= t.activity_date AND (i.valid_to IS NULL OR i.valid_to > t.activity_date))"""
CURRENT = "SELECT user_email, seat_tier, org_name, valid_from AS held_since FROM i WHERE valid_to IS NULL"
PEOPLE1 = "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY email NULLS LAST, manager_email NULLS LAST, title NULLS LAST, person_id NULLS LAST) AS n FROM h) WHERE n = 1"
TREE = """SELECT p.email, [p.email] AS path FROM p LEFT JOIN p k ON k.email = p.manager_email AND p.manager_email <> p.email WHERE k.email IS NULL
    UNION ALL SELECT p.email, list_append(t.path, p.email) FROM tree t JOIN p ON p.manager_email = t.email AND p.manager_email <> p.email"""
LATE = datetime.date(2024, 12, 31)
OLD = datetime.date(2021, 12, 31)
NEW = datetime.date(2022, 12, 31)


def at(roster, day):
    return roster.where(col("as_of_date") == F.lit(day))


@frames(R)
def parsed_roster(r):
    """A snapshot written as a wide file and read back, its date told by the folder's name."""
    path = workspace(r.sparkSession, "drop") + "/roster-20221231.csv"
    american = F.date_format("assignment_date", "M/d/yyyy")
    wide = at(r, NEW).select(
        F.concat(F.lit(" "), F.upper("user_email")).alias("EMAIL"), col("subscription_raw").alias("Subscription_1"), american.alias("Assignment_Date_1"), col("revoked_raw").alias("Revoked_Subscription_1"),
        F.date_format("revoke_date", "yyyy-MM-dd").alias("Revoke_Date_1"), col("org_name").alias("Team"),
    )
    wide.write.option("header", True).csv(path)
    good, _ = seats.parse_roster(r.sparkSession.read.option("header", True).csv(path).withColumn("source", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)))
    return good.select("user_email", "subscription_seq", "seat_tier", "assignment_date", "revoked_raw", "revoke_date", col("extra")["Team"].alias("team"), as_of_from_path(col("extra")["source"]).alias("as_of"))


@frames(R)
def parsed_drops(r):
    """All snapshots as wide files, several of each: a person's slots are the seat of the year, the tier of the year before, and a revocation of two years before."""
    before = lambda years: r.select(
        "user_email", F.add_months("as_of_date", 12 * years).alias("as_of_date"), *[col(c).alias(f"{c}_{years}") for c in ("seat_tier", "assignment_date", "revoked_raw", "revoke_date")]
    )
    wide = r.join(before(1), ["user_email", "as_of_date"], "left").join(before(2), ["user_email", "as_of_date"], "left")
    iso, american = (lambda c, f=f: F.date_format(c, f) for f in ("yyyy-MM-dd", "M/d/yyyy"))
    wide = wide.select(
        F.concat(F.lit("roster-"), F.date_format("as_of_date", "yyyyMMdd"), F.lit(".csv")).alias("drop"), F.concat(F.upper("user_email"), F.lit(" ")).alias("Email"),
        col("subscription_raw").alias("Subscription_1"), american("assignment_date").alias("ASSIGNMENT_DATE_1"), col("revoked_raw").alias("revoked_subscription_1"), iso("revoke_date").alias("Revoke_Date_1"),
        F.concat(F.lit(seats.PRODUCT), "seat_tier_1").alias("subscription_2"), iso("assignment_date_1").alias("Assignment_Date_2"), col("revoked_raw_1").alias("Revoked_Subscription_2"),
        american("revoke_date_1").alias("Revoke_Date_2"), col("revoked_raw_2").alias("Revoked_Subscription_3"), iso("revoke_date_2").alias("revoke_date_3"), col("org_name").alias("Team"),
    )
    path = workspace(r.sparkSession, "drops")
    wide.repartition(3).write.option("header", True).partitionBy("drop").csv(path)
    good, _ = seats.parse_roster(r.sparkSession.read.option("header", True).csv(path), drop="drop")
    return good.withColumns({"team": col("extra")["Team"], "as_of": as_of_from_path(col("drop"))}).drop("extra", "drop")


def repeated_drops(r):
    """The newest drop, its rows in another order, against the hashes of two that were loaded."""
    loaded = [seats.content_hash(at(r, d).drop("as_of_date")).select(F.lit(d).alias("as_of_date"), "content_hash") for d in (OLD, NEW)]
    return seats.repeated_content(at(r, NEW).orderBy(col("user_email").desc()), loaded[0].unionByName(loaded[1]))


QUERIES = {
    "s9_s10_s11_parse_roster": (
        parsed_roster,
        sql(
            R,
            f"""SELECT user_email, 1 AS subscription_seq, CASE WHEN subscription_raw IS NOT NULL THEN 'seat' END AS seat_tier, assignment_date, revoked_raw, revoke_date, org_name AS team, as_of_date AS as_of FROM r
            WHERE as_of_date = DATE '{NEW}'""",
        ),
    ),
    "s9_s10_s11_parse_drops": (
        parsed_drops,
        sql(
            R,
            """SELECT user_email, subscription_seq, substr(subscription_raw, 9) AS seat_tier, subscription_raw, assignment_date, revoked_raw, revoke_date, team, as_of FROM (
            SELECT user_email, 1 AS subscription_seq, subscription_raw, assignment_date, revoked_raw, revoke_date, org_name AS team, as_of_date AS as_of FROM r
            UNION ALL SELECT r.user_email, 2, 'Product ' || o.seat_tier, o.assignment_date, o.revoked_raw, o.revoke_date, r.org_name, r.as_of_date FROM r JOIN r o ON o.user_email = r.user_email AND year(o.as_of_date) = year(r.as_of_date) - 1
            UNION ALL SELECT r.user_email, 3, NULL, NULL, o.revoked_raw, o.revoke_date, r.org_name, r.as_of_date FROM r JOIN r o ON o.user_email = r.user_email AND year(o.as_of_date) = year(r.as_of_date) - 2)
            WHERE subscription_raw IS NOT NULL OR revoked_raw IS NOT NULL""",
        ),
    ),
    "sc1_sc2_seat_interval": (frames(R)(seats.seat_intervals), sql(R, "SELECT * FROM i", **STEPS)),
    "d5_dim_seat": (
        frames(R)(lambda r: seats.seat_intervals(r).select("user_email", "seat_tier", "org_name", "valid_from", "valid_to", col("valid_to").isNull().alias("is_current"))),
        sql(R, "SELECT user_email, seat_tier, org_name, valid_from, valid_to, valid_to IS NULL AS is_current FROM i", **STEPS),
    ),
    "d6_dim_seat_current": (frames(R)(lambda r: seats.current_seats(seats.seat_intervals(r))), sql(R, CURRENT, **STEPS)),
    "d7_telemetry_status": (
        frames(R, E, M)(lambda r, e, m: seats.telemetry_status(seats.current_seats(seats.seat_intervals(r)), marts.telemetry_days(e, m))),
        sql("roster events metrics", "SELECT c.*, CASE WHEN c.user_email IN (SELECT user_email FROM td) THEN 'Emitting' ELSE 'Never seen' END AS telemetry_status FROM c", **STEPS, td=DAYS, c=CURRENT),
    ),
    "d8_roster_status": (
        frames(R, E, M, "manual_alias")(
            lambda r, e, m, a: seats.roster_status(marts.dim_user(e, m, a, identity.derived_alias(e, m)), seats.current_seats(seats.seat_intervals(r)), AS_OF).select("user_email", "last_seen_date", "roster_status")
        ),
        sql(
            "roster events metrics manual_alias",
            f"""SELECT user_email, last_seen_date, CASE WHEN is_unknown THEN 'Unknown' WHEN user_email NOT IN (SELECT user_email FROM c) THEN 'Off-roster'
            WHEN DATE '{AS_OF}' - last_seen_date <= 28 THEN 'Active seat' ELSE 'Dormant' END AS roster_status FROM du""",
            **STEPS, c=CURRENT, sig=SIG, se=SEEN, al=ALIAS, du=DIM_USER,
        ),
    ),
    "d9_linked_identity": (
        frames(E, M, "manual_alias")(lambda e, m, a: marts.dim_user(e, m, a, identity.derived_alias(e, m)).select("user_email", "scope_email", (col("user_email") != col("scope_email")).alias("is_linked"))),
        sql("events metrics manual_alias", "SELECT user_email, scope_email, user_email <> scope_email AS is_linked FROM du", sig=SIG, se=SEEN, al=ALIAS, du=DIM_USER),
    ),
    "a10_fact_seat_day": (
        frames(R)(lambda r: seats.seat_days(seats.seat_intervals(r), LATE).groupBy("seat_date", "seat_tier", "org_name").agg(F.count("*").alias("seats"))),
        sql(
            R,
            f"""SELECT seat_date, seat_tier, org_name, count(*) AS seats FROM (SELECT user_email, seat_tier, org_name, CAST(unnest(generate_series(valid_from, least(coalesce(valid_to - 1, DATE '{LATE}'), DATE '{LATE}'), INTERVAL 1 DAY)) AS DATE) AS seat_date FROM i
            WHERE valid_from <= least(coalesce(valid_to - 1, DATE '{LATE}'), DATE '{LATE}')) GROUP BY 1, 2, 3""",
            **STEPS,
        ),
    ),
    "w3_l3_latest_drop": (
        frames(R)(lambda r: seats.latest_drops(r.select("as_of_date", (F.dayofyear("as_of_date") * 1000 + F.length("user_email")).alias("drop_id")))),
        sql(R, "SELECT as_of_date, CAST(max(dayofyear(as_of_date) * 1000 + length(user_email)) AS INT) AS drop_id FROM r GROUP BY 1"),
    ),
    "w4_drop_neighbours": (frames(R)(seats.drop_sequence), sql(R, DROPS)),
    "sc3_j7_j8_uncovered_day": (
        frames(R, E, M)(lambda r, e, m: seats.uncovered_days(marts.telemetry_days(e, m), seats.seat_intervals(r))),
        sql("roster events metrics", "SELECT * FROM ud", **STEPS, td=DAYS, ud=UNCOVERED),
    ),
    "q15_drop_delta": (
        frames(R)(lambda r: seats.drop_delta(at(r, OLD), at(r, NEW))),
        sql(
            R,
            f"""SELECT count(*) FILTER (x.user_email IS NULL) AS new, count(*) FILTER (x.user_email IS NOT NULL AND y.user_email IS NOT NULL AND x.seat_tier IS DISTINCT FROM y.seat_tier) AS tier_changed,
            count(*) FILTER (y.user_email IS NULL) AS closed, count(*) FILTER (x.user_email IS NOT NULL AND y.user_email IS NOT NULL AND x.seat_tier IS NOT DISTINCT FROM y.seat_tier) AS unchanged
            FROM (SELECT * FROM r WHERE as_of_date = DATE '{OLD}') x FULL JOIN (SELECT * FROM r WHERE as_of_date = DATE '{NEW}') y ON x.user_email = y.user_email AND x.subscription_seq = y.subscription_seq""",
        ),
    ),
    "q14_load_guards": (
        frames(R)(lambda r: seats.load_violations(at(r, NEW), at(r, OLD).where("seat_tier = 'Premium' AND org_name = 'OrgA'"), datetime.date(2020, 1, 1))),
        sql(
            R,
            f"""SELECT 'future as-of' AS guard, '{OLD}' AS subject UNION ALL SELECT 'out of order', '{OLD}'
            UNION ALL SELECT * FROM (SELECT 'as-of before an assignment', CAST(max(assignment_date) AS VARCHAR) FROM r WHERE as_of_date = DATE '{OLD}' AND seat_tier = 'Premium' AND org_name = 'OrgA' HAVING max(assignment_date) > DATE '{OLD}') UNION ALL SELECT * FROM (SELECT 'row count fell', concat((SELECT count(*) FROM r WHERE as_of_date = DATE '{NEW}'), '>', count(*))
            FROM r WHERE as_of_date = DATE '{OLD}' AND seat_tier = 'Premium' AND org_name = 'OrgA') UNION ALL SELECT 'organisation vanished', 'OrgB' UNION ALL SELECT 'tier vanished', 'Standard'""",
        ),
    ),
    "q14_repeated_content": (
        frames(R)(repeated_drops),
        sql(R, f"SELECT 'content loaded before' AS guard, CAST(as_of_date AS VARCHAR) AS subject FROM (SELECT DISTINCT as_of_date FROM r WHERE as_of_date IN (DATE '{OLD}', DATE '{NEW}')) WHERE as_of_date = DATE '{NEW}'"),
    ),
    "id1_j9_derived_alias": (frames(E, M)(identity.derived_alias), sql("events metrics", ALIAS, se=SEEN)),
    "id2_j2_scoping_address": (
        frames(E, M, "manual_alias")(lambda e, m, a: identity.scoping_address(e.where("user_email IS NOT NULL"), a, identity.derived_alias(e, m))),
        sql(
            "events metrics manual_alias",
            """SELECT x.user_email, CASE WHEN a.personal_email IS NOT NULL THEN coalesce(a.corporate_email, x.user_email) ELSE coalesce(al.corporate_email, x.user_email) END AS scope_email,
            CASE WHEN a.personal_email IS NOT NULL THEN coalesce(a.corporate_email, x.user_email) ELSE coalesce(al.corporate_email, x.user_email) END <> x.user_email AS is_linked
            FROM (SELECT DISTINCT user_email FROM e WHERE user_email IS NOT NULL) x LEFT JOIN a ON a.personal_email = x.user_email LEFT JOIN al ON al.personal_email = x.user_email""",
            se=SEEN, al=ALIAS,
        ),
    ),
    "id3_management_path": (
        frames("people")(lambda h: identity.management_paths(identity.one_per_email(h)).select("email", F.concat_ws(">", "path").alias("path"), F.size("path").alias("depth"))),
        sql("people", "SELECT email, array_to_string(path, '>') AS path, CAST(len(path) AS INT) AS depth FROM tree", p=PEOPLE1, tree=TREE),
    ),
    "id3_cyclic_managers": (
        frames("people")(lambda h: identity.cyclic_managers(identity.one_per_email(h))),
        sql("people", "SELECT email, manager_email AS parent FROM p WHERE email NOT IN (SELECT email FROM tree)", p=PEOPLE1, tree=TREE),
    ),
    "id4_one_per_email": (frames("people")(identity.one_per_email), sql("people", PEOPLE1)),
    "id5_visible_seats": (
        frames("people", R)(lambda h, r: identity.visible_to(seats.current_seats(seats.seat_intervals(r)), identity.management_paths(identity.one_per_email(h)), "u1@corp.example")),
        sql("people roster", "SELECT * FROM c WHERE user_email IN (SELECT email FROM tree WHERE list_contains(path, 'u1@corp.example'))", p=PEOPLE1, tree=TREE, **STEPS, c=CURRENT),
    ),
}
