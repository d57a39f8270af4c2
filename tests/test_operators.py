"""Hand-made rows with exact results for the cases that derived tables do not reach."""

from __future__ import annotations

import datetime as dt
import types

import duckdb
import pytest
from pyspark.sql import functions as F

from loamline.functions import columns as C
from loamline.functions import plain, spans
from loamline.operators import detection, identity, kpis, marts, otlp, profile, quality, reconcile, refresh, seats
from loamline.plans.archive import QUERIES
from loamline.plans.marts import QUERIES as MART_QUERIES
from loamline.sources import adapters, payloads, reservoir
from loamline.sources import store
from loamline.sources.commits import Commits, Part
from loamline.streaming import ingest

D = dt.date
ROSTER = "as_of_date date, user_email string, subscription_seq int, seat_tier string, assignment_date date, org_name string, subscription_raw string, revoked_raw string, revoke_date date"


def roster(spark, *rows):
    return spark.createDataFrame([(*r[:6], r[6] if len(r) > 6 else "Product seat", r[7] if len(r) > 7 else None, r[8] if len(r) > 8 else None) for r in rows], ROSTER)


def intervals(df):
    return {(r.user_email, r.valid_from, r.valid_to, r.valid_to_basis) for r in seats.seat_intervals(df).collect()}


def test_reset_splits_a_window_and_ignores_impossible_countdowns(spark):
    base = dt.datetime(2024, 1, 1, 10)
    rows = []
    for minute, pct, left in ((0, 30, 18000), (5, 80, 17700), (10, 10, 17400), (15, 60, 17100), (20, 99, 700000)):
        t = base + dt.timedelta(minutes=minute)
        rows += [("a", "5h", "usage.utilization", "gauge_last", t, float(pct)), ("a", "5h", "usage.reset_in_seconds", "gauge_last", t, float(left))]
    u = spark.createDataFrame(rows, "user_email string, usage_window string, metric_name string, value_kind string, ts timestamp, value double")
    got = marts.fact_usage_window(marts.utilization_segments(u)).orderBy("segment_no").collect()
    assert [(r.segment_no, r.end_pct, r.peak_pct, r.sample_count, r.is_reset_split) for r in got] == [(1, 80.0, 80.0, 2, True), (2, 60.0, 60.0, 2, True)]


def test_tool_percentiles(spark):
    rows = [("tool_result", "s", D(2024, 1, 1), "t", None, None, ms, ok) for ms, ok in ((100, True), (200, True), (300, False))]
    e = spark.createDataFrame(rows, "event_name string, session_id string, activity_date date, tool_name string, decision_source string, error_type string, duration_ms bigint, success_bool boolean")
    r = marts.fact_tool_outcome(e).first()
    assert (r.calls, r.successes, r.p50_ms, r.p95_ms, r.decision_source, r.error_type) == (3, 2, 200, 290, "unknown", "none")


def test_tool_percentiles_at_halves_are_exact(spark):
    """52 rows: 0.95 of the way is 48.45, so 1234 + 0.45 * 30 = 1247.5, to the even 1248; interpolated in doubles it comes out on either side in one engine or the other."""
    cases = [(14, 10, 100, 104), (18, 50, 1234, 1242), (47, 25, 1234, 1252), (52, 30, 1234, 1248), (59, 25, 2345, 2348)]  # rows, step, base, the exact value to the even
    rows = [("tool_result", f"s{n}", D(2024, 1, 1), "t", None, None, base + (step if i > 19 * (n - 1) // 20 else 0), True) for n, step, base, _ in cases for i in range(n)]
    e = spark.createDataFrame(rows, "event_name string, session_id string, activity_date date, tool_name string, decision_source string, error_type string, duration_ms bigint, success_bool boolean")
    want = {f"s{n}": p for n, _, _, p in cases}
    assert {r.session_id: r.p95_ms for r in marts.fact_tool_outcome(e).collect()} == want
    con = duckdb.connect()
    con.register("e", e.toPandas())
    assert dict(con.sql(f"SELECT session_id, p95_ms FROM ({MART_QUERIES['a5_fact_tool_outcome'][1].partition(') AS x)')[2]})").fetchall()) == want


def test_seat_gap_closes_and_reopens(spark):
    df = roster(spark, (D(2024, 1, 1), "a", 1, "P", None, "O"), (D(2024, 2, 1), "b", 1, "P", None, "O"), (D(2024, 3, 1), "a", 1, "P", None, "O"))
    got = intervals(df)
    assert ("a", D(2024, 1, 1), D(2024, 2, 1), "observation-dated") in got and ("a", D(2024, 3, 1), None, None) in got


def test_seat_tier_change_is_succession(spark):
    df = roster(spark, (D(2024, 1, 1), "a", 1, "P", D(2023, 12, 1), "O"), (D(2024, 2, 1), "a", 1, "S", D(2024, 1, 20), "O"))
    assert intervals(df) == {("a", D(2023, 12, 1), D(2024, 1, 20), "succession-dated"), ("a", D(2024, 1, 20), None, None)}


@pytest.mark.parametrize(("revoked", "basis", "end"), [(D(2024, 1, 10), "revoke-dated", D(2024, 1, 10)), (D(2024, 3, 10), "succession-dated", D(2024, 2, 1))])
def test_seat_revocation_counts_only_before_the_next_opening(spark, revoked, basis, end):
    df = roster(spark, (D(2024, 1, 1), "a", 1, "P", None, "O"), (D(2024, 2, 1), "a", 1, None, None, "O", None, "Product seat", revoked))
    assert ("a", D(2024, 1, 1), end, basis) in intervals(df)


def test_seat_history_does_not_depend_on_row_order(spark):
    df = roster(spark, *[(D(2024, m, 1), e, 1, t, None, o) for m, e, t, o in ((1, "a", "P", "O"), (2, "a", "P", "Q"), (3, "a", "S", "Q"), (1, "b", "P", "O"), (3, "b", "P", "O"))])
    assert intervals(df) == intervals(df.orderBy(F.rand(3)))


def test_seat_days_add_up_to_spans(spark):
    i = seats.seat_intervals(roster(spark, (D(2024, 1, 1), "a", 1, "P", None, "O"), (D(2024, 1, 11), "b", 1, "P", None, "O")))
    n = {r.user_email: r["count"] for r in seats.seat_days(i, D(2024, 1, 20)).groupBy("user_email").count().collect()}
    assert n == {"a": 10, "b": 10}


def test_parse_roster(spark):
    csv = spark.createDataFrame(
        [(" A@Corp.example", "Product Premium", "1/5/2024", "", "", "red"), ("b@corp.example", "", "", "Product seat", "2024-02-01", "blue"), ("", "Product X", "", "", "", ""), ("c@corp.example", "Product X", "soon", "", "", "")],
        ["EMAIL", "Subscription_1", "assignment_date_1", "revoked_subscription_2", "revoke_date_2", "Team"],
    )
    good, bad = seats.parse_roster(csv)
    got = {(r.user_email, r.subscription_seq, r.seat_tier, r.assignment_date, r.revoke_date, r.extra["Team"]) for r in good.collect()}
    assert got == {("a@corp.example", 1, "Premium", D(2024, 1, 5), None, "red"), ("b@corp.example", 2, None, None, D(2024, 2, 1), "blue")}
    assert {r.violation for r in bad.collect()} == {"blank email", "bad date"}


def test_parse_roster_tells_drops_apart(spark):
    rows = [("A@corp.example", "Product X", None, "Product Y", "2/3/2024", "d1"), ("a@corp.example", "Product X", None, None, None, "d2"), ("b@corp.example", "Product X", None, None, None, "d2"), ("B@corp.example", None, None, "Product Y", "2/3/2024", "d2")]
    csv = spark.createDataFrame([(*r, "north") for r in rows], "Email string, SUBSCRIPTION_1 string, Subscription_2 string, revoked_subscription_3 string, revoke_date_3 string, drop string, Site string")
    good, bad = seats.parse_roster(csv, drop="drop")
    assert {(r["drop"], r.user_email, r.subscription_seq, r.seat_tier, r.revoke_date, str(r.extra)) for r in good.collect()} == {
        ("d1", "a@corp.example", 1, "X", None, "{'Site': 'north'}"), ("d1", "a@corp.example", 3, None, D(2024, 2, 3), "{'Site': 'north'}"), ("d2", "a@corp.example", 1, "X", None, "{'Site': 'north'}"),
        ("d2", "b@corp.example", 1, "X", None, "{'Site': 'north'}"), ("d2", "b@corp.example", 3, None, D(2024, 2, 3), "{'Site': 'north'}"),
    }
    assert bad.count() == 0
    _, bad = seats.parse_roster(csv.unionByName(csv.where("drop = 'd1'")), drop="drop")
    assert {(r["drop"], r.user_email, r.subscription_seq, r.violation) for r in bad.collect()} == {("d1", "a@corp.example", k, "duplicate key") for k in (1, 3)}


def test_as_of_from_path(spark):
    paths = spark.createDataFrame([("x/roster-20240131.csv",), ("r-20240131-20240131.csv",), ("r-20240131-20240201.csv",), ("r-20241331.csv",), ("r-202401311.csv",)], ["p"])
    assert [r[0] for r in paths.select(C.as_of_from_path(F.col("p"))).collect()] == [D(2024, 1, 31), D(2024, 1, 31), None, None, None]


def test_alias_needs_two_sessions_and_one_partner(spark):
    def signal(*pairs):
        return spark.createDataFrame(list(pairs), "session_id string, user_email string")

    p, c, d = "x@mail.example", "x@corp.example", "y@corp.example"
    none = spark.createDataFrame([], "session_id string, user_email string")
    assert identity.derived_alias(signal(("1", p), ("1", c), ("2", p), ("2", c)), none).collect()[0].corporate_email == c
    assert identity.derived_alias(signal(("1", p), ("1", c)), none).count() == 0
    assert identity.derived_alias(signal(("1", p), ("1", c), ("2", p), ("2", c), ("3", p), ("3", d)), none).count() == 0


def test_management_cycle_and_self_links_do_not_hang(spark):
    people = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c"), ("d", "c"), ("e", None)], "email string, manager_email string")
    got = {r.email: r.path for r in identity.management_paths(people).collect()}
    assert got == {"c": ["c"], "d": ["c", "d"], "e": ["e"]}


def test_long_chains_keep_everyone(spark):
    n = 100
    people = spark.createDataFrame([(f"p{i}", f"p{i - 1}" if i else None) for i in range(n)] + [("x", "y"), ("y", "x"), ("z", "y")], "email string, manager_email string")
    paths, cyclic = identity.management_tree(people)
    got = {r.email: r.path for r in paths.collect()}
    assert got == {f"p{i}": [f"p{j}" for j in range(i + 1)] for i in range(n)}
    assert {(r.email, r.parent) for r in cyclic.collect()} == {("x", "y"), ("y", "x"), ("z", "y")}
    rows = spark.createDataFrame([("p99",), ("p3",), ("z",)], "user_email string")
    assert [r.user_email for r in identity.visible_to(rows, paths, "p50").collect()] == ["p99"]


def test_excluded_managers_make_roots(spark):
    people = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "email string, manager_email string")
    assert {r.email: r.path for r in identity.management_paths(people, excluded=("a",)).collect()} == {"a": ["a"], "b": ["b"], "c": ["b", "c"]}
    assert identity.management_paths(people.limit(0)).count() == 0


def test_calls_of_sessions_without_a_connection_count(spark):
    rows = [("server_connection", "s1", "my.srv", None, "failed", "http", "user", 1), ("server_connection", "s1", "my.srv", None, "connected", None, None, 2), ("api_request", "s2", None, "my_srv", None, None, None, 3), ("api_request", "s2", None, "other", None, None, None, 3)]
    e = spark.createDataFrame(rows, "event_name string, session_id string, server_name string, server_slug string, server_status string, transport string, server_scope string, event_time int")
    got = {(r.session_id, r.server_name, r.connections, r.failures, r.transport, r.server_scope, r.calls) for r in marts.bridge_server(e).collect()}
    assert got == {("s1", "my.srv", 2, 1, "http", "user", 0), ("s2", "my.srv", 0, 0, None, None, 1)}


def test_content_hash_counts_repeats_and_ignores_order(spark):
    h = lambda *x: seats.content_hash(spark.createDataFrame([(v,) for v in x], "a string")).first()
    assert h("A", "A", "B") != h("C", "C", "B") and h("A", "B", "A") == h("B", "A", "A") and h("A", "B") != h("A", "A", "B")


PAYLOAD = (
    '{"resourceLogs":[{"resource":{"attributes":[{"key":"session.id","value":{"stringValue":"r"}},{"key":"secret.token","value":{"stringValue":"x"}}]},"scopeLogs":[{"scope":{"name":"s"},"logRecords":['
    '{"timeUnixNano":"1704067200123456789","body":{"stringValue":"app.go"},"attributes":[{"key":"k","value":{"intValue":"7"}},{"key":"session.id","value":{"stringValue":"own"}},'
    '{"key":"prompt.text","value":{"stringValue":""}},{"key":"prompt.text","value":{"intValue":"0"}},{"key":"list","value":{"arrayValue":{"values":[{"intValue":"1"}]}}}]}]}]}]}'
)


def test_decode_and_redact(spark):
    p = spark.createDataFrame([(PAYLOAD,)], ["json"])
    r = otlp.explode_logs(p).first()
    assert (r.event_name, r.attrs["session.id"], r.attrs["k"], r.event_time) == ("go", "own", "7", dt.datetime(2024, 1, 1, 0, 0, 0, 123456))
    assert r.attrs["list"] == '{"values":[{"intValue":"1"}]}'
    clean = otlp.redact(p, "logs", ["secret.token"], ["prompt.text"])
    row = clean.first()
    assert row.gate_leaks == 1 and "secret.token" not in row.json and "prompt.text" not in row.json and '"k"' in row.json
    again = otlp.redact(clean.drop("gate_leaks"), "logs", ["secret.token"], ["prompt.text"]).first()
    assert again.gate_leaks == 0 and again.json == row.json


def test_redaction_keeps_all_that_is_not_denied(spark):
    import json

    tree = {
        "extra": [1, {"deep": None}],
        "resourceMetrics": [
            {
                "schemaUrl": "u", "resource": {"attributes": [{"key": "secret", "value": {"stringValue": "x"}}, {"key": "a", "value": {"kvlistValue": {"values": [{"key": "in", "value": {"intValue": "1"}}]}}}]},
                "scopeMetrics": [{"scope": {"attributes": [{"key": "secret", "value": {}}], "v": 2}, "metrics": [{"name": "m", "summary": {"dataPoints": [{"quantileValues": [{"quantile": 0.5}], "attributes": [{"key": "secret", "value": {"intValue": "3"}}]}]}}]}],
            }
        ],
    }
    want = json.loads(json.dumps(tree))
    block = want["resourceMetrics"][0]
    del block["resource"]["attributes"][0], block["scopeMetrics"][0]["scope"]["attributes"][0], block["scopeMetrics"][0]["metrics"][0]["summary"]["dataPoints"][0]["attributes"][0]
    texts = [json.dumps(tree), '{"resourceMetrics": [ {"schemaUrl": "kept as it is"} ]}', "no json", None, '{"resourceLogs": {"odd": 1}}', "[]"]
    p = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, json string")
    got = {r.i: (r.json, r.gate_leaks) for r in otlp.redact(p, "metrics", ["secret"], ["a"]).collect()}
    assert json.loads(got[0][0]) == want and got[0][1] == 0
    assert [got[i][0] for i in range(1, 6)] == [texts[1], None, None, texts[4], texts[5]]
    changed, report = reservoir.scrub(p.where("i = 1").withColumn("signal", F.lit("metrics")), "metrics", ["secret"], [])
    assert changed.count() == 0 and report.first().rewritten == 0


def _never(*_):
    raise AssertionError("scanned")


def test_plain_payloads_are_cut_without_a_scan(spark, monkeypatch):
    e, m = (adapters.rows(spark, "/root/testdata/sf0.001", n) for n in ("events", "metrics"))
    texts = {s: [r.json for r in p.select("json").collect()] for s, p in (("logs", payloads.log_payloads(e)), ("metrics", payloads.metric_payloads(m)))}
    want = {s: sorted(spans.without(t, frozenset(["secret.token"]), frozenset(["prompt.text"] if s == "logs" else [])) for t in texts[s]) for s in texts}
    monkeypatch.setattr(otlp, "spans", types.SimpleNamespace(without=_never))  # goes to the workers by value
    for s in texts:
        p = spark.createDataFrame([(t,) for t in texts[s]], "json string")
        assert sorted((r.json, r.gate_leaks) for r in otlp.redact(p, s, ["secret.token"], ["prompt.text"]).collect()) == want[s]


def test_cuts_of_the_jvm_equal_the_scan(spark):
    d, c, o = '{"key":"d","value":{"stringValue":"x"}}', '{"key":"c","value":{"stringValue":"%s"}}', '{"key":"o","value":{"intValue":"1"}}'
    lists = [d, f"{d},{o}", f"{o},{d}", f"{o},{d},{d}", f"{d}, {o}", f"{o}, {d}", f"{o} ,{d}", f" {d}", f"{d} ", c % "", c % "s", c % "d", f"{d},{c % 'n'},{o},{c % ''}", '{"key":"c","value":{"stringValue":null}}', '{"key":"c","value":{}}', '{"value":{},"key":"d"}',
             '{"key":"o","value":{"kvlistValue":{"values":[%s]}}}' % d, '{"key":"o","value":{"kvlistValue":{"attributes":[%s]}}}' % d, '{"key":"o","value":{"stringValue":"d"}}', '{"key":"\\u0064","value":1}']
    whole = '{"resourceLogs":[{"resource":{"attributes":[R]},"scopeLogs":[{"scope":{"attributes":[S]},"logRecords":[{"attributes":[L]},{"attributes":[]}]}]}]}'
    texts = [whole.replace("R", r).replace("S", "").replace("L", x) for r in ("", d, c % "x") for x in lists] + [whole.replace("R", "").replace("S", x).replace("L", "") for x in lists]
    texts += [t + tail for t in texts[:3] for tail in (" ", "]", "}", ',"a":1', " x", "{}")] + [whole.replace("logRecords", "other").replace("R", "").replace("S", "").replace("L", x) for x in lists]
    p = spark.createDataFrame(list(enumerate(texts)), "i int, json string")
    got = {r.i: (r.json, r.gate_leaks) for r in otlp.redact(p, "logs", ["d"], ["c"]).collect()}
    for i, t in enumerate(texts):
        want = spans.without(t, frozenset("d"), frozenset("c"))
        assert (got[i][0], got[i][1] or 0) == want, t


def _odd_texts():
    """Payloads that no two readers would take alike unless they were made to."""
    d, c, o = '{"key":"d","value":{"stringValue":"x"}}', '{"key":"c","value":{"intValue":"1"}}', '{"key":"o","value":{"doubleValue":N}}'
    whole = '{"resourceLogs":[{"schemaUrl":"u","resource":{"attributes":[@1]},"scopeLogs":[{"scope":{"attributes":[@2]},"logRecords":[{"flags":1,"attributes":[@3]}]}]}]}'
    numbers = ("1", "0", "-0", "0.0", "-0.0", "1.50", "29.27", "100.0", "-3.250", "0.0001", "0.00001", "1e3", "1.0E-4", "12345678901234.5", "0.1234567890123456789", "123456789012345678", "123456789012345678901", "1" * 50, "null", "true", '{"a": [1, 2.0]}', "[]")
    texts = [whole.replace("@1", d).replace("@2", "").replace("@3", f"{o.replace('N', n)},{c}") for n in numbers]
    texts += [whole.replace("@1", r).replace("@2", x).replace("@3", y) for r in ("", d) for x in ("", d, c) for y in ("", d, c, f"{d},{d}", f"{c}, {d}", '{"key":"d","key":"e","value":{}}', '{"value":1,"key":"d"}', '{"key":"e","value":{"stringValue":"é"}}', '{"key":"e","value":{"stringValue":"\\n"}}')]
    plain_ = texts[0]
    texts += [plain_ + " ", plain_ + " x", plain_ + "{}", plain_.replace("}", " }"), plain_[:-1], plain_.replace('"flags":1', '"flags":1,"flags":2'), plain_.replace('"flags":1', '"Z":{"b":1,"a":{"é":1}},"a":NaN'), plain_.replace('"flags":1', '"Z":{"b":1,"B":[{"y":1,"x":2}]}')]
    texts += ["{}", "[]", "3", "null", '"d"', "", " ", "{oops", '{"a":1,"a":2}', '{"a":1} {"d":2}', '{"a":' * 700 + "1" + "}" * 700, '{"a":' * 1200 + "1" + "}" * 1200, '{"%s":1}' % ("k" * 60_000), '{"resourceLogs":{"d":1}}', '{"resourceLogs":[7,"d"]}', '{"resourceLogs":"d"}', "\u00e9", None]
    return texts


def test_digests_and_faults_of_one_parse_are_those_of_the_jvm(spark):
    """What is told of a payload in one parse is what redaction, the quarantine and the hash tell of it by themselves."""
    texts = _odd_texts()
    p = spark.createDataFrame([("logs", D(2024, 1, 1), str(i), t) for i, t in enumerate(texts)], store.PAYLOAD)
    reader, sure = plain.Reader(frozenset("d"), frozenset("c")), 0
    got = {r.payload_id: r for r in store.prepared(p, ["d"], ["c"]).collect()}
    red = otlp.redact(p, "logs", ["d"], ["c"])
    want = {r.payload_id: r for r in red.withColumn("h", otlp.batch_hash(F.col("json"))).collect()}
    reasons = {r.payload_id: r.reason for r in otlp.quarantined(p).collect()}
    for i, t in enumerate(texts):
        mine, other = got[str(i)], want[str(i)]
        assert (mine.json, mine.batch_hash, mine.reason) == (other.json, other.h, reasons[str(i)]), t
        if t and "\\" not in t:
            try:
                tree = reader.tree(t)
                cut = reader.cut(t, tree, "logs")
            except (ValueError, RecursionError):
                continue
            if cut:
                assert cut == spans.without(t, frozenset("d"), frozenset("c")), t
                sure += reader.digest(cut[0], tree) is not None
    assert sure > 30


def test_a_payload_is_parsed_once_before_it_is_stored(spark):
    """One pass of Python tells all; before, each signal had its own, the quarantine one more, and the JVM parsed each payload five times."""
    p = spark.createDataFrame([("logs", D(2024, 1, 1), "1", PAYLOAD)], store.PAYLOAD)
    plan = store.prepared(p, ["secret.token"], ["prompt.text"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "from_json" not in plan


def test_a_scrub_hashes_nothing_and_tells_what_hashes_would(spark):
    p = spark.createDataFrame([(str(i), t) for i, t in enumerate(_odd_texts())], "payload_id string, json string")
    changed, report = reservoir.scrub(p, "logs", ["d"], ["c"])
    assert "sha2" not in report._jdf.queryExecution().optimizedPlan().toString()
    both = otlp.redact(p.withColumn("old", otlp.batch_hash(F.col("json"))), "logs", ["d"], ["c"])
    want = {r.payload_id for r in both.where(~otlp.batch_hash(F.col("json")).eqNullSafe(F.col("old"))).collect()}
    assert {r.payload_id for r in changed.collect()} == want and len(want) > 30


def test_payload_items_are_made_after_the_shuffle(spark):
    """Rows travel as columns: as trees they took two and a half times the bytes."""
    e, m = (adapters.rows(spark, "/root/testdata/sf0.001", n) for n in ("events", "metrics"))
    for p in (payloads.log_payloads(e), payloads.metric_payloads(m)):
        plan = p._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "stringValue" not in plan[plan.index("Exchange") :]


def test_hashes_of_turned_payloads_need_one_pass(spark):
    """Payloads are built and hashed where they stand; before, three sets of them were joined."""
    plan = QUERIES["p14_batch_hash"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("collect_list") == 1


def test_walk_finds_keys_at_any_depth(spark):
    p = spark.createDataFrame([("p", "logs", PAYLOAD.replace('"scope":{"name":"s"}', '"scope":{"attributes":[{"key":"tag","value":{"kvlistValue":{"values":[{"key":"in","value":{"doubleValue":0.5}}]}}}]}')), ("q", "logs", "no json")], "payload_id string, signal string, json string")
    got = {(r.path, r.value) for r in otlp.all_attrs(p).collect()}
    assert ("in", "0.5") in got and ("tag", '{"kvlistValue":{"values":[{"key":"in","value":{"doubleValue":0.5}}]}}') in got and ("session.id", "own") in got and ("k", "7") in got


def test_leaks_are_told_from_denied_keys_only(spark):
    """Keys that nobody denied are dropped before payloads are grouped."""
    paths = spark.createDataFrame([("p", "logs", "n", "secret.token"), ("p", "logs", "m", "secret.token"), ("q", "logs", "n", "k")], "payload_id string, signal string, name string, path string").distinct()
    found = otlp.redaction_leaks(paths, profile.catalogue_frame(paths, otlp.CATALOGUE))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    semi = plan.index("LeftSemi")
    assert [tuple(r) for r in found.collect()] == [("secret.token", 1)] and "payload_id" in plan[semi:] and "count(distinct payload_id" in plan[:semi]


def test_records_of_all_point_kinds(spark):
    point = '{"dataPoints":[{"attributes":[{"key":"a","value":{"stringValue":"v"}}]}]}'
    json = '{"resourceMetrics":[{"scopeMetrics":[{"metrics":[' + ",".join(f'{{"name":"{k}","{k}":{point}}}' for k in ("gauge", "sum", "histogram", "exponentialHistogram", "summary")) + f',{{"gauge":{point}}}]}}]}}]}}'
    m = spark.createDataFrame([("p", json)], "payload_id string, json string")
    got = sorted((r.signal, r.name, r.attrs.get("a")) for r in otlp.records(m, m.limit(0)).collect())
    assert got == sorted([("metrics", k, "v") for k in ("gauge", "sum", "histogram", "exponentialHistogram", "summary")] + [("resource", "*", None)])


def test_derived_columns_take_own_sources_first(spark):
    rows = spark.createDataFrame([({"a": "", "os": "linux"},), ({"a": "x", "os": "linux"},), ({},)], "attrs map<string,string>")
    derived = (otlp.Derived("resource", "where", ("os",)), otlp.Derived("logs", "where", ("a", "b")))
    assert [r.where for r in otlp.promote(rows, (), "logs", derived).collect()] == ["linux", "x", None]


def test_histogram_and_cumulative_points(spark):
    json = (
        '{"resourceMetrics":[{"scopeMetrics":[{"metrics":[{"name":"h","histogram":{"aggregationTemporality":"1","dataPoints":[{"timeUnixNano":"1000","sum":2.5,"count":"4"}]}},'
        '{"name":"g","gauge":{"dataPoints":[{"timeUnixNano":"1000","asInt":"3"}]}},{"name":"c","sum":{"aggregationTemporality":"2","dataPoints":[{"timeUnixNano":"1000","asDouble":1.5}]}}]}]}]}'
    )
    got = {(r.metric_name, r.value_kind, r.value, r["count"]) for r in otlp.explode_metrics(spark.createDataFrame([(json,)], ["json"])).collect()}
    assert got == {("h", "hist_sum", 2.5, 4), ("g", "gauge_last", 3.0, None), ("c", "sum_cumulative", 1.5, None)}


def test_first_truthy_falls_through_empty_and_zero(spark):
    df = spark.createDataFrame([({"a": "", "b": "0", "c": "x"},)], "m map<string,string>")
    assert df.select(C.first_truthy(F.col("m"), ["a", "missing", "b", "c"])).first()[0] == "x"


def test_silence_ends_at_a_missing_day(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1), 5), ("a", D(2024, 1, 2), 0), ("a", D(2024, 1, 3), 0), ("b", D(2024, 1, 1), 0), ("b", D(2024, 1, 3), 0)], "subject string, day date, n int")
    got = {r.subject: r.silent_days for r in quality.silence_run(df, D(2024, 1, 1), D(2024, 1, 3)).collect()}
    assert got == {"a": 2, "b": 1}


def test_standing_since_restarts_after_a_gap(spark):
    df = spark.createDataFrame([(D(2024, 1, d), "t", "s") for d in (1, 3, 4)] + [(D(2024, 1, d), "t", "other") for d in (1, 2)], "cycle date, finding_type string, subject string")
    assert [(r.subject, r.first_seen, r.standing_since, r.cycles) for r in quality.current_findings(df).collect()] == [("s", D(2024, 1, 1), D(2024, 1, 3), 2)]


FOUND = "finding_type string, subject string, kind string, row_count long, details string"


def test_a_cycle_that_is_in_is_not_detected_again(spark, tmp_path):
    ran = []

    def found():
        ran.append(1)
        return spark.createDataFrame([("t", "s", "defect", 1, "{}")], "finding_type string, subject string, kind string, row_count long, details string")

    done = [detection.append_cycle(spark, str(tmp_path), dt.date(2024, 1, day), found) for day in (2, 2, 1, 3)]
    assert done == [True, False, False, True] and len(ran) == 2


def test_cycles_append_once_and_one_that_finds_nothing_counts(spark, tmp_path):
    root = f"file://{tmp_path}/log"
    some = spark.createDataFrame([("t", "s", "defect", 2, "{}"), ("g", "s", "gauge", None, None)], FOUND)
    assert detection.append_cycle(spark, root, D(2024, 1, 1), some)
    assert not detection.append_cycle(spark, root, D(2024, 1, 1), some) and not detection.append_cycle(spark, root, D(2023, 12, 1), some)
    assert detection.append_cycle(spark, root, D(2024, 1, 2), some.limit(0))
    log, cycles = detection.read_log(spark, root)
    assert log.count() == 2 and sorted((c.cycle.day, c.findings) for c in cycles.collect()) == [(1, 2), (2, 0)]
    assert detection.open_findings(log, cycles).count() == 0
    detection.append_cycle(spark, root, D(2024, 1, 3), some.withColumn("row_count", F.lit(7).cast("long")))
    found = detection.open_findings(*detection.read_log(spark, root))
    assert sorted((r.finding_type, r.first_seen, r.standing_since, r.cycles, r.row_count) for r in found.collect()) == [(t, D(2024, 1, 1), D(2024, 1, 3), 1, 7) for t in "gt"]
    assert [tuple(r) for r in detection.open_defects(found).collect()] == [("t", 1, D(2024, 1, 3))]


def test_a_mart_added_to_the_graph_is_written(spark, tmp_path):
    built = []

    def shared(n):
        built.append("shared")
        return n.where("x > 1")

    nodes = {
        "last": refresh.Node(("added", "numbers"), lambda a, n: n.join(a, "x", "left_anti")), "added": refresh.Node(("part",), lambda p: p.where("x < 4")),
        "part": refresh.Node(("numbers",), shared, mart=False), "other": refresh.Node(("part",), lambda p: p),
    }
    numbers = spark.createDataFrame([(x,) for x in range(6)], "x int")
    for _ in range(2):
        log = refresh.refresh(spark, nodes, {"numbers": numbers}, str(tmp_path))
    assert {r.mart: r.row_count for r in log.collect()} == {"added": 2, "other": 4, "last": 4} and built == ["shared"] * 2
    assert spark.read.parquet(str(tmp_path / "_refresh_log")).count() == 6
    with pytest.raises(ValueError, match="nothing"):
        refresh.refresh(spark, nodes | {"bad": refresh.Node(("nothing",), lambda x: x)}, {"numbers": numbers}, str(tmp_path))


def test_paths_of_many_values_drop_out_before_grouping(spark):
    rows = [("logs", None if x % 3 else {"user.email": f"s{x % 2}"}, {"id": str(x), "few": str(x % 25), "more": str(x % 26)}) for x in range(3000)]
    recs = spark.createDataFrame(rows, "signal string, resource map<string,string>, attrs map<string,string>")
    flat = recs.select("signal", F.explode("attrs").alias("path", "value"))
    left = {r.path for r in profile.few_valued(flat, ["signal", "path"], 25).collect()}
    assert "few" in left and "id" not in left
    got = profile.seat_reach(recs).collect()
    assert {r.path for r in got} == {"few"} and len(got) == 25 and {r.seats for r in got} == {2}
    assert profile.seat_reach(recs.limit(0)).count() == 0


def test_profile_counts_people_without_a_row_of_each_path(spark):
    """Sessions and seats come from lists of paths: no NULL counts, and a record is not multiplied by what is counted."""
    rows = [("logs", "a", {"x": "1", "session.id": s}, {"user.email": u} if u else {}) for s, u in (("s1", "u1"), ("s1", "u2"), ("s2", "u1"), ("s2", None))]
    rows += [("logs", "a", {"y": "2"}, {}), ("logs", "a", None, {"user.email": "u9"})]
    recs = spark.createDataFrame(rows, "signal string, name string, attrs map<string,string>, resource map<string,string>")
    out = profile.record_profile(recs)
    assert {(r.path, r.records, r.sessions, r.seats, r.share) for r in out.collect()} == {("x", 4, 2, 2, 4 / 6), ("session.id", 4, 2, 2, 4 / 6), ("y", 1, 0, 0, 1 / 6)}
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_shares_of_paths_look_at_no_value(spark):
    """The same records and shares as the whole profile, without its sessions, seats and values."""
    rows = [("logs", "a", {"x": "1", "y": "2"}, {}), ("logs", "a", {"x": "3"}, {}), ("logs", "a", {}, {}), ("metrics", "a", {"x": None}, {})]
    recs = spark.createDataFrame(rows, "signal string, name string, attrs map<string,string>, resource map<string,string>")
    keys = ["signal", "name", "path", "records", "share"]
    short = profile.path_shares(recs)
    assert sorted(short.collect()) == sorted(profile.record_profile(recs).select(*keys).collect()) and short.count() == 3
    assert "Join" not in short._jdf.queryExecution().optimizedPlan().toString()


def test_drift_decodes_each_payload_once(spark):
    plan = QUERIES["c8_c9_c10_basis_drift"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan  # claims are judged on written records


def test_missing_names_are_unknown_literals(spark):
    df = spark.createDataFrame([("a",), (None,), ("z",)], "name string")
    assert {r.name for r in profile.unknown_literals(df, "name", ["a"]).collect()} == {None, "z"}


def test_a_backfill_loads_once_by_name(spark, tmp_path):
    schema = "session_id string, user_email string, scope_name string, activity_date date"
    staged = spark.createDataFrame([(None, None, None, D(2024, 1, 1)), ("s", "a@corp.example", "drop", D(2024, 1, 1)), ("t", "a@corp.example", "keep", None)], schema)
    root = f"file://{tmp_path}/b"
    assert reconcile.load_backfill(spark, root, "one", staged, staged.limit(0), scopes=["drop"]) == 1
    assert reconcile.load_backfill(spark, root, "one", staged, staged.limit(0), scopes=[]) is None
    assert sorted(str(r.scope_name) for r in Commits(spark, root).read("backfilled", staged.schema).collect()) == ["None", "keep"]


def test_purge_tells_both_facts_and_keeps_what_it_cannot_judge(spark):
    t = dt.datetime(2024, 1, 1)
    e = spark.createDataFrame([("a@x.example", t), (None, t), ("b@corp.example", t)], "user_email string, event_time timestamp")
    m = spark.createDataFrame([("c@y.example", t), ("d@x.example", dt.datetime(2024, 2, 1))], "user_email string, ts timestamp")
    condition = ~F.col("user_email").endswith("@corp.example")
    kept_e, kept_m, finding = reconcile.purge_facts(e, m, condition, dt.datetime(2024, 1, 15), "gone")
    assert (kept_e.count(), kept_m.count()) == (2, 1)
    assert tuple(finding.first()) == ("gone", "(dataset)", "gauge", 2, '{"events":1,"metrics":1,"domains":["x.example","y.example"]}')
    assert reconcile.purge_facts(e.limit(0), m.limit(0), condition, t, "gone")[2].first().row_count == 0


def test_cohorts_partition_the_instrumented(spark):
    daily = spark.createDataFrame([("a", D(2024, 1, 20)), ("b", D(2024, 1, 5)), ("b", D(2024, 1, 20)), ("c", D(2023, 12, 1)), ("c", D(2024, 1, 20))], "user_email string, activity_date date")
    people = spark.createDataFrame([(x,) for x in "abcd"], "user_email string")
    first = daily.groupBy("user_email").agg(F.min("activity_date").alias("first_seen_date"))
    got = {r.user_email: r.cohort for r in kpis.cohorts(people, daily, (D(2024, 1, 16), D(2024, 1, 30)), (D(2024, 1, 1), D(2024, 1, 15)), first).collect()}
    assert got == {"a": "new", "b": "retained", "c": "reactivated", "d": "idle"}


def test_ratio_of_nothing_is_null(spark):
    assert spark.range(1).select(kpis.ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_ingest_twice_adds_nothing(spark):
    p = spark.createDataFrame([("logs", D(2024, 1, 1), "1", '{"b":1,"a":2}'), ("logs", D(2024, 1, 1), "2", '{"a":2,"b":1}')], "signal string, dt date, payload_id string, json string")
    fresh, more = reservoir.ingest(p, spark.createDataFrame([], "batch_hash string"))
    assert fresh.count() == 1
    again, _ = reservoir.ingest(p, more)
    assert again.count() == 0


def stream_of(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).parquet(str(tmp_path / "in"))


def run(spark, df, tmp_path, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_ingested_payloads_are_hashed_once(spark):
    """What is fresh and what the ledger gets are read from one table: neither hashes a payload again."""
    p = spark.createDataFrame([("logs", "a", PAYLOAD), ("logs", "b", PAYLOAD)], "signal string, payload_id string, json string")
    for df in reservoir.ingest(p, spark.createDataFrame([], "batch_hash string")):
        assert "sha2" not in df._jdf.queryExecution().optimizedPlan().toString() and df.count() == 1


def test_stream_dedupe_within_horizon(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    s = stream_of(spark, tmp_path, [(t, '{"a":1,"b":2}'), (t, '{"b":2,"a":1}'), (t, '{"a":3}')], "at timestamp, json string")
    run(spark, ingest.dedupe(s, "at"), tmp_path, "deduped")
    assert spark.table("deduped").count() == 2


def test_stream_throttle_equals_batch(spark, tmp_path):
    s = stream_of(spark, tmp_path, [("a", us) for us in range(0, 1000, 100)] + [("b", 50)], "key string, us long")
    run(spark, ingest.throttle_stream(s, gap_us=300), tmp_path, "throttled", "append")
    got = sorted((r.key, r.us) for r in spark.table("throttled").collect())
    assert got == [("a", 0), ("a", 300), ("a", 600), ("a", 900), ("b", 50)]
    batch = spark.createDataFrame([("a", us) for us in range(0, 1000, 100)] + [("b", 50)], "k string, us long").withColumn("t", F.timestamp_micros("us"))
    assert sorted((r.key, r.us) for r in ingest.throttle_batch(batch, "k", "t", gap_us=300).collect()) == got


def test_ingest_over_several_batches_stores_each_payload_once(spark, tmp_path):
    root, sink, checkpoint = (f"file://{tmp_path}/{n}" for n in ("raw", "sink", "ck"))
    rows = [("logs", D(2024, 1, d), str(d), PAYLOAD.replace('"7"', f'"{d}"')) for d in range(1, 5)]
    point = '{"resourceMetrics":[{"scopeMetrics":[{"metrics":[{"name":"m","gauge":{"dataPoints":[{"timeUnixNano":"1704067200000000000","asInt":"3","attributes":[{"key":"k","value":{"intValue":"9"}}]}]}}]}]}]}'
    frame = lambda some: spark.createDataFrame(some, "signal string, dt date, payload_id string, json string")
    stored = []
    for some in (rows[:2], rows[:3], [rows[3], ("metrics", D(2024, 1, 4), "m", point), ("logs", D(2024, 1, 4), "odd", "no json")], rows):
        reservoir.write_raw(frame(some), root)
        ingest.continuous_ingest(ingest.payload_stream(spark, root), sink, checkpoint, ["secret.token"], ["prompt.text"]).awaitTermination()
        stored.append(sorted(r.k for s in ("logs", "metrics") for r in store.read_facts(spark, sink, s).collect()))
    assert stored == [[1, 2], [1, 2, 3], [1, 2, 3, 4, 9], [1, 2, 3, 4, 9]]
    assert Commits(spark, sink).read("ledger", store.LEDGER).count() == 5
    assert [r.reason for r in Commits(spark, sink).read("quarantine", store.QUARANTINE).collect()] == ["no JSON"]


def test_a_new_checkpoint_in_the_same_place_loses_nothing(spark, tmp_path):
    import shutil

    root, sink, checkpoint = (f"file://{tmp_path}/{n}" for n in ("raw", "sink", "ck"))
    for d in (1, 2):
        reservoir.write_raw(spark.createDataFrame([("logs", D(2024, 1, d), str(d), PAYLOAD.replace('"7"', f'"{d}"'))], store.PAYLOAD), root)
        ingest.continuous_ingest(ingest.payload_stream(spark, root), sink, checkpoint, [], []).awaitTermination()
        shutil.rmtree(tmp_path / "ck")  # the stream begins with batch 0 again
    assert sorted(r.k for r in store.read_facts(spark, sink, "logs").collect()) == [1, 2]


def test_a_batch_that_dies_between_two_tables_leaves_nothing(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/store"
    p = spark.createDataFrame([("logs", D(2024, 1, 1), "1", PAYLOAD)], store.PAYLOAD)
    real = Commits.write

    def dying(self, table, rows, day):
        if table == "ledger":
            raise OSError("lost")
        return real(self, table, rows, day)

    monkeypatch.setattr(Commits, "write", dying)
    with pytest.raises(OSError, match="lost"):
        store.ingest(spark, root, p, [], [])
    assert store.read_facts(spark, root, "logs").count() == 0 and list((tmp_path / "store" / "events").iterdir())
    monkeypatch.undo()
    assert store.ingest(spark, root, p, [], []) == 1 and store.ingest(spark, root, p, [], [], batch=("s", 0)) == 2
    assert store.ingest(spark, root, p, [], [], batch=("s", 0)) is None
    assert store.read_facts(spark, root, "logs").count() == 1 and Commits(spark, root).read("ledger", store.LEDGER).count() == 1
    monkeypatch.setattr(Commits, "write", dying)
    with pytest.raises(OSError, match="lost"):  # an interrupted replay leaves the old rows
        store.replay(spark, root, p.limit(0), [], [], dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert store.read_facts(spark, root, "logs").count() == 1


def test_unknown_signals_are_an_error(spark, tmp_path):
    p = spark.createDataFrame([("traces", D(2024, 1, 1), "1", PAYLOAD)], store.PAYLOAD)
    with pytest.raises(Exception, match="no fact takes the signal traces"):
        store.ingest(spark, f"file://{tmp_path}/store", p, [], [])


def test_manifests_are_read_from_the_last_snapshot(spark, tmp_path):
    commits = Commits(spark, f"file://{tmp_path}/store")
    parts = [Part("t", f"t/{i}", "2024-01-01", f"2024-01-{i % 28 + 1:02d}") for i in range(70)]
    for i, part in enumerate(parts):
        commits.commit([part], [parts[i - 1]] if i % 2 else [], ("s", i))
    (tmp_path / "store" / "_commits" / "000000000001.json").unlink()  # behind two snapshots
    state = commits.state()
    assert state.number == 70 and state.batches == {"s": 69} and sorted(state.live) == sorted(p.path for p in parts[1::2])
    assert all(p.last >= "2024-01-20" for p in state.parts("t", since=D(2024, 1, 20)))


def test_walk_of_plain_payloads_needs_no_scan_and_equals_it(spark, monkeypatch):
    o = '{"key":"o","value":{"%s":%s}}'
    plain = [o % x for x in (("intValue", '"1"'), ("doubleValue", "1.50"), ("boolValue", "true"), ("stringValue", '""'), ("stringValue", "null"), ("stringValue", '"a, {b} [c]"'))]
    texts = ['{"x":[%s]}' % ",".join(plain), "{}", '{"a":{"b":%s}}' % plain[0]]
    rest = ['{"x":[%s,{"key":"n","value":{"kvlistValue":{"values":[%s]}}}]}' % (plain[0], plain[1]), '{"x":["key"]}', '{"x":{"key" : "a","value":1}}', '{"x":%s}]' % plain[0], '{"x":%s} y' % plain[0], '{"x":%s' % plain[0], '{"x":{"value":7,"key":"k"}}', None]
    frame = lambda of: spark.createDataFrame([(str(i), "logs", t) for i, t in enumerate(of)], "payload_id string, signal string, json string")
    told = lambda of: sorted((r.payload_id, r.path, r.value) for r in otlp.all_attrs(frame(of)).collect())
    want = lambda of: sorted((str(i), k, v) for i, t in enumerate(of) if t for k, v in spans.pairs(t))
    assert told(texts + rest) == want(texts + rest)
    monkeypatch.setattr(otlp, "spans", types.SimpleNamespace(pairs=_never))
    assert told(texts) == want(texts)


def test_spans_leave_the_rest_byte_for_byte():
    from loamline.functions import plain, spans

    cut = lambda text, denied="d", content="c": spans.without(text, frozenset([denied]), frozenset([content]))
    d, o = '{"key":"d","value":{"stringValue":"x"}}', '{ "key" : "o", "value":{"doubleValue": 1.10} }'
    for items, want in (
        (f"{d}, {o}", o), (f"{o} , {d}", o + " "), (f"{d},{o} ,{d}", o + " "), (f"{o},{d},{d}", o), (d, ""), (f" {d} , {d} ", "  "), (f"{o},{d},{o}", f"{o},{o}"), ("1, " + d + ", [2]", "1, [2]"),
    ):
        text = '{"a": 1e400, "n":12345678901234567890.123,"attributes":[%s]}'
        assert cut(text % items) == (text % want, 0)
    deep = "[" * 200_000 + "]" * 200_000
    assert cut('{"attributes":[%s],"deep":%s}' % (d, deep)) == ('{"attributes":[],"deep":%s}' % deep, 0)
    assert spans.pairs('{"x":{"key":"a","value":%s}}' % deep) == [("a", deep)]
    assert cut('{"attributes":[{"key":"\\u0064","value":1}]}'.replace("\\\\", "\\")) == ('{"attributes":[]}', 0)  # an escaped name
    assert cut('{"attributes":[{"key":["d"],"value":1},{"key":{"d":1}}]}')[0].count("key") == 2
    assert cut('{"attributes":[{"value":{"kvlistValue":{"values":[{"key":"d"}],"attributes":[%s,%s]}},"key":"o"}]}' % (d, o))[0].count('"d"') == 1
    assert cut("{oops") == (None, 0) == cut('{"a":1') and cut('"text"') == ('"text"', 0)
    assert spans.pairs('{"key":"s","value":"\\ud800 x"}'.replace("\\\\", "\\")) == [("s", "? x")] and spans.pairs('{"key":"n","value": 5 , "z":[]}') == [("n", "5")]
    log = '{"resourceLogs":[{"resource":{"attributes":[C]},"scopeLogs":[{"logRecords":[{"attributes":[C]}]}]}]}'
    for value, leaks in (('{"stringValue":""}', 0), ('{"stringValue":"s"}', 1), ('{"intValue":"0"}', 1), ('{"stringValue":null,"boolValue":false}', 1), ('{"stringValue":"","intValue":"1"}', 0), ("{}", 0), ("7", 0)):
        c = '{"key":"c","value":%s}' % value
        assert cut(log.replace("C", c)) == (log.replace("C", c, 1).replace("[C]", "[]"), leaks)
    assert [spans.fault(x) for x in ("{oops", '{"a":1,"a":2}', '{"a":[{"b":1,"b":1}]}', "[" * 100_000 + "]" * 100_000)] == ["no JSON", "repeated key", "repeated key", "too deep"]


def test_payloads_that_are_none_stop_nothing(spark):
    texts = ["{oops", '{"a":1,"a":2}', None, PAYLOAD, "{}", '{"key":"k","value":{"stringValue":"\\ud800"}}'.replace("\\\\", "\\")]
    p = spark.createDataFrame([("logs", D(2024, 1, 1), str(i), t) for i, t in enumerate(texts)], store.PAYLOAD)
    assert p.select(otlp.batch_hash(F.col("json")).alias("h")).where("h IS NULL").count() == 1
    assert [r.reason for r in otlp.quarantined(p).orderBy("payload_id").collect()] == ["no JSON", "repeated key", "no text", None, None, None]
    assert reservoir.scrub(p, "logs", ["secret.token"], [])[1].first().rewritten == 2 and otlp.all_attrs(p).count() == 8


def archive(spark, root):
    rows = [("logs", D(2024, 1, d), str(d), PAYLOAD if d > 1 else '{"a": 1.10}') for d in (1, 2, 3)] + [("logs", D(2024, 1, 3), "odd", "no json")]
    for row in rows:
        reservoir.write_raw(spark.createDataFrame([row], store.PAYLOAD), root)


def test_plans_come_from_listings(spark, tmp_path):
    raw, small = f"file://{tmp_path}/raw", f"file://{tmp_path}/small"
    archive(spark, raw)
    days = lambda plan: sorted(r.dt.day for r in plan.collect())
    mine = reservoir.listed(spark, raw)
    plan = lambda *a, **k: reservoir.compaction_plan(mine, reservoir.listed(spark, small), *a, **k)
    assert days(plan(D(2024, 1, 3))) == [1, 2] and days(plan(D(2024, 1, 9), D(2024, 1, 2), D(2024, 1, 2))) == [2]
    text = plan(D(2024, 1, 3))._jdf.queryExecution().toString()
    assert "binaryFile" in text and "FileScan text" not in text and "content" not in text.split("Physical Plan")[-1]
    reservoir.compact(reservoir.read_raw(spark, raw, ["logs"], D(2024, 1, 1), D(2024, 1, 1)), plan(D(2024, 1, 2)), small)
    assert days(plan(D(2024, 1, 9))) == [2, 3] and days(plan(D(2024, 1, 9), rebuild=True)) == [1, 2, 3]
    assert reservoir.inventory_diff(mine, reservoir.listed(spark, small), D(2024, 1, 3)).first().missing == 2


def test_archives_have_few_files_a_day(spark, tmp_path):
    """Many tasks that hold rows of a day leave one small file of it, not one each."""
    from loamline.plans.archive import by_day

    p = spark.range(64).selectExpr("'logs' AS signal", "DATE '2024-01-01' AS dt", "CAST(id AS STRING) AS payload_id", "'{}' AS json").repartition(16)
    reservoir.write_raw(by_day(p), str(tmp_path / "raw"))
    assert reservoir.listed(spark, str(tmp_path / "raw")).count() == 1


def test_newest_write_is_told_from_names(spark):
    f = lambda *names: spark.createDataFrame([("logs", D(2024, 1, 1), n) for n in names], "signal string, dt date, name string")
    r = reservoir.inventory_diff(f("101500-a", "235959-b", "250000-c", "d", "d"), f("101500-a", "235958-z")).first()
    assert (r.names, r.missing, r.first_name, r.target_names, r.newest_source, r.newest_target, r.untimed) == (4, 3, "235959-b", 2, dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 1, 23, 59, 58), 2)


def test_scrub_rewrites_dirty_files_only(spark, tmp_path, monkeypatch):
    root, window = f"file://{tmp_path}/raw", (D(2024, 1, 1), D(2024, 1, 9))
    archive(spark, root)
    files = lambda: {r.path: r.modified for r in reservoir.listed(spark, root).collect()}
    texts = lambda: sorted(r.json for r in reservoir.read_raw(spark, root, ["logs"], *window).collect())
    before, said = files(), texts()
    dry = reservoir.scrub_archive(spark, root, "logs", ["secret.token"], ["prompt.text"], *window)
    assert {(r.dt.day, r.files, r.dirty_files, r.rewritten, r.leaks) for r in dry.collect()} == {(1, 1, 0, 0, 0), (2, 1, 1, 1, 1), (3, 2, 1, 1, 1)} and files() == before
    finish = reservoir.finish_swap
    monkeypatch.setattr(reservoir, "finish_swap", lambda *a: False)  # dies when all is written down
    reservoir.scrub_archive(spark, root, "logs", ["secret.token"], ["prompt.text"], *window, execute=True)
    assert files() == before and texts() == said
    monkeypatch.undo()
    assert finish(spark, root) and not finish(spark, root)
    after = files()
    assert sum(after.get(p) == t for p, t in before.items()) == 2 and len(after) == 4
    now = texts()
    assert len(now) == 4 and not any("secret.token" in t for t in now) and {'{"a": 1.10}', "no json"} <= set(now)


def test_throttle_state_goes_with_time(spark, tmp_path):
    """A key that was silent for a gap has no state left; one that goes on keeps it, across restarts of the stream."""
    second = 1_000_000
    for rows in [[("a", 0), ("b", 1), (None, 2), ("b", None)], [("a", 200), ("c", 250)], [("a", 310), ("c", 900)], [("a", 2000), ("d", 2000)], [("d", 2001)]]:
        df = spark.createDataFrame(rows, "key string, us long").withColumn("us", F.col("us") * second)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        s = spark.readStream.schema("key string, us long").parquet(str(tmp_path / "in"))
        q = ingest.throttle_stream(s, gap_us=300 * second, late="0 seconds").writeStream.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()
        assert q.exception() is None
    got = sorted((str(r.key), r.us // second) for r in spark.read.schema("key string, us long").parquet(str(tmp_path / "out")).collect())
    assert got == [("None", 2), ("a", 0), ("a", 310), ("a", 2000), ("b", 1), ("c", 250), ("c", 900), ("d", 2000)]
    state = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "ck"))
    assert {r.k for r in state.select(F.col("key.key").alias("k")).collect()} == {"a", "d"}


def test_throttle_takes_rows_and_asks_once():
    """A key's rows come as rows, not as a frame, and its state is asked for once."""
    from pyspark.sql import Row

    asked = []

    class Last:
        def get(self):
            asked.append("get")
            return (100,)

        def update(self, value):
            asked.append(value)

    t = ingest.Throttle(50)
    t.last = Last()
    got = list(t.handleInputRows(("a",), iter([Row(key="a", us=u) for u in (220, 149, 150, 90, 199)]), None))
    assert got == [Row(key="a", us=150), Row(key="a", us=220)] and asked == ["get", (220,)]


def test_groups_of_sorted_batches(spark):
    import pyarrow as pa

    batches = [[("a", 1), ("a", 1)], [("a", 1)], [("b", 1), (None, 1)], [(None, 1)], [(None, 2)], [], [("c", 2), ("c", 3), ("d", 3)], [("d", 3)], [("e", 3)]]
    rows = [pa.RecordBatch.from_pydict({"k": pa.array([k for k, _ in b], pa.string()), "n": pa.array([n for _, n in b], pa.int64())}) for b in batches]
    parts = [list(zip(*t.to_pydict().values(), strict=True)) for t in ingest._groups(iter(rows), ["k", "n"])]
    assert [r for p in parts for r in p] == [r for b in batches for r in b]
    assert all(not set(p) & set(q) for i, p in enumerate(parts) for q in parts[:i]) and max(map(len, parts)) <= 4


@pytest.mark.parametrize("block", [0, 700, 5000])
def test_throttle_over_blocks_equals_a_fold(spark, block):
    import random

    r = random.Random(5)
    rows = [(k, r.randrange(20_000)) for k in ["a"] * 400 + ["b"] * 20 + [None] * 30] + [("c", 5), ("c", 5), ("d", None)]
    df = spark.createDataFrame(rows, "k string, us long").select("k", F.timestamp_micros("us").alias("t")).repartition(3)
    got = sorted((str(x.key), x.us) for x in ingest.throttle_batch(df, "k", "t", gap_us=300, block_us=block).collect())
    want = []
    for k in {k for k, _ in rows}:
        last = None
        for us in sorted(us for key, us in rows if key == k and us is not None):
            if last is None or us - last >= 300:
                want.append((str(k), us))
                last = us
    assert got == sorted(want)
    assert ingest.throttle_batch(df.limit(0), "k", "t").count() == 0


def test_stream_counts_leaks(spark, tmp_path):
    s = stream_of(spark, tmp_path, [(PAYLOAD,)], "json string")
    q = run(spark, ingest.observed_leaks(s, "logs", ["secret.token"], ["prompt.text"]), tmp_path, "observed")
    seen = [p.observedMetrics["gate"] for p in q.recentProgress if "gate" in p.observedMetrics]
    assert sum(r.leaks or 0 for r in seen) == 1


def test_leaks_of_more_batches_than_spark_remembers_add_up(spark, tmp_path):
    for i in range(6):
        spark.createDataFrame([(PAYLOAD,)], "json string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        s = spark.readStream.schema("json string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        clean = ingest.observed_leaks(s, "logs", ["secret.token"], ["prompt.text"])
        seen = ingest.tallied(spark, lambda: clean.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert seen == {"leaks": 6, "payloads": 6}


def test_catalogue_is_consistent():
    seen = set()
    for e in otlp.CATALOGUE:
        assert e.status in ("promoted", "kept", "denied") and (e.signal, e.name, e.path) not in seen
        assert bool(e.column) == (e.status == "promoted") and (not e.partner or e.basis == "collinear")
        seen.add((e.signal, e.name, e.path))
