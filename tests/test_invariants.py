"""Q10-Q17: each invariant fires on a frame that violates it and is silent on one that does not."""
import datetime as dt

from ledgerlark.operators import invariants as V

D = dt.date


def test_cohort_sizes(spark):
    ret = spark.createDataFrame([(D(2024, 1, 1), 2, 0), (D(2024, 1, 1), 2, 1), (D(2024, 1, 8), 3, 0), (D(2024, 1, 15), 1, 0)],
                                "signup_week date, cohort_size long, weeks_since_signup long")
    users = spark.createDataFrame([(D(2024, 1, 1),)] * 2 + [(D(2024, 1, 8),)] * 2, "signup_week date")
    assert {tuple(r) for r in V.cohort_sizes_match_users(ret, users).collect()} == {(D(2024, 1, 8), 3, 2), (D(2024, 1, 15), 1, None)}


def test_cost_ledger(spark):
    conv = spark.createDataFrame([(1.0,), (2.0,)], "cost_usd double")
    req = spark.createDataFrame([(3.0, False), (9.0, True)], "cost_usd double, is_orphan boolean")
    assert V.conversation_cost_matches_ledger(conv, req).count() == 0
    bad = V.conversation_cost_matches_ledger(conv, req.unionByName(req)).collect()
    assert [tuple(r) for r in bad] == [(3.0, 6.0, -3.0)]


def test_mismatch_slo(spark):
    daily = spark.createDataFrame([(D(2024, 1, 1), 100, 3), (D(2024, 1, 2), 100, 2), (D(2024, 1, 3), 0, 0)],
                                  "metric_date date, n_requests long, n_cost_mismatches long")
    assert [tuple(r) for r in V.cost_mismatch_rate_within_slo(daily, 0.02).collect()] == [(D(2024, 1, 1), 100, 3, 0.03)]


def test_daily_cost(spark):
    daily = spark.createDataFrame([(D(2024, 1, 1), 5.0), (D(2024, 1, 2), 1.0), (D(2024, 1, 3), 2.0)], "metric_date date, total_cost_usd double")
    ledger = spark.createDataFrame([(D(2024, 1, 1), 2.0), (D(2024, 1, 1), 3.0), (D(2024, 1, 2), 1.5), (D(2024, 1, 4), 7.0)],
                                   "request_date date, total_cost_usd double")
    got = {r.metric_date: r.delta_usd for r in V.daily_cost_reconciles(daily, ledger).collect()}
    assert got == {D(2024, 1, 2): -0.5, D(2024, 1, 3): 2.0, D(2024, 1, 4): -7.0}


def test_request_dates(spark):
    req = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),), (D(2024, 1, 2),)], "request_date date")
    daily = spark.createDataFrame([(D(2024, 1, 1),)], "metric_date date")
    assert [tuple(r) for r in V.every_request_date_has_daily_row(req, daily).collect()] == [(D(2024, 1, 2), 2)]


def test_accuracy(spark):
    s = "n_correct_predictions long, n_reviewed_predictions long"
    a, b = spark.createDataFrame([(9, 10)], s), spark.createDataFrame([(4, 5), (4, 5)], s)
    assert V.intent_accuracy_consistent(a, a).count() == 0
    assert [tuple(r) for r in V.intent_accuracy_consistent(a, b).collect()] == [(0.9, 0.8)]


def test_week_zero(spark):
    week = D(2024, 1, 1)
    users = spark.createDataFrame([("u1", week, D(2024, 1, 2)), ("u2", week, D(2024, 1, 3))], "user_id string, signup_week date, signup_date date")
    conv = spark.createDataFrame([("u1", D(2024, 1, 8)), ("u1", D(2024, 1, 8)), ("u2", D(2024, 1, 10))], "user_id string, conversation_date date")
    s = "signup_week date, weeks_since_signup long, n_retained_users long"
    assert V.retention_week0_recomputed(spark.createDataFrame([(week, 0, 1), (week, 1, 5)], s), users, conv).count() == 0
    assert [tuple(r) for r in V.retention_week0_recomputed(spark.createDataFrame([(week, 0, 2)], s), users, conv).collect()] == [(week, 2, 1)]


def test_incident(spark):
    day, s = D(2024, 2, 11), "metric_name string, metric_date date, is_anomaly boolean, is_actionable_anomaly boolean"
    good = [(m, day, True, True) for m in V.INCIDENT_METRICS] + [("error_rate", D(2024, 2, 1), True, True), ("timeout_rate", D(2024, 2, 1), True, True)]
    assert V.anomaly_detector_flags_incident(spark.createDataFrame(good, s), str(day)).count() == 0
    bad = [(m, day, True, m != "timeout_rate") for m in V.INCIDENT_METRICS] + [("error_rate", D(2024, 2, d), True, False) for d in (1, 2)]
    got = {r.metric_name for r in V.anomaly_detector_flags_incident(spark.createDataFrame(bad, s), str(day)).collect()}
    assert got == {"timeout_rate", "error_rate"}
