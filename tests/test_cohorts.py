"""K01 on a hand-written cohort."""
import datetime as dt

from ledgerlark.operators.cohorts import weekly_cohort_retention

D = dt.date


def test_weekly_retention(spark):
    users = spark.createDataFrame([
        ("u1", D(2024, 1, 1), D(2024, 1, 1)),
        ("u2", D(2024, 1, 3), D(2024, 1, 1)),
        ("u0", D(2023, 12, 30), D(2023, 12, 25)),     # signup week starts before the window
    ], "user_id string, signup_date date, signup_week date")
    conv = spark.createDataFrame([
        ("u1", D(2024, 1, 1), False), ("u1", D(2024, 1, 8), True), ("u2", D(2024, 1, 9), False),
        ("u2", D(2024, 1, 10), False), ("u0", D(2024, 1, 2), False), ("u1", D(2024, 1, 21), False),
    ], "user_id string, conversation_date date, is_escalated boolean")
    rows = {r.weeks_since_signup: r for r in weekly_cohort_retention(users, conv).collect()}
    assert sorted(rows) == [0, 1, 2]                  # window ends 2024-01-21: weeks 0..2 started
    w0, w1, w2 = rows[0], rows[1], rows[2]
    assert w0.cohort_size == 2 and w0.n_retained_users == 2 and w0.retention_rate == 1.0
    # u2 signed up on the 3rd: the 9th is its day 6 (week 0), the 10th its day 7 (week 1)
    assert w0.n_conversations == 2
    assert w1.n_retained_users == 2 and w1.n_conversations == 2 and w1.n_escalated_conversations == 1
    assert w2.n_retained_users == 1
    assert w0.week_fully_elapsed_on == D(2024, 1, 9) and w0.is_fully_observable
    assert w2.week_fully_elapsed_on == D(2024, 1, 23) and not w2.is_fully_observable


def test_no_week_is_left_out_of_a_long_window(spark):
    """A user active in each of 60 weeks: 60 rows, every conversation counted, the grid has W59."""
    from ledgerlark.plans.reports import cohort_grid

    start = D(2023, 1, 2)
    users = spark.createDataFrame([("u1", start, start)], "user_id string, signup_date date, signup_week date")
    days = [start + dt.timedelta(days=7 * w) for w in range(60)] + [start + dt.timedelta(days=7 * 60 + 6)]
    conv = spark.createDataFrame([("u1", d, False) for d in days], "user_id string, conversation_date date, is_escalated boolean")
    out = weekly_cohort_retention(users, conv)
    rows = out.collect()
    assert len(rows) == 61 and sum(r.n_conversations for r in rows) == 61
    grid = cohort_grid(out)
    assert grid.columns[-1] == "W60" and grid.first()["W59"] == 1.0
    assert cohort_grid(out.where("false")).columns == ["signup_week", "cohort_label"]
