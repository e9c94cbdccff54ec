"""K01 / M19 - weekly cohort retention of assistant usage.

Grain: (signup_week, weeks_since_signup).  A cohort is the users whose signup
week lies wholly inside the observed conversation window; week N of a user is
``floor(days since the user's own signup / 7)``.

Plan shape:

* window bounds: one 1-row aggregate, broadcast (proven single row);
* activity: users ⋈ conversations on user_id (sort-merge; AQE splits a skewed
  heavy user), then a *two-level* aggregate - (week, N, user) first, then
  (week, N) - instead of ``count(distinct user)`` next to other aggregates,
  which would Expand every row;
* spine: ``explode(sequence(0, weeks to the window end))`` per cohort - no driver
  round trip and no fixed last week: a longer window has a longer spine.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.exprs import count_where, ratio


def window_bounds(conversations: DataFrame) -> DataFrame:
    return conversations.agg(
        F.min("conversation_date").alias("window_start"), F.max("conversation_date").alias("window_end")
    )


def cohort_users(users: DataFrame, bounds: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Users whose whole signup week lies inside the conversation window."""
    u = users.select("user_id", "signup_date", "signup_week", *by).crossJoin(F.broadcast(bounds))
    return u.where(
        (F.col("signup_week") >= F.col("window_start"))
        & (F.date_add("signup_week", 6) <= F.col("window_end"))
    ).select("user_id", "signup_date", "signup_week", *by)


def weekly_cohort_retention(users: DataFrame, conversations: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """K01; with user columns in ``by`` (X05: segment, signup_channel) each cohort splits by their values."""
    bounds = window_bounds(conversations)
    members = cohort_users(users, bounds, by)
    cohort = ["signup_week", *by]

    cohorts = members.groupBy(*cohort).agg(
        F.count(F.lit(1)).alias("cohort_size"), F.max("signup_date").alias("last_signup_date")
    )
    weeks_to_end = F.floor(F.datediff("window_end", "signup_week") / F.lit(7)).cast("int")
    spine = (
        cohorts.crossJoin(F.broadcast(bounds))
        .select("*", F.explode(F.sequence(F.lit(0), weeks_to_end)).alias("weeks_since_signup"))
    )

    conv = conversations.select("user_id", "conversation_date", "is_escalated")
    joined = members.join(conv, "user_id").where(F.col("conversation_date") >= F.col("signup_date"))
    week_n = F.floor(F.datediff("conversation_date", "signup_date") / F.lit(7)).cast("int")
    per_user = joined.groupBy(*cohort, week_n.alias("weeks_since_signup"), "user_id").agg(
        F.count(F.lit(1)).alias("n_conv"), count_where(F.col("is_escalated")).alias("n_esc"),
    )
    activity = per_user.groupBy(*cohort, "weeks_since_signup").agg(
        F.count(F.lit(1)).alias("n_retained_users"),
        F.sum("n_conv").alias("n_conversations"),
        F.sum("n_esc").alias("n_escalated_conversations"),
    )

    keys = [*cohort, "weeks_since_signup"]
    cells = activity.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in activity.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])   # a user column may be null
    j = spine.join(cells, same, "left")
    elapsed = F.date_add("last_signup_date", (F.col("weeks_since_signup") + 1) * 7 - 1)
    retained = F.coalesce("n_retained_users", F.lit(0))
    n_conv = F.coalesce("n_conversations", F.lit(0))
    return j.select(
        *cohort,
        F.col("weeks_since_signup").cast("long").alias("weeks_since_signup"),
        "cohort_size",
        retained.alias("n_retained_users"),
        ratio(retained, "cohort_size").alias("retention_rate"),
        n_conv.alias("n_conversations"),
        ratio(n_conv, "cohort_size").alias("conversations_per_cohort_user"),
        F.coalesce("n_escalated_conversations", F.lit(0)).alias("n_escalated_conversations"),
        elapsed.alias("week_fully_elapsed_on"),
        (elapsed <= F.col("window_end")).alias("is_fully_observable"),
    )
