"""Oracle SQL for the data-quality layer: generic checks, SQL invariants, suite."""

from __future__ import annotations

from ledgerlark.operators.checks import DECLARED, RAW_DATASETS, Check, layer_of
from ledgerlark.operators.invariants import SQL_CHECKS
from ledgerlark.oracle.marts_sql import r
from ledgerlark.oracle.sql import CTE

# dataset name -> oracle CTE
DATASET_CTE = {
    "raw_users": "raw_users", "raw_conversations": "raw_conversations", "raw_llm_requests": "raw_llm_requests",
    "raw_intent_predictions": "raw_intent_predictions", "raw_escalations": "raw_escalations",
    "raw_daily_model_prices": "raw_daily_model_prices",
    "model_aliases": "s_aliases", "intent_catalog": "s_intent_catalog", "model_catalog": "s_model_catalog",
    "stg_users": "s_users", "stg_conversations": "s_conversations", "stg_llm_requests": "s_llm_requests",
    "stg_intent_predictions": "s_intent_predictions", "stg_escalations": "s_escalations",
    "stg_daily_model_prices": "s_daily_model_prices",
    "int_model_costs": "i_model_costs_view", "int_conversation_request_rollup": "i_rollup",
    "int_conversation_quality": "i_quality", "int_daily_product_metrics": "i_daily",
    "int_intent_confusion": "i_confusion",
    "dim_users": "m_dim_users", "dim_models": "m_dim_models", "dim_intents": "m_dim_intents",
    "fct_conversations": "m_fct_conversations", "fct_llm_requests": "m_fct_llm_requests",
    "fct_daily_product_metrics": "m_fct_daily", "fct_daily_model_costs": "m_fct_daily_model_costs",
    "mart_model_reliability_daily": "m_reliability", "mart_intent_quality": "m_intent_quality",
    "mart_daily_anomalies": "m_anomalies", "fct_weekly_cohort_retention": "m_retention",
}


def _lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def _val(ch: Check, col: str) -> str:
    return f"CASE WHEN trim({col}) <> '' THEN {col} END" if ch.dataset in RAW_DATASETS else col


def violation_count_sql(ch: Check) -> str:
    """Scalar SQL counting the violations of one declared check."""
    t = DATASET_CTE[ch.dataset]
    if ch.kind == "unique":
        v = _val(ch, ch.column)
        return (f"(SELECT count(*) FROM (SELECT v FROM (SELECT {v} AS v FROM {t}) x WHERE v IS NOT NULL "
                f"GROUP BY v HAVING count(*) > 1) y)")
    if ch.kind == "not_null":
        return f"(SELECT count(*) FROM {t} WHERE ({_val(ch, ch.column)}) IS NULL)"
    if ch.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in ch.values)
        return f"(SELECT count(*) FROM (SELECT {ch.column} FROM {t} WHERE {ch.column} NOT IN ({vals}) GROUP BY 1) x)"
    if ch.kind == "relationships":
        p, pc = DATASET_CTE[ch.parent[0]], ch.parent[1]
        return (f"(SELECT count(*) FROM {t} c WHERE c.{ch.column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {p} p WHERE p.{pc} = c.{ch.column}))")
    if ch.kind == "accepted_range":
        conds = []
        if ch.low is not None:
            conds.append(f"{ch.column} {'>=' if ch.inclusive else '>'} {ch.low!r}")
        if ch.high is not None:
            conds.append(f"{ch.column} {'<=' if ch.inclusive else '<'} {ch.high!r}")
        return f"(SELECT count(*) FROM {t} WHERE NOT ({' AND '.join(conds)}))"
    if ch.kind == "expression":
        return f"(SELECT count(*) FROM {t} WHERE NOT ({ch.expression}))"
    if ch.kind == "combination":
        cols = ", ".join(ch.columns)
        return f"(SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1) x)"
    raise ValueError(ch.kind)


def _row(ch: Check) -> str:
    return (f"SELECT '{ch.check_name}' AS check_name, '{ch.dataset}' AS dataset, '{layer_of(ch.dataset)}' AS layer, "
            f"'{ch.kind}' AS kind, '{ch.severity}' AS severity, {violation_count_sql(ch)} AS n_violations")


CTE["q_cohort_sizes"] = """
    SELECT signup_week, any_value(cohort_size) AS cohort_size,
           nullif((SELECT count(*) FROM m_dim_users u WHERE u.signup_week = m.signup_week), 0) AS n_users
    FROM m_retention m GROUP BY signup_week, m.cohort_size
    HAVING m.cohort_size IS DISTINCT FROM (SELECT count(*) FROM m_dim_users u WHERE u.signup_week = m.signup_week)
"""
CTE["q_conversation_cost"] = """
    SELECT sum(c) AS conversation_cost, sum(q) AS request_cost, sum(c) - sum(q) AS delta_usd
    FROM (SELECT cost_usd AS c, NULL AS q FROM m_fct_conversations
          UNION ALL SELECT NULL, cost_usd FROM m_fct_llm_requests WHERE conversation_id IS NOT NULL) both_sides
    HAVING abs(sum(c) - sum(q)) > 0.0001
"""
CTE["q_mismatch_slo"] = f"""
    SELECT metric_date, n_requests, n_cost_mismatches, share AS mismatch_rate
    FROM (SELECT *, {r('n_cost_mismatches', 'n_requests')} AS share FROM m_fct_daily) d WHERE share > 0.02
"""
CTE["q_daily_cost"] = """
    SELECT metric_date, sum(product) AS product_cost, sum(ledger) AS ledger_cost,
           coalesce(sum(product), 0) - coalesce(sum(ledger), 0) AS delta_usd
    FROM (SELECT metric_date, total_cost_usd AS product, NULL AS ledger FROM m_fct_daily
          UNION ALL SELECT request_date, NULL, total_cost_usd FROM m_fct_daily_model_costs) both_sides
    GROUP BY metric_date HAVING abs(coalesce(sum(product), 0) - coalesce(sum(ledger), 0)) > 0.0001
"""
CTE["q_request_dates"] = """
    SELECT request_date, count(*) AS n_requests FROM m_fct_llm_requests
    WHERE request_date IN (SELECT request_date FROM m_fct_llm_requests EXCEPT SELECT metric_date FROM m_fct_daily) GROUP BY request_date
"""
CTE["q_accuracy"] = f"""
    SELECT acc[1] AS daily_accuracy, acc[2] AS intent_mart_accuracy
    FROM (SELECT [(SELECT {r('sum(n_correct_predictions)', 'sum(n_reviewed_predictions)')} FROM m_fct_daily),
                  (SELECT {r('sum(n_correct_predictions)', 'sum(n_reviewed_predictions)')} FROM m_intent_quality)] AS acc) x
    WHERE abs(acc[1] - acc[2]) > 0.0001
"""
CTE["q_week0"] = """
    SELECT signup_week, n_retained_users, nullif(came, 0) AS n_week0_users
    FROM (SELECT signup_week, n_retained_users,
                 (SELECT count(*) FROM m_dim_users u WHERE u.signup_week = m.signup_week AND EXISTS (
                      SELECT 1 FROM m_fct_conversations c
                      WHERE c.user_id = u.user_id AND c.conversation_date - u.signup_date BETWEEN 0 AND 6)) AS came
          FROM m_retention m WHERE weeks_since_signup = 0) w
    WHERE n_retained_users <> came
"""
CTE["q_incident"] = """
    SELECT metric_name, problem FROM (
        SELECT metric_name, coalesce(count_if(is_actionable_anomaly AND metric_date = DATE '{incident}'), 0) AS hits,
               coalesce(count_if(is_anomaly AND metric_date <> DATE '{incident}'), 0) AS others
        FROM (SELECT metric_name, metric_date, is_anomaly, is_actionable_anomaly FROM m_anomalies
              UNION ALL SELECT unnest(['error_rate', 'timeout_rate', 'p95_latency_ms']), NULL, NULL, NULL) a
        WHERE metric_name IN ('error_rate', 'timeout_rate', 'p95_latency_ms') GROUP BY metric_name
    ) m, LATERAL (SELECT unnest([if(hits = 0, 'no actionable flag on the incident date', NULL),
                                 if(metric_name = 'error_rate' AND others > 1, others || ' flags outside the incident date', NULL)]) AS problem) p
    WHERE problem IS NOT NULL
"""
CTE["q_conflicting"] = """
    SELECT conversation_id, started_at, initial_intent, resolution_status
    FROM m_fct_conversations WHERE has_conflicting_resolution
"""
CTE["q_unreconciled"] = """
    SELECT request_id, request_date, model_name, logged_cost_usd, cost_usd AS calculated_cost_usd, cost_delta_pct
    FROM m_fct_llm_requests WHERE NOT is_cost_reconciled
"""
SQL_CHECK_CTE = {
    "check_cohort_sizes": "q_cohort_sizes",
    "check_conversation_cost_ledger": "q_conversation_cost",
    "check_cost_mismatch_slo": "q_mismatch_slo",
    "check_daily_cost_reconciliation": "q_daily_cost",
    "check_request_dates_covered": "q_request_dates",
    "check_intent_accuracy_consistency": "q_accuracy",
    "check_retention_week0": "q_week0",
    "check_incident_detection": "q_incident",
    "warn_conflicting_resolution": "q_conflicting",
    "warn_unreconciled_costs": "q_unreconciled",
}


def _status(inner: str) -> str:
    return (f"SELECT *, CASE WHEN n_violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
            f"ELSE 'error' END AS status FROM ({inner}) s")


def declared_suite_sql(kind: str | None = None) -> str:
    rows = [_row(c) for c in DECLARED if kind is None or c.kind == kind]
    return _status("\nUNION ALL\n".join(rows))


def sql_suite_sql() -> str:
    rows = [
        f"SELECT '{n}' AS check_name, 'marts' AS dataset, 'test' AS layer, 'sql' AS kind, '{sev}' AS severity, "
        f"(SELECT count(*) FROM {SQL_CHECK_CTE[n]}) AS n_violations"
        for n, sev in SQL_CHECKS
    ]
    return _status("\nUNION ALL\n".join(rows))
