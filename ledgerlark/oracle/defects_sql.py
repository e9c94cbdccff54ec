"""Oracle SQL for X01 (defect injection) and X02 (manifest reconciliation)."""

from __future__ import annotations

import re

from ledgerlark.operators.defects import (
    CONFLICT_ISSUE, DEFAULT_SEED, DETECTORS, LEGACY_PRICE_MULTIPLIER, REPLAY_DELAY_SECONDS, UNIT, issue_bounds,
)
from ledgerlark.oracle.sql import CTE

# Clean feeds: the fixture's defect predicates switched off.
_REQUEST_DEFECTS = ["(pk * ln + ok) % 499 = 0", "(ok + pk * 3) % 503 = 7", "(ok * 3 + pk) % 997 = 5",
                    "pk % 199 = 3", "(ok * 5 + pk) % 251 = 9", "(ok + pk * 7) % 101 = 11", "(ok + pk) % 331 = 1"]
_clean_req = CTE["raw_llm_requests"]
for pred in _REQUEST_DEFECTS:
    assert pred in _clean_req, pred
    _clean_req = _clean_req.replace(pred, "false")
CTE["c_raw_llm_requests"] = _clean_req
_conv_defect = " OR (esc AND ok % 251 = 0)"
assert _conv_defect in CTE["raw_conversations"]
CTE["c_raw_conversations"] = CTE["raw_conversations"].replace(_conv_defect, "")


def _draw(key: str, part: int = 0) -> str:
    return f"('0x' || substr(md5('{DEFAULT_SEED}:' || {key}), {1 + 8 * part}, 8))::bigint"


_issue = "CASE " + " ".join(f"WHEN v >= {lo} AND v < {hi} THEN '{n}'" for n, lo, hi in issue_bounds()) + " END"
_factor = "CASE model_name " + " ".join(f"WHEN '{m}' THEN cast({f} as decimal(3,2))"
                                        for m, f in LEGACY_PRICE_MULTIPLIER.items()) + " END"
CTE["x_req_drawn"] = f"""
    SELECT *, {_issue} AS issue, {_factor} AS factor
    FROM (SELECT *, {_draw('request_id')} AS v, {_draw('request_id', 1)} AS v2 FROM c_raw_llm_requests) d
"""
CTE["x_raw_llm_requests"] = f"""
    SELECT request_id,
           CASE WHEN issue = 'missing_conversation_id' THEN '' ELSE conversation_id END AS conversation_id,
           created_at, model_provider,
           CASE WHEN issue = 'unknown_model_name' THEN model_name || '-preview' ELSE model_name END AS model_name,
           prompt_tokens, completion_tokens,
           CASE WHEN issue = 'token_sum_mismatch' THEN cast(cast(total_tokens as bigint) + 50 + v2 % 350 as varchar)
                ELSE total_tokens END AS total_tokens,
           CASE WHEN issue = 'negative_latency' THEN cast(-cast(latency_ms as bigint) as varchar) ELSE latency_ms END
               AS latency_ms,
           CASE WHEN issue = 'stale_price_cost' AND factor IS NOT NULL
                THEN cast(cast(round(cast(cost_usd as decimal(12,6)) * factor, 6) as decimal(12,6)) as varchar)
                ELSE cost_usd END AS cost_usd,
           status, error_type,
           CASE WHEN issue = 'late_arriving_request'
                THEN cast(cast(created_at as timestamp) + to_seconds((2 + v2 % 4) * 86400) as varchar)
                WHEN cp = 1 THEN cast(cast(_ingested_at as timestamp) + to_seconds({REPLAY_DELAY_SECONDS}) as varchar)
                ELSE _ingested_at END AS _ingested_at
    FROM x_req_drawn, (SELECT unnest([0, 1]) AS cp) copies
    WHERE cp = 0 OR issue = 'duplicate_request_id'
"""
CTE["x_conv_drawn"] = f"""
    SELECT c.*, c.escalated = 'True' AND {_draw('c.conversation_id')} < t.th AS hit
    FROM c_raw_conversations c,
         (SELECT cast(floor({CONFLICT_ISSUE[1]} * count(*) / count(*) FILTER (WHERE escalated = 'True')
                            * {float(UNIT)}) as bigint) AS th FROM c_raw_conversations) t
"""
CTE["x_raw_conversations"] = """
    SELECT conversation_id, user_id, started_at, ended_at, channel, initial_intent,
           CASE WHEN hit THEN 'True' ELSE resolved_without_escalation END AS resolved_without_escalation,
           escalated, satisfaction_score
    FROM x_conv_drawn
"""
CTE["x_manifest"] = f"""
    SELECT 'raw_llm_requests' AS table_name, 'request_id' AS key_column, request_id AS key_value, issue
    FROM x_req_drawn WHERE issue IS NOT NULL AND (issue <> 'stale_price_cost' OR factor IS NOT NULL)
    UNION ALL
    SELECT 'raw_conversations', 'conversation_id', conversation_id, '{CONFLICT_ISSUE[0]}' FROM x_conv_drawn WHERE hit
"""


def _namespace(prefix: str, replaced: dict[str, str]) -> dict[str, str]:
    """Copy every CTE depending on ``replaced`` roots under ``prefix``; returns old -> new names."""
    mapping = dict(replaced)
    changed = True
    while changed:
        changed = False
        for name, body in list(CTE.items()):
            if name in mapping or name.startswith(("x_", "c_", "y_")):
                continue
            if any(re.search(r"\b" + re.escape(old) + r"\b", body) for old in mapping):
                mapping[name] = prefix + name
                changed = True
    for old, new in mapping.items():
        if old in replaced:
            continue
        body = CTE[old]
        for o, n in mapping.items():
            body = re.sub(r"\b" + re.escape(o) + r"\b", n, body)
        CTE[new] = body
    return mapping


_NS = _namespace("y_", {"raw_llm_requests": "x_raw_llm_requests", "raw_conversations": "x_raw_conversations"})
_DS = {"priced_requests": _NS["i_model_costs"], "stg_conversations": _NS["s_conversations"]}
_flagged = "\nUNION ALL\n".join(
    f"SELECT '{issue}' AS issue, {key} AS key_value FROM {_DS[ds]} WHERE coalesce({expr}, false)"
    for issue, (ds, key, expr) in DETECTORS.items())

DEFECT_MANIFEST_SQL = "SELECT * FROM x_manifest"
RECONCILIATION_SQL = f"""
    SELECT coalesce(m.issue, f.issue) AS issue,
           count(*) FILTER (WHERE m.issue IS NOT NULL) AS expected,
           count(*) FILTER (WHERE m.issue IS NOT NULL AND f.issue IS NOT NULL) AS detected,
           count(*) FILTER (WHERE m.issue IS NOT NULL AND f.issue IS NULL) AS missed,
           count(*) FILTER (WHERE m.issue IS NULL) AS extra
    FROM (SELECT DISTINCT issue, key_value FROM x_manifest) m
    FULL OUTER JOIN (SELECT DISTINCT issue, key_value FROM ({_flagged}) q) f
      ON m.issue = f.issue AND m.key_value = f.key_value
    GROUP BY 1
"""
