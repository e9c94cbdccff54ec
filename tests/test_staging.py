"""Staging rules on hand-written frames with known answers."""
from ledgerlark.operators import staging as S
from ledgerlark.sources import seeds

REQ_COLS = ["request_id", "conversation_id", "created_at", "model_provider", "model_name", "prompt_tokens",
            "completion_tokens", "total_tokens", "latency_ms", "cost_usd", "status", "error_type", "_ingested_at"]


def req(rid, conv="c_1", created="2024-01-01 10:00:00", ingested="2024-01-01 10:00:30", model="gpt-4o-mini",
        pt="100", ct="50", tt="150", lat="800", cost="0.000045", status="success", err=""):
    return (rid, conv, created, "OpenAI ", model, pt, ct, tt, lat, cost, status, err, ingested)


def test_request_rules(spark):
    rows = [
        req("a", ingested="2024-01-01 10:05:00", cost="0.000099"),
        req("a", ingested="2024-01-01 10:00:30"),                     # earliest copy wins
        req("b", conv="", lat="-5", tt="999"),                         # orphan, bad latency, token gap
        req("c", model="gpt-4.1-preview", ingested="2024-01-01 11:01:00"),   # alias; 61 minute boundaries
        req("d", created="2024-01-01 10:00:59", ingested="2024-01-01 11:00:00"),  # 60 boundaries: on time
        req("e", status="Timeout ", err="upstream_timeout", lat=None),
    ]
    raw = spark.createDataFrame(rows, ",".join(f"{c} string" for c in REQ_COLS))
    out = {r.request_id: r for r in S.stg_llm_requests(raw, seeds.model_aliases(spark)).collect()}
    assert len(out) == 5
    a = out["a"]
    assert a.had_duplicate_ingest and str(a.recorded_cost_usd) == "0.000045"
    assert a.model_provider == "openai" and a.token_bucket == "0-499" and a.latency_bucket == "<1s"
    b = out["b"]
    assert b.is_orphan and b.conversation_id is None
    assert b.latency_ms is None and b.raw_latency_ms == -5 and b.has_invalid_latency and b.latency_bucket is None
    assert b.has_token_sum_mismatch and b.total_tokens == 150 and b.raw_total_tokens == 999
    c = out["c"]
    assert c.has_model_alias and c.model_name == "gpt-4.1" and c.model_name_raw == "gpt-4.1-preview"
    assert c.is_late_arriving
    assert out["d"].is_late_arriving is False
    e = out["e"]
    assert e.status == "timeout" and e.is_failed and not e.is_success
    assert e.latency_bucket == "15s+"          # NULL raw latency falls to the last bucket


CONV_COLS = ["conversation_id", "user_id", "started_at", "ended_at", "channel", "initial_intent",
             "resolved_without_escalation", "escalated", "satisfaction_score"]


def test_conversation_rules(spark):
    rows = [
        ("c1", "u", "2024-01-01 10:00:00", "2024-01-01 10:01:30", " Web", "Fee_Question", "True", "True", "4.0"),
        ("c2", "u", "2024-01-01 10:00:00", "2024-01-01 10:00:05", "whatsapp", "x", "True", "False", ""),
        ("c3", "u", "2024-01-01 23:59:59", "2024-01-02 00:00:01", "web", "x", "False", "False", "4.5"),
    ]
    raw = spark.createDataFrame(rows, ",".join(f"{c} string" for c in CONV_COLS))
    out = {r.conversation_id: r for r in S.stg_conversations(raw).collect()}
    c1 = out["c1"]
    assert c1.resolution_status == "escalated" and c1.has_conflicting_resolution and not c1.is_auto_resolved
    assert c1.channel == "web" and c1.initial_intent == "fee_question" and c1.duration_seconds == 90
    assert c1.satisfaction_score == 4 and c1.has_satisfaction_score
    c2 = out["c2"]
    assert c2.resolution_status == "auto_resolved" and c2.satisfaction_score is None and not c2.has_satisfaction_score
    c3 = out["c3"]
    assert c3.resolution_status == "abandoned" and c3.duration_seconds == 2 and c3.satisfaction_score == 5


def test_prediction_rules(spark):
    cols = "prediction_id string, conversation_id string, created_at string, predicted_intent string, " \
           "confidence string, human_corrected_intent string, is_correct string"
    rows = [("p1", "c", "2024-01-01 10:00:00", "a", "0.950", "", ""),
            ("p2", "c", "2024-01-01 10:00:00", "a", "0.700", "b", "False"),
            ("p3", "c", "2024-01-01 10:00:00", "a", "0.499", "A", "True")]
    out = {r.prediction_id: r for r in S.stg_intent_predictions(spark.createDataFrame(rows, cols)).collect()}
    assert not out["p1"].is_human_reviewed and out["p1"].is_corrected is False and out["p1"].is_correct is None
    assert out["p1"].confidence_bucket == "0.90-1.00"
    assert out["p2"].is_corrected and out["p2"].confidence_bucket == "0.70-0.79"
    assert out["p3"].is_human_reviewed and not out["p3"].is_corrected and out["p3"].confidence_bucket == "<0.50"


def test_staging_reads_written_request_rows_not_the_feed(spark, tmp_path):
    """The feed is derived once: replays and staging come from the written typed rows, in a run and on their own."""
    from ledgerlark.plans.pipeline import materialize
    from ledgerlark.plans.registry import TYPED_REQUESTS
    from ledgerlark.plans.warehouse import Warehouse, dependencies, written_datasets

    rows = [("r1", "c1", "10", "2024-01-01 10:00:05"), ("r1", "c1", "10", "2024-01-01 10:00:09"), ("r2", "", None, "2024-01-01 10:00:05"),
            ("r3", "c2", "-4", "2024-01-01 11:59:00"), ("r3", "c2", "-4", "2024-01-01 11:59:00"), (None, "c3", "7", None)]
    feed = spark.createDataFrame(rows, "request_id string, conversation_id string, latency_ms string, _ingested_at string").selectExpr(
        "*", "'2024-01-01 10:00:00' AS created_at", "' OpenAI' AS model_provider", "'gpt-4o-mini' AS model_name", "'5' AS prompt_tokens",
        "'6' AS completion_tokens", "'11' AS total_tokens", "'0.000001' AS cost_usd", "'success' AS status", "'' AS error_type")
    lazy = Warehouse(spark, {"llm_requests": feed}).stg_llm_requests
    wh = Warehouse(spark, {"llm_requests": feed})
    run = materialize(wh, str(tmp_path / "wh"), names=list(TYPED_REQUESTS))
    staged = wh.stg_llm_requests
    read = {f.split(run.folder)[1].split("/")[2] for f in staged.inputFiles()}
    assert read == {"typed_requests", "request_replays"}
    assert sorted(map(str, staged.collect())) == sorted(map(str, lazy.collect()))
    assert {r.request_id: r.had_duplicate_ingest for r in staged.collect()} == {"r1": True, "r2": False, "r3": True, None: False}
    assert dependencies()["request_replays"] == {"typed_requests"} and written_datasets()["request_replays"] == {"typed_requests"}
