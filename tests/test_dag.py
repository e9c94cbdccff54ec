"""The DAG is read off the definitions: what a dataset reads, what a run writes, cycles."""
import pytest

from ledgerlark.plans.warehouse import CHECKS, MART_NAMES, _consumers_first, dependencies, written_datasets


def test_operators_that_carry_a_dataset_name_are_no_reads():
    deps = dependencies()
    assert all(n not in reads for n, reads in deps.items())
    assert deps["stg_users"] == set()
    assert deps["stg_llm_requests"] == {"request_replays"}
    assert deps["priced_requests"] == {"stg_llm_requests", "stg_daily_model_prices"}
    assert deps["fct_conversations"] == {"conversation_facts", "stg_users"}
    assert {"fct_weekly_cohort_retention", "mart_intent_quality", "stg_conversations"} <= deps[CHECKS]


def test_a_run_writes_every_mart_after_what_it_reads():
    waits = written_datasets()
    assert set(MART_NAMES) <= set(waits)
    done: set[str] = set()
    for n in waits:
        assert waits[n] <= done
        done.add(n)


def test_a_cycle_is_an_error():
    with pytest.raises(ValueError, match="read each other"):
        _consumers_first({"a": {"b"}, "b": {"a"}, "c": set()})


def test_extract_files_grow_with_the_input():
    from ledgerlark.plans.registry import EXTRACT_BYTES, INCREMENTAL_BATCHES, extract_files

    for n_bytes in (0, 1, 10 << 20, 3 << 30, 300 << 30):
        n = extract_files(n_bytes)
        assert n % INCREMENTAL_BATCHES == 0 and n >= INCREMENTAL_BATCHES and n * EXTRACT_BYTES >= n_bytes


def test_orphans_are_kept_and_spread_and_match_nothing(spark):
    from ledgerlark.operators.marts import left_join_nullable_key

    left = spark.createDataFrame([("r1", "c1"), ("r2", None), ("c1", None), (None, None)], "request_id string, conversation_id string")
    right = spark.createDataFrame([("c1", 7), ("c1", 8), (None, 9)], "conversation_id string, n int")
    got = left_join_nullable_key(left, right, "conversation_id", "request_id")
    rows = [tuple(r) for r in got.select("request_id", "conversation_id", "n").collect()]
    assert sorted(rows, key=str) == sorted([("r1", "c1", 7), ("r1", "c1", 8), ("r2", None, None), ("c1", None, None), (None, None, None)], key=str)


def test_ties_of_first_and_last_model_go_by_request_id(spark):
    from ledgerlark.operators.intermediate import int_conversation_request_rollup

    rows = [("r2", "a-model"), ("r1", "z-model"), ("r3", "m-model")]
    priced = spark.createDataFrame(rows, "request_id string, model_name string").selectExpr(
        "*", "'c1' AS conversation_id", "timestamp '2024-01-01 12:00:00' AS created_at", "'p' AS model_provider", "'success' AS status",
        "true AS is_success", "false AS is_failed", "1 AS prompt_tokens", "1 AS completion_tokens", "2 AS total_tokens", "5 AS latency_ms",
        "0.1BD AS calculated_cost_usd", "0.1BD AS recorded_cost_usd", "false AS has_invalid_latency", "false AS has_token_sum_mismatch",
        "false AS has_model_alias", "false AS had_duplicate_ingest")
    r = int_conversation_request_rollup(priced).first()
    assert (r.first_model_name, r.last_model_name, r.n_distinct_models, r.n_requests) == ("z-model", "m-model", 3, 3)


def test_a_query_on_written_layers_has_the_lineage_of_what_it_reads_written():
    from ledgerlark.plans.registry import CHECK_KINDS, ON_WRITTEN_LAYERS
    from ledgerlark.plans.warehouse import written_for

    waits = written_datasets()
    assert written_for(("raw_users", "intent_catalog")) == set()
    assert written_for(("fct_weekly_cohort_retention",)) == {"stg_users", "stg_conversations", "fct_weekly_cohort_retention"}
    assert written_for(("int_intent_confusion",)) == {"stg_intent_predictions"}
    assert written_for(tuple(waits)) == set(waits)
    assert {n for n, reads in ON_WRITTEN_LAYERS.items() if reads is None} == {"check_suite"}
    for n, reads in ON_WRITTEN_LAYERS.items():
        found = written_for(reads or tuple(waits))
        assert set(reads or ()) & set(waits) <= found and all(waits[d] <= found for d in found)
        assert n in CHECK_KINDS or reads is None or set(reads) <= set(MART_NAMES)
