"""Generated by scripts/gen_decimal_columns.py: DECIMAL output columns per query."""

DECIMAL_COLUMNS = {'check_conversation_cost_ledger': ['conversation_cost', 'request_cost', 'delta_usd'],
 'check_daily_cost_reconciliation': ['product_cost', 'ledger_cost', 'delta_usd'],
 'dim_models': ['current_input_price_per_1k_tokens', 'current_output_price_per_1k_tokens'],
 'dim_users': ['lifetime_llm_cost_usd'],
 'fct_conversations': ['intent_confidence', 'cost_usd'],
 'fct_daily_model_costs': ['total_cost_usd',
                           'total_logged_cost_usd',
                           'cost_reconciliation_delta_usd',
                           'wasted_cost_on_failures_usd',
                           'input_price_per_1k_tokens',
                           'output_price_per_1k_tokens'],
 'fct_daily_product_metrics': ['total_cost_usd', 'total_logged_cost_usd', 'cost_reconciliation_delta_usd'],
 'fct_llm_requests': ['input_price_per_1k_tokens',
                      'output_price_per_1k_tokens',
                      'cost_usd',
                      'logged_cost_usd',
                      'cost_delta_usd'],
 'int_conversation_quality': ['confidence'],
 'int_conversation_request_rollup': ['cost_usd', 'logged_cost_usd'],
 'int_daily_product_metrics': ['conversation_cost_usd', 'cost_usd', 'logged_cost_usd'],
 'int_model_costs': ['recorded_cost_usd',
                     'input_price_per_1k_tokens',
                     'output_price_per_1k_tokens',
                     'calculated_cost_usd',
                     'cost_delta_usd'],
 'mart_intent_quality': ['total_cost_usd'],
 'mart_model_reliability_daily': ['total_cost_usd'],
 'monthly_kpis': ['conversation_cost_usd', 'cost_usd', 'logged_cost_usd', 'cost_reconciliation_delta_usd'],
 'report_cost_by_model': ['cost'],
 'report_cost_drift_by_model': ['delta'],
 'report_daily_model_costs': ['total_cost_usd',
                              'total_logged_cost_usd',
                              'cost_reconciliation_delta_usd',
                              'wasted_cost_on_failures_usd',
                              'input_price_per_1k_tokens',
                              'output_price_per_1k_tokens'],
 'report_daily_model_costs_filtered': ['total_cost_usd',
                                       'total_logged_cost_usd',
                                       'cost_reconciliation_delta_usd',
                                       'wasted_cost_on_failures_usd',
                                       'input_price_per_1k_tokens',
                                       'output_price_per_1k_tokens'],
 'report_data_quality_summary': ['calculated_cost', 'logged_cost'],
 'report_headline_tiles': ['llm_cost_usd'],
 'report_incident_blast_radius': ['cost_of_affected_conversations_usd'],
 'report_kpi_series': ['total_cost_usd', 'total_logged_cost_usd', 'cost_reconciliation_delta_usd'],
 'report_model_scorecard': ['cost'],
 'report_reliability': ['total_cost_usd'],
 'request_price_lookup': ['input_price_per_1k_tokens', 'output_price_per_1k_tokens'],
 'stg_intent_predictions': ['confidence'],
 'stg_llm_requests': ['recorded_cost_usd'],
 'stg_llm_requests_incremental': ['recorded_cost_usd'],
 'warn_unreconciled_costs': ['logged_cost_usd', 'calculated_cost_usd'],
 'weekly_kpis': ['conversation_cost_usd', 'cost_usd', 'logged_cost_usd', 'cost_reconciliation_delta_usd']}
