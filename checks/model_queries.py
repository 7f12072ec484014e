"""The operational tables themselves: the ground every other query stands on."""

from checks.registry import register

SPECS = {
    "member": "member_id:text birth_year:long sex_code:text state_code:text",
    "provider": "provider_id:text provider_entity_type:text specialty_group:text state_code:text",
    "provider_contract": "contract_id:text provider_id:text plan_id:text",
    "membership_month": "member_id:text plan_id:text coverage_month:date coverage_end_date:date "
    "coverage_status:text",
    "claim_line": "claim_line_id:text claim_id:text line_number:long rendering_provider_id:text "
    "service_code_system:text service_code:text service_date:date place_of_service_code:text units:num "
    "charge_amount:num allowed_amount:num member_liability_amount:num",
    "claim_header": "claim_id:text logical_claim_id:text claim_version_number:long prior_claim_id:text "
    "member_id:text plan_id:text billing_provider_id:text rendering_provider_id:text claim_type:text "
    "claim_status:text service_from_date:date service_through_date:date received_date:date "
    "adjudication_date:date principal_diagnosis_code:text total_charge_amount:num "
    "total_allowed_amount:num total_member_liability_amount:num",
    "payment_transaction": "payment_transaction_id:text claim_id:text transaction_sequence_number:long "
    "transaction_date:date transaction_type:text signed_transaction_amount:num "
    "reverses_transaction_id:text",
    "claim_review": "review_id:text claim_id:text review_status:text selected_date:date "
    "completed_date:date selection_reason:text",
    "audit_outcome": "audit_id:text review_id:text claim_id:text outcome:text confirmed_amount:num "
    "outcome_date:date",
    "policy_assignment": "policy_assignment_id:text provider_id:text treatment_group:text "
    "assignment_start_date:date",
    "anomaly_injection": "injection_id:text rule_id:text label_scope:text target_table:text "
    "target_record_id:text claim_id:text claim_line_id:text payment_transaction_id:text reporting_period:date "
    "expected_financial_exposure:num",
}

for table, spec in SPECS.items():
    register(
        f"source_{table}",
        lambda model, table=table: getattr(model, table),
        spec,
        f"SELECT * FROM op_{table}",
    )
