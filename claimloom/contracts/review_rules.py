"""Settings of the ten review rules.

Fixed values: rule names, severities, confidences, code limits and category maps are the
published contract of the rule set and must be kept as they are for results to agree.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# rule id, name, severity, confidence
RULES = (
    ("PI001", "Exact duplicate claim line", "high", "0.98"),
    ("PI002", "Near-duplicate claim line", "medium", "0.75"),
    ("PI003", "Unresolved payment after reversal", "critical", "0.95"),
    ("PI004", "Impossible service and payment dates", "high", "0.99"),
    ("PI005", "Claim header and line total mismatch", "high", "0.95"),
    ("PI006", "Paid amount exceeds allowed amount", "high", "0.90"),
    ("PI007", "Unusual provider billing amount", "medium", "0.70"),
    ("PI008", "Sudden provider utilization increase", "medium", "0.70"),
    ("PI009", "Repeated procedure above configurable limit", "medium", "0.80"),
    ("PI010", "Inconsistent diagnosis and procedure category", "medium", "0.65"),
)

# label scope, target table, explanation and evidence name of each rule's findings
FINDING_TEXTS = {
    "PI001": (
        "claim_line", "fact_claim_line",
        "Claim line exactly duplicates another service line.",
        "duplicate_line_count",
    ),
    "PI002": (
        "claim_line", "fact_claim_line",
        "Claim line is a near duplicate with changed service units.",
        "near_duplicate_units",
    ),
    "PI003": (
        "payment_transaction", "fact_payment_transaction",
        "Positive repayment remains after a full reversal sequence.",
        "unresolved_repayment",
    ),
    "PI004": (
        "payment_transaction", "fact_payment_transaction",
        "Payment transaction date precedes the claim service date.",
        "transaction_date",
    ),
    "PI005": (
        "claim", "fact_claim",
        "Claim header allowed amount does not reconcile to its lines.",
        "header_allowed_amount",
    ),
    "PI006": (
        "claim", "fact_claim",
        "Net payment exceeds allowed amount less member liability.",
        "net_paid_amount",
    ),
    "PI007": (
        "provider", "fact_claim_line",
        "Provider line amount exceeds the specialty peer threshold.",
        "allowed_amount",
    ),
    "PI008": (
        "provider_period", "fact_claim",
        "Provider monthly claim volume exceeds its historical baseline.",
        "provider_month_claim_count",
    ),
    "PI009": (
        "claim", "fact_claim",
        "Procedure frequency exceeds the configured claim limit.",
        "service_code_frequency",
    ),
    "PI010": (
        "claim", "fact_claim",
        "Principal diagnosis is incompatible with the governed procedure category.",
        "diagnosis_procedure_categories",
    ),
}

SERVICE_LIMITS = {
    "HCPCS": {"99213": 4, "99214": 4, "93000": 2, "97110": 4, "90834": 2},
    "APC": {"5012": 3, "5072": 3, "5112": 3, "5523": 3, "8011": 3},
}

DIAGNOSIS_CATEGORIES = {
    "cardiovascular": ("I10",),
    "endocrine": ("E119",),
    "musculoskeletal": ("M1711",),
    "respiratory": ("J449",),
    "behavioral": ("F329",),
    "preventive": ("Z0000",),
}

PROCEDURE_CATEGORIES = {
    "HCPCS": {
        "99213": "evaluation_management",
        "99214": "evaluation_management",
        "93000": "cardiovascular",
        "97110": "musculoskeletal",
        "90834": "behavioral",
    },
    "MS-DRG": {
        "470": "musculoskeletal",
        "291": "cardiovascular",
        "871": "respiratory",
        "392": "evaluation_management",
        "690": "endocrine",
    },
    "APC": {
        "5012": "evaluation_management",
        "5072": "cardiovascular",
        "5112": "musculoskeletal",
        "5523": "respiratory",
        "8011": "behavioral",
    },
}

COMPATIBLE_DIAGNOSES = {
    "evaluation_management": (
        "cardiovascular", "endocrine", "musculoskeletal", "respiratory", "behavioral", "preventive",
    ),
    "cardiovascular": ("cardiovascular",),
    "endocrine": ("endocrine",),
    "musculoskeletal": ("musculoskeletal",),
    "respiratory": ("respiratory",),
    "behavioral": ("behavioral",),
}

# diagnosis that never fits the procedure category
INCOMPATIBLE_DIAGNOSIS = {
    "cardiovascular": "M1711",
    "endocrine": "J449",
    "musculoskeletal": "F329",
    "respiratory": "E119",
    "behavioral": "I10",
}


@dataclass(frozen=True)
class RuleSettings:
    run_id: str
    deterministic_seed: int
    contract_version: int = 1
    source_variant: str = "anomalous_evaluation"
    maximum_findings_per_rule: int = 50
    peer_threshold_multiplier: str = "1.25"
    minimum_peer_count: int = 11
    utilization_surge_factor: str = "3.0"
    minimum_historical_months: int = 6
    minimum_historical_claims: int = 11
    policy_start: date = date(2026, 1, 1)
    minimum_precision: str = "0.70"
    minimum_recall: str = "0.85"
    maximum_false_positive_rate: str = "0.10"
    incompatible_diagnosis: dict[str, str] = field(default_factory=lambda: dict(INCOMPATIBLE_DIAGNOSIS))


def mapping_rows(mapping: dict[str, dict[str, object]]) -> list[tuple]:
    """(system, code, value) rows of a nested code map."""
    return [(system, code, value) for system, codes in mapping.items() for code, value in codes.items()]
