"""Registry contract, and a cross-section of queries against DuckDB on the smallest data."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import canonical, connect
from checks.registry import QUERIES
from tests.conftest import SMALL

SAMPLE = (
    "source_claim_line", "source_claim_header", "source_payment_transaction", "e2_monthly_cost_utilization",
    "e5_provider_service_concentration", "e6_cost_change_decomposition", "f6_early_warning_signals",
    "r1_exact_duplicate_lines", "r2_near_duplicate_lines", "r7_unusual_peer_amounts", "r14_rule_evaluation",
    "i5_fact_claim", "b35_physician_service_silver", "b21_part_d_suppression_lineage", "h_inpatient_silver_report",
    "h18_reference_integrity", "l1_provider_month_panel", "e22_band_cut_points", "e21_inpatient_contract_benchmark", "e22_all_band_cut_points", "e22_band_comparison", "g2_line_numbers_hot_path",
    "k1_seed_exact_duplicates",
    "e2_monthly_cost_utilization_over_star", "r13_label_matches_over_star",
    "b22_required_columns", "h16_schema_drift", "h35_check_set", "c4_label_isolation", "g8_schema_hashes", "i10_bridge_claim_anomaly",
)


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    query = QUERIES[name]
    frame = query.run(spark, SMALL)
    names = sorted(frame.columns)
    ours = canonical([tuple(row[n] for n in names) for row in frame.collect()])
    result = duck.execute(query.oracle())
    order = [d[0] for d in result.description]
    theirs = canonical([tuple(dict(zip(order, row))[n] for n in names) for row in result.fetchall()])
    assert names == sorted(order)
    assert ours == theirs


def test_entry_points_agree():
    names, oracles = entry_points.queries(), entry_points.oracle_sql()
    assert set(oracles) <= set(names) and len(names) > 150 and set(QUERIES) <= set(names)
    # numbered operators, if present, are looked at in their own tests
    without = sorted(name for name in QUERIES if name not in oracles)
    assert without == ["g7_content_fingerprints", "k11_field_changes", "r14_seeded_backtest"]


def test_flagship_runs(spark):
    assert entry_points.entry(spark).count() > 0
