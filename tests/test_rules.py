"""Rules on small hand-made facts, and peer amounts against a plain loop."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimloom.contracts.review_rules import RuleSettings
from claimloom.errors import ContractError
from claimloom.operators import marks
from claimloom.plans import conformed, evaluation, rules

D = Decimal
DAY = date(2026, 2, 3)
CLAIM_SCHEMA = (
    "claim_id string, billing_provider_id string, specialty_group string, service_date date, service_month date, "
    "claim_status string, is_current_version boolean, total_allowed_amount decimal(18,2), "
    "total_member_liability_amount decimal(18,2), net_paid_amount decimal(18,2), principal_diagnosis_code string"
)
LINE_SCHEMA = (
    "claim_line_id string, claim_id string, line_number int, rendering_provider_id string, service_code_system string, "
    "service_code string, service_date date, place_of_service_code string, units decimal(18,4), "
    "charge_amount decimal(18,2), allowed_amount decimal(18,2), member_liability_amount decimal(18,2), "
    "plan_paid_amount decimal(18,2)"
)
PAYMENT_SCHEMA = (
    "payment_transaction_id string, claim_id string, transaction_sequence_number int, transaction_date date, "
    "transaction_type string, signed_transaction_amount decimal(18,2)"
)


def claim(number, allowed="100.00", liability="20.00", net="80.00", provider="P1", day=DAY, diagnosis="I10"):
    return (f"CLM{number}", provider, "cardiology", day, day.replace(day=1), "paid", True, D(allowed), D(liability), D(net), diagnosis)


def line(number, claim_number, place=1, code="99213", units="1.0000", allowed="100.00", system="HCPCS", pos=None):
    return (f"LIN{number:012d}", f"CLM{claim_number}", place, "P1", system, code, DAY, pos, D(units), D("120.00"),
            D(allowed), D("20.00"), D(allowed) - D("20.00"))


def facts(spark, claims=(), lines=(), payments=(), categories=()):
    return conformed.Facts(
        claims=spark.createDataFrame(list(claims), CLAIM_SCHEMA),
        lines=spark.createDataFrame(list(lines), LINE_SCHEMA),
        payments=spark.createDataFrame(list(payments), PAYMENT_SCHEMA),
        memberships=None, reviews=None, assignments=None,
        service_categories=spark.createDataFrame(list(categories), "service_code_system string, service_code string, service_category string"),
    )


def targets(df):
    return sorted(r["target_record_id"] for r in df.collect())


def test_exact_duplicates_need_two_equal_first_and_last_lines(spark):
    lines = [line(1, 1), line(2, 1, 2, code="x"), line(3, 1, 3),          # flagged: line 3 copies line 1
             line(4, 2), line(5, 2, 2), line(6, 2, 3),                       # three equal lines
             line(7, 3), line(8, 3, 2), line(9, 3, 3, code="y")]             # the copy is not last
    found = rules.exact_duplicates(facts(spark, lines=lines))
    assert targets(found) == ["LIN000000000003"]
    assert found.first()["amount_at_risk"] == D("80.00")


def test_near_duplicates_need_a_quarter_unit(spark):
    lines = [line(1, 1, units="2.0000"), line(2, 1, 2, units="2.2500"),
             line(3, 2, units="2.0000"), line(4, 2, 2, units="2.5000"),
             line(5, 3, units="2.7500", pos="11"), line(6, 3, 2, units="2.5000", pos="11")]
    found = {r["target_record_id"]: r["threshold_value"] for r in rules.near_duplicates(facts(spark, lines=lines)).collect()}
    assert found == {"LIN000000000002": "['2.0000', '2.2500']", "LIN000000000006": "['2.5000', '2.7500']"}


def test_repayment_only_after_a_reversal(spark):
    def pay(n, seq, kind, amount):
        return (f"PAY{n}", "CLM1", seq, DAY, kind, D(amount))

    payments = [pay(1, 1, "payment", "80"), pay(2, 2, "reversal", "-80"), pay(3, 3, "payment", "32"),
                pay(4, 4, "reversal", "-32"), pay(5, 5, "payment", "10"), pay(6, 6, "adjustment", "5")]
    assert targets(rules.repayments_after_reversal(facts(spark, payments=payments))) == ["PAY3", "PAY5"]


def test_headers_without_lines_compare_with_zero(spark):
    found = rules.header_mismatches(facts(spark, claims=[claim(1), claim(2), claim(3, allowed="0.00")], lines=[line(1, 1)]))
    assert targets(found) == ["CLM2"]


def test_overpaid_claims(spark):
    found = rules.overpayments(facts(spark, claims=[claim(1), claim(2, net="80.01"), claim(3, net="-5.00")]))
    assert [(r["target_record_id"], r["amount_at_risk"]) for r in found.collect()] == [("CLM2", D("0.01"))]


def loop_unusual(amounts, minimum=11):
    """Sorted peers, each compared with its predecessor times 1.25."""
    if len(amounts) < minimum:
        return []
    ordered = sorted(amounts, key=lambda item: (item[1], item[0]))
    hits = []
    for (_, lower), (name, value) in zip(ordered, ordered[1:]):
        if value >= (lower * D("1.25")).quantize(D("0.01")):
            hits.append(name)
    return sorted(hits)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_unusual_amounts_equal_a_plain_loop(spark, seed):
    random.seed(seed)
    pool = [D(random.choice(["0.00", "0.01", "0.02", "0.03", "99.99", "100.00", "100.01", "125.00"])) for _ in range(12)]
    pool += [D(random.randint(0, 90000)) / 100 for _ in range(25)]
    lines = [line(i, 1, i, allowed=str(v)) for i, v in enumerate(pool, start=1)]
    got = targets(rules.unusual_amounts(facts(spark, claims=[claim(1)], lines=lines), RuleSettings("run", 1)))
    assert got == loop_unusual([(f"LIN{i:012d}", v) for i, v in enumerate(pool, start=1)])


def test_small_peer_groups_are_left_alone(spark):
    lines = [line(i, 1, i, allowed=str(10 ** i)) for i in range(1, 10)]
    assert targets(rules.unusual_amounts(facts(spark, claims=[claim(1)], lines=lines), RuleSettings("run", 1))) == []


def test_surge_needs_history(spark):
    old = [claim(f"{m}{i}", day=date(2025, m, 5)) for m in range(1, 7) for i in (1, 2)]
    new = [claim(f"9{i}", day=date(2026, 3, 9), net="10.00") for i in range(7)]
    short = [claim(f"8{i}", provider="P2", day=date(2026, 3, 9)) for i in range(40)]
    found = rules.utilization_surges(facts(spark, claims=old + new + short), RuleSettings("run", 1)).collect()
    assert [(r["target_record_id"], r["observed_value"], r["threshold_value"], r["amount_at_risk"]) for r in found] == [
        ("P1:2026-03-01", "7", "6.0000", D("70.00"))]


def test_repeated_procedures_flag_exactly_one_over(spark):
    limits = spark.createDataFrame([("HCPCS", "93000", 2)], "service_code_system string, service_code string, limit int")
    lines = [line(i, 1, i, code="93000", allowed=str(20 + i)) for i in (1, 2, 3)]
    lines += [line(i, 2, i, code="93000") for i in (11, 12, 13, 14)]
    found = rules.repeated_procedures(facts(spark, lines=lines), limits).collect()
    assert [(r["target_record_id"], r["amount_at_risk"]) for r in found] == [("CLM1", D("3.00"))]


def test_diagnosis_mismatch_needs_a_single_category(spark):
    categories = [("HCPCS", "93000", "cardiovascular"), ("HCPCS", "97110", "musculoskeletal")]
    claims = [claim(1, diagnosis="M1711"), claim(2, diagnosis="M1711"), claim(3, diagnosis="I10")]
    lines = [line(1, 1, code="93000"), line(2, 1, 2, code="none"), line(3, 2, code="93000"), line(4, 2, 2, code="97110"),
             line(5, 3, code="93000")]
    found = rules.diagnosis_mismatches(facts(spark, claims=claims, lines=lines, categories=categories), RuleSettings("run", 1)).collect()
    assert [(r["target_record_id"], r["observed_value"]) for r in found] == [("CLM1", "musculoskeletal:cardiovascular")]


def test_labels_are_refused_as_detection_input(spark):
    with pytest.raises(ContractError):
        conformed.refuse_labels(["fact_claim", "bridge_claim_anomaly"])


def test_matching_and_empty_denominators(spark):
    settings = RuleSettings("run", 1)
    findings = spark.createDataFrame(
        [("F1", "PI005", "claim", "C1", None, None, None, None, "C1", D("3.00")),
         ("F2", "PI005", "claim", "C2", None, None, None, None, "C2", D("1.00"))],
        "finding_id string, rule_id string, label_scope string, claim_id string, claim_line_id string, "
        "payment_transaction_id string, provider_id string, reporting_period date, target_record_id string, amount_at_risk decimal(18,2)")
    labels = spark.createDataFrame(
        [("I1", "PI005", "claim", "C1", None, None, None, None, "C1", D("3.00")),
         ("I2", "PI008", "provider_period", "C9", None, None, "P1", date(2026, 3, 1), "P1:2026-03-01", D("7.00"))],
        "injection_id string, rule_id string, label_scope string, claim_id string, claim_line_id string, "
        "payment_transaction_id string, provider_id string, reporting_period date, target_record_id string, "
        "expected_financial_exposure decimal(18,2)")
    matches = evaluation.match_labels(findings, labels, settings)
    got = [(r["match_id"], r["canonical_target_id"], r["match_status"]) for r in matches.orderBy("match_id").collect()]
    assert got == [("MAT0000000001", "C1", "true_positive"), ("MAT0000000002", "C2", "false_positive"),
                   ("MAT0000000003", "P1:2026-03-01", "false_negative")]
    eligible = spark.createDataFrame([("PI005", 10), ("PI008", 1)], "rule_id string, eligible_target_count bigint")
    scores = {r["rule_id"]: r for r in evaluation.evaluate(matches, eligible, settings).collect()}
    assert len(scores) == 11 and scores["PI005"]["precision"] == D("0.5000") and scores["PI001"]["recall"] is None
    assert scores["ALL"]["eligible_target_count"] == 11 and scores["PI008"]["exposure_recall"] == D("0.0000")
    assert scores["PI001"]["precision_threshold_passed"] is False


def test_cap_keeps_the_strongest_and_numbers_in_order(spark):
    settings = RuleSettings("run", 1, maximum_findings_per_rule=2)
    claims = [claim(i, net=str(80 + i)) for i in range(1, 6)]
    selected = rules.select_findings(rules.overpayments(facts(spark, claims=claims)), settings)
    got = [(r["finding_id"], r["target_record_id"]) for r in rules.findings_table(selected).orderBy("finding_id").collect()]
    assert got == [("FND0000000001", "CLM4"), ("FND0000000002", "CLM5")]
    assert {r["comparison_operator"] for r in rules.evidence_table(selected).collect()} == {">"}


def test_only_claims_that_may_repeat_their_first_line_are_compared(spark):
    lines = [line(1, 1), line(2, 1, 2, code="x"), line(3, 1, 3)]                   # the first line again
    lines += [line(4, 2, code="a"), line(5, 2, 2, code="b"), line(6, 2, 3, code="b")]  # others repeat, the first doesn't
    lines += [line(7, 3, pos="11"), line(8, 3, pos="11")]                          # two first lines
    lines += [line(100 + i, 10 + i) for i in range(40)]                            # single lines
    kept = rules.with_repeated_first_lines(facts(spark, lines=lines)).lines
    found = {r["claim_id"] for r in kept.select("claim_id").distinct().collect()}
    assert {"CLM1", "CLM3"} <= found and found <= {"CLM1", "CLM2", "CLM3"}
    assert kept.filter("claim_id = 'CLM1'").count() == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_duplicates_equal_a_plain_loop(spark, seed):
    """Claims of every shape: no first line, several of a number, null numbers and signatures."""
    random.seed(seed)
    lines, exact, near = [], set(), set()
    for number in range(120):
        own = [line(100 * number + i, number, random.choice([1, 1, 2, 3, 4, None]), code=random.choice("ab"), pos=random.choice([None, "11"]),
                    units=random.choice(["1.0000", "1.2500", "1.5000"])) for i in range(random.randint(1, 5))]
        lines += own
        last = max((r[2] for r in own if r[2] is not None), default=None)
        groups = {}
        for r in own:
            groups.setdefault((r[5], r[7]), []).append(r)
        for group in groups.values():
            if min((r[2] for r in group if r[2] is not None), default=0) == 1:
                units = {r[8] for r in group}
                near |= {r[0] for r in group if r[2] == last and r[8] % 1 != 0
                         and units & {r[8] - D("0.25"), r[8] + D("0.25")}}
            for value in {r[8] for r in group}:
                same = [r[2] for r in group if r[8] == value]
                known = [n for n in same if n is not None]
                if len(same) == 2 and known and min(known) == 1 and max(known) == last:
                    exact |= {r[0] for r in own if r[2] == last}
    given = facts(spark, lines=lines)
    assert exact and near
    assert set(targets(rules.exact_duplicates(given))) == exact
    assert targets(rules.near_duplicates(given)) == sorted(near)


def test_amounts_below_zero_are_compared_too(spark):
    pool = [D(v) for v in ("-30.00", "-20.00", "-20.00", "-1.00", "0.00", "0.00", "0.01", "0.02", "0.02", "5.00", "6.00", "9.00", "9.00", "40.00")]
    lines = [line(i, 1, i, allowed=str(v)) for i, v in enumerate(pool, start=1)]
    got = targets(rules.unusual_amounts(facts(spark, claims=[claim(1)], lines=lines), RuleSettings("run", 1)))
    assert got == loop_unusual([(f"LIN{i:012d}", v) for i, v in enumerate(pool, start=1)])


def test_marks_leave_most_rows_out_and_none_that_match(spark):
    rows = spark.range(20_000).selectExpr("concat('C', id) claim_id", "id")
    wanted = rows.filter("id % 1000 = 7").select("claim_id")
    kept = marks.may_match(rows, "claim_id", wanted)
    assert kept.columns == rows.columns and 20 <= kept.count() <= 25
    assert kept.join(wanted, "claim_id", "left_semi").count() == 20
    assert marks.may_match(rows, "claim_id", wanted.filter("false")).count() == 0


def test_only_lines_of_claims_that_may_repeat_a_service_are_kept(spark):
    lines = [line(1, 1, code="a"), line(2, 1, 2, code="b"), line(3, 1, 3, code="a")]
    lines += [line(100 + i, 10 + i, 1 + i % 2, code=f"c{i}") for i in range(60)]
    lines += [(*line(900 + i, 0)[:1], None, *line(900 + i, 0)[2:]) for i in range(2)]   # two lines of no claim
    kept = rules.with_repeated_services(facts(spark, lines=lines)).lines
    assert sorted(r[0] for r in kept.select("claim_line_id").collect()) == [f"LIN{i:012d}" for i in (1, 2, 3, 900, 901)]
    # distinct pairs of claim and service: two of claim 1, sixty single ones, one of no claim
    assert evaluation.services_in_claims(facts(spark, lines=lines)).first()[0] == 63


def test_a_limit_of_none_is_exceeded_by_single_lines(spark):
    limits = spark.createDataFrame([("HCPCS", "a", 0), ("HCPCS", "b", 1)], "service_code_system string, service_code string, limit int")
    lines = [line(1, 1, code="a"), line(2, 2, code="b"), line(3, 3, code="b"), line(4, 3, 2, code="b")]
    assert targets(rules.repeated_procedures(facts(spark, lines=lines), limits)) == ["CLM1", "CLM3"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_unusual_amounts_of_every_size_equal_a_plain_loop(spark, seed):
    random.seed(seed)
    pool = [D(random.randint(1, 9)) * D(10) ** random.randint(-2, 7) for _ in range(40)]
    pool += [(value * D("1.25")).quantize(D("0.01")) for value in random.sample(pool, 10)] + random.sample(pool, 10)
    pool += [-value for value in random.sample(pool, 5)]
    lines = [line(i, 1, i, allowed=str(v)) for i, v in enumerate(pool, start=1)]
    given = facts(spark, claims=[claim(1)], lines=lines)
    assert targets(rules.unusual_amounts(given, RuleSettings("run", 1))) == loop_unusual([(f"LIN{i:012d}", v) for i, v in enumerate(pool, start=1)])
    # one row for each growing bucket, not one for each amount
    many = [line(i, 1, i, allowed=f"{1000 + i}.00") for i in range(1, 101)]
    assert rules.peer_amounts(facts(spark, claims=[claim(1)], lines=many), RuleSettings("run", 1), 1.25).count() <= 2
    assert rules.peer_amounts(facts(spark, claims=[claim(1)], lines=many), RuleSettings("run", 1)).count() == 100


def test_a_category_that_rules_nothing_out_is_still_another(spark):
    categories = [("HCPCS", "93000", "cardiovascular"), ("HCPCS", "99213", "evaluation_management"), ("HCPCS", "empty", None)]
    claims = [claim(1, diagnosis="M1711"), claim(2, diagnosis="M1711"), claim(3, diagnosis="M1711")]
    lines = [line(1, 1, code="93000"), line(2, 1, 2, code="99213"), line(3, 2, code="99213"), line(4, 3, code="93000"), line(5, 3, 2, code="empty")]
    found = rules.diagnosis_mismatches(facts(spark, claims=claims, lines=lines, categories=categories), RuleSettings("run", 1))
    assert targets(found) == ["CLM3"]
