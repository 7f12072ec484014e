"""Policy panel, estimates, percentiles and peer benchmarks."""

from datetime import date

from pyspark.sql import functions as F

from checks.bronze_model import bronze_frame
from checks.oracle_base import SUBQUERIES
from checks.oracle_numbers import half_up, scaled, whole
from checks.policy_oracle import EFFECTS, define
from checks.registry import register
from claimloom.contracts.silver import INPATIENT
from claimloom.operators.percentiles import exact_percentiles
from claimloom.plans import benchmark, policy, silver

DESIGN = policy.PolicyDesign(run_id="warehouse-policy", policy_start=date(2000, 1, 1))


def panel(model):
    return model.layers.keep("policy_panel", lambda: policy.provider_month_panel(model.facts, DESIGN), DESIGN)


SUBQUERIES["p_attribution"] = """
SELECT member_id, billing_provider_key AS provider_key FROM (
  SELECT member_id, billing_provider_key, row_number() OVER (PARTITION BY member_id
    ORDER BY count(*) DESC, billing_provider_key) AS place
  FROM f_claims WHERE is_current_version AND claim_status = 'paid' AND service_date < DATE '2000-01-01'
  GROUP BY member_id, billing_provider_key) ranked WHERE place = 1"""
register(
    "f10_member_attribution",
    lambda m: policy.member_attribution(m.facts, DESIGN),
    "member_id:text provider_key:long",
    "SELECT * FROM p_attribution",
)
MEM, CNT = whole("eligible_member_months"), whole("claim_count")
SUBQUERIES["p_grid"] = """
SELECT provider_key, treatment_group, CAST(DATE '1999-01-01' + to_months(CAST(i AS INTEGER)) AS DATE)
  AS reporting_month, CAST(i AS INTEGER) - 12 AS event_time
FROM op_policy_assignment JOIN k_provider USING (provider_id), range(0, 18) r(i)"""
SUBQUERIES["p_panel"] = f"""
SELECT provider_key, reporting_month, treatment_group, treatment_group = 'treated' AS treatment_indicator,
  reporting_month >= DATE '2000-01-01' AS post_policy_indicator,
  treatment_group = 'treated' AND reporting_month >= DATE '2000-01-01' AS treatment_post, event_time,
  eligible_member_months, claim_count,
  {half_up(scaled('paid', 2), f'100 * {MEM}')} AS paid_pmpm,
  {half_up(scaled('allowed', 2), f'100 * {MEM}')} AS allowed_pmpm,
  {half_up(whole('claim_count * 1000'), MEM)} AS claims_per_1000,
  {half_up(whole('denied'), CNT)} AS denial_rate, {half_up(whole('reviewed'), CNT)} AS review_rate
FROM (
  SELECT g.*, coalesce(members, 0) AS eligible_member_months, coalesce(claims, 0) AS claim_count,
    CAST(coalesce(paid, 0) AS DECIMAL(18,2)) AS paid, CAST(coalesce(allowed, 0) AS DECIMAL(18,2)) AS allowed,
    coalesce(denied, 0) AS denied, coalesce(reviewed, 0) AS reviewed
  FROM p_grid g
  LEFT JOIN (SELECT provider_key, coverage_month AS reporting_month, count(*) AS members
    FROM op_membership_month JOIN p_attribution USING (member_id) WHERE coverage_status = 'active'
    GROUP BY ALL) e USING (provider_key, reporting_month)
  LEFT JOIN (SELECT billing_provider_key AS provider_key, service_month AS reporting_month, count(*) AS claims,
      sum(net_paid_amount) FILTER (WHERE claim_status = 'paid') AS paid,
      sum(total_allowed_amount) FILTER (WHERE claim_status = 'paid') AS allowed,
      count(*) FILTER (WHERE claim_status = 'denied') AS denied
    FROM f_claims WHERE is_current_version GROUP BY ALL) c USING (provider_key, reporting_month)
  LEFT JOIN (SELECT billing_provider_key AS provider_key, service_month AS reporting_month, count(*) AS reviewed
    FROM op_claim_review JOIN f_claims USING (claim_id)
    WHERE is_current_version AND review_status = 'completed' GROUP BY ALL) r
    USING (provider_key, reporting_month)) cells"""
PANEL_SPEC = (
    "provider_key:long reporting_month:date treatment_group:text treatment_indicator:bool "
    "post_policy_indicator:bool treatment_post:bool event_time:long eligible_member_months:long "
    "claim_count:long paid_pmpm:num allowed_pmpm:num claims_per_1000:num denial_rate:num review_rate:num"
)
register("l1_provider_month_panel", panel, PANEL_SPEC, "SELECT * FROM p_panel")
register("d11_provider_month_grid", panel, "provider_key:long reporting_month:date treatment_group:text event_time:long",
         "SELECT * FROM p_grid")
register(
    "e9_panel_outcomes",
    panel,
    "provider_key:long reporting_month:date denial_rate:num review_rate:num claims_per_1000:num",
    "SELECT * FROM p_panel",
)

EFFECT_SPEC = (
    "run_id:text outcome_name:text specification:text coefficient:num standard_error:num "
    "confidence_interval_lower:num confidence_interval_upper:num p_value:num provider_count:long "
    "observation_count:long"
)


RESULTS = ("policy_effect_estimate", "event_study_estimate", "policy_diagnostic")


def estimates(model):
    """The three result tables; one pair of passes fills all of them."""
    computed = {}

    def table(name):
        if not computed:
            computed.update(policy.estimate_policy(panel(model), DESIGN))
        return computed[name]

    return {name: model.layers.keep(name, lambda name=name: table(name), DESIGN) for name in RESULTS}


define(DESIGN)
SUBQUERIES["l_effects"] = f"""SELECT '{DESIGN.run_id}' AS run_id, outcome_name, specification, round(b, 4) AS coefficient,
  round(se, 4) AS standard_error, round(b - 1.96 * se, 4) AS confidence_interval_lower,
  round(b + 1.96 * se, 4) AS confidence_interval_upper, round(p, 4) AS p_value, groups AS provider_count,
  observations AS observation_count FROM l_terms WHERE specification IN {EFFECTS}"""


def effects_where(test):
    return lambda m: estimates(m)["policy_effect_estimate"].filter(test)


for name, test in {
    "l2_policy_effects": "true",
    "l3_winsorized_effects": "specification = 'winsorized_99_percent'",
    "l4_unweighted_effects": "specification = 'unweighted_provider_month'",
}.items():
    register(name, effects_where(test), EFFECT_SPEC, f"SELECT * FROM l_effects WHERE {test}")
# how far each bound lies from 1.96 errors, and whether the interval leaves zero out, of every effect
register(
    "l6_intervals",
    lambda m: estimates(m)["policy_effect_estimate"].selectExpr(
        "outcome_name", "specification", "confidence_interval_lower", "confidence_interval_upper", "p_value",
        "confidence_interval_lower > 0 or confidence_interval_upper < 0 as excludes_zero",
        "abs(confidence_interval_upper - coefficient - 1.96 * standard_error) <= 0.001 as matches_error"),
    "outcome_name:text specification:text confidence_interval_lower:num confidence_interval_upper:num p_value:num "
    "excludes_zero:bool matches_error:bool",
    "SELECT outcome_name, specification, confidence_interval_lower, confidence_interval_upper, p_value, "
    "abs(coefficient) > 1.96 * standard_error AS excludes_zero, TRUE AS matches_error FROM l_effects",
)
register(
    "l6_interval_violations",
    lambda m: estimates(m)["policy_effect_estimate"].filter(
        "coefficient not between confidence_interval_lower and confidence_interval_upper "
        "or abs(confidence_interval_upper - coefficient - 1.96 * standard_error) > 0.001 or p_value not between 0 and 1"
    ),
    EFFECT_SPEC,
    "SELECT * FROM l_effects WHERE coefficient NOT BETWEEN confidence_interval_lower AND confidence_interval_upper "
    "OR abs(confidence_interval_upper - coefficient - 1.96 * standard_error) > 0.001 OR p_value NOT BETWEEN 0 AND 1",
)
register(
    "l5_event_study",
    lambda m: estimates(m)["event_study_estimate"],
    "run_id:text outcome_name:text event_time:long coefficient:num standard_error:num "
    "confidence_interval_lower:num confidence_interval_upper:num p_value:num",
    f"SELECT '{DESIGN.run_id}' AS run_id, outcome_name, event_time, round(b, 4) AS coefficient, round(se, 4) AS standard_error, "
    "round(b - 1.96 * se, 4) AS confidence_interval_lower, round(b + 1.96 * se, 4) AS confidence_interval_upper, "
    "round(p, 4) AS p_value FROM l_terms WHERE specification = 'event_study'",
)
DIAGNOSTIC_SPEC = (
    "run_id:text outcome_name:text diagnostic_name:text specification:text statistic:num p_value:num "
    "passed:bool explanation:text"
)
register(
    "l7_pretrend_tests",
    lambda m: estimates(m)["policy_diagnostic"].filter("diagnostic_name = 'parallel_trends'"), DIAGNOSTIC_SPEC,
    f"SELECT '{DESIGN.run_id}' AS run_id, outcome_name, 'parallel_trends' AS diagnostic_name, 'joint_wald' AS specification, "
    f"round(statistic, 4) AS statistic, round(p, 4) AS p_value, p >= {DESIGN.significance} AS passed, "
    "'Joint Wald test of treatment-specific event coefficients -12 through -2.' AS explanation FROM l_wald",
)
register(
    "l8_placebo_tests",
    lambda m: estimates(m)["policy_diagnostic"].filter("diagnostic_name = 'placebo_policy_date'"), DIAGNOSTIC_SPEC,
    f"SELECT '{DESIGN.run_id}' AS run_id, outcome_name, 'placebo_policy_date' AS diagnostic_name, '1999-07-01' AS specification, "
    f"round(b, 4) AS statistic, round(p, 4) AS p_value, p >= {DESIGN.significance} AS passed, "
    "'Pretreatment-only placebo interaction at July 1999.' AS explanation FROM l_terms WHERE specification = 'placebo'",
)


def four(column):
    return F.round(column, 4).alias(column)


register(
    "l3_winsor_limits",
    lambda m: exact_percentiles(
        panel(m).unpivot(["provider_key"], [F.col(o).cast("double").alias(o) for o in policy.OUTCOMES],
                         "outcome", "value"),
        ["outcome"], "value", {"upper_limit": 0.99},
    ).select("outcome", four("upper_limit")),
    "outcome:text upper_limit:num",
    "SELECT outcome, round(quantile_cont(CAST(value AS DOUBLE), 0.99), 4) AS upper_limit FROM (UNPIVOT "
    "(SELECT provider_key, paid_pmpm, allowed_pmpm, claims_per_1000, denial_rate, review_rate FROM p_panel) "
    f"ON {', '.join(policy.OUTCOMES)} INTO NAME outcome VALUE value) u GROUP BY outcome",
)


def inpatient(model):
    return silver.typed_silver(bronze_frame(model, "inpatient"), INPATIENT)


BENCH_COHORT = ["ms_drg_code", "reporting_year"]
register(
    "e21_peer_benchmarks",
    lambda m: benchmark.peer_benchmark(inpatient(m), BENCH_COHORT, "average_total_payment").select(
        *BENCH_COHORT, "peer_count", four("mean"), four("standard_deviation"), *map(four, benchmark.STATISTICS)
    ),
    "ms_drg_code:text reporting_year:long peer_count:long mean:num standard_deviation:num percentile_25:num "
    "median:num percentile_75:num percentile_90:num percentile_95:num",
    "SELECT ms_drg_code, reporting_year, count(*) AS peer_count, "
    f"{half_up(scaled('sum(average_total_payment)', 6), '1000000 * ' + whole('count(*)'))} AS mean, "
    "round(stddev_samp(v), 4) AS standard_deviation, "
    + ", ".join(f"round(quantile_cont(v, {f}), 4) AS {n}" for n, f in benchmark.STATISTICS.items())
    + " FROM (SELECT *, CAST(average_total_payment AS DOUBLE) AS v FROM silver_inpatient) s "
    "GROUP BY ms_drg_code, reporting_year HAVING count(*) >= 11",
)
register(
    "e22_band_cut_points",
    lambda m: benchmark.band_cut_points(inpatient(m), "total_discharges").select(*map(four, benchmark.QUARTILES)),
    "percentile_25:num median:num percentile_75:num",
    "SELECT " + ", ".join(f"quantile_cont(total_discharges, {f}) AS {n}" for n, f in benchmark.QUARTILES.items())
    + " FROM silver_inpatient",
)
register(
    "e21_line_amount_percentiles",
    lambda m: exact_percentiles(m.claim_line, ["service_code_system"], "allowed_amount",
                                {"median": 0.5, "percentile_99": 0.99}).select(
        "service_code_system", four("median"), four("percentile_99")),
    "service_code_system:text median:num percentile_99:num",
    "SELECT service_code_system, round(quantile_cont(CAST(allowed_amount AS DOUBLE), 0.5), 4) AS median, "
    "round(quantile_cont(CAST(allowed_amount AS DOUBLE), 0.99), 4) AS percentile_99 FROM op_claim_line "
    "GROUP BY service_code_system",
)
