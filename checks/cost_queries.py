"""Cost, utilization and cash-flow marts."""

from checks.oracle_base import SUBQUERIES
from checks.oracle_numbers import half_up, scaled, whole
from checks.registry import register
from claimloom.plans import cost

SUBQUERIES["k_plan"] = "SELECT plan_id, row_number() OVER (ORDER BY plan_id) AS plan_key FROM op_plan"
SUBQUERIES["k_provider"] = (
    "SELECT provider_id, specialty_group, row_number() OVER (ORDER BY provider_id) AS provider_key "
    "FROM op_provider"
)
SUBQUERIES["f_net"] = (
    "SELECT claim_id, sum(signed_transaction_amount) AS net FROM op_payment_transaction GROUP BY claim_id"
)
SUBQUERIES["f_claims"] = """
SELECT h.*, p.plan_key, b.provider_key AS billing_provider_key, b.specialty_group,
  CAST(date_trunc('month', service_from_date) AS DATE) AS service_month,
  service_from_date AS service_date, CAST(coalesce(net, 0) AS DECIMAL(18,2)) AS net_paid_amount,
  claim_version_number = max(claim_version_number) OVER (PARTITION BY logical_claim_id) AS is_current_version
FROM op_claim_header h JOIN k_plan p USING (plan_id)
JOIN k_provider b ON b.provider_id = h.billing_provider_id LEFT JOIN f_net USING (claim_id)"""
SUBQUERIES["k_category"] = """
SELECT CAST(p_partkey AS VARCHAR) AS service_code, CASE p_type WHEN 'ECONOMY' THEN 'evaluation_management'
  WHEN 'LARGE' THEN 'cardiovascular' WHEN 'MEDIUM' THEN 'endocrine' WHEN 'PROMO' THEN 'musculoskeletal'
  WHEN 'SMALL' THEN 'respiratory' WHEN 'STANDARD' THEN 'behavioral' END AS mapped
FROM part WHERE p_partkey % 10 <> 0"""
SUBQUERIES["f_lines"] = """
SELECT l.*, CAST(allowed_amount - member_liability_amount AS DECIMAL(18,2)) AS plan_paid_amount,
  coalesce(mapped, lower(replace(service_code_system, '-', '_'))) AS service_category,
  CAST(date_trunc('month', service_date) AS DATE) AS service_month
FROM op_claim_line l LEFT JOIN k_category USING (service_code)"""
SUBQUERIES["f_paid_lines"] = """
SELECT l.*, c.plan_key FROM f_lines l JOIN f_claims c USING (claim_id)
WHERE c.is_current_version AND c.claim_status = 'paid'"""
SUBQUERIES["f_exposure"] = """
SELECT coverage_month AS service_month, plan_key, count(*) AS eligible_member_months
FROM op_membership_month JOIN k_plan USING (plan_id) WHERE coverage_status = 'active' GROUP BY ALL"""

MEMBERS = whole("eligible_member_months")
SUBQUERIES["mart_cost"] = f"""
SELECT *, {half_up(scaled('allowed_amount', 2), f'100 * {MEMBERS}')} AS allowed_pmpm,
  {half_up(scaled('paid_amount', 2), f'100 * {MEMBERS}')} AS paid_pmpm,
  {half_up(whole('claim_count * 1000'), MEMBERS)} AS claims_per_1000,
  {half_up(scaled('service_units', 4), f'10 * {MEMBERS}')} AS units_per_1000,
  {half_up(scaled('allowed_amount', 2), f'100 * {whole("paid_claim_count")}')} AS allowed_per_claim
FROM (
  SELECT service_month, plan_key, eligible_member_months, coalesce(claim_count, 0) AS claim_count,
    coalesce(paid_claim_count, 0) AS paid_claim_count,
    CAST(coalesce(service_units, 0) AS DECIMAL(18,4)) AS service_units,
    CAST(coalesce(allowed_amount, 0) AS DECIMAL(18,2)) AS allowed_amount,
    CAST(coalesce(paid_amount, 0) AS DECIMAL(18,2)) AS paid_amount
  FROM f_exposure
  LEFT JOIN (
    SELECT service_month, plan_key, count(*) AS claim_count,
      count(*) FILTER (WHERE claim_status = 'paid') AS paid_claim_count,
      sum(total_allowed_amount) FILTER (WHERE claim_status = 'paid') AS allowed_amount,
      sum(net_paid_amount) FILTER (WHERE claim_status = 'paid') AS paid_amount
    FROM f_claims WHERE is_current_version GROUP BY ALL) USING (service_month, plan_key)
  LEFT JOIN (SELECT service_month, plan_key, sum(units) AS service_units FROM f_paid_lines GROUP BY ALL)
    USING (service_month, plan_key)) cells"""

COST_SPEC = (
    "service_month:date plan_key:long eligible_member_months:long claim_count:long paid_claim_count:long "
    "service_units:num allowed_amount:num paid_amount:num allowed_pmpm:num paid_pmpm:num "
    "claims_per_1000:num units_per_1000:num allowed_per_claim:num"
)
register(
    "e1_member_month_exposure",
    lambda m: cost.exposure(m.facts),
    "service_month:date plan_key:long eligible_member_months:long",
    "SELECT * FROM f_exposure",
)
register("e2_monthly_cost_utilization", lambda m: cost.monthly_cost_utilization(m.facts), COST_SPEC,
         "SELECT * FROM mart_cost")
register(
    "e3_cost_and_utilization_rates",
    lambda m: cost.monthly_cost_utilization(m.facts).select(
        "service_month", "plan_key", *cost.SIGNAL_METRICS, "allowed_per_claim"
    ),
    "service_month:date plan_key:long allowed_pmpm:num paid_pmpm:num claims_per_1000:num "
    "units_per_1000:num allowed_per_claim:num",
    "SELECT * FROM mart_cost",
)

SUBQUERIES["mart_cash"] = """
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS payment_month, plan_key,
  count(*) AS transaction_count, count(*) FILTER (WHERE transaction_type = 'payment') AS payment_count,
  count(*) FILTER (WHERE transaction_type <> 'payment') AS reversal_count,
  sum(signed_transaction_amount) AS net_payment_cash_flow
FROM op_payment_transaction JOIN f_claims USING (claim_id) GROUP BY ALL"""
register(
    "e4_monthly_payment_cash_flow",
    lambda m: cost.monthly_payment_cash_flow(m.facts),
    "payment_month:date plan_key:long transaction_count:long payment_count:long reversal_count:long "
    "net_payment_cash_flow:num",
    "SELECT * FROM mart_cash",
)


def concentration_sql(entity: str, amounts: str) -> str:
    share = half_up(scaled("top_10_allowed_amount", 2), scaled("total_allowed_amount", 2))
    return f"""
SELECT *, {share} AS top_10_share, round(squares / nullif(CAST(total_allowed_amount AS DOUBLE)
    * CAST(total_allowed_amount AS DOUBLE), 0), 4) AS hhi
FROM (
  SELECT service_month, plan_key, '{entity}' AS entity_type, count(*) AS entity_count,
    sum(amount) AS total_allowed_amount, sum(amount) FILTER (WHERE place <= 10) AS top_10_allowed_amount,
    CAST(sum(amount * amount) AS DOUBLE) AS squares
  FROM (SELECT *, row_number() OVER (PARTITION BY service_month, plan_key ORDER BY amount DESC) AS place
    FROM ({amounts}) entity_amounts) ranked
  GROUP BY service_month, plan_key) sums"""


PROVIDER_AMOUNTS = """
SELECT service_month, plan_key, billing_provider_key, CAST(sum(total_allowed_amount) AS DECIMAL(18,2)) AS amount
FROM f_claims WHERE is_current_version AND claim_status = 'paid' GROUP BY ALL"""
SERVICE_AMOUNTS = """
SELECT service_month, plan_key, service_code_system, service_code,
  CAST(sum(allowed_amount) AS DECIMAL(18,2)) AS amount
FROM f_paid_lines GROUP BY ALL"""
SUBQUERIES["mart_concentration"] = (
    f"SELECT * FROM ({concentration_sql('provider', PROVIDER_AMOUNTS)}) "
    f"UNION ALL SELECT * FROM ({concentration_sql('service', SERVICE_AMOUNTS)})"
)
CONCENTRATION_SPEC = (
    "service_month:date plan_key:long entity_type:text entity_count:long total_allowed_amount:num "
    "top_10_allowed_amount:num top_10_share:num hhi:num"
)
register(
    "e5_provider_service_concentration",
    lambda m: cost.provider_service_concentration(m.facts),
    CONCENTRATION_SPEC,
    "SELECT * FROM mart_concentration",
)
register(
    "f11_top_ten_share",
    lambda m: cost.concentration_of(cost.provider_amounts(m.facts), "provider").select(
        "service_month", "plan_key", "top_10_allowed_amount", "top_10_share"
    ),
    "service_month:date plan_key:long top_10_allowed_amount:num top_10_share:num",
    "SELECT * FROM mart_concentration WHERE entity_type = 'provider'",
)

SUBQUERIES["f_categories"] = """
SELECT service_month, plan_key, service_category, sum(allowed_amount) AS amount, sum(units) AS units
FROM f_paid_lines GROUP BY ALL"""
register(
    "e7_category_totals",
    lambda m: cost.category_totals(m.facts),
    "service_month:date plan_key:long service_category:text amount:num units:num",
    "SELECT * FROM f_categories",
)
A1, A0 = scaled("now_amount", 2), scaled("was_amount", 2)
U1, U0 = scaled("now_units", 4), scaled("was_units", 4)
SUBQUERIES["mart_decomposition"] = f"""
SELECT reporting_month, base_month, plan_key, service_category, was_amount AS base_allowed_amount,
  now_amount AS current_allowed_amount, now_amount - was_amount AS total_cost_change,
  {half_up(f'{A1} * {U0} - {A0} * {U1}', U1, 0)} / 100 AS price_effect,
  {half_up(f'{A0} * {U1} - {A0} * {U0}', U0, 0)} / 100 AS utilization_effect,
  {half_up(f'({A1} + {A0}) * {U1} * {U0} - {A1} * {U0} * {U0} - {A0} * {U1} * {U1}', f'{U1} * {U0}', 0)} / 100
    AS mix_effect,
  0 AS reconciliation_residual
FROM (
  SELECT n.service_month AS reporting_month, b.service_month AS base_month, n.plan_key, n.service_category,
    n.amount AS now_amount, n.units AS now_units, b.amount AS was_amount, b.units AS was_units
  FROM f_categories n JOIN f_categories b ON b.plan_key = n.plan_key
    AND b.service_category = n.service_category
    AND b.service_month = CAST(n.service_month - INTERVAL 12 MONTH AS DATE)
  WHERE n.units <> 0 AND b.units <> 0) paired"""
DECOMPOSITION_SPEC = (
    "reporting_month:date base_month:date plan_key:long service_category:text base_allowed_amount:num "
    "current_allowed_amount:num total_cost_change:num price_effect:num utilization_effect:num "
    "mix_effect:num reconciliation_residual:num"
)
register(
    "e6_cost_change_decomposition",
    lambda m: cost.cost_change_decomposition(m.facts),
    DECOMPOSITION_SPEC,
    "SELECT * FROM mart_decomposition",
)


def list_median(values: str) -> str:
    """Doubled median of a list of whole numbers, so that the middle of two stays whole."""
    ordered = f"list_sort({values})"
    return (
        f"({ordered}[CAST((len({values}) + 1) // 2 AS BIGINT)] "
        f"+ {ordered}[CAST(len({values}) // 2 + 1 AS BIGINT)])"
    )


CENTER = f"CAST(round({half_up(whole(list_median('past')), '2', 0)}) AS BIGINT)"
SPREAD = "list_transform(past, lambda x: abs(x - center))"
SCALE = f"CAST(round({half_up(whole(list_median(SPREAD)), '2', 0)}) AS BIGINT)"
SUBQUERIES["mart_signals"] = f"""
SELECT service_month, plan_key, metric_name, value / 10000.0 AS metric_value, history_month_count,
  center / 10000.0 AS baseline_median, spread / 10000.0 AS baseline_mad, robust_z_score, relative_change,
  signal_status, metric_name || ': ' || signal_status || '; history_months=' || history_month_count
    AS explanation
FROM (
  SELECT *, CASE WHEN NOT enough THEN 'insufficient_history'
    WHEN robust_z_score >= 3.0 AND abs(relative_change) >= 0.2 THEN 'warning' ELSE 'normal' END
    AS signal_status
  FROM (
    SELECT *, {half_up(whole('value - center'), whole('spread'))} AS robust_z_score,
      {half_up(whole('value - center'), whole('center'))} AS relative_change
    FROM (
      SELECT *, CASE WHEN enough THEN {SCALE} END AS spread
      FROM (
        SELECT *, len(past) AS history_month_count,
          len(past) >= 6 AND eligible_member_months >= 100 AS enough,
          CASE WHEN len(past) >= 6 AND eligible_member_months >= 100 THEN {CENTER} END AS center
        FROM (
          SELECT *, coalesce(list(value) OVER (PARTITION BY plan_key, metric_name ORDER BY service_month
            ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), []) AS past
          FROM (
            SELECT service_month, plan_key, eligible_member_months, metric_name,
              CAST(round(metric_value * 10000) AS BIGINT) AS value
            FROM (UNPIVOT (SELECT service_month, plan_key, eligible_member_months, allowed_pmpm, paid_pmpm,
                claims_per_1000, units_per_1000 FROM mart_cost)
              ON allowed_pmpm, paid_pmpm, claims_per_1000, units_per_1000
              INTO NAME metric_name VALUE metric_value)) long_form) windowed) centered) scaled_rows) scored
) labelled"""
SIGNAL_SPEC = (
    "service_month:date plan_key:long metric_name:text metric_value:num history_month_count:long "
    "baseline_median:num baseline_mad:num robust_z_score:num relative_change:num signal_status:text "
    "explanation:text"
)
register(
    "f6_early_warning_signals",
    lambda m: cost.early_warning_signals(cost.monthly_cost_utilization(m.facts)),
    SIGNAL_SPEC,
    "SELECT * FROM mart_signals",
)
