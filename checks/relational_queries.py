"""Single relational operators of the inventory on the claims tables."""

from datetime import date

from pyspark.sql import functions as F

from checks.bronze_model import BRONZE, bronze_frame
from checks.oracle_numbers import half_even, half_up
from checks.policy_queries import DESIGN
from checks.registry import register
from checks.star_queries import star_of
from claimloom.functions.dates import month_end, month_spine
from claimloom.plans import conformed, cost
from claimloom.plans.policy import member_attribution
from claimloom.sources import landing, publish

current = lambda m: cost.current_claims(m.facts)
register("c2_current_claims", current, "claim_id:text logical_claim_id:text claim_version_number:long",
         "SELECT * FROM f_claims WHERE is_current_version")
register(
    "c3_status_filters",
    lambda m: m.claim_review.filter("review_status = 'completed'").join(
        current(m).filter("claim_status = 'paid'").select("claim_id", "claim_status"), "claim_id"),
    "review_id:text claim_id:text claim_status:text",
    "SELECT review_id, claim_id, claim_status FROM op_claim_review JOIN f_claims USING (claim_id) "
    "WHERE review_status = 'completed' AND is_current_version AND claim_status = 'paid'",
)
register(
    "d1_required_key_lookup",
    lambda m: star_of(m).fact_claim.select("claim_id", "member_key", "plan_key", "billing_provider_key"),
    "claim_id:text member_key:long plan_key:long billing_provider_key:long",
    "SELECT claim_id, member_key, plan_key, billing_provider_key FROM f_claims JOIN k_member USING (member_id)",
)
register(
    "d2_optional_key_lookup",
    lambda m: star_of(m).fact_claim.select("claim_id", "prior_claim_key", "rendering_provider_key"),
    "claim_id:text prior_claim_key:long rendering_provider_key:long",
    "SELECT claim_id, prior_claim_key, rendering_provider_key FROM fact_claim",
)
register(
    "d3_date_roles",
    lambda m: star_of(m).fact_claim.select(
        "claim_id", "service_date_key", "service_through_date_key", "received_date_key", "adjudication_date_key"),
    "claim_id:text service_date_key:long service_through_date_key:long received_date_key:long adjudication_date_key:long",
    "SELECT claim_id, service_date_key, service_through_date_key, received_date_key, adjudication_date_key FROM fact_claim",
)
register(
    "d4_composite_key_lookup",
    lambda m: star_of(m).fact_claim_line.select("claim_line_id", "service_key"),
    "claim_line_id:text service_key:long",
    "SELECT claim_line_id, service_key FROM fact_claim_line",
)
register(
    "d5_claims_with_child_totals",
    lambda m: m.claim_header.select("claim_id").join(
        m.claim_line.groupBy("claim_id").agg(F.count("*").alias("lines"), F.sum("allowed_amount").alias("allowed")),
        "claim_id", "left",
    ).na.fill(0, ["lines", "allowed"]),
    "claim_id:text lines:long allowed:num",
    "SELECT claim_id, coalesce(n, 0) AS lines, coalesce(a, 0) AS allowed FROM op_claim_header LEFT JOIN "
    "(SELECT claim_id, count(*) AS n, sum(allowed_amount) AS a FROM op_claim_line GROUP BY claim_id) l USING (claim_id)",
)
register(
    "d6_reviews_with_audits",
    lambda m: star_of(m).fact_claim_review,
    "review_id:text audit_outcome:text confirmed_amount:num",
    "SELECT review_id, audit_outcome, confirmed_amount FROM fact_claim_review",
)
register(
    "d8_enriched_lines",
    lambda m: m.facts.lines.select("claim_line_id", "claim_id", "service_code_system").join(
        m.facts.claims.select("claim_id", "specialty_group", "billing_provider_id", "plan_key"), "claim_id"),
    "claim_line_id:text specialty_group:text billing_provider_id:text service_code_system:text plan_key:long",
    "SELECT claim_line_id, specialty_group, billing_provider_id, service_code_system, plan_key FROM f_lines JOIN "
    "(SELECT claim_id, specialty_group, billing_provider_id, plan_key FROM f_claims) c USING (claim_id)",
)
register(
    "d9_full_outer_claims_and_reviews",
    lambda m: m.claim_review.select("claim_id", "review_id").join(
        m.denial_outcome.select("claim_id", "denial_id"), "claim_id", "full"),
    "claim_id:text review_id:text denial_id:text",
    "SELECT claim_id, review_id, denial_id FROM op_claim_review FULL JOIN op_denial_outcome USING (claim_id)",
)
register(
    "d10_prior_year_months",
    lambda m: cost.category_totals(m.facts).alias("n").join(
        cost.category_totals(m.facts).select(
            F.add_months("service_month", 12).alias("service_month"), "plan_key", "service_category",
            F.col("amount").alias("prior_amount")),
        ["service_month", "plan_key", "service_category"],
    ).select("service_month", "plan_key", "service_category", "amount", "prior_amount"),
    "service_month:date plan_key:long service_category:text amount:num prior_amount:num",
    "SELECT n.service_month, n.plan_key, n.service_category, n.amount, b.amount AS prior_amount FROM f_categories n "
    "JOIN f_categories b ON b.plan_key = n.plan_key AND b.service_category = n.service_category "
    "AND n.service_month = CAST(b.service_month + INTERVAL 12 MONTH AS DATE)",
)
register(
    "d12_attributed_exposure",
    lambda m: m.facts.memberships.filter("coverage_status = 'active'").join(
        member_attribution(m.facts, DESIGN), "member_id"
    ).groupBy("provider_key").agg(F.count("*").alias("member_months")),
    "provider_key:long member_months:long",
    "SELECT provider_key, count(*) AS member_months FROM op_membership_month JOIN p_attribution USING (member_id) "
    "WHERE coverage_status = 'active' GROUP BY provider_key",
)
register(
    "e15_filtered_counts",
    lambda m: m.facts.claims.groupBy("plan_key").agg(
        *[F.count_if(F.col("claim_status") == s).alias(s) for s in ("paid", "denied", "adjusted")],
        F.count_if(F.col("adjudication_date").isNull()).alias("undecided")),
    "plan_key:long paid:long denied:long adjusted:long undecided:long",
    "SELECT plan_key, count(*) FILTER (WHERE claim_status = 'paid') AS paid, count(*) FILTER (WHERE claim_status = 'denied') "
    "AS denied, count(*) FILTER (WHERE claim_status = 'adjusted') AS adjusted, "
    "count(*) FILTER (WHERE adjudication_date IS NULL) AS undecided FROM f_claims GROUP BY plan_key",
)
register(
    "e18_duplicate_key_groups",
    lambda m: m.read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).filter("copies > 1"),
    "l_orderkey:long l_linenumber:long copies:long",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
register("e19_ledger_net", lambda m: conformed.ledger_net(m.payment_transaction), "claim_id:text net_paid_amount:num",
         "SELECT claim_id, net AS net_paid_amount FROM f_net")
register(
    "e8_panel_cell_counts",
    lambda m: current(m).groupBy("billing_provider_key", "service_month").agg(
        F.count("*").alias("claims"), F.count_if(F.col("claim_status") == "denied").alias("denied")),
    "billing_provider_key:long service_month:date claims:long denied:long",
    "SELECT billing_provider_key, service_month, count(*) AS claims, count(*) FILTER (WHERE claim_status = 'denied') AS denied "
    "FROM f_claims WHERE is_current_version GROUP BY ALL",
)
register(
    "f2_reversal_seen",
    lambda m: m.payment_transaction.join(
        m.payment_transaction.filter("transaction_type = 'reversal'").groupBy("claim_id").agg(
            F.min("transaction_sequence_number").alias("first_reversal")), "claim_id"
    ).select("payment_transaction_id", (F.col("transaction_sequence_number") > F.col("first_reversal")).alias("after_reversal")),
    "payment_transaction_id:text after_reversal:bool",
    "SELECT payment_transaction_id, transaction_sequence_number > f AS after_reversal FROM op_payment_transaction JOIN "
    "(SELECT claim_id, min(transaction_sequence_number) AS f FROM op_payment_transaction WHERE transaction_type = 'reversal' "
    "GROUP BY claim_id) r USING (claim_id)",
)
register(
    "f3_first_and_last_lines",
    lambda m: m.claim_line.groupBy("claim_id").agg(F.min("line_number").alias("first_line"), F.max("line_number").alias("last_line")),
    "claim_id:text first_line:long last_line:long",
    "SELECT claim_id, min(line_number) AS first_line, max(line_number) AS last_line FROM op_claim_line GROUP BY claim_id",
)
register(
    "f12_latest_per_key",
    lambda m: landing.latest_per_key(
        m.claim_header.select("logical_claim_id", "claim_version_number", "claim_id"), ["logical_claim_id"],
        F.col("claim_version_number")),
    "logical_claim_id:text claim_version_number:long claim_id:text",
    "SELECT logical_claim_id, claim_version_number, claim_id FROM f_claims WHERE is_current_version",
)
register(
    "f13_repeated_service_counts",
    lambda m: m.claim_line.groupBy("claim_id", "service_code_system", "service_code").agg(F.count("*").alias("times")).filter("times > 1"),
    "claim_id:text service_code_system:text service_code:text times:long",
    "SELECT claim_id, service_code_system, service_code, count(*) AS times FROM op_claim_line GROUP BY ALL HAVING count(*) > 1",
)
register(
    "g6_month_spine",
    lambda m: m.read("customer").select(
        "c_custkey", F.explode(month_spine(date(2000, 11, 5), date(2001, 2, 10))).alias("month")
    ).withColumn("last_day", month_end(F.col("month"), date(2001, 2, 10))),
    "c_custkey:long month:date last_day:date",
    "SELECT c_custkey, month, least(last_day(month), DATE '2001-02-10') AS last_day FROM customer, "
    "(VALUES (DATE '2000-11-01'), (DATE '2000-12-01'), (DATE '2001-01-01'), (DATE '2001-02-01')) v(month) "
    "",
)
register(
    "g10_distinct_sorted_values",
    lambda m: bronze_frame(m, "geographic").agg(
        F.array_join(F.array_sort(F.collect_set("BENE_GEO_LVL")), ",").alias("levels"),
        F.array_join(F.array_sort(F.collect_set("YEAR")), ",").alias("years")),
    "levels:text years:text",
    "SELECT array_to_string(list_sort(list(DISTINCT BENE_GEO_LVL)), ',') AS levels, "
    "array_to_string(list_sort(list(DISTINCT YEAR)), ',') AS years FROM bronze_geographic",
)
register(
    "g11_union_all",
    lambda m: m.claim_review.select("claim_id", F.lit("review").alias("kind")).unionByName(
        m.denial_outcome.select("claim_id", F.lit("denial").alias("kind"))),
    "claim_id:text kind:text",
    "SELECT claim_id, 'review' AS kind FROM op_claim_review UNION ALL SELECT claim_id, 'denial' FROM op_denial_outcome",
)
register("g12_distinct_dates", lambda m: star_of(m).dim_date, "calendar_date:date", "SELECT calendar_date FROM dim_date")
register(
    "a15_stable_sample",
    lambda m: publish.stable_sample(m.claim_header, ["claim_id"], 25),
    "claim_id:text claim_status:text",
    "SELECT claim_id, claim_status FROM op_claim_header ORDER BY claim_id LIMIT 25",
)
register(
    "a9_table_profile",
    lambda m: landing.profile(bronze_frame(m, "inpatient")),
    "position:long column_name:text column_type:text is_nullable:bool row_count:long",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{'int' if c == '_reporting_year' else 'string'}' AS column_type, "
        "TRUE AS is_nullable, count(*) AS row_count FROM bronze_inpatient"
        for i, c in enumerate(BRONZE["inpatient"][1])),
)


register(
    "n_scalar_functions",
    lambda m: m.claim_header.select(
        "claim_id",
        F.upper(F.trim("claim_status")).alias("status"),
        F.coalesce(F.nullif("principal_diagnosis_code", F.lit("I10")), F.lit("none")).alias("diagnosis"),
        F.quarter("service_from_date").alias("quarter"),
        F.date_format("service_from_date", "yyyy-MM").alias("year_month"),
        F.round(F.col("total_allowed_amount") / F.lit(8).cast("decimal(2,0)"), 2).alias("half_up"),
        F.bround(F.col("total_allowed_amount") / F.lit(8).cast("decimal(2,0)"), 2).alias("half_even"),
        F.substr(F.col("claim_id"), F.lit(4)).cast("bigint").alias("number"),
    ),
    "claim_id:text status:text diagnosis:text quarter:long year_month:text half_up:num half_even:num number:long",
    "SELECT claim_id, upper(claim_status) AS status, coalesce(nullif(principal_diagnosis_code, 'I10'), 'none') AS diagnosis, "
    "quarter(service_from_date) AS quarter, strftime(service_from_date, '%Y-%m') AS year_month, "
    + "{} AS half_up, {} AS half_even, CAST(substr(claim_id, 4) AS BIGINT) AS number FROM op_claim_header".format(
        half_up("CAST(total_allowed_amount * 100 AS HUGEINT)", "800", 2),
        half_even("CAST(total_allowed_amount * 100 AS HUGEINT)", "800", 2)),
)
