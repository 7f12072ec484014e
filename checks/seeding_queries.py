"""Seeded irregularities: labels, inserted rows, field changes, isolation and the whole back-test."""

from datetime import date
from functools import partial

from pyspark.sql import functions as F

from checks.oracle_base import SUBQUERIES
from checks.oracle_numbers import half_even, scaled
from checks.registry import register
from checks.rule_queries import SETTINGS as RULES
from checks.rule_queries import limits_of
from claimloom.contracts.review_rules import INCOMPATIBLE_DIAGNOSIS
from claimloom.functions import hashing
from claimloom.operators import differences, quality
from claimloom.plans import conformed, evaluation, rules, seeding

SEED = seeding.SeedSettings(seed=731, policy_start=date(2000, 1, 1))
STEPS = ("record", "ledger", "outlier", "surge", "repeat", "diagnosis")


def seeding_steps(model, upto="diagnosis", write_tables=False):
    """``step, before, after, changes`` of each step in turn, ``changes`` being the step's own.

    Every step reads written target lists; with ``write_tables`` the tables that a step changes are written too.
    """
    names = "member plan provider claim_header claim_line adjudication_event payment_transaction".split()
    state = seeding.Seeded({n: getattr(model, n) for n in names}, keep=partial(model.layers.keep, settings=SEED))
    run = {
        "record": seeding.seed_record_level,
        "ledger": seeding.seed_ledger,
        "outlier": seeding.seed_outlier_amounts,
        "surge": seeding.seed_surges,
        "repeat": lambda s, c: seeding.seed_repeated_procedures(s, c, limits_of(model)),
        "diagnosis": lambda s, c: seeding.seed_diagnoses(s, c, model.service_categories),
    }
    for step in STEPS[: STEPS.index(upto) + 1]:
        before = state
        state = run[step](seeding.replace(before, changes=None), SEED)
        own = state.changes
        state = seeding.replace(state, changes=own if before.changes is None else before.changes.unionByName(own))
        if step != STEPS[-1]:
            # later steps read the labels so far several times
            state = seeding.replace(state, labels=model.layers.keep(f"seed_labels_{step}", lambda s=state: s.labels, SEED))
        if write_tables:
            changed = {n: model.layers.keep(f"seeded_{step}_{n}", lambda t=t: t, SEED)
                       for n, t in state.tables.items() if t is not before.tables[n]}
            state = seeding.replace(state, tables={**state.tables, **changed})
        yield step, before, state, own


def seeded(model, upto="diagnosis"):
    """State after the given step."""
    *_, (_, _, state, _) = seeding_steps(model, upto)
    return state


def ranked(namespace, identity):
    return f"sha256('{SEED.seed}:{namespace}:' || {identity})"


def number(column):
    return f"CAST(substr({column}, 4) AS BIGINT)"


def fresh(prefix, top, offset, width):
    return f"'{prefix}' || lpad(CAST({top} + {offset} AS VARCHAR), {width}, '0')"


PAYABLE = "claim_status IN ('paid', 'adjusted')"
SUBQUERIES["s_tops"] = f"""
SELECT (SELECT max({number('claim_line_id')}) FROM op_claim_line) AS line_top,
  (SELECT max({number('payment_transaction_id')}) FROM op_payment_transaction) AS pay_top,
  (SELECT max({number('claim_id')}) FROM op_claim_header) AS claim_top"""
SUBQUERIES["s_rec"] = f"""
SELECT 'INJ' || lpad(CAST(so + 1 AS VARCHAR), 10, '0') AS injection_id, rule_id,
  CASE WHEN copied THEN {fresh('LIN', 'line_top', 'so + 1', 18)} ELSE claim_id END AS target_record_id, claim_id,
  billing_provider_id AS provider_id, service_month AS reporting_period,
  CASE WHEN copied THEN line_net WHEN rule_id = 'PI005' THEN 10.00
    ELSE total_allowed_amount - total_member_liability_amount + 10 - last_payment END AS exposure
FROM (
  SELECT *, ['PI001', 'PI002', 'PI005', 'PI006'][CAST(so // 50 + 1 AS INTEGER)] AS rule_id, so < 100 AS copied
  FROM (SELECT *, row_number() OVER (ORDER BY d) - 1 AS so FROM (
    SELECT *, {ranked('record_level_target', 'claim_id')} AS d FROM f_claims
    WHERE {PAYABLE} AND claim_id IN (SELECT claim_id FROM op_payment_transaction)
      AND claim_id IN (SELECT claim_id FROM op_claim_line) ORDER BY d LIMIT 200) c) o) t
JOIN (SELECT claim_id, arg_min(plan_paid_amount, line_number) AS line_net FROM f_lines GROUP BY claim_id) l USING (claim_id)
JOIN (SELECT claim_id, arg_max(signed_transaction_amount, payment_transaction_id) AS last_payment
  FROM op_payment_transaction GROUP BY claim_id) p USING (claim_id), s_tops"""
SUBQUERIES["s_led"] = f"""
SELECT 'INJ' || lpad(CAST(so + 201 AS VARCHAR), 10, '0') AS injection_id,
  CASE WHEN so < 50 THEN 'PI003' ELSE 'PI004' END AS rule_id,
  CASE WHEN so < 50 THEN {fresh('PAY', 'pay_top', 'so * 2 + 2', 18)} ELSE payment_transaction_id END AS target_record_id,
  claim_id, billing_provider_id AS provider_id, service_month AS reporting_period,
  CASE WHEN so < 50 THEN {half_even(scaled('signed_transaction_amount', 2) + ' * 40', '100', 0)} / 100 ELSE 0 END AS exposure
FROM (SELECT *, row_number() OVER (ORDER BY d) - 1 AS so FROM (
  SELECT p.*, billing_provider_id, service_month, {ranked('ledger_temporal_target', 'payment_transaction_id')} AS d
  FROM op_payment_transaction p JOIN f_claims c USING (claim_id)
  WHERE transaction_type = 'payment' AND signed_transaction_amount > 0
    AND claim_id NOT IN (SELECT claim_id FROM s_rec) ORDER BY d LIMIT 100) e) o, s_tops"""
SUBQUERIES["s_taken2"] = "SELECT claim_id FROM s_rec UNION SELECT claim_id FROM s_led"
CENTS = lambda v: scaled(v, 2)
SUBQUERIES["s_out_base"] = f"""
SELECT *, list_reduce(list_concat([{CENTS('top')}], CAST(range(turn) AS HUGEINT[])),
    lambda acc, x: (2 * acc * 125 + 100) // 200) AS new_allowed
FROM (
  SELECT *, row_number() OVER (PARTITION BY specialty_group, service_code_system ORDER BY so) AS turn
  FROM (SELECT *, row_number() OVER (ORDER BY d) - 1 AS so FROM (
    SELECT * FROM (SELECT l.*, c.specialty_group, c.billing_provider_id, c.service_month AS claim_month, c.claim_status,
        max(l.allowed_amount) OVER (PARTITION BY specialty_group, service_code_system) AS top,
        count(*) OVER (PARTITION BY specialty_group, service_code_system) AS peers,
        {ranked('pi007_target', 'claim_line_id')} AS d
      FROM f_lines l JOIN f_claims c USING (claim_id)) placed
    WHERE {PAYABLE} AND peers >= 11 AND claim_id NOT IN (SELECT claim_id FROM s_taken2)
      AND claim_id IN (SELECT claim_id FROM op_payment_transaction WHERE transaction_type = 'payment')
    QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY d) = 1 ORDER BY d LIMIT 50) e) o) t"""
SUBQUERIES["s_out"] = f"""
SELECT 'INJ' || lpad(CAST(so + 301 AS VARCHAR), 10, '0') AS injection_id, 'PI007' AS rule_id,
  claim_line_id AS target_record_id, claim_id, billing_provider_id AS provider_id, claim_month AS reporting_period,
  CAST(new_allowed AS DOUBLE) / 100 - allowed_amount
    - ({half_even(f"new_allowed * {CENTS('member_liability_amount')}", CENTS('allowed_amount'), 0)} / 100
       - member_liability_amount) AS exposure
FROM s_out_base"""
SUBQUERIES["s_taken3"] = "SELECT claim_id FROM s_taken2 UNION SELECT claim_id FROM s_out"
SUBQUERIES["s_periods"] = f"""
SELECT *, row_number() OVER (ORDER BY d) - 1 AS so,
  greatest(claims + 1, CAST(floor(CAST(history AS DOUBLE) / months * 3.0) AS BIGINT) + 1) - claims AS clones
FROM (
  SELECT *, {ranked('pi008_target', "billing_provider_id || ':' || CAST(service_month AS VARCHAR)")} AS d
  FROM (SELECT billing_provider_id, service_month, count(*) AS claims FROM f_claims GROUP BY ALL) m
  JOIN (SELECT billing_provider_id, count(*) AS months, sum(n) AS history FROM (
      SELECT billing_provider_id, service_month, count(*) AS n FROM f_claims WHERE service_month < DATE '2000-01-01'
      GROUP BY ALL) h GROUP BY billing_provider_id HAVING count(*) >= 6 AND sum(n) >= 11) p USING (billing_provider_id)
  JOIN (SELECT billing_provider_id, service_month, count(*) AS templates FROM s_templates GROUP BY ALL) t
    USING (billing_provider_id, service_month)
  ORDER BY d LIMIT 50) e"""
SUBQUERIES["s_templates"] = """
SELECT claim_id, billing_provider_id, service_month,
  row_number() OVER (PARTITION BY billing_provider_id, service_month ORDER BY claim_id) AS template
FROM f_claims WHERE service_month >= DATE '2000-01-01' AND claim_id NOT IN (SELECT claim_id FROM s_taken3)
  AND claim_id IN (SELECT claim_id FROM op_payment_transaction WHERE signed_transaction_amount > 0)"""
SUBQUERIES["s_clones"] = f"""
SELECT so, o AS clone_offset, t.claim_id AS template_claim, p.billing_provider_id, p.service_month,
  {fresh('CLM', 'claim_top', 'row_number() OVER (ORDER BY so, o)', 12)} AS new_claim,
  row_number() OVER (ORDER BY so, o) AS clone
FROM (SELECT *, unnest(range(CAST(clones AS BIGINT))) AS o FROM s_periods) p
JOIN s_templates t ON t.billing_provider_id = p.billing_provider_id AND t.service_month = p.service_month
  AND t.template = p.o % p.templates + 1, s_tops"""
SUBQUERIES["s_sur"] = """
SELECT 'INJ' || lpad(CAST(so + 351 AS VARCHAR), 10, '0') AS injection_id, 'PI008' AS rule_id,
  any_value(billing_provider_id) || ':' || CAST(any_value(service_month) AS VARCHAR) AS target_record_id,
  arg_min(new_claim, clone) AS claim_id, any_value(billing_provider_id) AS provider_id,
  any_value(service_month) AS reporting_period, sum(paid) AS exposure
FROM s_clones LEFT JOIN (SELECT claim_id, sum(signed_transaction_amount) AS paid FROM op_payment_transaction
  WHERE transaction_type = 'payment' GROUP BY claim_id) t ON t.claim_id = template_claim GROUP BY so"""
SUBQUERIES["s_taken4"] = "SELECT claim_id FROM s_taken3 UNION SELECT claim_id FROM s_sur"
SUBQUERIES["s_claims9"] = """
SELECT claim_id, claim_id AS origin, claim_type, claim_status, billing_provider_id, service_month FROM f_claims
UNION ALL SELECT new_claim, template_claim, claim_type, claim_status, c.billing_provider_id, c.service_month
FROM s_clones JOIN f_claims c ON c.claim_id = template_claim"""
SUBQUERIES["s_rep"] = f"""
SELECT 'INJ' || lpad(CAST(so + 401 AS VARCHAR), 10, '0') AS injection_id, 'PI009' AS rule_id,
  {fresh('LIN', 'line_top', '100 + cloned + coalesce(sum(copies) OVER (ORDER BY so ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1', 18)}
    AS target_record_id, claim_id, billing_provider_id AS provider_id, service_month AS reporting_period,
  net * copies AS exposure, copies
FROM (SELECT *, row_number() OVER (ORDER BY d) - 1 AS so FROM (
  SELECT c.*, first_net AS net, 2 - current AS copies, {ranked('pi009_target', 'c.claim_id')} AS d
  FROM s_claims9 c JOIN (
    SELECT claim_id, arg_min(first_net, first_line) AS first_net, arg_min(current, first_line) AS current FROM (
      SELECT claim_id, service_code_system, service_code, count(*) AS current, min(line_number) AS first_line,
        arg_min(plan_paid_amount, line_number) AS first_net
      FROM f_lines WHERE CAST(service_code AS BIGINT) % 2 = 0 AND CAST(service_code AS BIGINT) % 10 <> 0
      GROUP BY ALL HAVING count(*) <= 1) g GROUP BY claim_id) b ON b.claim_id = c.origin
  WHERE {PAYABLE} AND claim_type IN ('professional', 'outpatient') AND c.claim_id NOT IN (SELECT claim_id FROM s_taken4)
    AND c.origin IN (SELECT claim_id FROM op_payment_transaction WHERE transaction_type = 'payment' AND signed_transaction_amount > 0)
  ORDER BY d LIMIT 50) e) o, s_tops,
  (SELECT count(*) AS cloned FROM s_clones JOIN op_claim_line l ON l.claim_id = template_claim) n"""
SUBQUERIES["s_dia"] = f"""
SELECT 'INJ' || lpad(CAST(so + 451 AS VARCHAR), 10, '0') AS injection_id, 'PI010' AS rule_id, claim_id AS target_record_id,
  claim_id, billing_provider_id AS provider_id, service_month AS reporting_period, 0 AS exposure, origin, category
FROM (SELECT *, row_number() OVER (ORDER BY d) - 1 AS so FROM (
  SELECT c.*, s.category, {ranked('pi010_target', 'c.claim_id')} AS d
  FROM s_claims9 c JOIN (SELECT claim_id, min(mapped) AS category FROM f_lines LEFT JOIN k_category USING (service_code) GROUP BY claim_id
    HAVING count(*) = count(mapped) AND count(DISTINCT mapped) = 1 AND min(mapped) <> 'evaluation_management') s
    ON s.claim_id = c.origin
  WHERE {PAYABLE} AND claim_type IN ('professional', 'inpatient', 'outpatient')
    AND c.claim_id NOT IN (SELECT claim_id FROM s_taken4) AND c.claim_id NOT IN (SELECT claim_id FROM s_rep)
  ORDER BY d LIMIT 50) e) o"""
LABEL_SPEC = (
    "injection_id:text rule_id:text target_record_id:text claim_id:text provider_id:text reporting_period:date "
    "expected_financial_exposure:num"
)
WHERE = {"PI001": "s_rec", "PI002": "s_rec", "PI005": "s_rec", "PI006": "s_rec", "PI003": "s_led", "PI004": "s_led",
         "PI007": "s_out", "PI008": "s_sur", "PI009": "s_rep", "PI010": "s_dia"}
STEP_OF = {"s_rec": "record", "s_led": "ledger", "s_out": "outlier", "s_sur": "surge", "s_rep": "repeat", "s_dia": "diagnosis"}
NAMES = ("k1_seed_exact_duplicates", "k2_seed_near_duplicates", "k3_seed_repayments", "k4_seed_impossible_dates",
         "k5_seed_header_mismatches", "k6_seed_overpayments", "k7_seed_outlier_amounts", "k8_seed_surges",
         "k9_seed_repeated_procedures", "k10_seed_diagnoses")
for place, name in enumerate(NAMES, start=1):
    rule = f"PI{place:03d}"
    register(
        name,
        lambda m, r=rule: seeded(m, STEP_OF[WHERE[r]]).labels.filter(F.col("rule_id") == r),
        LABEL_SPEC,
        f"SELECT *, exposure AS expected_financial_exposure FROM {WHERE[rule]} WHERE rule_id = '{rule}'",
    )
CHANGE_SPEC = (
    "injection_id:text change_sequence_number:long field_operation:text target_table:text target_record_id:text "
    "column_name:text governed_value_type:text before_value:text after_value:text expected_contract_violation:bool"
)
register("k11_field_changes", lambda m: seeded(m).changes, CHANGE_SPEC, None)
register(
    "f14_change_sequences",
    lambda m: seeded(m).changes.groupBy("injection_id").agg(
        F.count("*").alias("changes"), F.max("change_sequence_number").alias("last_number"),
        F.count_distinct("change_sequence_number").alias("distinct_numbers"),
    ).filter("changes <> last_number or changes <> distinct_numbers"),
    "injection_id:text changes:long last_number:long distinct_numbers:long",
    "SELECT '' AS injection_id, 0 AS changes, 0 AS last_number, 0 AS distinct_numbers WHERE FALSE",
)


def isolation(model):
    """Rows outside the labelled claims are untouched, row counts grow as planned, targets are disjoint."""
    state = seeded(model)
    before = {n: getattr(model, n) for n in ("claim_header", "claim_line", "payment_transaction", "adjudication_event")}
    labelled = state.labels.filter("rule_id <> 'PI008'").select("claim_id")
    known = before["claim_header"].select("claim_id")
    reports = [quality.duplicate_keys("targets_not_disjoint", state.labels, ["target_record_id"]),
               quality.violations(state.labels, {"negative_exposure": F.col("expected_financial_exposure") < 0})]
    for table, rows in before.items():
        plain = lambda df: df.join(labelled, "claim_id", "left_anti").join(known, "claim_id", "left_semi")
        reports.append(quality.rows_differ(f"{table}_untouched_rows_changed", plain(rows), plain(state.tables[table])))
    return quality.all_checks(*reports)


register(
    "k12_seeding_isolation",
    isolation,
    "check_name:text violations:long",
    "SELECT * FROM (VALUES ('targets_not_disjoint', 0), "
    "('negative_exposure', (SELECT count(*) FROM s_rec WHERE exposure < 0)), "
    "('claim_header_untouched_rows_changed', 0), ('claim_line_untouched_rows_changed', 0), "
    "('payment_transaction_untouched_rows_changed', 0), ('adjudication_event_untouched_rows_changed', 0)) v(check_name, violations)",
)


KEYS = {"claim_header": "claim_id", "claim_line": "claim_line_id", "payment_transaction": "payment_transaction_id",
        "adjudication_event": "adjudication_event_id"}


def row_deltas(model):
    """Rows that each step inserted, deleted or updated in each table, as found between versions and as logged.

    ``unlike_fields`` counts field changes that the log lacks, that never happened, or whose values differ.
    """
    parts, unique = [], {}
    for step, before, after, own in seeding_steps(model, write_tables=True):
        log = model.layers.keep(f"seed_changes_{step}", lambda c=own: c, SEED)
        logged = differences.net_changes(log, ["injection_id", "change_sequence_number"])
        for table, key in KEYS.items():
            old, new = before.tables[table], after.tables[table]
            if new is old:
                continue
            if table not in unique:
                unique[table] = differences.unique_key(old, key)
            changed = model.layers.keep(f"seed_rows_{step}_{table}", lambda o=old, n=new, k=key, u=unique[table]: differences.row_changes(o, n, k, u), SEED)
            unique[table] = unique[table] and differences.stays_unique(new, key, changed)
            named = logged.filter(F.col("target_table") == table)
            sides = [changed.withColumn("found", F.lit(1)),
                     named.select("record_id", "operation").distinct().withColumn("logged", F.lit(1)),
                     differences.unlike_fields(differences.field_changes(old, new, key, changed), named).withColumn("unlike", F.abs("surplus"))]
            counted = quality.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides).groupBy("operation").agg(
                *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("found", "found_rows"), ("logged", "logged_rows"), ("unlike", "unlike_fields"))])
            parts.append(counted.select(F.lit(step).alias("step"), F.lit(table).alias("table_name"), "*"))
    return quality.reduce(lambda a, b: a.unionByName(b), parts)


NEVER_FITTING = ", ".join(f"('{category}', '{code}')" for category, code in INCOMPATIBLE_DIAGNOSIS.items())


def delta_sql(step, table, operation, rows):
    return f"SELECT '{step}' AS step, '{table}' AS table_name, '{operation}' AS operation, ({rows}) AS found_rows"


DELTAS = " UNION ALL ".join(delta_sql(*part) for part in (
    ("record", "claim_line", "insert", "SELECT count(*) FROM s_rec WHERE rule_id IN ('PI001', 'PI002')"),
    ("record", "claim_header", "update", "SELECT count(*) FROM s_rec WHERE rule_id <> 'PI006'"),
    ("record", "payment_transaction", "update", "SELECT count(*) FROM s_rec WHERE rule_id <> 'PI005' AND exposure <> 0"),
    ("ledger", "payment_transaction", "insert", "SELECT 2 * count(*) FROM s_led WHERE rule_id = 'PI003'"),
    ("ledger", "payment_transaction", "update", "SELECT count(*) FROM s_led WHERE rule_id = 'PI004'"),
    ("outlier", "claim_line", "update", "SELECT count(*) FROM s_out"),
    ("outlier", "claim_header", "update", "SELECT count(DISTINCT claim_id) FROM s_out"),
    ("outlier", "payment_transaction", "update", "SELECT count(*) FROM s_out WHERE exposure <> 0"),
    ("surge", "claim_header", "insert", "SELECT count(*) FROM s_clones"),
    *(("surge", t, "insert", f"SELECT count(*) FROM s_clones JOIN op_{t} c ON c.claim_id = template_claim{only}")
      for t, only in (("claim_line", ""), ("adjudication_event", ""), ("payment_transaction", " AND transaction_type = 'payment'"))),
    ("repeat", "claim_line", "insert", "SELECT coalesce(sum(copies), 0) FROM s_rep"),
    ("repeat", "claim_header", "update", "SELECT count(DISTINCT claim_id) FROM s_rep"),
    ("repeat", "payment_transaction", "update", "SELECT count(*) FROM s_rep WHERE exposure <> 0"),
    # a claim whose diagnosis fits its category as little as the new one may have that very code already
    ("diagnosis", "claim_header", "update",
     f"SELECT count(*) FROM s_dia JOIN op_claim_header h ON h.claim_id = origin JOIN (VALUES {NEVER_FITTING}) v(category, code) "
     "USING (category) WHERE principal_diagnosis_code IS DISTINCT FROM code"),
))
register(
    "k12_row_deltas",
    row_deltas,
    "step:text table_name:text operation:text found_rows:long logged_rows:long unlike_fields:long",
    f"SELECT *, found_rows AS logged_rows, 0 AS unlike_fields FROM ({DELTAS}) d WHERE found_rows > 0",
)


def manifest(model):
    names = ("claim_header", "claim_line", "payment_transaction", "membership_month", "provider")
    parts = [
        hashing.content_fingerprint(getattr(model, n)).select(
            F.lit(n).alias("table_name"), "row_count", "content_sha256",
            F.lit(hashing.schema_fingerprint(getattr(model, n))).alias("schema_sha256"),
        )
        for n in names
    ]
    return quality.reduce(lambda a, b: a.unionByName(b), parts)


register(
    "k13_baseline_manifest",
    lambda m: manifest(m).select("table_name", "row_count"),
    "table_name:text row_count:long",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM op_{n}"
                       for n in ("claim_header", "claim_line", "payment_transaction", "membership_month", "provider")),
)
register("g7_content_fingerprints", manifest,
         "table_name:text row_count:long content_sha256:text schema_sha256:text", None)


# columns whose contents are hashed by the same rule on both sides; "q" are quoted in JSON
CONTENTS = {
    "provider": "provider_id:q provider_entity_type:q specialty_group:q state_code:q synthetic_record:p",
    "membership_month": "member_id:q plan_id:q coverage_month:q coverage_status:q",
    "claim_header": "claim_id:q member_id:q claim_version_number:p claim_status:q service_from_date:q adjudication_date:q "
                    "total_allowed_amount:p prior_claim_id:q",
    "claim_line": "claim_line_id:q claim_id:q units:p place_of_service_code:q allowed_amount:p",
    "payment_transaction": "payment_transaction_id:q claim_id:q transaction_date:q signed_transaction_amount:p reverses_transaction_id:q",
}


def content_hashes(model):
    parts = []
    for table, spec in CONTENTS.items():
        names = [item.split(":")[0] for item in spec.split()]
        hashed = hashing.content_fingerprint(getattr(model, table), names)
        parts.append(hashed.select(F.lit(table).alias("table_name"), "row_count", "content_sha256"))
    return quality.reduce(lambda a, b: a.unionByName(b), parts)


def content_sql(table, spec):
    values = []
    for name, quoted in (item.split(":") for item in spec.split()):
        mark = '"' if quoted == "q" else ""
        values.append(f"""coalesce('{{"v":{mark}' || CAST({name} AS VARCHAR) || '{mark}}}', '{{}}')""")
    words = " || ':' || ".join(
        f"CAST(coalesce(sum(CAST(CAST('0x' || substr(d, {start}, 15) AS UBIGINT) AS HUGEINT)), 0) AS VARCHAR)" for start in (1, 16, 31, 46)
    )
    return (
        f"SELECT '{table}' AS table_name, count(*) AS row_count, sha256(CAST(count(*) AS VARCHAR) || ':' || {words}) AS content_sha256 "
        f"FROM (SELECT sha256(concat_ws(',', {', '.join(values)})) AS d FROM op_{table}) rows"
    )


CONTENT_SQL = " UNION ALL ".join(content_sql(table, spec) for table, spec in CONTENTS.items())
register("g7_content_hashes", content_hashes, "table_name:text row_count:long content_sha256:text", CONTENT_SQL)


def backtest(model):
    """Seed, conform, detect without labels, then score against the labels."""
    state = seeded(model)
    keep = partial(model.layers.keep, settings=SEED)
    tables = {n: getattr(model, n) for n in ("membership_month", "claim_review", "policy_assignment", "plan", "provider")}
    written = {n: keep(f"seeded_{n}", lambda n=n: state.tables[n]) for n in ("claim_header", "claim_line", "payment_transaction")}
    facts = conformed.from_operational({**tables, **written}, model.service_categories)
    facts = conformed.replace(facts, claims=keep("seeded_conformed_claims", lambda: facts.claims))
    findings = keep("seeded_findings", lambda: rules.findings_table(rules.run_rules(facts, RULES, limits_of(model))))
    found = evaluation.match_labels(findings, state.labels, RULES)
    return evaluation.evaluate(found, evaluation.eligible_targets(facts, RULES), RULES)


register(
    "r14_seeded_backtest",
    backtest,
    "rule_id:text eligible_target_count:long true_positive_count:long false_positive_count:long "
    "false_negative_count:long precision:num recall:num exposure_recall:num",
    None,
)

# -- reproducible sampling ---------------------------------------------------------------------
register(
    "g3_hash_ranked_selection",
    lambda m: hashing.select_ranked(m.claim_header, 7, "sample", "claim_id", 20, ["a", "b", "c"]).select(
        "claim_id", "bucket", "selection_order"),
    "claim_id:text bucket:text selection_order:long",
    "SELECT claim_id, ['a', 'b', 'c'][CAST(so // 20 + 1 AS INTEGER)] AS bucket, so AS selection_order FROM ("
    "SELECT claim_id, row_number() OVER (ORDER BY sha256('7:sample:' || claim_id)) - 1 AS so FROM op_claim_header) r WHERE so < 60",
)
UNIT = "CAST(CAST('0x' || substr(sha256('7:unit:' || claim_id), 1, 16) AS UHUGEINT) AS DOUBLE) / 18446744073709551616.0"
register(
    "g4_hash_unit_and_integer",
    lambda m: m.claim_header.select(
        "claim_id", F.round(hashing.unit(7, "unit", F.col("claim_id")), 9).alias("fraction"),
        hashing.bounded_integer(7, "unit", F.col("claim_id"), 10, 19).alias("bounded")),
    "claim_id:text fraction:num bounded:long",
    f"SELECT claim_id, round({UNIT}, 9) AS fraction, 10 + CAST(floor({UNIT} * 10) AS BIGINT) AS bounded FROM op_claim_header",
)
CHOICES = hashing.normalized_weights([("low", 2), ("middle", 5), ("high", 3)])
register(
    "g5_weighted_choice",
    lambda m: m.claim_header.select(
        "claim_id", hashing.weighted_choice(hashing.unit(7, "unit", F.col("claim_id")), CHOICES).alias("choice")),
    "claim_id:text choice:text",
    f"SELECT claim_id, CASE WHEN u < 0.2 THEN 'low' WHEN u < 0.7 THEN 'middle' ELSE 'high' END AS choice "
    f"FROM (SELECT claim_id, {UNIT} AS u FROM op_claim_header) h",
)
