"""Distributed two-way fixed-effects fits against dense dummy regressions."""

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.plans import policy

MONTHS = list(range(-4, 3))


def panel_rows(providers=24, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for p in range(providers):
        level = rng.normal(50, 10)
        for t in MONTHS:
            treated = p % 3 == 0
            y = level + 2 * t + (7 if treated and t >= 0 else 0) + rng.normal(0, 3)
            missing = rng.random() < 0.1
            rows.append((p, t, treated, int(rng.integers(0, 9)), *[None if missing else round(y + k, 4) for k in range(5)]))
    return rows


SCHEMA = "provider_key bigint, event_time int, treatment_indicator boolean, eligible_member_months bigint, " + ", ".join(
    f"{o} double" for o in policy.OUTCOMES
)


def dense_fit(rows, terms, months, outcome, weighted=True, upper=None):
    rows = [r for r in rows if r[4 + outcome] is not None and r[1] in months]
    providers = sorted({r[0] for r in rows})
    y = np.array([r[4 + outcome] for r in rows], float)
    if upper is not None:
        y = np.minimum(y, upper)
    w = np.array([max(r[3], 1) if weighted else 1 for r in rows], float)
    x = np.column_stack(
        [[1.0] * len(rows)]
        + [[float(r[2] and r[1] in term) for r in rows] for term in terms]
        + [[float(r[0] == p) for r in rows] for p in providers[1:]]
        + [[float(r[1] == m) for r in rows] for m in months[1:]]
    )
    bread = np.linalg.inv(x.T @ (w[:, None] * x))
    beta = bread @ (x.T @ (w * y))
    u = y - x @ beta
    meat = np.zeros_like(bread)
    for p in providers:
        own = np.array([r[0] == p for r in rows])
        score = x[own].T @ (w[own] * u[own])
        meat += np.outer(score, score)
    g, n, k = len(providers), len(rows), x.shape[1]
    cov = g / (g - 1) * (n - 1) / (n - k) * bread @ meat @ bread
    s = slice(1, 1 + len(terms))
    return beta[s], cov[s, s], g, n


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(panel_rows(), SCHEMA).repartition(5)


@pytest.mark.parametrize(
    "terms, months, weighted, upper",
    [
        (((0, 1, 2),), tuple(MONTHS), True, None),
        (((0, 1, 2),), tuple(MONTHS), False, None),
        (((0, 1, 2),), tuple(MONTHS), True, 60.0),
        (tuple((m,) for m in MONTHS if m != -1), tuple(MONTHS), True, None),
        (((-2, -1),), (-4, -3, -2, -1), True, None),
    ],
)
def test_fit_equals_dense_regression(panel, terms, months, weighted, upper):
    fit = policy.fit_models(panel, [policy.Model("m", 1, terms, months, weighted, upper)])[0]
    beta, cov, groups, n = dense_fit(panel_rows(), terms, months, 1, weighted, upper)
    np.testing.assert_allclose(fit.coefficients, beta, rtol=1e-8)
    np.testing.assert_allclose(fit.covariance, cov, rtol=1e-6, atol=1e-10)
    assert (fit.providers, fit.observations) == (groups, n)


def test_estimates_cover_every_outcome_and_specification(panel):
    design = policy.PolicyDesign(run_id="run", policy_start=date(2026, 1, 1), pre_months=4, post_months=3, placebo_months_before=2)
    results = policy.estimate_policy(panel, design)
    effects = results["policy_effect_estimate"].collect()
    assert len(effects) == 15 and {r["outcome_name"] for r in effects} == set(policy.OUTCOMES)
    assert all(r["confidence_interval_lower"] <= r["coefficient"] <= r["confidence_interval_upper"] for r in effects)
    events = results["event_study_estimate"].collect()
    assert len(events) == 5 * 6 and -1 not in {r["event_time"] for r in events}
    diagnostics = results["policy_diagnostic"].collect()
    assert len(diagnostics) == 10 and all(r["explanation"] for r in diagnostics)
    assert "2025-11-01" in {r["specification"] for r in diagnostics}


def test_tails():
    assert policy.normal_p_value(1.96, 1.0) == pytest.approx(0.05, abs=1e-4)
    assert policy.chi_square_tail(19.675, 11) == pytest.approx(0.05, abs=1e-4)
    assert policy.chi_square_tail(5.991, 2) == pytest.approx(0.05, abs=1e-4)
    assert policy.chi_square_tail(3.0, 4) == pytest.approx(math.exp(-1.5) * 2.5)


def test_panel_is_balanced(model):
    design = policy.PolicyDesign(run_id="run", policy_start=date(2000, 1, 1))
    panel = policy.provider_month_panel(model.facts, design)
    counts = {r["n"] for r in panel.groupBy("provider_key").agg(F.count("*").alias("n")).collect()}
    assert counts == {18}
    zero = panel.filter("claim_count = 0").select("denial_rate", "review_rate").distinct().collect()
    assert all(tuple(r) == (None, None) for r in zero)


def test_a_model_without_observations_is_refused(panel):
    with pytest.raises(ContractError, match="no observations for late"):
        policy.fit_models(panel, [policy.Model("late", 1, ((9,),), (8, 9))])


def test_providers_are_dealt_to_all_tasks(spark, panel):
    rows = policy.provider_rows(panel)
    assert rows.select(F.spark_partition_id()).distinct().count() > 4


def test_each_pair_of_cells_is_summed_once(panel):
    cells = policy._model_cells(policy.provider_rows(panel), [policy.Model("m", 1, ((0, 1, 2),), tuple(MONTHS))], None)
    pairs = policy._moment_sums(cells, scores=False).filter("kind = 'gram'")
    assert pairs.filter("a > b").isEmpty() and pairs.filter("a = b").count() == 2 * len(MONTHS)


def test_providers_of_a_task_are_multiplied_together(spark, panel):
    """A row a task and pair of cells leaves the tasks, not one for each provider; a second row of a cell counts as before."""
    model = policy.Model("m", 1, ((0, 1, 2),), tuple(MONTHS))
    cells = policy._model_cells(policy.provider_rows(panel), [model], None)
    assert "MapInArrow" in policy._moment_sums(cells, scores=False)._jdf.queryExecution().toString()
    twice = spark.createDataFrame([(0, [(2, 1.0, 3.0), (2, 3.0, 5.0), (4, 2.0, 1.0)], 6.0, 3.0)],
                                  "model int, cells array<struct<c int, w double, y double>>, weight double, mean double")
    sums = {(r["kind"], r["a"], r["b"]): r["value"] for r in policy._moment_sums(twice, scores=False).collect()}
    assert sums == pytest.approx({
        ("gram", 2, 2): 2 * 4 - 16 / 6, ("gram", 2, 4): -8 / 6, ("gram", 4, 4): 2 - 4 / 6, ("cross", 2, None): 6.0,
        ("cross", 4, None): -4.0, ("providers", None, None): 1.0, ("observations", None, None): 3.0})
    scored = {(r["kind"], r["a"], r["b"]): r["value"] for r in policy._moment_sums(twice, scores=True).collect()}
    assert scored == {("meat", 2, 2): 36.0, ("meat", 2, 4): -24.0, ("meat", 4, 4): 16.0}
