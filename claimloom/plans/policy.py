"""Provider-month policy panel and difference-in-differences estimates.

Provider effects are absorbed exactly.  Every regressor is a sum of month-by-treatment cells, so the
moments of all models are sums over pairs of a provider's cells, taken in the tasks as products of
matrices of providers and cells; only sums by pair of cells reach the driver, where a system of at most a few
dozen unknowns is solved.  A second pass sums products of each provider's scores for the
cluster-robust variance.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.functions.dates import month_of, month_spine, months_from
from claimloom.functions.numbers import MONEY, count_as_decimal, or_fail, rate, total
from claimloom.operators.percentiles import exact_percentiles
from claimloom.plans.conformed import Facts

SUMS = pa.schema([("model", pa.int32()), ("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.float64())])
OUTCOMES = ("paid_pmpm", "allowed_pmpm", "claims_per_1000", "denial_rate", "review_rate")


@dataclass(frozen=True)
class PolicyDesign:
    run_id: str
    policy_start: date = date(2026, 1, 1)
    pre_months: int = 12
    post_months: int = 6
    placebo_months_before: int = 6
    treated_value: str = "treated"
    winsor_fraction: float = 0.99
    significance: float = 0.05

    def month(self, offset: int) -> date:
        index = self.policy_start.year * 12 + self.policy_start.month - 1 + offset
        return date(index // 12, index % 12 + 1, 1)


def member_attribution(facts: Facts, design: PolicyDesign) -> DataFrame:
    """Provider with most paid current claims of each member before the policy; ties to the lowest key."""
    paid = facts.claims.filter(
        F.col("is_current_version")
        & (F.col("claim_status") == "paid")
        & (F.col("service_date") < F.lit(design.policy_start))
    )
    counted = paid.groupBy("member_id", "billing_provider_key").agg(F.count("*").alias("_claims"))
    return counted.groupBy("member_id").agg(
        F.max(F.struct("_claims", (-F.col("billing_provider_key")).alias("_order"))).alias("_best")
    ).select("member_id", (-F.col("_best._order")).alias("provider_key"))


def provider_month_panel(facts: Facts, design: PolicyDesign) -> DataFrame:
    """Balanced panel: every assigned provider in every month of the design window."""
    first, last = design.month(-design.pre_months), design.month(design.post_months - 1)
    key = ["provider_key", "reporting_month"]
    grid = facts.assignments.select(
        "provider_key", "treatment_group", F.explode(month_spine(first, last)).alias("reporting_month")
    )
    inside = lambda month: month.between(F.lit(first), F.lit(last))
    exposure = (
        facts.memberships.filter((F.col("coverage_status") == "active") & inside(F.col("coverage_month")))
        .select("member_id", month_of(F.col("coverage_month")).alias("reporting_month"))
        .join(member_attribution(facts, design), "member_id")
        .select(*key, F.lit(1).alias("_members"))
    )
    current = facts.claims.filter(F.col("is_current_version") & inside(F.col("service_month"))).select(
        "claim_id",
        F.col("billing_provider_key").alias("provider_key"),
        F.col("service_month").alias("reporting_month"),
        "claim_status",
        "net_paid_amount",
        "total_allowed_amount",
    )
    paid = F.col("claim_status") == "paid"
    claims = current.select(
        *key,
        F.lit(1).alias("_claims"),
        F.when(paid, F.col("net_paid_amount")).alias("_paid"),
        F.when(paid, F.col("total_allowed_amount")).alias("_allowed"),
        (F.col("claim_status") == "denied").cast("int").alias("_denied"),
    )
    reviews = (
        facts.reviews.filter(F.col("review_status") == "completed")
        .select("claim_id")
        .join(current.select("claim_id", *key), "claim_id")
        .select(*key, F.lit(1).alias("_reviews"))
    )
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [exposure, claims, reviews])
    count = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)
    cells = stacked.groupBy(*key).agg(
        count("_members"), count("_claims"), count("_denied"), count("_reviews"),
        total(F.col("_paid")).alias("_paid"), total(F.col("_allowed")).alias("_allowed"),
    )
    unassigned = F.concat(F.lit("no policy assignment of provider key "), F.col("provider_key").cast("string"))
    filled = grid.join(cells, key, "full").select(
        *key, or_fail(F.col("treatment_group"), unassigned, "string").alias("treatment_group"),
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("_members", "_claims", "_denied", "_reviews")],
        *[F.coalesce(n, F.lit(0)).cast(MONEY).alias(n) for n in ("_paid", "_allowed")],
    )
    treated = F.col("treatment_group") == design.treated_value
    post = F.col("reporting_month") >= F.lit(design.policy_start)
    members, claim_count = count_as_decimal(F.col("_members")), count_as_decimal(F.col("_claims"))
    whole = lambda value: value.cast("decimal(18,0)")
    return filled.select(
        *key,
        "treatment_group",
        treated.alias("treatment_indicator"),
        post.alias("post_policy_indicator"),
        (treated & post).alias("treatment_post"),
        months_from(F.col("reporting_month"), design.policy_start).alias("event_time"),
        F.col("_members").alias("eligible_member_months"),
        F.col("_claims").alias("claim_count"),
        rate(F.col("_paid"), members).alias("paid_pmpm"),
        rate(F.col("_allowed"), members).alias("allowed_pmpm"),
        rate(whole(F.col("_claims") * 1000), members).alias("claims_per_1000"),
        rate(whole(F.col("_denied")), claim_count).alias("denial_rate"),
        rate(whole(F.col("_reviews")), claim_count).alias("review_rate"),
    )


# -- estimation -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """One regression on the panel: outcome on treatment terms, provider and month effects."""

    name: str
    outcome: int
    terms: tuple[tuple[int, ...], ...]  # event times at which each treatment dummy is one
    months: tuple[int, ...]  # event times used
    weighted: bool = True
    upper: float | None = None

    @property
    def width(self) -> int:
        return len(self.terms) + len(self.months) - 1


@dataclass(frozen=True)
class Fit:
    coefficients: np.ndarray
    covariance: np.ndarray
    providers: int
    observations: int


def provider_rows(panel: DataFrame) -> DataFrame:
    """One row per provider holding its months; the design window bounds the arrays.

    A provider's few bytes become thousands of products, so providers are dealt to all tasks by number, which
    adaptive planning leaves alone; judged by their bytes, they met in one or two tasks.
    """
    tasks = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    month = F.struct(
        F.col("event_time").alias("t"),
        F.col("treatment_indicator").cast("int").alias("d"),
        F.greatest("eligible_member_months", F.lit(1)).cast("double").alias("w"),
        F.array(*[F.col(name).cast("double") for name in OUTCOMES]).alias("y"),
    )
    return panel.repartition(tasks, "provider_key").groupBy("provider_key").agg(F.collect_list(month).alias("months"))


def _cell(event_time: int, treated: int) -> int:
    return 2 * event_time + treated


def _model_cells(rows: DataFrame, models: list[Model], fitted: list[dict[int, float]] | None) -> DataFrame:
    """One row per model and provider: its cells with number, weight and outcome less the fitted value."""

    def cells(place: int, model: Model) -> Column:
        used = F.filter("months", lambda m: m["y"][model.outcome].isNotNull() & m["t"].isin(*model.months))

        def cell(m: Column) -> Column:
            number = m["t"] * 2 + m["d"]
            value = m["y"][model.outcome]
            if model.upper is not None:
                value = F.least(value, F.lit(model.upper))
            if fitted is not None:
                lowest = _cell(min(model.months), 0)
                values = [fitted[place].get(c, 0.0) for c in range(lowest, _cell(max(model.months), 1) + 1)]
                value = value - F.get(F.lit(values), number - lowest)
            weight = m["w"] if model.weighted else F.lit(1.0)
            return F.struct(number.alias("c"), weight.alias("w"), value.alias("y"))

        return F.struct(F.lit(place).alias("model"), F.transform(used, cell).alias("cells"))

    dealt = rows.select(F.explode(F.array(*[cells(*each) for each in enumerate(models)])).alias("_m")).select("_m.*")
    added = lambda value: F.aggregate("cells", F.lit(0.0), lambda sum_, m: sum_ + value(m))
    weight = added(lambda m: m["w"])
    return dealt.filter(F.size("cells") > 0).select(
        "model", "cells", weight.alias("weight"), (added(lambda m: m["w"] * m["y"]) / weight).alias("mean")
    )


def _batch_sums(cells: pa.ListArray, weight: np.ndarray, mean: np.ndarray, scores: bool) -> dict[tuple, float]:
    """Sums of some providers of one model by kind and pair of cells: see ``_moment_sums``."""
    values, owner = cells.flatten(), pc.list_parent_indices(cells).to_numpy()
    number, own, outcome = (values.field(n).to_numpy(zero_copy_only=False) for n in ("c", "w", "y"))
    known, at = np.unique(number, return_inverse=True)
    shape = len(cells), len(known)
    by_cell = lambda amounts: np.bincount(owner * shape[1] + at, amounts, minlength=shape[0] * shape[1]).reshape(shape)
    held, weighed, score = by_cell(np.ones(len(own))), by_cell(own), by_cell(own * (outcome - mean[owner]))
    if scores:
        pairs, found = {"meat": score.T @ score}, {}
    else:
        pairs = {"gram": np.diag((held * weighed).sum(axis=0)) - weighed.T @ (weighed / weight[:, None])}
        found = {("cross", int(c), None): value for c, value in zip(known, score.sum(axis=0), strict=True)}
        found |= {("providers", None, None): shape[0], ("observations", None, None): len(own)}
    met = held.T @ held
    for kind, matrix in pairs.items():
        for left, right in np.argwhere(np.triu(met) > 0):
            found[kind, int(known[left]), int(known[right])] = matrix[left, right]
    return found


def _moment_sums(cells: DataFrame, scores: bool) -> DataFrame:
    """Sums over providers by model and pair of cells, each pair once, the lower cell first.

    First pass: ``gram`` of the cells and ``cross`` with the outcome, provider means removed, and the
    numbers of ``providers`` and ``observations``.  With ``scores``: products of the provider's scores, as ``meat``.
    Batches of providers are multiplied as matrices, and a task sends its sums only.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Counter()
        for batch in batches:
            models = batch["model"].to_numpy()
            for model in np.unique(models):
                part = batch.filter(pa.array(models == model))
                own = _batch_sums(part["cells"], part["weight"].to_numpy(), part["mean"].to_numpy(), scores)
                for key, value in own.items():
                    sums[(int(model), *key)] += float(value)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(
                zip(*((*key, value) for key, value in sums.items()), strict=True), SUMS.types, strict=True)], schema=SUMS)

    found = cells.select("model", "cells", "weight", "mean").mapInArrow(summed, "model int, kind string, a int, b int, value double")
    return found.groupBy("model", "kind", "a", "b").agg(F.sum("value").alias("value"))


def _cell_columns(model: Model) -> tuple[list[int], np.ndarray]:
    """The model's cells and, for each, which regressors are one in it."""
    cells = [(t, d) for t in model.months for d in (0, 1)]
    rows = [
        [float(d and t in term) for term in model.terms] + [float(t == month) for month in model.months[1:]]
        for t, d in cells
    ]
    return [_cell(*cell) for cell in cells], np.array(rows)


def _matrices(sums: DataFrame, models: list[Model]) -> list[dict[str, np.ndarray]]:
    """Collected sums as arrays by kind; the number of cells is bounded by the design, not by the data."""
    places = [{c: n for n, c in enumerate(_cell_columns(model)[0])} for model in models]
    found = []
    for place in places:
        size = len(place)
        found.append({"gram": np.zeros((size, size)), "meat": np.zeros((size, size)), "cross": np.zeros(size),
                      "providers": np.zeros(()), "observations": np.zeros(())})
    for row in sums.collect():
        place = places[row["model"]]
        at = tuple(place[c] for c in (row["a"], row["b"]) if c is not None)
        found[row["model"]][row["kind"]][at] = row["value"]
        found[row["model"]][row["kind"]][at[::-1]] = row["value"]
    return found


def fit_models(panel: DataFrame, models: list[Model]) -> list[Fit]:
    """Weighted two-way fixed-effects fits with provider-clustered covariance, all in two passes.

    The panel has one row per provider and month and should be a written table: both passes read it.
    A model without observations has no fit and raises.
    """
    rows = provider_rows(panel)
    first = _matrices(_moment_sums(_model_cells(rows, models, None), scores=False), models)
    empty = sorted({model.name for model, sums in zip(models, first, strict=True) if not sums["observations"]})
    if empty:
        raise ContractError(f"no observations for {', '.join(empty)}")
    inverses, betas, fitted = [], [], []
    for model, sums in zip(models, first, strict=True):
        cells, columns = _cell_columns(model)
        inverse = np.linalg.pinv(columns.T @ sums["gram"] @ columns, hermitian=True)
        beta = inverse @ (columns.T @ sums["cross"])
        inverses.append(inverse)
        betas.append(beta)
        fitted.append(dict(zip(cells, map(float, columns @ beta), strict=True)))
    second = _matrices(_moment_sums(_model_cells(rows, models, fitted), scores=True), models)
    fits = []
    for model, inverse, beta, sums, scored in zip(models, inverses, betas, first, second, strict=True):
        columns = _cell_columns(model)[1]
        groups, n = int(sums["providers"]), int(sums["observations"])
        unknowns = 1 + (groups - 1) + model.width
        factor = groups / (groups - 1) * (n - 1) / (n - unknowns)
        covariance = factor * inverse @ (columns.T @ scored["meat"] @ columns) @ inverse
        terms = len(model.terms)
        fits.append(Fit(beta[:terms], covariance[:terms, :terms], groups, n))
    return fits


def normal_p_value(coefficient: float, error: float) -> float:
    return math.erfc(abs(coefficient / error) / math.sqrt(2))


def chi_square_tail(statistic: float, freedom: int) -> float:
    """Upper tail of the chi-square distribution, by recursion on the degrees of freedom."""
    half = statistic / 2
    tail = math.erfc(math.sqrt(half)) if freedom % 2 else math.exp(-half)
    step = 1 if freedom % 2 else 2
    while step + 2 <= freedom:
        tail += half ** (step / 2) * math.exp(-half) / math.gamma(step / 2 + 1)
        step += 2
    return tail


def _four(value: float) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)


EFFECT_SCHEMA = (
    "run_id string, outcome_name string, specification string, coefficient decimal(18,4), "
    "standard_error decimal(18,4), confidence_interval_lower decimal(18,4), "
    "confidence_interval_upper decimal(18,4), p_value decimal(18,4), provider_count bigint, "
    "observation_count bigint"
)
EVENT_SCHEMA = (
    "run_id string, outcome_name string, event_time int, coefficient decimal(18,4), "
    "standard_error decimal(18,4), confidence_interval_lower decimal(18,4), "
    "confidence_interval_upper decimal(18,4), p_value decimal(18,4)"
)
DIAGNOSTIC_SCHEMA = (
    "run_id string, outcome_name string, diagnostic_name string, specification string, "
    "statistic decimal(18,4), p_value decimal(18,4), passed boolean, explanation string"
)


def outcome_limits(panel: DataFrame, design: PolicyDesign) -> dict[str, float]:
    """Upper winsor limit of each outcome over its non-null provider months."""
    long = panel.unpivot(
        ["provider_key"], [F.col(name).cast("double").alias(name) for name in OUTCOMES], "outcome", "value"
    )
    limits = exact_percentiles(long, ["outcome"], "value", {"limit": design.winsor_fraction})
    return {row["outcome"]: row["limit"] for row in limits.collect()}  # five rows


def estimate_policy(panel: DataFrame, design: PolicyDesign) -> dict[str, DataFrame]:
    """Effects in three specifications, event study and diagnostics for every outcome."""
    months = tuple(range(-design.pre_months, design.post_months))
    before = tuple(month for month in months if month < 0)
    event_times = tuple(month for month in months if month != -1)
    post = (tuple(month for month in months if month >= 0),)
    placebo = (tuple(month for month in before if month >= -design.placebo_months_before),)
    limits = outcome_limits(panel, design)
    models = []
    for index, outcome in enumerate(OUTCOMES):
        models += [
            Model("balanced_panel", index, post, months),
            Model("winsorized_99_percent", index, post, months, upper=limits[outcome]),
            Model("unweighted_provider_month", index, post, months, weighted=False),
            Model("event_study", index, tuple((month,) for month in event_times), months),
            Model("placebo", index, placebo, before),
        ]
    fits = fit_models(panel, models)
    effects, events, diagnostics = [], [], []
    for model, fit in zip(models, fits, strict=True):
        outcome = OUTCOMES[model.outcome]
        errors = np.sqrt(np.diag(fit.covariance))

        def inference(place: int) -> tuple:
            b, se = float(fit.coefficients[place]), float(errors[place])
            p_value = normal_p_value(b, se)
            return (*map(_four, (b, se, b - 1.96 * se, b + 1.96 * se)), _four(p_value))

        if model.name == "event_study":
            events += [
                (design.run_id, outcome, time, *inference(place)) for place, time in enumerate(event_times)
            ]
            leads = [place for place, time in enumerate(event_times) if time < -1]
            beta = fit.coefficients[leads]
            inverse = np.linalg.pinv(fit.covariance[np.ix_(leads, leads)])
            statistic = float(beta @ inverse @ beta)
            p_value = chi_square_tail(statistic, len(leads))
            diagnostics.append(
                (design.run_id, outcome, "parallel_trends", "joint_wald", _four(statistic), _four(p_value),
                 p_value >= design.significance,
                 f"Joint Wald test of treatment-specific event coefficients {-design.pre_months} through -2.")
            )
        elif model.name == "placebo":
            b, se = float(fit.coefficients[0]), float(errors[0])
            p_value = normal_p_value(b, se)
            start = design.month(-design.placebo_months_before)
            diagnostics.append(
                (design.run_id, outcome, "placebo_policy_date", start.isoformat(), _four(b), _four(p_value),
                 p_value >= design.significance,
                 f"Pretreatment-only placebo interaction at {start:%B %Y}.")
            )
        else:
            effects.append(
                (design.run_id, outcome, model.name, *inference(0), fit.providers, fit.observations)
            )
    spark = panel.sparkSession
    return {
        "policy_effect_estimate": spark.createDataFrame(effects, EFFECT_SCHEMA),
        "event_study_estimate": spark.createDataFrame(events, EVENT_SCHEMA),
        "policy_diagnostic": spark.createDataFrame(diagnostics, DIAGNOSTIC_SCHEMA),
    }
