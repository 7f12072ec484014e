"""The same marts, leads, scores and metrics over the star schema, held against the SQL of the operational path."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from checks.registry import QUERIES, register
from checks.reporting_queries import metrics
from checks.star_queries import star_of
from claimloom.plans import conformed, evaluation, reporting


class _OwnLayers:
    """The layers of a model under names of their own."""

    def __init__(self, layers):
        self._layers, self.root = layers, layers.root

    def keep(self, name, build, settings=None):
        return self._layers.keep(f"star_{name}", build, settings)


class _Resolving:
    """Tables of a star by which labels are resolved; claims, lines and payments as conformed, which are written already."""

    WRITTEN = {"fact_claim": "claims", "fact_claim_line": "lines", "fact_payment_transaction": "payments"}

    def __init__(self, star, facts):
        self._star, self._facts = star, facts

    def __getitem__(self, name):
        return getattr(self._facts, self.WRITTEN[name]) if name in self.WRITTEN else getattr(self._star, name)


class OverStar:
    """A model whose facts, members and labels come from the star schema's keys; the rest is the model's."""

    def __init__(self, model):
        self._model, self.layers = model, _OwnLayers(model.layers)

    def __getattr__(self, name):
        return getattr(self._model, name)

    @cached_property
    def facts(self):
        star = star_of(self._model)
        unlabelled = star.lazy_tables([name for name in star.TABLES if name not in conformed.LABEL_TABLES])
        return conformed.StarFacts(unlabelled, self._model.service_categories, self.layers.keep)

    @property
    def claim_header(self):
        return self.facts.claims

    @property
    def membership_month(self):
        return self.facts.memberships

    @property
    def anomaly_injection(self):
        return self.layers.keep("labels", lambda: evaluation.resolve_labels(_Resolving(star_of(self._model), self.facts)))


for name in (
    "e2_monthly_cost_utilization", "e4_monthly_payment_cash_flow", "e5_provider_service_concentration",
    "e6_cost_change_decomposition", "f6_early_warning_signals", "l1_provider_month_panel", "l2_policy_effects",
    "e10_eligible_targets", "r11_selected_findings", "r13_label_matches", "r14_rule_evaluation", "e13_executive_indicators",
):
    query = QUERIES[name]
    spec = " ".join(f"{column}:{kind}" for column, kind in query.columns.items())
    register(f"{name}_over_star", lambda m, build=query.build: build(OverStar(m)), spec, query.sql)


def star_comparison(model):
    """Every metric of the operational path against its recomputation from the star schema."""
    return reporting.compare_metrics(metrics(model), metrics(OverStar(model)), "star")


register(
    "h31_two_path_comparison",
    star_comparison,
    "metric_id:text comparison_scope:text metric_type:text reference_value:num recomputed_value:num tolerance:num passed:bool",
    "SELECT metric_id, comparison_scope, metric_type, value AS reference_value, value AS recomputed_value, "
    "CASE metric_type WHEN 'financial' THEN 0.01 WHEN 'rate' THEN 0.0001 WHEN 'coefficient' THEN 0.001 WHEN 'p_value' THEN 0.001 "
    "ELSE 0 END AS tolerance, TRUE AS passed FROM x_metrics",
)
register(
    "h32_two_path_metric_counts",
    lambda m: star_comparison(m).groupBy("metric_id").agg(
        F.count("*").alias("scopes"), F.count_if("passed").alias("passed"), F.count("recomputed_value").alias("recomputed")),
    "metric_id:text scopes:long passed:long recomputed:long",
    "SELECT metric_id, count(*) AS scopes, count(*) AS passed, count(value) AS recomputed FROM x_metrics GROUP BY metric_id",
)
