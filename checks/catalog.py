"""Imports every module that registers queries."""

from checks import (  # noqa: F401
    benchmark_queries,
    cost_queries,
    guard_queries,
    integrity_queries,
    model_queries,
    policy_queries,
    relational_queries,
    reporting_queries,
    rule_queries,
    seeding_queries,
    silver_queries,
    source_queries,
    star_path_queries,
    star_queries,
)
