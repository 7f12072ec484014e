"""Registered queries: a Spark builder, its output columns and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.oracle_base import compose
from claimloom.sources.warehouse_model import WarehouseModel

# output kinds: (Spark type, DuckDB type); dates travel as ISO text, decimals as doubles
KINDS = {
    "long": ("bigint", "BIGINT"),
    "num": ("double", "DOUBLE"),
    "text": ("string", "VARCHAR"),
    "date": ("string", "VARCHAR"),
    "bool": ("boolean", "BOOLEAN"),
}


@dataclass(frozen=True)
class Query:
    build: Callable[[WarehouseModel], DataFrame]
    columns: dict[str, str]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        result = self.build(WarehouseModel(spark, folder))
        casts = [F.col(name).cast(KINDS[kind][0]).alias(name) for name, kind in self.columns.items()]
        return result.select(*casts)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = ", ".join(
            f'CAST({"CAST(" + name + " AS DATE)" if kind == "date" else name} AS {KINDS[kind][1]}) AS {name}'
            for name, kind in self.columns.items()
        )
        return compose(f"SELECT {casts} FROM ({self.sql}) result")


QUERIES: dict[str, Query] = {}


def columns(spec: str) -> dict[str, str]:
    """``"a:long b:num"`` as an ordered mapping."""
    return dict(item.split(":") for item in spec.split())


def register(name: str, build: Callable[[WarehouseModel], DataFrame], spec: str, sql: str | None) -> None:
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")
    QUERIES[name] = Query(build, columns(spec), sql)
