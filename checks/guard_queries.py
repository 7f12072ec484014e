"""Guards of columns, schemas, labels and check sets, shown over whole tables that keep or break them."""

import json
import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.bronze_model import bronze_frame
from checks.integrity_queries import ORACLE_TABLES
from checks.oracle_base import SUBQUERIES
from checks.registry import register
from checks.seeding_queries import WHERE, seeded
from checks.silver_queries import CONTRACTS, family_report
from checks.source_queries import LATER_COLUMN, SOURCE_COLUMNS, reported_years
from claimloom.contracts.silver import LINEAGE, OUTPATIENT
from claimloom.functions.hashing import schema_fingerprint
from claimloom.operators import quality
from claimloom.plans import conformed, silver, silver_quality
from claimloom.sources.warehouse_model import SOURCE_SCHEMAS

together = lambda parts: reduce(DataFrame.unionByName, parts)


def required(contract):
    return [*contract.dimensions, *contract.indicators, *LINEAGE]


def required_columns(model):
    """Filled rows of every required column; each family lacks the first one of its key."""
    parts = []
    for family, contract in CONTRACTS.items():
        rows = bronze_frame(model, family)
        rows = rows.drop(required(contract)[0])
        absent = silver.missing_columns(rows, required(contract))
        there = [name for name in required(contract) if name not in absent]
        filled = quality.report(rows, {name: F.count(F.col(name)) for name in there}).withColumn("present", F.lit(True))
        lacking = model.spark.createDataFrame([(name, None, False) for name in absent], "check_name string, violations long, present boolean")
        parts.append(filled.unionByName(lacking).select(
            F.lit(family).alias("family"), F.col("check_name").alias("column_name"), "present", F.col("violations").alias("filled_rows")))
    return together(parts)


register(
    "b22_required_columns",
    required_columns,
    "family:text column_name:text present:bool filled_rows:long",
    " UNION ALL ".join(
        f"SELECT '{family}' AS family, '{name}' AS column_name, "
        + (f"TRUE AS present, count({name}) AS filled_rows FROM bronze_{family}" if place else "FALSE AS present, NULL AS filled_rows")
        for family, contract in CONTRACTS.items() for place, name in enumerate(required(contract))
    ),
)
WITHHELD = list(OUTPATIENT.dimensions)[-1]


def drift(model):
    """Rows of each year by what its columns break: the first year lacks a column, the last has one more."""
    years, parts = reported_years(model), []
    for year in years:
        rows = bronze_frame(model, "outpatient").filter(F.col("_reporting_year") == year)
        if year == years[0]:
            rows = rows.drop(WITHHELD)
        elif year == years[-1]:
            rows = rows.withColumn(LATER_COLUMN, F.lit("x"))
        problems = silver_quality.schema_drift(rows, OUTPATIENT, len(SOURCE_COLUMNS)) or ["none"]
        counted = rows.agg(F.count("*").alias("row_count"))
        parts.append(counted.select(F.lit(year).alias("reporting_year"), F.explode(F.array(*map(F.lit, problems))).alias("problem"), "row_count"))
    return together(parts)


DRIFT_SQL = f"""SELECT _reporting_year AS reporting_year, count(*) AS row_count, CASE
  WHEN _reporting_year = min(_reporting_year) OVER () THEN ['absent {WITHHELD}', '{len(SOURCE_COLUMNS) - 1} source columns instead of {len(SOURCE_COLUMNS)}']
  WHEN _reporting_year = max(_reporting_year) OVER () THEN ['{len(SOURCE_COLUMNS) + 1} source columns instead of {len(SOURCE_COLUMNS)}']
  ELSE ['none'] END AS problems
FROM bronze_outpatient GROUP BY _reporting_year"""
register("h16_schema_drift", drift, "reporting_year:long problem:text row_count:long",
         f"SELECT reporting_year, unnest(problems) AS problem, row_count FROM ({DRIFT_SQL}) d")

# checks of one family by the contract of its SQL, in which one name is missing and one was never carried out
CHECK_NAMES = re.findall(r"'(\w+)' AS check_name", SUBQUERIES["report_inpatient"])
register(
    "h35_check_set",
    lambda m: quality.compared_check_set(family_report(m, "inpatient"), {*CHECK_NAMES[1:], "never_carried_out"}),
    "check_name:text contracted:bool carried_out:bool violations:long",
    f"SELECT check_name, check_name <> '{CHECK_NAMES[0]}' AS contracted, TRUE AS carried_out, violations FROM report_inpatient "
    "UNION ALL SELECT 'never_carried_out', TRUE, FALSE, NULL",
)


def isolation(model):
    tables = model.tables()
    refused = conformed.label_tables(ORACLE_TABLES)
    return together([
        tables[name].agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), F.lit(name in refused).alias("refused"), "row_count")
        for name in ORACLE_TABLES
    ])


register(
    "c4_label_isolation",
    isolation,
    "table_name:text refused:bool row_count:long",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {name == 'anomaly_injection'} AS refused, count(*) AS row_count FROM {table}"
        for name, table in ORACLE_TABLES.items()
    ),
)


def schema_text(columns):
    named = [dict(zip(("name", "type"), column.split())) for column in columns.split(", ")]
    return json.dumps(named, separators=(",", ":"))


register(
    "g8_schema_hashes",
    lambda m: together([
        m.read(name).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(schema_fingerprint(m.read(name))).alias("schema_sha256"), "row_count")
        for name in SOURCE_SCHEMAS
    ]),
    "table_name:text schema_sha256:text row_count:long",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, sha256('{schema_text(columns)}') AS schema_sha256, count(*) AS row_count FROM {name}"
        for name, columns in SOURCE_SCHEMAS.items()
    ),
)


def numbered_injections(model):
    """Injections of each rule, and those whose changes are numbered from 1 without a gap."""
    state = seeded(model)
    number = F.col("change_sequence_number")
    numbers = state.changes.groupBy("injection_id").agg(
        F.count("*").alias("_n"), F.min(number).alias("_first"), F.max(number).alias("_last"), F.count_distinct(number).alias("_distinct"))
    gapless = (F.col("_first") == 1) & (F.col("_n") == F.col("_last")) & (F.col("_n") == F.col("_distinct"))
    return state.labels.join(numbers, "injection_id", "left").groupBy("rule_id").agg(
        F.count("*").alias("injections"), F.count_if(gapless | F.col("_n").isNull()).alias("gapless"))


register(
    "f14_numbered_injections",
    numbered_injections,
    "rule_id:text injections:long gapless:long",
    " UNION ALL ".join(
        f"SELECT rule_id, count(*) AS injections, count(*) AS gapless FROM {table} GROUP BY rule_id" for table in sorted(set(WHERE.values()))
    ),
)
