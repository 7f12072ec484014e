"""Round trips through text landings, published tables and exports, on data derived from the given tables."""

import json
from functools import reduce

from pyspark.sql import functions as F

from checks.bronze_model import BRONZE, bronze_frame
from checks.registry import register
from claimloom.contracts.silver import LINEAGE
from claimloom.functions.hashing import schema_fingerprint
from claimloom.sources import landing, publish

SOURCE_COLUMNS = [c for c in BRONZE["outpatient"][1] if c not in LINEAGE]
# this year's file is in another charset, and the last year's has one more column
LATIN_YEAR = 2020
LATER_COLUMN = "Later_Note"
SECOND_LINE = 'second ""line"", é'


def reported_years(model):
    rows = bronze_frame(model, "outpatient").select("_reporting_year").distinct().collect()
    return sorted(row["_reporting_year"] for row in rows)


def annual_frames(model):
    """Rows of each year as its file holds them: some texts have line breaks, quotes, commas or U+FFFD."""
    source = bronze_frame(model, "outpatient")
    years = reported_years(model)
    code, note = F.col("APC_Cd"), F.col("APC_Desc")
    told = F.when(code.endswith("1"), F.concat(note, F.lit("\n" + SECOND_LINE.replace('""', '"')))).when(
        code.endswith("2") & (F.col("_reporting_year") != LATIN_YEAR), F.concat(note, F.lit("\ufffd"))
    ).otherwise(note)
    frames = {}
    for year in years:
        rows = source.filter(F.col("_reporting_year") == year).withColumn("APC_Desc", told).select(*SOURCE_COLUMNS)
        frames[year] = rows.withColumn(LATER_COLUMN, F.lit("x")) if year == years[-1] else rows
    return frames


def raw_root(model):
    """Annual CSV data sets of the outpatient family, one per year, written once."""
    root = f"{model.layers.root}/raw"
    marker = "raw_outpatient_written"

    def write():
        for year, rows in annual_frames(model).items():
            rows.write.mode("overwrite").csv(
                f"{root}/outpatient/{year}/outpatient_{year}.csv", header=True, nullValue="", emptyValue="", quoteAll=True,
                escape='"', encoding="ISO-8859-1" if year == LATIN_YEAR else "UTF-8",
            )
        return model.spark.range(1)

    model.layers.keep(marker, write)
    return root


def landed(model):
    root, target = raw_root(model), f"{model.layers.root}/landed"

    def land():
        return landing.land_family(model.spark, root, target, "outpatient", reported_years(model),
                                   aliases={"APC_Desc": "APC_Description"}, encodings={LATIN_YEAR: "latin-1"},
                                   acquired_at="2026-01-01T00:00:00Z")

    inventory = model.layers.keep("landed_inventory", land)
    return inventory, model.spark.read.parquet(f"{target}/outpatient")


KEY = "Rndrng_Prvdr_CCN:text APC_Cd:text "
TOLD = f"""CASE WHEN APC_Cd LIKE '%1' THEN APC_Desc || chr(10) || '{SECOND_LINE.replace('""', '"')}'
WHEN APC_Cd LIKE '%2' AND _reporting_year <> {LATIN_YEAR} THEN APC_Desc || chr(65533) ELSE APC_Desc END"""
register(
    "a1_text_landing",
    lambda m: landed(m)[1],
    KEY + "_reporting_year:long CAPC_Srvcs:text Avg_Mdcr_Pymt_Amt:text _source_id:text",
    "SELECT Rndrng_Prvdr_CCN, APC_Cd, _reporting_year, CAPC_Srvcs, Avg_Mdcr_Pymt_Amt, 'outpatient' AS _source_id "
    "FROM bronze_outpatient",
)
register(
    "a2_source_charset",
    lambda m: landed(m)[1].filter(F.col("_reporting_year") == LATIN_YEAR),
    KEY + "APC_Description:text",
    f"SELECT Rndrng_Prvdr_CCN, APC_Cd, {TOLD} AS APC_Description FROM bronze_outpatient WHERE _reporting_year = {LATIN_YEAR}",
)
register(
    "a3_column_aliases",
    lambda m: landed(m)[1],
    KEY + "_reporting_year:long APC_Description:text",
    f"SELECT Rndrng_Prvdr_CCN, APC_Cd, _reporting_year, {TOLD} AS APC_Description FROM bronze_outpatient",
)
register(
    "a4_lineage_columns",
    lambda m: landed(m)[1].select(
        "_reporting_year", "_source_id", "_acquired_at_utc", F.col("_source_file").endswith(".csv").alias("named")
    ).distinct(),
    "_reporting_year:long _source_id:text _acquired_at_utc:text named:bool",
    "SELECT DISTINCT _reporting_year, 'outpatient' AS _source_id, '2026-01-01T00:00:00Z' AS _acquired_at_utc, TRUE AS named "
    "FROM bronze_outpatient",
)
INVENTORY_SQL = f"""SELECT _reporting_year AS reporting_year,
  {len(SOURCE_COLUMNS)} + CAST(_reporting_year = max(_reporting_year) OVER () AS INT) AS source_column_count, count(*) AS row_count,
  count(*) OVER () = 1 AS schema_consistent
FROM bronze_outpatient GROUP BY _reporting_year"""
INVENTORY = "reporting_year:long source_column_count:long row_count:long schema_consistent:bool"
register("a8_family_landing_inventory", lambda m: landed(m)[0], INVENTORY, INVENTORY_SQL)
register("a11_schema_drift_inventory", lambda m: landing.family_inventory(annual_frames(m)), INVENTORY, INVENTORY_SQL)
register(
    "a10_schema_signature",
    lambda m: bronze_frame(m, "outpatient").groupBy("_reporting_year").agg(
        F.lit(schema_fingerprint(bronze_frame(m, "outpatient"))).alias("schema_signature"), F.count("*").alias("row_count")
    ).select("_reporting_year", "row_count", (F.length("schema_signature") == 64).alias("signed")),
    "_reporting_year:long row_count:long signed:bool",
    "SELECT _reporting_year, count(*) AS row_count, TRUE AS signed FROM bronze_outpatient GROUP BY _reporting_year",
)


def signatures(model):
    """The signature of each year's columns; the last year has one more."""
    frames = [rows.agg(F.lit(year).alias("_reporting_year"), F.lit(schema_fingerprint(rows)).alias("schema_signature"),
                       F.count("*").alias("row_count")) for year, rows in annual_frames(model).items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def signed_text(columns):
    return "sha256('" + json.dumps([{"name": c, "type": "string"} for c in columns], separators=(",", ":")) + "')"


register(
    "a10_annual_schema_signatures",
    signatures,
    "_reporting_year:long schema_signature:text row_count:long",
    f"SELECT _reporting_year, CASE WHEN _reporting_year = max(_reporting_year) OVER () THEN {signed_text([*SOURCE_COLUMNS, LATER_COLUMN])} "
    f"ELSE {signed_text(SOURCE_COLUMNS)} END AS schema_signature, count(*) AS row_count FROM bronze_outpatient GROUP BY _reporting_year",
)


def published(model):
    path = f"{model.layers.root}/published_claims"

    def check(written):
        if written.filter("claim_id is null").limit(1).count():
            raise ValueError("claims without identifier")

    return publish.publish(model.claim_header.select("claim_id", "claim_status", "total_allowed_amount"), path, check)


CLAIM_SPEC = "claim_id:text claim_status:text total_allowed_amount:num"
CLAIM_SQL = "SELECT claim_id, claim_status, total_allowed_amount FROM op_claim_header"
register("a6_validated_publish", published, CLAIM_SPEC, CLAIM_SQL)
register("a5_parquet_sink", published, CLAIM_SPEC, CLAIM_SQL)
ROW_GROUP_ROWS = 1_000


def published_footers(model):
    """Codec, rows, largest row group and bounds of the identifier, as the footers of the published files have them."""
    path = f"{model.layers.root}/published_in_small_groups"
    claims = model.claim_header.select("claim_id", "claim_status", "adjudication_date").coalesce(2)
    footers = publish.parquet_footers(publish.publish(claims, path, row_group_rows=ROW_GROUP_ROWS))
    return footers.groupBy("column_name", "codec").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.count_if(F.col("row_count") > ROW_GROUP_ROWS).alias("groups_too_large"),
        (F.count("*") >= F.ceil(F.sum("row_count") / ROW_GROUP_ROWS)).alias("enough_groups"),
        F.when(F.col("column_name") == "claim_id", F.min("smallest")).alias("smallest"),
        F.when(F.col("column_name") == "claim_id", F.max("largest")).alias("largest"),
    )


register(
    "a5_parquet_footers",
    published_footers,
    "column_name:text codec:text row_count:long null_count:long groups_too_large:long enough_groups:bool smallest:text largest:text",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, 'ZSTD' AS codec, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"0 AS groups_too_large, TRUE AS enough_groups, {bounds.format('min')} AS smallest, {bounds.format('max')} AS largest "
        "FROM op_claim_header"
        for c, bounds in (("claim_id", "{}(claim_id)"), ("claim_status", "NULL"), ("adjudication_date", "NULL"))
    ),
)


def required_tables(model):
    published(model)
    return publish.load_tables(model.spark, model.layers.root, ["published_claims"])["published_claims"]


register("a13_required_tables", required_tables, CLAIM_SPEC, CLAIM_SQL)


def exported(model):
    path = f"{model.layers.root}/exported_claims"
    publish.write_csv(model.claim_header.select("claim_id", "claim_status", "service_from_date", "total_allowed_amount"),
                      path, ["claim_id"])
    return model.spark.read.csv(path, header=True)


register(
    "a14_csv_export",
    exported,
    "claim_id:text claim_status:text service_from_date:text total_allowed_amount:text",
    "SELECT claim_id, claim_status, CAST(service_from_date AS VARCHAR) AS service_from_date, "
    "CAST(total_allowed_amount AS VARCHAR) AS total_allowed_amount FROM op_claim_header",
)
CONTRACT = {"claim_id": ("VARCHAR", False), "service_from_date": ("DATE", False), "claim_version_number": ("SMALLINT", False),
            "adjudication_date": ("DATE", True), "total_allowed_amount": ("DECIMAL(18,4)", False)}
register(
    "a17_contract_schema",
    lambda m: publish.conform(m.claim_header, publish.table_schema(CONTRACT)),
    "claim_id:text service_from_date:date claim_version_number:long adjudication_date:date total_allowed_amount:num",
    "SELECT claim_id, service_from_date, claim_version_number, adjudication_date, total_allowed_amount FROM op_claim_header",
)
