"""All-text source families derived from line items, one definition for Spark and DuckDB.

Column texts below are plain SQL that both engines read the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.contracts.silver import OUTPATIENT, PART_D, PHYSICIAN, PHYSICIAN_SERVICE


def text(value: str) -> str:
    return f"CAST({value} AS STRING)"


def base_select(codes: int) -> str:
    """Per supplier, code and year: line count, lowest and highest price."""
    return f"""
SELECT l_suppkey AS supp, l_partkey % {codes} AS code, CAST(year(l_shipdate) + 24 AS INT) AS yr,
  count(*) AS n, min(CAST(l_extendedprice AS DECIMAL(18,2))) AS lo,
  max(CAST(l_extendedprice AS DECIMAL(18,2))) AS hi
FROM lineitem GROUP BY l_suppkey, l_partkey % {codes}, year(l_shipdate)"""


RUCA = "CASE WHEN supp % 9 = 0 THEN NULL WHEN supp % 9 = 1 THEN ' ' ELSE {} END"


def lineage(source: str) -> dict[str, str]:
    return {
        "_source_id": f"'{source}'",
        "_reporting_year": "yr",
        "_source_file": f"'{source}_' || {text('yr')} || '.csv'",
        "_acquired_at_utc": "'2026-01-01T00:00:00Z'",
    }


HOSPITAL = {
    "Rndrng_Prvdr_CCN": f"lpad({text('supp')}, 6, '0')",
    "Rndrng_Prvdr_Org_Name": f"' Hospital ' || {text('supp')}",
    "Rndrng_Prvdr_St": f"{text('supp')} || ' Main Street'",
    "Rndrng_Prvdr_City": f"'City ' || {text('supp % 7')}",
    "Rndrng_Prvdr_State_Abrvtn": f"'S' || {text('supp % 10')}",
    "Rndrng_Prvdr_State_FIPS": f"lpad({text('supp % 56')}, 2, '0')",
    "Rndrng_Prvdr_Zip5": f"CASE WHEN supp % 41 = 0 THEN '12' ELSE lpad({text('supp * 37 % 90000')}, 5, '0') END",
    "Rndrng_Prvdr_RUCA": RUCA.format(text("supp % 10")),
    "Rndrng_Prvdr_RUCA_Desc": RUCA.format(f"'Area ' || {text('supp % 10')}"),
}
PROVIDER = {
    "Rndrng_Prvdr_Last_Org_Name": f"'Name ' || {text('supp')}",
    "Rndrng_Prvdr_First_Name": "'First'",
    "Rndrng_Prvdr_MI": "CASE WHEN supp % 3 = 0 THEN NULL ELSE 'M' END",
    "Rndrng_Prvdr_Crdntls": "'MD'",
    "Rndrng_Prvdr_Ent_Cd": "CASE WHEN supp % 4 = 0 THEN 'O' ELSE 'I' END",
    "Rndrng_Prvdr_St1": f"{text('supp')} || ' Main Street'",
    "Rndrng_Prvdr_St2": "''",
    "Rndrng_Prvdr_City": f"'City ' || {text('supp % 7')}",
    "Rndrng_Prvdr_State_Abrvtn": f"'S' || {text('supp % 10')}",
    "Rndrng_Prvdr_State_FIPS": f"CASE WHEN supp % 31 = 0 THEN '' ELSE lpad({text('supp % 56')}, 2, '0') END",
    "Rndrng_Prvdr_Zip5": f"lpad({text('supp * 37 % 90000')}, 5, '0')",
    "Rndrng_Prvdr_RUCA": RUCA.format(text("supp % 10")),
    "Rndrng_Prvdr_RUCA_Desc": RUCA.format(f"'Area ' || {text('supp % 10')}"),
    "Rndrng_Prvdr_Cntry": "CASE WHEN supp % 17 = 0 THEN 'CA' ELSE 'US' END",
    "Rndrng_Prvdr_Type": f"'Specialty ' || {text('supp % 3')}",
    "Rndrng_Prvdr_Mdcr_Prtcptg_Ind": "CASE WHEN supp % 19 = 0 THEN 'X' ELSE 'Y' END",
}
NPI = f"lpad({text('supp + 1000000000')}, 10, '0')"

INPATIENT_COLUMNS = {
    **HOSPITAL,
    "DRG_Cd": f"lpad({text('code')}, 3, '0')",
    "DRG_Desc": f"'Group ' || {text('code')}",
    "Tot_Dschrgs": f"CASE WHEN (supp + code) % 23 = 0 THEN '12.5' WHEN (supp + code) % 29 = 0 THEN 'bad' "
    f"ELSE {text('n * 5 + code % 4')} END",
    "Avg_Submtd_Cvrd_Chrg": f"CASE WHEN code % 4 <> 0 THEN {text('hi')} ELSE {text('lo')} END",
    "Avg_Tot_Pymt_Amt": f"' ' || CASE WHEN code % 4 <> 0 THEN {text('lo')} ELSE {text('hi')} END",
    "Avg_Mdcr_Pymt_Amt": text("CAST(lo * CAST(0.8 AS DECIMAL(2,1)) AS DECIMAL(20,3))"),
    **lineage("inpatient"),
}
HIDDEN = "CASE WHEN (supp + code) % 5 = 0 THEN NULL ELSE {} END"
OUTLIER = "CASE WHEN (supp + code) % 3 = 0 THEN NULL ELSE {} END"
OUTPATIENT_COLUMNS = {
    **HOSPITAL,
    "APC_Cd": f"lpad({text('code + 5000')}, 4, '0')",
    "APC_Desc": f"'Group ' || {text('code')}",
    "Bene_Cnt": f"CASE WHEN (supp + code) % 5 = 0 OR code = 7 THEN NULL ELSE {text('n * 6')} END",
    "CAPC_Srvcs": HIDDEN.format(text("n * 9 + code % 5")),
    "Avg_Tot_Sbmtd_Chrgs": HIDDEN.format(f"CASE WHEN code % 6 <> 0 THEN {text('hi')} ELSE {text('lo')} END"),
    "Avg_Mdcr_Alowd_Amt": HIDDEN.format(f"CASE WHEN code % 6 <> 0 THEN {text('lo')} ELSE {text('hi')} END"),
    "Avg_Mdcr_Pymt_Amt": HIDDEN.format(text("lo")),
    "Outlier_Srvcs": OUTLIER.format(text("n + 11")),
    "Avg_Mdcr_Outlier_Amt": OUTLIER.format(f"CASE WHEN code % 2 = 0 THEN {text('hi')} ELSE '1.5' END"),
    **lineage("outpatient"),
}
PHYSICIAN_SERVICE_COLUMNS = {
    "Rndrng_NPI": NPI,
    **PROVIDER,
    "HCPCS_Cd": f"'A' || lpad({text('code')}, 4, '0')",
    "HCPCS_Desc": f"'Service ' || {text('code')}",
    "HCPCS_Drug_Ind": "CASE WHEN code % 5 = 0 THEN 'Y' ELSE 'N' END",
    "Place_Of_Srvc": "CASE WHEN code % 3 = 0 THEN 'F' ELSE 'O' END",
    "Tot_Benes": text("n * 7 + 4"),
    "Tot_Srvcs": f"CASE WHEN code % 8 = 0 THEN '12.5' ELSE {text('n * 9')} END",
    "Tot_Bene_Day_Srvcs": text("n * 8"),
    "Avg_Sbmtd_Chrg": f"CASE WHEN code % 6 <> 0 THEN {text('hi')} ELSE {text('lo')} END",
    "Avg_Mdcr_Alowd_Amt": f"CASE WHEN code % 6 <> 0 THEN {text('lo')} ELSE {text('hi')} END",
    "Avg_Mdcr_Pymt_Amt": text("lo"),
    "Avg_Mdcr_Stdzd_Amt": f"CASE WHEN code % 7 = 0 THEN NULL ELSE {text('hi')} END",
    **lineage("physician_service"),
}


def flag(place: int, counter: bool = True) -> str:
    other = f"WHEN (supp + yr + {place}) % 13 = 0 THEN '#' " if counter else ""
    return f"CASE WHEN (supp + yr + {place}) % 11 = 0 THEN '*' {other}END"


def hidden_by(place: int, value: str, counter: bool = True) -> str:
    other = f" OR (supp + yr + {place}) % 13 = 0" if counter else ""
    return f"CASE WHEN (supp + yr + {place}) % 11 = 0{other} THEN NULL ELSE {value} END"


PHYSICIAN_COLUMNS = {
    "Rndrng_NPI": NPI,
    **PROVIDER,
    "Tot_HCPCS_Cds": text("n % 40"),
    "Tot_Benes": text("n * 8 + 3"),
    "Tot_Srvcs": f"{text('n * 9')} || '.5'",
    "Tot_Mdcr_Pymt_Amt": text("hi"),
    "Drug_Sprsn_Ind": flag(0),
    "Drug_Tot_HCPCS_Cds": hidden_by(0, text("n % 9")),
    "Drug_Tot_Benes": hidden_by(0, text("n")),
    "Drug_Mdcr_Pymt_Amt": hidden_by(0, text("lo")),
    "Med_Sprsn_Ind": flag(1),
    "Med_Tot_HCPCS_Cds": hidden_by(1, text("n % 9")),
    # one supplier breaks the rule that suppressed details are empty
    "Med_Tot_Benes": "CASE WHEN supp = 5 THEN '4' ELSE " + hidden_by(1, text("n")) + " END",
    "Bene_Avg_Age": text("60 + n % 30"),
    "Bene_CC_PH_Diabetes_V2_Pct": f"CASE WHEN supp % 5 = 0 THEN '75' ELSE {text('n % 70')} END",
    "Bene_CC_PH_Cancer_V2_Pct": f"CASE WHEN yr % 3 = 0 THEN NULL ELSE {text('n % 90')} END",
    "Bene_Avg_Risk_Scre": "CASE WHEN supp % 50 = 7 THEN '0' ELSE '1.25' END",
    **lineage("physician"),
}


def part_d_columns() -> dict[str, str]:
    hidden = {
        measure: (place, "#" in indicator.tokens)
        for place, indicator in enumerate(PART_D.indicators.values())
        for measure in indicator.measures
    }
    columns = {
        name: rendering
        for name, rendering in zip(
            PART_D.dimensions,
            [NPI, *[PROVIDER[c] for c in list(PROVIDER)[:14]], "CASE WHEN supp % 23 = 0 THEN NULL ELSE 'Internal Medicine' END",
             "CASE WHEN supp % 3 = 0 THEN 'Claim-Specialty' ELSE 'NPPES-Taxonomy' END"],
            strict=True,
        )
    }
    for place, name in enumerate(PART_D.integers):
        value = text(f"n * {place % 7 + 1}")
        columns[name] = hidden_by(hidden[name][0], value, hidden[name][1]) if name in hidden else value
    for place, name in enumerate(PART_D.decimals):
        value = text(f"lo + {place}")
        if name.endswith("_Rate"):
            value = f"{text('n % 101')} || '.25'"
        elif name == "Bene_Avg_Age":
            value = text("50 + n % 60")
        elif name == "Bene_Avg_Risk_Scre":
            value = "CASE WHEN supp % 10 = 0 THEN NULL ELSE '0.9' END"
        columns[name] = hidden_by(hidden[name][0], value, hidden[name][1]) if name in hidden else value
    for place, (name, indicator) in enumerate(PART_D.indicators.items()):
        columns[name] = flag(place, "#" in indicator.tokens)
    return {**columns, **lineage("part_d")}


GEOGRAPHIC_BASE = """
SELECT s_nationkey AS nat, l_partkey % 3 AS age, CAST(year(l_shipdate) + 19 AS INT) AS yr, count(*) AS n,
  min(CAST(l_extendedprice AS DECIMAL(18,2))) AS lo, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS hi
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
GROUP BY s_nationkey, l_partkey % 3, year(l_shipdate)"""
GEOGRAPHIC_COLUMNS = {
    "YEAR": text("yr"),
    "BENE_GEO_LVL": "CASE WHEN nat = 0 THEN 'National' WHEN nat < 8 THEN 'State' ELSE 'County' END",
    "BENE_GEO_DESC": "CASE WHEN nat = 0 THEN 'National' WHEN nat = 1 THEN 'Territory' WHEN nat = 2 THEN 'ZZ' "
    f"ELSE 'Place ' || {text('nat')} END",
    "BENE_GEO_CD": f"CASE WHEN nat < 3 OR nat = 9 THEN NULL ELSE lpad({text('nat')}, 5, '0') END",
    "BENE_AGE_LVL": "CASE age WHEN 0 THEN 'All' WHEN 1 THEN '<65' ELSE '>=65' END",
    "BENES_TOTAL_CNT": f"CASE WHEN (nat + yr) % 6 = 0 THEN '*' ELSE {text('n')} END",
    "TOT_MDCR_PYMT_AMT": f"CASE WHEN (nat + yr) % 7 = 0 THEN ' NA ' ELSE {text('hi')} END",
    "BENE_FEML_PCT": f"CASE WHEN (nat + yr) % 8 = 0 THEN '' WHEN (nat + yr) % 9 = 0 THEN '*' ELSE {text('n % 110')} END",
    "ACUTE_HOSP_READMSN_CNT": f"CASE WHEN nat = 4 THEN 'not-a-number' ELSE {text('n % 50')} || '.5' END",
    **lineage("geographic"),
}

BRONZE = {
    "inpatient": (base_select(50), INPATIENT_COLUMNS),
    "outpatient": (base_select(40), OUTPATIENT_COLUMNS),
    "physician_service": (base_select(60), PHYSICIAN_SERVICE_COLUMNS),
    "physician": (base_select(1), PHYSICIAN_COLUMNS),
    "part_d": (base_select(1), part_d_columns()),
    "geographic": (GEOGRAPHIC_BASE, GEOGRAPHIC_COLUMNS),
}


def bronze_sql(name: str) -> str:
    base, columns = BRONZE[name]
    return f"SELECT {', '.join(f'{value} AS {column}' for column, value in columns.items())} FROM ({base}) base"


def bronze_frame(model, name: str) -> DataFrame:
    """The same family as a DataFrame over the model's line items, written once."""

    def build() -> DataFrame:
        base, columns = BRONZE[name]
        frames = {"lineitem": model.read("lineitem"), "supplier": model.read("supplier")}
        grouped = model.spark.sql(
            base.replace("FROM lineitem", "FROM {lineitem}").replace("JOIN supplier", "JOIN {supplier}"),
            **{k: v for k, v in frames.items() if k in base},
        )
        return grouped.select(*[F.expr(value).alias(column) for column, value in columns.items()])

    return model.layers.keep(f"bronze_{name}", build)
