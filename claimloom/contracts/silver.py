"""Contracts of the six annual source families.

Fixed values: source column names, their targets, tokens, bands, patterns and allowed values
describe public files and must be kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

LINEAGE = ("_source_id", "_reporting_year", "_source_file", "_acquired_at_utc")

NPI = "[0-9]{10}"
CCN = "[0-9A-Za-z]{6}"
TWO_DIGITS, THREE_DIGITS, FOUR_DIGITS, FIVE_DIGITS = ("[0-9]{%d}" % n for n in (2, 3, 4, 5))
HCPCS = "[0-9A-Za-z]{5}"

PRIMARY_AND_COUNTER = {"*": "primary_suppressed_fewer_than_11", "#": "counter_suppressed"}


@dataclass(frozen=True)
class Indicator:
    """A suppression flag column, the group it governs and the measures it blanks."""

    group: str
    measures: tuple[str, ...] = ()
    prefix: str | None = None
    tokens: tuple[str, ...] = ("*", "#")


@dataclass(frozen=True)
class Band:
    column: str
    measure: str
    ranges: tuple[tuple[str, int, int | None], ...]
    when_null: str | None = None


@dataclass(frozen=True)
class SourceContract:
    name: str
    key: tuple[str, ...]
    dimensions: dict[str, str]
    unknown: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    decimals: tuple[str, ...] | None = None  # None: every other column is a decimal measure
    targets: dict[str, str] = field(default_factory=dict)
    period: str = "reporting_year"
    periods: tuple[int, ...] = (2019, 2020, 2021, 2022, 2023, 2024)
    band: Band | None = None
    indicators: dict[str, Indicator] = field(default_factory=dict)
    statuses: dict[str, str] = field(default_factory=dict)
    trim_tokens: bool = True
    flags: tuple[tuple[str, str, str], ...] = ()  # flag, left measure, right measure
    flag_nulls_false: bool = False
    null_groups: dict[str, str] = field(default_factory=dict)  # status column, governing measure
    top_coded_suffix: str | None = None
    top_code: int = 75
    country: str | None = None
    patterns: dict[str, str] = field(default_factory=dict)
    null_breaks_pattern: bool = True
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    minimum: tuple[str, int] | None = None
    ordered: tuple[tuple[str, str], ...] = ()  # lower measure may not exceed the higher
    cohort: tuple[str, ...] = ()
    cohort_measure: str = ""  # compared between peers
    cohort_volume: str | None = None  # totalled over peers
    minimum_peers: int = 11
    private: tuple[str, ...] = ()  # columns left out of public extracts

    def target(self, source: str) -> str:
        return self.targets.get(source, source.lower())


HOSPITAL = {
    "Rndrng_Prvdr_CCN": "hospital_ccn",
    "Rndrng_Prvdr_Org_Name": "hospital_name",
    "Rndrng_Prvdr_St": "hospital_street_address",
    "Rndrng_Prvdr_City": "hospital_city",
    "Rndrng_Prvdr_State_Abrvtn": "hospital_state_abbreviation",
    "Rndrng_Prvdr_State_FIPS": "hospital_state_fips",
    "Rndrng_Prvdr_Zip5": "hospital_zip5",
    "Rndrng_Prvdr_RUCA": "hospital_ruca_code",
    "Rndrng_Prvdr_RUCA_Desc": "hospital_ruca_description",
}
HOSPITAL_PATTERNS = {
    "hospital_ccn": CCN,
    "hospital_state_fips": TWO_DIGITS,
    "hospital_zip5": FIVE_DIGITS,
}
HOSPITAL_PRIVATE = ("hospital_name", "hospital_street_address", "hospital_zip5")

INPATIENT = SourceContract(
    name="inpatient_provider_service",
    key=("hospital_ccn", "ms_drg_code", "reporting_year"),
    dimensions={**HOSPITAL, "DRG_Cd": "ms_drg_code", "DRG_Desc": "ms_drg_description"},
    unknown=("hospital_ruca_code", "hospital_ruca_description"),
    integers=("Tot_Dschrgs",),
    decimals=("Avg_Submtd_Cvrd_Chrg", "Avg_Tot_Pymt_Amt", "Avg_Mdcr_Pymt_Amt"),
    targets={
        "Tot_Dschrgs": "total_discharges",
        "Avg_Submtd_Cvrd_Chrg": "average_submitted_covered_charge",
        "Avg_Tot_Pymt_Amt": "average_total_payment",
        "Avg_Mdcr_Pymt_Amt": "average_medicare_payment",
    },
    band=Band("discharge_volume_band", "total_discharges",
              (("low", 11, 13), ("medium", 14, 20), ("high", 21, 35), ("very_high", 36, None))),
    flags=(("total_payment_above_covered_charge", "average_total_payment",
            "average_submitted_covered_charge"),),
    flag_nulls_false=True,
    patterns={**HOSPITAL_PATTERNS, "ms_drg_code": THREE_DIGITS},
    minimum=("total_discharges", 11),
    ordered=(("average_medicare_payment", "average_total_payment"),),
    cohort=("ms_drg_code", "hospital_state_fips", "hospital_ruca_code", "discharge_volume_band",
            "reporting_year"),
    cohort_measure="average_total_payment",
    cohort_volume="total_discharges",
    private=HOSPITAL_PRIVATE,
)

OUTPATIENT = SourceContract(
    name="outpatient_provider_service",
    key=("hospital_ccn", "comprehensive_apc_code", "reporting_period"),
    dimensions={**HOSPITAL, "APC_Cd": "comprehensive_apc_code", "APC_Desc": "comprehensive_apc_description"},
    unknown=("hospital_ruca_code", "hospital_ruca_description"),
    integers=("Bene_Cnt", "CAPC_Srvcs", "Outlier_Srvcs"),
    decimals=("Avg_Tot_Sbmtd_Chrgs", "Avg_Mdcr_Alowd_Amt", "Avg_Mdcr_Pymt_Amt", "Avg_Mdcr_Outlier_Amt"),
    targets={
        "Bene_Cnt": "beneficiary_count",
        "CAPC_Srvcs": "comprehensive_apc_services",
        "Outlier_Srvcs": "outlier_services",
        "Avg_Tot_Sbmtd_Chrgs": "average_submitted_charge",
        "Avg_Mdcr_Alowd_Amt": "average_medicare_allowed_amount",
        "Avg_Mdcr_Pymt_Amt": "average_medicare_payment",
        "Avg_Mdcr_Outlier_Amt": "average_medicare_outlier_amount",
    },
    period="reporting_period",
    periods=(2019, 2021, 2023),
    band=Band("service_volume_band", "comprehensive_apc_services",
              (("low", 11, 20), ("medium", 21, 38), ("high", 39, 88), ("very_high", 89, None)),
              when_null="suppressed"),
    null_groups={
        "provider_apc_summary_status": "comprehensive_apc_services",
        "beneficiary_count_status": "beneficiary_count",
        "outlier_detail_status": "outlier_services",
    },
    flags=(
        ("allowed_amount_above_submitted_charge", "average_medicare_allowed_amount", "average_submitted_charge"),
        ("medicare_payment_above_submitted_charge", "average_medicare_payment", "average_submitted_charge"),
        ("outlier_amount_above_regular_payment", "average_medicare_outlier_amount", "average_medicare_payment"),
    ),
    patterns={**HOSPITAL_PATTERNS, "comprehensive_apc_code": FOUR_DIGITS},
    ordered=(("average_medicare_payment", "average_medicare_allowed_amount"),),
    cohort=("comprehensive_apc_code", "hospital_state_fips", "hospital_ruca_code", "service_volume_band",
            "reporting_period"),
    cohort_measure="average_medicare_payment",
    cohort_volume="comprehensive_apc_services",
    private=HOSPITAL_PRIVATE,
)

RENDERING_PROVIDER = {
    "Rndrng_Prvdr_Last_Org_Name": "provider_last_or_organization_name",
    "Rndrng_Prvdr_First_Name": "provider_first_name",
    "Rndrng_Prvdr_MI": "provider_middle_initial",
    "Rndrng_Prvdr_Crdntls": "provider_credentials",
    "Rndrng_Prvdr_Ent_Cd": "provider_entity_code",
    "Rndrng_Prvdr_St1": "provider_street_address_1",
    "Rndrng_Prvdr_St2": "provider_street_address_2",
    "Rndrng_Prvdr_City": "provider_city",
    "Rndrng_Prvdr_State_Abrvtn": "provider_state_abbreviation",
    "Rndrng_Prvdr_State_FIPS": "provider_state_fips",
    "Rndrng_Prvdr_Zip5": "provider_zip5",
    "Rndrng_Prvdr_RUCA": "provider_ruca_code",
    "Rndrng_Prvdr_RUCA_Desc": "provider_ruca_description",
    "Rndrng_Prvdr_Cntry": "provider_country_code",
}

PHYSICIAN_SERVICE = SourceContract(
    name="physician_provider_service",
    key=("rendering_npi", "hcpcs_code", "place_of_service_category", "reporting_year"),
    dimensions={
        "Rndrng_NPI": "rendering_npi",
        **RENDERING_PROVIDER,
        "Rndrng_Prvdr_Type": "provider_type",
        "Rndrng_Prvdr_Mdcr_Prtcptg_Ind": "medicare_participation_indicator",
        "HCPCS_Cd": "hcpcs_code",
        "HCPCS_Desc": "hcpcs_description",
        "HCPCS_Drug_Ind": "hcpcs_drug_indicator",
        "Place_Of_Srvc": "place_of_service_category",
    },
    unknown=("provider_state_fips", "provider_ruca_code", "provider_ruca_description"),
    integers=("Tot_Benes", "Tot_Bene_Day_Srvcs"),
    decimals=("Tot_Srvcs", "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt", "Avg_Mdcr_Pymt_Amt", "Avg_Mdcr_Stdzd_Amt"),
    targets={
        "Tot_Benes": "total_beneficiaries",
        "Tot_Srvcs": "total_services",
        "Tot_Bene_Day_Srvcs": "total_beneficiary_day_services",
        "Avg_Sbmtd_Chrg": "average_submitted_charge",
        "Avg_Mdcr_Alowd_Amt": "average_medicare_allowed_amount",
        "Avg_Mdcr_Pymt_Amt": "average_medicare_payment",
        "Avg_Mdcr_Stdzd_Amt": "average_standardized_medicare_payment",
    },
    band=Band("beneficiary_volume_band", "total_beneficiaries",
              (("low", 11, 17), ("medium", 18, 31), ("high", 32, 72), ("very_high", 73, None))),
    flags=(
        ("allowed_amount_above_submitted_charge", "average_medicare_allowed_amount", "average_submitted_charge"),
        ("medicare_payment_above_submitted_charge", "average_medicare_payment", "average_submitted_charge"),
        ("standardized_payment_above_allowed_amount", "average_standardized_medicare_payment",
         "average_medicare_allowed_amount"),
    ),
    country="provider_country_code",
    patterns={"rendering_npi": NPI, "hcpcs_code": HCPCS},
    null_breaks_pattern=False,
    domains={
        "provider_entity_code": ("I", "O"),
        "place_of_service_category": ("F", "O"),
        "hcpcs_drug_indicator": ("N", "Y"),
        "medicare_participation_indicator": ("N", "Y"),
    },
    minimum=("total_beneficiaries", 11),
    ordered=(("average_medicare_payment", "average_medicare_allowed_amount"),),
    cohort=("hcpcs_code", "place_of_service_category", "provider_type", "provider_country_code",
            "peer_state_fips", "beneficiary_volume_band", "reporting_year"),
    cohort_measure="average_medicare_payment",
    cohort_volume="total_beneficiaries",
    private=("provider_last_or_organization_name", "provider_first_name", "provider_street_address_1",
             "provider_street_address_2", "provider_zip5"),
)

AGES = ("LT_65", "65_74", "75_84", "GT_84")
RACES = ("Wht", "Black", "API", "Hspnc", "NatInd", "Othr")

PHYSICIAN = SourceContract(
    name="physician_provider_summary",
    key=("provider_npi", "reporting_year"),
    dimensions={
        "Rndrng_NPI": "provider_npi",
        **RENDERING_PROVIDER,
        "Rndrng_Prvdr_Type": "provider_specialty",
        "Rndrng_Prvdr_Mdcr_Prtcptg_Ind": "medicare_participation_indicator",
    },
    integers=(
        "Tot_HCPCS_Cds", "Tot_Benes", "Drug_Tot_HCPCS_Cds", "Drug_Tot_Benes", "Med_Tot_HCPCS_Cds",
        "Med_Tot_Benes", *(f"Bene_Age_{age}_Cnt" for age in AGES), "Bene_Feml_Cnt", "Bene_Male_Cnt",
        *(f"Bene_Race_{race}_Cnt" for race in RACES), "Bene_Dual_Cnt", "Bene_Ndual_Cnt",
    ),
    band=Band("provider_size_band", "tot_benes",
              (("small", 11, 49), ("medium", 50, 199), ("large", 200, 999), ("very_large", 1000, None))),
    indicators={
        "Drug_Sprsn_Ind": Indicator("drug", prefix="Drug_"),
        "Med_Sprsn_Ind": Indicator("medical", prefix="Med_"),
    },
    statuses=PRIMARY_AND_COUNTER,
    trim_tokens=False,
    top_coded_suffix="_Pct",
    patterns={"provider_npi": NPI},
    null_breaks_pattern=False,
    cohort=("provider_specialty", "provider_country_code", "provider_state_abbreviation",
            "provider_ruca_code", "provider_entity_code", "reporting_year"),
    cohort_measure="tot_mdcr_pymt_amt",
    cohort_volume="tot_benes",
    private=("provider_street_address_1", "provider_street_address_2", "provider_first_name",
             "provider_middle_initial", "provider_last_or_organization_name", "provider_credentials",
             "provider_zip5"),
)

PRESCRIBER = {
    "Prscrbr_NPI": "prescriber_npi",
    "Prscrbr_Last_Org_Name": "prescriber_last_or_organization_name",
    "Prscrbr_First_Name": "prescriber_first_name",
    "Prscrbr_MI": "prescriber_middle_initial",
    "Prscrbr_Crdntls": "prescriber_credentials",
    "Prscrbr_Ent_Cd": "prescriber_entity_code",
    "Prscrbr_St1": "prescriber_street_address_1",
    "Prscrbr_St2": "prescriber_street_address_2",
    "Prscrbr_City": "prescriber_city",
    "Prscrbr_State_Abrvtn": "prescriber_state_abbreviation",
    "Prscrbr_State_FIPS": "prescriber_state_fips",
    "Prscrbr_zip5": "prescriber_zip5",
    "Prscrbr_RUCA": "prescriber_ruca_code",
    "Prscrbr_RUCA_Desc": "prescriber_ruca_description",
    "Prscrbr_Cntry": "prescriber_country_code",
    "Prscrbr_Type": "prescriber_type",
    "Prscrbr_Type_src": "prescriber_type_source",
}


def _claims_and_cost(prefix: str) -> tuple[str, str]:
    return f"{prefix}_Tot_Clms", f"{prefix}_Tot_Drug_Cst"


PART_D = SourceContract(
    name="part_d_provider_summary",
    key=("prescriber_npi", "reporting_year"),
    dimensions=PRESCRIBER,
    unknown=("prescriber_type", "prescriber_ruca_code"),
    integers=(
        "Tot_Clms", "Tot_Day_Suply", "Tot_Benes", "GE65_Tot_Clms", "GE65_Tot_Day_Suply", "GE65_Tot_Benes",
        "Brnd_Tot_Clms", "Gnrc_Tot_Clms", "Othr_Tot_Clms", "MAPD_Tot_Clms", "PDP_Tot_Clms", "LIS_Tot_Clms",
        "NonLIS_Tot_Clms", "Opioid_Tot_Clms", "Opioid_Tot_Suply", "Opioid_Tot_Benes", "Opioid_LA_Tot_Clms",
        "Opioid_LA_Tot_Suply", "Opioid_LA_Tot_Benes", "Antbtc_Tot_Clms", "Antbtc_Tot_Benes",
        "Antpsyct_GE65_Tot_Clms", "Antpsyct_GE65_Tot_Benes", *(f"Bene_Age_{age}_Cnt" for age in AGES),
        "Bene_Feml_Cnt", "Bene_Male_Cnt",
        *(f"Bene_Race_{race}_Cnt" for race in ("Wht", "Black", "Api", "Hspnc", "Natind", "Othr")),
        "Bene_Dual_Cnt", "Bene_Ndual_Cnt",
    ),
    decimals=(
        "Tot_30day_Fills", "GE65_Tot_30day_Fills", "Tot_Drug_Cst", "GE65_Tot_Drug_Cst", "Brnd_Tot_Drug_Cst",
        "Gnrc_Tot_Drug_Cst", "Othr_Tot_Drug_Cst", "MAPD_Tot_Drug_Cst", "PDP_Tot_Drug_Cst", "LIS_Drug_Cst",
        "NonLIS_Drug_Cst", "Opioid_Tot_Drug_Cst", "Opioid_LA_Tot_Drug_Cst", "Antbtc_Tot_Drug_Cst",
        "Antpsyct_GE65_Tot_Drug_Cst", "Opioid_Prscrbr_Rate", "Opioid_LA_Prscrbr_Rate", "Bene_Avg_Age",
        "Bene_Avg_Risk_Scre",
    ),
    band=Band("prescriber_size_band", "tot_clms",
              (("small", 11, 55), ("medium", 56, 200), ("large", 201, 938), ("very_large", 939, None))),
    indicators={
        "GE65_Sprsn_Flag": Indicator(
            "age_65_and_older_activity",
            ("GE65_Tot_Clms", "GE65_Tot_30day_Fills", "GE65_Tot_Drug_Cst", "GE65_Tot_Day_Suply"),
        ),
        "GE65_Bene_Sprsn_Flag": Indicator("age_65_and_older_beneficiaries", ("GE65_Tot_Benes",)),
        "Brnd_Sprsn_Flag": Indicator("brand", _claims_and_cost("Brnd")),
        "Gnrc_Sprsn_Flag": Indicator("generic", _claims_and_cost("Gnrc")),
        "Othr_Sprsn_Flag": Indicator("other_drug", _claims_and_cost("Othr")),
        "MAPD_Sprsn_Flag": Indicator("medicare_advantage_part_d", _claims_and_cost("MAPD")),
        "PDP_Sprsn_Flag": Indicator("standalone_part_d", _claims_and_cost("PDP")),
        "LIS_Sprsn_Flag": Indicator("low_income_subsidy", ("LIS_Tot_Clms", "LIS_Drug_Cst")),
        "NonLIS_Sprsn_Flag": Indicator("non_low_income_subsidy", ("NonLIS_Tot_Clms", "NonLIS_Drug_Cst")),
        "Antpsyct_GE65_Sprsn_Flag": Indicator(
            "antipsychotic_age_65_and_older_activity", _claims_and_cost("Antpsyct_GE65"), tokens=("*",)
        ),
        "Antpsyct_GE65_Bene_Suprsn_Flag": Indicator(
            "antipsychotic_age_65_and_older_beneficiaries", ("Antpsyct_GE65_Tot_Benes",), tokens=("*",)
        ),
    },
    statuses={"*": "primary_suppressed", "#": "counter_suppressed"},
    patterns={"prescriber_npi": NPI},
    null_breaks_pattern=False,
    domains={
        "prescriber_entity_code": ("I", "O"),
        "prescriber_type_source": ("Claim-Specialty", "NPPES-Specialty", "NPPES-Taxonomy"),
    },
    cohort=("prescriber_type", "prescriber_type_source", "prescriber_country_code",
            "prescriber_state_abbreviation", "prescriber_ruca_code", "prescriber_entity_code",
            "reporting_year"),
    cohort_measure="tot_drug_cst",
    cohort_volume="tot_clms",
    private=("prescriber_last_or_organization_name", "prescriber_first_name", "prescriber_middle_initial",
             "prescriber_credentials", "prescriber_street_address_1", "prescriber_street_address_2",
             "prescriber_zip5"),
)


@dataclass(frozen=True)
class GeographicContract:
    key: tuple[str, ...] = ("year", "geography_level", "geography_id", "beneficiary_age_level")
    dimensions: tuple[str, ...] = ("YEAR", "BENE_GEO_LVL", "BENE_GEO_DESC", "BENE_GEO_CD", "BENE_AGE_LVL")
    fixed: tuple[tuple[str, str, str], ...] = (
        ("National", "National", "US"),
        ("State", "Territory", "AGG_TERRITORY"),
        ("State", "ZZ", "AGG_ZZ"),
    )
    coded: tuple[str, ...] = ("State", "County")
    integer_suffixes: tuple[str, ...] = ("_CNT",)
    suppressed: tuple[str, ...] = ("*",)
    not_applicable: tuple[str, ...] = ("NA",)
    blank: tuple[str, ...] = ("",)
    levels: tuple[str, ...] = ("National", "State", "County")
    ages: tuple[str, ...] = ("All", "<65", ">=65")
    years: tuple[int, ...] = tuple(range(2014, 2025))


GEOGRAPHIC = GeographicContract()

SOURCES = {c.name: c for c in (PHYSICIAN, PART_D, INPATIENT, OUTPATIENT, PHYSICIAN_SERVICE)}
