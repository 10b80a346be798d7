"""Column lists of the unified table, before and after labelling."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: output column order ---------------------------------------

FINAL_COLUMNS = [
    "EIN", "EIN2", "ORG_NAME", "ORG_NAME_SEC", "ORG_PERS_ICO",
    "ORG_FISCAL_PERIOD", "ORG_TYPE_501C", "ORG_TYPE_PF", "ORG_CORP_FORM",
    "ORG_RULING_DATE", "ORG_RULING_YEAR", "ORG_YEAR_FIRST", "ORG_YEAR_LAST",
    "ORG_YEAR_COUNT",
    "NTEE_IRS", "NTEE_NCCS", "NTEEV2", "NCCS_LEVEL_1", "NCCS_LEVEL_2",
    "NCCS_LEVEL_3",
    "BMF_SUBSECTION_CODE", "BMF_TAX_EXEMPT_PURP", "BMF_CLASSIFICATION_CODE",
    "BMF_DEDUCTIBILITY_CODE", "BMF_FILING_REQ_CODE", "BMF_PF_FILING_REQ_CODE",
    "BMF_FOUNDATION_CODE", "BMF_STATUS_CODE", "BMF_AFFILIATION_CODE",
    "BMF_GROUP_EXEMPT_NUM", "BMF_INCOME_LEVEL", "BMF_ASSET_LEVEL",
    "F990_FORM_YEAR", "F990_TOTAL_REVENUE_RECENT", "F990_TOTAL_INCOME_RECENT",
    "F990_TOTAL_ASSETS_RECENT", "F990_ORG_ADDR_STREET", "F990_ORG_ADDR_CITY",
    "F990_ORG_ADDR_STATE", "F990_ORG_ADDR_ZIP",
    "CENSUS_URBAN_AREA", "CENSUS_STATE_ABBR", "CENSUS_COUNTY_NAME",
    "CENSUS_CBSA_NAME", "CENSUS_CBSA_FIPS", "CENSUS_BLOCK_FIPS",
    "ORG_ADDR_FULL", "ORG_ADDR_MATCH", "LATITUDE", "LONGITUDE",
    "GEOCODER_SCORE", "GEOCODER_MATCH",
]

# unified-table name -> name used from labelling onwards
FINAL_NAMES = {
    "ORG_NAME_CURRENT": "ORG_NAME",
    "BMF_ORGANIZATION_CODE": "ORG_CORP_FORM",
    "BMF_ASSET_CODE": "BMF_ASSET_LEVEL",
    "BMF_INCOME_CODE": "BMF_INCOME_LEVEL",
    "ORG_FISCAL_YEAR": "F990_FORM_YEAR",
}

# what labelling needs on entry, in its order
LABELLING_COLUMNS = [
    "EIN", "EIN2", "ORG_NAME", "ORG_NAME_SEC", "ORG_PERS_ICO", "ORG_FISCAL_PERIOD",
    "ORG_TYPE_501C", "ORG_TYPE_PF", "ORG_CORP_FORM", "ORG_RULING_DATE",
    "ORG_RULING_YEAR", "ORG_YEAR_FIRST", "ORG_YEAR_LAST", "ORG_YEAR_COUNT",
    "NTEE_IRS", "NTEE_NCCS", "NTEEV2", "NCCS_LEVEL_1", "NCCS_LEVEL_2",
    "NCCS_LEVEL_3", "BMF_SUBSECTION_CODE", "BMF_DEDUCTIBILITY_CODE",
    "BMF_FILING_REQ_CODE", "BMF_PF_FILING_REQ_CODE", "BMF_FOUNDATION_CODE",
    "BMF_STATUS_CODE", "BMF_CLASSIFICATION_CODE", "BMF_AFFILIATION_CODE",
    "BMF_GROUP_EXEMPT_NUM", "BMF_INCOME_LEVEL", "BMF_ASSET_LEVEL", "F990_FORM_YEAR",
    "F990_TOTAL_REVENUE_RECENT", "F990_TOTAL_INCOME_RECENT",
    "F990_TOTAL_ASSETS_RECENT", "F990_ORG_ADDR_STREET", "F990_ORG_ADDR_CITY",
    "F990_ORG_ADDR_STATE", "F990_ORG_ADDR_ZIP", "CENSUS_URBAN_AREA",
    "CENSUS_STATE_ABBR", "CENSUS_COUNTY_NAME", "CENSUS_CBSA_NAME",
    "CENSUS_CBSA_FIPS", "CENSUS_BLOCK_FIPS", "ORG_ADDR_FULL", "ORG_ADDR_MATCH",
    "LATITUDE", "LONGITUDE", "GEOCODER_SCORE", "GEOCODER_MATCH",
]

# --- end of fixed values ------------------------------------------------------

# derived on the way from the unified table to the labelling input
_DERIVED = {"ORG_TYPE_501C", "ORG_TYPE_PF", "BMF_TAX_EXEMPT_PURP"}

_INT_COLUMNS = {
    "ORG_FISCAL_PERIOD", "ORG_CORP_FORM", "ORG_RULING_YEAR", "ORG_YEAR_FIRST",
    "ORG_YEAR_LAST", "ORG_YEAR_COUNT", "BMF_SUBSECTION_CODE",
    "BMF_CLASSIFICATION_CODE", "BMF_DEDUCTIBILITY_CODE", "BMF_FILING_REQ_CODE",
    "BMF_PF_FILING_REQ_CODE", "BMF_FOUNDATION_CODE", "BMF_STATUS_CODE",
    "BMF_AFFILIATION_CODE", "BMF_GROUP_EXEMPT_NUM", "BMF_INCOME_LEVEL",
    "BMF_ASSET_LEVEL", "F990_FORM_YEAR",
}
_LONG_COLUMNS = {
    "F990_TOTAL_REVENUE_RECENT", "F990_TOTAL_INCOME_RECENT",
    "F990_TOTAL_ASSETS_RECENT",
}
_DOUBLE_COLUMNS = {"LATITUDE", "LONGITUDE", "GEOCODER_SCORE"}


def _column_type(final_name: str) -> T.DataType:
    if final_name in _INT_COLUMNS:
        return T.IntegerType()
    if final_name in _LONG_COLUMNS:
        return T.LongType()
    if final_name in _DOUBLE_COLUMNS:
        return T.DoubleType()
    return T.StringType()


_UNIFIED_NAMES = {final: unified for unified, final in FINAL_NAMES.items()}

# identifiers, FIPS and ZIP codes are strings: a number would lose leading zeros
UNIFIED_SCHEMA = T.StructType(
    [
        T.StructField(_UNIFIED_NAMES.get(c, c), _column_type(c))
        for c in FINAL_COLUMNS
        if c not in _DERIVED
    ]
)
