"""The labelling job: unified table in, 52 labelled columns out.

One narrow plan: scan, one projection, write. Nothing is shuffled, because every
dictionary is a constant and the purpose is computed in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.fixed.columns import FINAL_COLUMNS, FINAL_NAMES, LABELLING_COLUMNS
from almoner.functions import codes
from almoner.operators import derive

LABELLED = [
    "ORG_FISCAL_PERIOD",
    "BMF_STATUS_CODE",
    "BMF_AFFILIATION_CODE",
    "BMF_DEDUCTIBILITY_CODE",
    "BMF_ASSET_LEVEL",
    "BMF_INCOME_LEVEL",
    "ORG_CORP_FORM",
    "BMF_FOUNDATION_CODE",
    "NCCS_LEVEL_1",
    "NCCS_LEVEL_2",
    "NCCS_LEVEL_3",
    "BMF_FILING_REQ_CODE",
    "BMF_PF_FILING_REQ_CODE",
]


def labelling_input(unified: DataFrame) -> DataFrame:
    """Derived types, final names, the 51 columns labelling works on."""
    return (
        unified.transform(derive.with_org_types)
        .transform(derive.rename_final)
        .transform(derive.select_strict, LABELLING_COLUMNS)
    )


def label_in_steps(unified: DataFrame) -> DataFrame:
    """Labelling one operator at a time, to look at what lies between. The order
    matters in two places: affiliation is imputed before it is labelled, and the
    filing requirement reads the imputed PF code before that becomes a label."""
    return (
        labelling_input(unified)
        .transform(derive.impute_non_pf)
        .transform(derive.impute_affiliation)
        .transform(derive.clean_sentinels)
        .transform(derive.with_purpose)
        .transform(derive.recode_filing_requirement)
        .transform(derive.label_columns, *LABELLED)
        .transform(derive.select_strict, FINAL_COLUMNS)
    )


def _computed() -> dict[str, Column]:
    """Every column labelling computes, as an expression on the unified table."""
    subsection, classification = F.col("BMF_SUBSECTION_CODE"), F.col("BMF_CLASSIFICATION_CODE")
    raw_pf = F.col("BMF_PF_FILING_REQ_CODE")
    org_type = codes.org_type_501c(subsection)
    never = codes.never_pf(org_type)
    pf = F.when(never, F.lit(0)).otherwise(raw_pf)
    cleaned = {
        "BMF_AFFILIATION_CODE": codes.independent_affiliation(
            F.col("BMF_GROUP_EXEMPT_NUM"), F.col("BMF_AFFILIATION_CODE")
        ),
        "NCCS_LEVEL_3": codes.sentinel_to_null(F.col("NCCS_LEVEL_3"), "-", ""),
        "BMF_FILING_REQ_CODE": codes.filing_code(F.col("BMF_FILING_REQ_CODE"), pf),
        "BMF_PF_FILING_REQ_CODE": pf,
    }
    renamed = {new: F.col(old) for old, new in FINAL_NAMES.items()}
    return {
        **renamed,
        "ORG_TYPE_501C": org_type,
        "ORG_TYPE_PF": F.when(never, F.lit(0)).otherwise(codes.org_type_pf(raw_pf)),
        "BMF_TAX_EXEMPT_PURP": codes.tax_exempt_purpose(subsection, classification),
        **{v: codes.label_of(v, cleaned.get(v, renamed.get(v, F.col(v)))) for v in LABELLED},
    }


def label_registry(unified: DataFrame) -> DataFrame:
    """Labelling in a single projection: same result as the steps, but each wide
    row is written once instead of once per step that uses another's output."""
    computed = _computed()
    return unified.select(*[computed.get(c, F.col(c)).alias(c) for c in FINAL_COLUMNS])
