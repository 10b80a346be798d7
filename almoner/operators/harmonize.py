"""From the columns of one release to harmonized names and types."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.fixed.columns import UNIFIED_SCHEMA
from almoner.fixed.crosswalk import SQL_TYPES, COLUMN_NAMES, legacy_names
from almoner.functions.codes import pad_code, padded_ein

# harmonized name -> name in the unified table, where the two differ
UNIFIED_NAMES = {
    "F990_ORG_EIN": "EIN",
    "BMF_ORG_NAME": "ORG_NAME_CURRENT",
    "BMF_ORG_NAME_SEC": "ORG_NAME_SEC",
    "BMF_PERS_NAME_ICO": "ORG_PERS_ICO",
    "BMF_ACCT_PD_CODE": "ORG_FISCAL_PERIOD",
    "BMF_RULING_DATE": "ORG_RULING_DATE",
    "BMF_NTEE": "NTEE_IRS",
    "NCCS_NTEE": "NTEE_NCCS",
    "BMF_ADDR_STREET": "F990_ORG_ADDR_STREET",
    "BMF_ADDR_CITY": "F990_ORG_ADDR_CITY",
    "BMF_ADDR_STATE": "F990_ORG_ADDR_STATE",
    "BMF_ADDR_ZIP": "F990_ORG_ADDR_ZIP",
}

# codes that aren't numbers: activity codes begin with zeros that count, and one
# subsection is the text CO
TEXT_CODES = ("BMF_ACTIVITY_CODE", "BMF_SUBSECTION_CODE")

_HARMONIZED = list(legacy_names())
_DECLARED = {new: SQL_TYPES[old] for old, new in COLUMN_NAMES if old in SQL_TYPES}


def _not_blank(name: str) -> Column:
    return F.when(F.trim(F.col(name)) != "", F.col(name))


def rename_columns(df: DataFrame) -> DataFrame:
    """Harmonized names for the legacy columns a release happens to have.

    Several legacy columns can stand for one harmonized column; the first one
    in crosswalk order that is not blank wins. Unknown columns are kept.
    """
    present = set(df.columns)
    columns, used = [], set()
    for new, olds in legacy_names().items():
        sources = [c for c in [new, *olds] if c in present]
        if sources:
            value = F.col(sources[0]) if len(sources) == 1 else F.coalesce(*map(_not_blank, sources))
            columns.append(value.alias(new))
            used.update(sources)
    return df.select(*columns, *[c for c in df.columns if c not in used])


def drop_unknown(df: DataFrame, keep: tuple[str, ...] = ("VINTAGE",)) -> DataFrame:
    """Drop columns that are not in the crosswalk and cannot be rebuilt later."""
    known = set(_HARMONIZED)
    return df.select(*[c for c in df.columns if c in known or c in keep])


def _typed(name: str) -> Column:
    text = F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))
    declared = _DECLARED.get(name, "")
    width = re.fullmatch(r"CHAR\((\d+)\)", declared)
    if width:
        # all-digit codes get the zeros a number lost; longer codes stay whole
        padded = pad_code(text, int(width.group(1)))
        return F.when(text.rlike("^[0-9]+$"), padded).otherwise(text)
    if declared == "VARCHAR":
        return text
    if name == "F990_ORG_EIN":
        return padded_ein(text)
    if "_TOTAL_" in name:
        return text.try_cast("double")
    if name in TEXT_CODES:
        return text
    if name.startswith("BMF_") and name.endswith("_CODE"):
        return text.try_cast("int")
    return text


def cast_columns(df: DataFrame) -> DataFrame:
    """One type per harmonized column; values that do not fit become NULL.

    Declared ``CHAR(n)`` columns are codes padded to ``n`` digits, other
    ``BMF_..._CODE`` columns are integers unless listed as text, totals are
    doubles, the rest is text. ``lost_values`` counts what did not fit.
    """
    known = set(_HARMONIZED)
    return df.select(
        *[(_typed(c).alias(c) if c in known else F.col(c)) for c in df.columns]
    )


def lost_values(df: DataFrame) -> DataFrame:
    """Per renamed column the values ``cast_columns`` turns into NULL: rows
    ``(column, n)``, columns without loss left out."""
    known = set(_HARMONIZED)
    names = [c for c in df.columns if c in known]
    lost = [F.count_if((F.trim(F.col(c).cast("string")) != "") & _typed(c).isNull()).alias(c) for c in names]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, n long")
    wide = df.agg(*lost)
    return wide.unpivot([], names, "column", "n").where("n > 0")


def harmonize(df: DataFrame) -> DataFrame:
    """Rename, drop what is unknown, cast."""
    return cast_columns(drop_unknown(rename_columns(df)))


def with_vintage(df: DataFrame, year: int) -> DataFrame:
    return df if "VINTAGE" in df.columns else df.withColumn("VINTAGE", F.lit(year))


def union_vintages(vintages: dict[int, DataFrame]) -> DataFrame:
    """Stack releases, filling columns a release lacks with NULL.

    A release that already carries ``VINTAGE`` keeps it, so one frame may hold
    several releases that share a layout.
    """
    frames = [with_vintage(df, year) for year, df in vintages.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def to_unified_names(df: DataFrame) -> DataFrame:
    """Names and types of the unified table for the harmonized columns present."""
    df = df.withColumnsRenamed(UNIFIED_NAMES)
    types = {f.name: f.dataType for f in UNIFIED_SCHEMA}
    return df.select(
        *[(F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)) for c in df.columns]
    )


def json_dictionary(df: DataFrame, key: str, text: str) -> DataFrame:
    """Code lists embedded as a JSON object anywhere in a text column, as rows
    ``(key, code, label)``. Text without an object gives no rows."""
    found = F.from_json(F.regexp_extract(F.col(text), r"(?s)(\{.*\})", 1), "map<string,string>")
    return df.select(F.col(key), F.explode(found).alias("code", "label"))


def unpadded_key(code: Column) -> Column:
    """``03-1`` -> ``3-1``."""
    return F.regexp_replace(code, "^0+", "")


def comparable_label(label: Column) -> Column:
    """Label without the ``(501C..)`` suffix, dates in brackets and punctuation,
    so that two spellings of one label compare equal."""
    text = F.regexp_replace(label, r" \(501C[0-9]+-[0-9]\)$", "")
    text = F.regexp_replace(text, r" \(Created Before [0-9/]+\)", "")
    return F.regexp_replace(text, "[.',]", "")


def compare_dictionaries(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer comparison of two ``(code, label)`` dictionaries on the
    unpadded code: which side has a code, and whether the labels agree."""
    a = left.select(unpadded_key(F.col("code")).alias("code"), F.col("label").alias("left_label"))
    b = right.select(unpadded_key(F.col("code")).alias("code"), F.col("label").alias("right_label"))
    same = F.col("left_label") == F.col("right_label")
    alike = comparable_label(F.col("left_label")) == comparable_label(F.col("right_label"))
    return a.join(b, "code", "full").withColumn(
        "status",
        F.when(F.col("left_label").isNull(), "right only")
        .when(F.col("right_label").isNull(), "left only")
        .when(same, "same")
        .when(alike, "same up to suffix")
        .otherwise("different"),
    )
