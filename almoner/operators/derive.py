"""Derivation, imputation and labelling of the unified table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.fixed import dictionaries
from almoner.fixed.columns import FINAL_NAMES
from almoner.functions import codes, taxonomy


def with_org_types(df: DataFrame) -> DataFrame:
    """``ORG_TYPE_501C`` from the subsection, ``ORG_TYPE_PF`` from the PF code."""
    return df.withColumns(
        {
            "ORG_TYPE_501C": codes.org_type_501c(F.col("BMF_SUBSECTION_CODE")),
            "ORG_TYPE_PF": codes.org_type_pf(F.col("BMF_PF_FILING_REQ_CODE")),
        }
    )


def rename_final(df: DataFrame) -> DataFrame:
    """Names used from labelling onwards."""
    return df.withColumnsRenamed(FINAL_NAMES)


def select_strict(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered projection; an absent column fails when the plan is analysed."""
    return df.select(*columns)


def column_coverage(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required or present column: is it kept, missing, or dropped,
    and how many values are not NULL. One pass over the data, one output row
    per column."""
    kinds = {c: "kept" if c in required else "dropped" for c in df.columns}
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    present = counts.unpivot([], df.columns, "column_name", "n_not_null").select(
        "column_name", codes.lookup_text(kinds, F.col("column_name")).alias("kind"), "n_not_null"
    )
    missing = [c for c in required if c not in df.columns]
    if not missing:
        return present
    absent = counts.select(
        F.explode(F.array(*map(F.lit, missing))).alias("column_name"),
        F.lit("missing").alias("kind"),
        F.lit(0).cast("long").alias("n_not_null"),
    )
    return present.unionByName(absent)


def impute_non_pf(df: DataFrame) -> DataFrame:
    """Organizations of a type that cannot be a private foundation get 0 in both
    PF columns, over whatever was there; an unknown type changes nothing."""
    never = codes.never_pf(F.col("ORG_TYPE_501C"))
    return df.withColumns(
        {
            c: F.when(never, F.lit(0)).otherwise(F.col(c))
            for c in ("ORG_TYPE_PF", "BMF_PF_FILING_REQ_CODE")
        }
    )


def impute_affiliation(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "BMF_AFFILIATION_CODE",
        codes.independent_affiliation(
            F.col("BMF_GROUP_EXEMPT_NUM"), F.col("BMF_AFFILIATION_CODE")
        ),
    )


def clean_sentinels(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "NCCS_LEVEL_3", codes.sentinel_to_null(F.col("NCCS_LEVEL_3"), "-", "")
    )


def label_columns(df: DataFrame, *variables: str) -> DataFrame:
    """Replace codes by labels; a code outside its dictionary becomes NULL."""
    return df.withColumns({v: codes.label_of(v, F.col(v)) for v in variables})


def with_purpose(df: DataFrame) -> DataFrame:
    """``BMF_TAX_EXEMPT_PURP`` computed in place, for every organization."""
    return df.withColumn(
        "BMF_TAX_EXEMPT_PURP",
        codes.tax_exempt_purpose(
            F.col("BMF_SUBSECTION_CODE"), F.col("BMF_CLASSIFICATION_CODE")
        ),
    )


def purpose_table(df: DataFrame) -> DataFrame:
    """Side table of organizations with a known purpose."""
    return with_purpose(df).select("EIN2", "BMF_TAX_EXEMPT_PURP").dropna()


def merge_purpose(df: DataFrame, purposes: DataFrame, how: str = "left") -> DataFrame:
    """Attach the side table. ``inner`` drops organizations without a purpose,
    ``left`` keeps them with NULL."""
    return df.join(purposes, "EIN2", how)


def recode_filing_requirement(df: DataFrame) -> DataFrame:
    """Two-character filing codes; reads the imputed, still unlabelled PF code."""
    return df.withColumn(
        "BMF_FILING_REQ_CODE",
        codes.filing_code(F.col("BMF_FILING_REQ_CODE"), F.col("BMF_PF_FILING_REQ_CODE")),
    )


def with_nteev2(df: DataFrame, code: str = "NTEE_IRS") -> DataFrame:
    return df.withColumn("NTEEV2", taxonomy.nteev2(F.col(code)))


def with_ntee_levels(df: DataFrame, v2: str = "NTEEV2") -> DataFrame:
    return df.withColumns(
        {f"NTEE{level}": taxonomy.ntee_level(F.col(v2), level) for level in range(1, 6)}
    )


def dictionary_frame(spark: SparkSession, variables: list[str] | None = None) -> DataFrame:
    """The long dictionary table (at most a few hundred rows by construction)."""
    return literal_frame(
        spark, dictionaries.long_rows(variables), dictionaries.DICTIONARY_SCHEMA
    )


def dd(spark: SparkSession, variable: str) -> DataFrame:
    """Dictionary of one variable, in level order."""
    if variable not in dictionaries.VARIABLES:
        raise ValueError(f"no dictionary for {variable!r}")
    return dictionary_frame(spark, [variable]).orderBy("ord")


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal table as a local relation, so that Spark knows how small it is."""
    import pyarrow as pa

    fields = [f.strip().split(" ") for f in schema.split(",")]
    arrow = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    table = pa.table(
        {
            name: pa.array([row[i] for row in rows], type=arrow[kind])
            for i, (name, kind) in enumerate(fields)
        }
    )
    return spark.createDataFrame(table)
