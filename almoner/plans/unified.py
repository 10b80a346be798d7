"""The unified table: built from releases, updated with a new one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.fixed.columns import UNIFIED_SCHEMA
from almoner.operators import derive, harmonize, unify
from almoner.session import written


def named_release(raw: DataFrame) -> DataFrame:
    """Harmonized release under unified names, with the derived identifiers.
    Records without an EIN cannot be matched and are left out."""
    named = raw.transform(harmonize.harmonize).transform(harmonize.to_unified_names)
    keyed = unify.with_ein2(named).where(F.col("EIN").isNotNull())
    return derive.with_nteev2(keyed) if "NTEE_IRS" in keyed.columns else keyed


def newest_record(df: DataFrame) -> DataFrame:
    """One row per organization: the newest release, then the latest tax period;
    a hash of the whole record settles what is left, so that a retry keeps the
    same one."""
    order = [F.desc_nulls_last(c) for c in ("VINTAGE", "F990_TAX_PERIOD_END_DATE") if c in df.columns]
    return unify.latest_by(df, "EIN", *order, F.xxhash64(*df.columns))


def prepare_release(raw: DataFrame) -> DataFrame:
    """A release ready to be laid over the unified table."""
    return newest_record(named_release(raw))


YEARS = "ORG_YEARS"


def record_state(named: DataFrame, tie: str | None = None) -> DataFrame:
    """Per organization, for every column its newest known value with its age, and
    the releases it appears in.

    Ages are release, tax period and a tie-break (a hash of the record by
    default), so states can be merged in any order and any number of times.
    """
    period = [c for c in ("F990_TAX_PERIOD_END_DATE",) if c in named.columns]
    last = F.expr(tie) if tie else F.xxhash64(*named.columns)
    age = [F.col("VINTAGE").alias("vintage"), (F.col(period[0]) if period else F.lit(None)).cast("string").alias("period"), last.alias("tie")]
    values = [c for c in named.columns if c not in ("EIN", "VINTAGE")]
    newest = [F.max(F.when(F.col(c).isNotNull(), F.struct(*age, F.col(c).alias("value")))).alias(c) for c in values]
    return named.groupBy("EIN").agg(*newest, F.array_sort(F.collect_set("VINTAGE")).alias(YEARS))


def merged_states(*states: DataFrame) -> DataFrame:
    """One state out of several."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), states)
    values = [c for c in stacked.columns if c not in ("EIN", YEARS)]
    years = F.array_sort(F.array_distinct(F.flatten(F.collect_list(YEARS))))
    return stacked.groupBy("EIN").agg(*[F.max(c).alias(c) for c in values], years.alias(YEARS))


def current(state: DataFrame) -> DataFrame:
    """The unified table a stored state stands for."""
    values = [c for c in state.columns if c not in ("EIN", YEARS)]
    newest = state.agg(F.max(F.array_max(YEARS)).alias("newest")).scalar()
    last = F.array_max(YEARS)
    return state.select(
        "EIN",
        last.alias("VINTAGE"),
        *[F.col(f"{c}.value").alias(c) for c in values],
        F.array_min(YEARS).alias("ORG_YEAR_FIRST"),
        last.alias("ORG_YEAR_LAST"),
        F.size(YEARS).alias("ORG_YEAR_COUNT"),
        (last == newest).alias("ACTIVE"),
    )


def build_unified(releases: dict[int, DataFrame], tie: str | None = None) -> DataFrame:
    """Every organization any release has: the newest known value of each column,
    the span of its appearances and whether it is in the newest release. Releases
    are read once, for the state, which is stored."""
    stacked = harmonize.union_vintages(
        {year: named_release(harmonize.with_vintage(raw, year)) for year, raw in releases.items()}
    )
    return current(written(record_state(stacked, tie), "state"))


def complete(unified: DataFrame) -> DataFrame:
    """Columns labelling expects but the releases did not bring, as typed NULLs."""
    absent = {
        f.name: F.lit(None).cast(f.dataType) for f in UNIFIED_SCHEMA if f.name not in unified.columns
    }
    return unified.withColumns(absent)


def update_unified(
    existing: DataFrame,
    release: DataFrame,
    filings: DataFrame | None = None,
    blocks: DataFrame | None = None,
) -> DataFrame:
    """Lay a prepared release over the unified table, then refresh financials
    from e-filed returns and geography from the block crosswalk if given.

    The block lookup looks at its input twice, so the joined table is written
    first rather than joined twice.
    """
    out = unify.upsert(existing, release)
    if filings is not None:
        out = unify.recent_financials(out, filings)
    if blocks is not None:
        out = unify.append_fips(written(out, "update"), blocks)
    return out
