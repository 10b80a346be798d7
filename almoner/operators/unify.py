"""One record per organization out of many releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.functions import codes
from almoner.functions.geography import FIPS_WIDTH, fips
from almoner.operators.joins import lookup_join


def with_ein2(df: DataFrame, ein: str = "EIN") -> DataFrame:
    """Nine-digit ``EIN`` and its ``EIN-XX-XXXXXXX`` form."""
    return df.withColumns(
        {ein: codes.padded_ein(F.col(ein)), "EIN2": codes.ein2(F.col(ein))}
    )


def latest_by(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row per key in the given order.

    Filtering ``row_number`` to 1 lets Spark keep one row per key before the
    shuffle (WindowGroupLimit), so a key with very many rows costs a local sort
    in each task and never arrives whole in one place.
    """
    newest_first = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_record(
    df: DataFrame, key: str = "EIN", vintage: str = "VINTAGE", tie: str = "RECORD_ID"
) -> DataFrame:
    """Newest record per organization; within a release the highest record id wins."""
    return latest_by(df, key, F.desc_nulls_last(vintage), F.desc_nulls_last(tie))


def year_span(df: DataFrame, key: str = "EIN", year: str = "YEAR") -> DataFrame:
    """First and last year an organization appears in, and in how many."""
    return df.groupBy(key).agg(
        F.min(year).alias("ORG_YEAR_FIRST"),
        F.max(year).alias("ORG_YEAR_LAST"),
        F.count_distinct(year).cast("int").alias("ORG_YEAR_COUNT"),
    )


def activity_status(df: DataFrame, key: str = "EIN", vintage: str = "VINTAGE") -> DataFrame:
    """Active organizations are those in the newest release. One aggregate per
    organization against a scalar taken from the same aggregate; no join with the
    newest release, and no second scan."""
    last = df.groupBy(key).agg(F.max(vintage).alias("LAST_VINTAGE"))
    newest = last.agg(F.max("LAST_VINTAGE").alias("newest")).scalar()
    return last.withColumn(
        "STATUS", F.when(F.col("LAST_VINTAGE") == newest, "ACTIVE").otherwise("INACTIVE")
    )


RECENT = {
    "F990_TOTAL_REVENUE": "F990_TOTAL_REVENUE_RECENT",
    "F990_TOTAL_INCOME": "F990_TOTAL_INCOME_RECENT",
    "F990_TOTAL_ASSETS": "F990_TOTAL_ASSETS_RECENT",
}


def recent_financials(
    orgs: DataFrame, filings: DataFrame, key: str = "EIN", year: str = "TAX_YEAR", tie: str = "FILING_ID"
) -> DataFrame:
    """Totals of the newest e-filed return, falling back on what the table had."""
    newest = latest_by(
        filings.select(key, year, tie, *RECENT), key, F.desc_nulls_last(year), F.desc_nulls_last(tie)
    ).select(key, *RECENT)
    joined = orgs.join(newest, key, "left")
    updated = {
        recent: F.coalesce(total, recent) if recent in orgs.columns else F.col(total)
        for total, recent in RECENT.items()
    }
    return joined.withColumns(updated).drop(*RECENT)


def upsert(
    existing: DataFrame, update: DataFrame, key: str = "EIN", vintage: str = "VINTAGE"
) -> DataFrame:
    """Existing organizations with the values of a release laid over them, plus
    the organizations only the release has. Of two records the known values of
    the newer one win, the release's if they are of one age or no ages are
    given; a NULL does not erase a known value. One row per key on both sides."""
    names = existing.columns + [c for c in update.columns if c not in existing.columns]
    old, new = set(existing.columns), set(update.columns)
    joined = existing.alias("old").join(update.alias("new"), key, "full")
    late = F.lit(False)
    if vintage in old and vintage in new:
        late = F.coalesce(F.col(f"new.{vintage}") < F.col(f"old.{vintage}"), F.lit(False))

    def value(name: str) -> Column:
        if name == key:
            return F.col(key)
        sides = [F.col(f"{s}.{name}") for s, has in (("new", new), ("old", old)) if name in has]
        if len(sides) == 1:
            return sides[0].alias(name)
        return F.when(late, F.coalesce(*reversed(sides))).otherwise(F.coalesce(*sides)).alias(name)

    return joined.select(*[value(c) for c in names])


def append_fips(
    orgs: DataFrame, blocks: DataFrame, block: str = "CENSUS_BLOCK_FIPS", key: str = "EIN"
) -> DataFrame:
    """Geography columns of the block crosswalk for already geocoded organizations.

    The crosswalk has millions of rows, so it is joined by key; blocks that hold
    very many organizations, and organizations without a block, are spread out.
    """
    return lookup_join(orgs, blocks, [block], spread_by=key)


def with_fips_levels(df: DataFrame, block: str = "CENSUS_BLOCK_FIPS") -> DataFrame:
    """State, county, tract and block identifiers from the block identifier."""
    return df.withColumns({f"{level.upper()}_FIPS": fips(F.col(block), level) for level in FIPS_WIDTH})


def get_fips(df: DataFrame, level: str = "tract", block_fips: str = "CENSUS_BLOCK_FIPS") -> DataFrame:
    """One identifier of the given level, cut from the block identifier."""
    if level not in FIPS_WIDTH:
        raise ValueError(f"level must be one of {list(FIPS_WIDTH)}, not {level!r}")
    return df.withColumn(f"{level.upper()}_FIPS", fips(F.col(block_fips), level))
