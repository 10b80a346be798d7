"""Census panel, roll-ups through geographic crosswalks, statistical areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions.codes import literal_map
from almoner.functions.geography import cbsa_class
from almoner.operators import quantiles
from almoner.operators.joins import lookup_join

# --- fixed values -------------------------------------------------------------
GEOGRAPHIES = ("msa", "county", "tract")
TOTALS = ["total_population", "housing_units", "occupied", "vacant", "renter_occ"]
PERCENTAGES = [
    "white_perc", "black_perc", "asian_perc", "hawaiian_perc",
    "american_alaskan_perc", "two_or_more_perc", "other_perc", "rural_perc",
    "bachelors_perc", "hispanic_perc", "poverty_perc", "unemployment",
    "turnover_perc",
]
MEDIANS = [
    "med_family_income_adj", "med_gross_rent_adj", "med_household_income_adj",
    "median_value_adj",
]
# --- end of fixed values --------------------------------------------------------


def census_data(
    panels: dict[str, DataFrame],
    geo: str,
    years: list[int] | None = None,
    format: str = "long",
) -> DataFrame:
    """The panel of one geography, all years or the ones asked for, stacked
    (``long``) or with one row per area (``wide``)."""
    if geo not in GEOGRAPHIES:
        raise ValueError(f"geo must be one of {GEOGRAPHIES}, not {geo!r}")
    if format not in ("long", "wide"):
        raise ValueError(f"format must be long or wide, not {format!r}")
    panel = panels[geo]
    if years is not None:
        panel = panel.where(F.col("year").isin(*years))
    return panel if format == "long" else widen(panel, years)


def widen(panel: DataFrame, years: list[int] | None = None) -> DataFrame:
    """One row per ``geoid``, one column per variable and year: the years given,
    or else every year the panel has."""
    if years is None:
        years = sorted(r[0] for r in panel.select("year").dropna().distinct().collect())
    if not years:
        return panel.select("geoid").distinct()
    variables = [c for c in panel.columns if c not in ("geoid", "year")]
    wide = panel.groupBy("geoid").pivot("year", years).agg(
        *[F.first(v, ignorenulls=True).alias(v) for v in variables]
    )
    pairs = [(y, v) for v in variables for y in years]
    single = len(variables) == 1
    return wide.select(
        "geoid",
        *[F.col(f"`{y}`" if single else f"`{y}_{v}`").alias(f"{v}_{y}") for y, v in pairs],
    )


def adjust_inflation(panel: DataFrame, factors: dict[int, float], columns: list[str]) -> DataFrame:
    """Dollar columns in the reference year's dollars. One factor per year; a
    year without a factor gives NULL rather than an unadjusted amount."""
    pairs = [(year, float(factor)) for year, factor in factors.items()]
    factor = F.try_element_at(literal_map(pairs), F.col("year"))
    return panel.withColumns({c: F.col(c) * factor for c in columns})


def apportion(panel: DataFrame, weights: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of old areas moved onto the reference areas. ``weights`` has
    ``geoid, new_geoid, weight``; the weights of one old area add up to 1. What
    lies in areas without weights is kept under a NULL area."""
    old = panel.groupBy("geoid", "year").agg(*[F.sum(c).alias(c) for c in columns])
    return (
        old.join(weights, "geoid", "left")
        .groupBy(F.col("new_geoid").alias("geoid"), "year")
        .agg(*[F.sum(F.col(c) * F.coalesce("weight", F.lit(1.0))).alias(c) for c in columns])
    )


def roll_up(
    panel: DataFrame,
    crosswalk: DataFrame,
    level: str,
    totals: list[str] | None = None,
    percentages: list[str] | None = None,
    medians: list[str] | None = None,
    weight: str = "total_population",
    summaries: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Aggregate the panel up to a larger geography; by default every variable
    the panel has, each by its own rule.

    Totals are added. Percentages are means weighted by population over the areas
    where they are known. A median can't be had from the medians of parts: it comes
    from the ``summaries`` of its values (``quantiles.summarized`` by ``geoid`` and
    ``year``) if they are given, and is NULL if not. Areas the crosswalk lacks are kept
    under a NULL area.
    """
    present = set(panel.columns)
    totals = [c for c in TOTALS if c in present] if totals is None else totals
    percentages = [c for c in PERCENTAGES if c in present] if percentages is None else percentages
    medians = [c for c in MEDIANS if c in present] if medians is None else medians

    def mean(c: str) -> Column:
        known = F.when(F.col(c).isNotNull(), F.col(weight))
        return F.try_divide(F.sum(F.col(c) * known), F.sum(known))

    rolled = (
        panel.join(crosswalk.select("geoid", level), "geoid", "left")
        .groupBy(level, "year")
        .agg(
            *[F.sum(c).alias(c) for c in totals],
            *[mean(c).alias(c) for c in percentages],
            *[F.lit(None).cast("double").alias(c) for c in medians],
        )
    )
    names = rolled.columns
    for c, summary in (summaries or {}).items():
        merged = quantiles.rolled_up(summary, crosswalk, ["geoid", "year"], level)
        value = quantiles.quantile(merged, [level, "year"]).select(F.col(level).alias("_area"), F.col("year").alias("_year"), F.col("value").alias(c))
        rolled = rolled.drop(c).join(value, F.col(level).eqNullSafe(F.col("_area")) & (F.col("year") == F.col("_year")), "left").drop("_area", "_year")
    return rolled.select(*names, *[c for c in summaries or {} if c not in names])


def hierarchy_totals(df: DataFrame, levels: list[str], totals: list[str]) -> DataFrame:
    """Totals at every level of a nested hierarchy, largest area first in
    ``levels``. Rows are added up at the finest level before they are repeated
    for the coarser ones."""
    finest = df.groupBy(*levels).agg(*[F.sum(c).alias(c) for c in totals])
    return finest.rollup(*levels).agg(
        *[F.sum(c).alias(c) for c in totals], F.grouping_id().cast("long").alias("level")
    )


def classify_areas(areas: DataFrame, population: str = "population") -> DataFrame:
    return areas.withColumn("cbsa_class", cbsa_class(F.col(population)))


def core_based_areas(metro: DataFrame, micro: DataFrame, key: str = "geoid") -> DataFrame:
    """Metropolitan and micropolitan areas in one list; ``in_both`` is false for
    every area as long as the two lists exclude each other."""
    both = metro.select(key).join(micro.select(key), key, "left_semi").distinct()
    return (
        metro.unionByName(micro)
        .join(both.withColumn("in_both", F.lit(True)), key, "left")
        .na.fill(False, ["in_both"])
    )


def combined_areas(areas: DataFrame) -> DataFrame:
    """Number of areas and population per combined area."""
    return (
        areas.where(F.col("csa").isNotNull())
        .groupBy("csa")
        .agg(F.count(F.lit(1)).alias("n_areas"), F.sum("population").alias("population"))
    )


def unattached_areas(areas: DataFrame) -> DataFrame:
    """Areas that belong to no combined area."""
    return areas.where(F.col("csa").isNull())


def area_summary(areas: DataFrame) -> DataFrame:
    """Combined areas and the areas that belong to none, told apart by ``kind``,
    in one pass."""
    loose = F.col("csa").isNull()
    return (
        areas.groupBy(
            F.when(loose, "unattached").otherwise("combined").alias("kind"),
            F.when(loose, F.col("geoid")).otherwise(F.col("csa")).alias("id"),
        )
        .agg(F.count(F.lit(1)).alias("n_areas"), F.sum("population").alias("population"))
    )


def append_census(
    orgs: DataFrame, panel: DataFrame, on: list[str], key: str = "EIN"
) -> DataFrame:
    """Census variables of an organization's area and year. Areas differ widely
    in how many organizations they hold, hence the spread join."""
    return lookup_join(orgs, panel, on, spread_by=key)
