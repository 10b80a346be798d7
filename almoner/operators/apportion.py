"""Weights that carry counts from one census's areas to another's.

A table of weights is a sparse matrix: ``geoid``, ``new_geoid``, ``weight``, where the
weights of an old area add up to 1. Several redrawings in a row are the product of their
matrices: a join on the areas between and a sum. What an area loses to no known area
stays in the table under a NULL new area, so totals are kept throughout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How far the weights of an area may be from 1 in all, for rounding.
TOLERANCE = 1e-9


def weights_of_blocks(blocks: DataFrame, old: str, new: str, population: str) -> DataFrame:
    """Weights by what lives in the blocks two areas share.

    An old area nobody lives in is divided by numbers of blocks. Blocks without a new
    area go to the NULL one; blocks without an old area have nothing to pass on. A
    missing or negative population counts as 0.
    """
    people = F.greatest(F.coalesce(F.col(population), F.lit(0)), F.lit(0))
    shared = (
        blocks.where(F.col(old).isNotNull())
        .groupBy(F.col(old).alias("geoid"), F.col(new).alias("new_geoid"))
        .agg(F.sum(people).alias("people"), F.count(F.lit(1)).alias("n_blocks"))
    )
    # a row per pair of areas, so whole areas are added up from few rows
    whole = shared.groupBy("geoid").agg(F.sum("people").alias("all_people"), F.sum("n_blocks").alias("all_blocks"))
    weight = F.when(F.col("all_people") > 0, F.col("people") / F.col("all_people")).otherwise(F.col("n_blocks") / F.col("all_blocks"))
    return shared.join(whole, "geoid").select("geoid", "new_geoid", weight.alias("weight")).where("weight > 0")


def composed(first: DataFrame, second: DataFrame) -> DataFrame:
    """Weights of ``first`` and then ``second``. An area between that ``second`` lacks is
    lost there: its share goes to the NULL area."""
    between = F.col("between")
    step = first.select("geoid", F.col("new_geoid").alias("between"), F.col("weight").alias("w1"))
    onward = second.select(F.col("geoid").alias("between"), "new_geoid", F.col("weight").alias("w2"))
    known = step.where(between.isNotNull()).join(onward, "between", "left")
    lost = step.where(between.isNull()).select("geoid", F.lit(None).cast(second.schema["new_geoid"].dataType).alias("new_geoid"), F.col("w1").alias("weight"))
    return (
        known.select("geoid", "new_geoid", (F.col("w1") * F.coalesce("w2", F.lit(1.0))).alias("weight"))
        .unionByName(lost)
        .groupBy("geoid", "new_geoid")
        .agg(F.sum("weight").alias("weight"))
    )


def chain(steps: list[DataFrame]) -> DataFrame:
    """The product of redrawings, oldest first. Neighbours are multiplied pairwise, so
    the plan is as deep as the logarithm of their number."""
    if not steps:
        raise ValueError("no weights to compose")
    while len(steps) > 1:
        steps = [composed(*steps[i : i + 2]) if i + 1 < len(steps) else steps[i] for i in range(0, len(steps), 2)]
    return steps[0]


def problems(weights: DataFrame, areas: DataFrame | None = None) -> DataFrame:
    """What is wrong with a table of weights: one row per finding, none if it is sound.

    ``sum``: weights of an area that don't add up to 1; ``negative``: one below 0;
    ``lost``: a share that goes to no area; ``unknown``: an area of ``areas`` without
    weights.
    """
    sums = weights.groupBy("geoid").agg(
        F.sum("weight").alias("total"),
        F.min("weight").alias("least"),
        F.sum(F.when(F.col("new_geoid").isNull(), F.col("weight"))).alias("lost"),
    )
    found = sums.select(
        "geoid",
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.lit("sum").alias("problem"), F.when(F.abs(F.col("total") - 1) > TOLERANCE, F.col("total")).alias("value")),
                    F.struct(F.lit("negative").alias("problem"), F.when(F.col("least") < 0, F.col("least")).alias("value")),
                    F.struct(F.lit("lost").alias("problem"), F.when(F.col("lost") > 0, F.col("lost")).alias("value")),
                ),
                lambda p: p["value"].isNotNull(),
            )
        ).alias("p"),
    ).select("geoid", "p.problem", "p.value")
    if areas is None:
        return found
    missing = areas.select("geoid").distinct().join(sums, "geoid", "left_anti")
    return found.unionByName(missing.select("geoid", F.lit("unknown").alias("problem"), F.lit(1.0).alias("value")))


def carried(panel: DataFrame, steps: dict[int, DataFrame], columns: list[str]) -> DataFrame:
    """A panel on the areas of the last redrawing.

    ``steps`` names the first year of each new set of areas; a row goes through those
    that came after its year. All rows go at once: weights are tagged with the first
    year they are for, so a row is joined and not scanned once per set.
    """
    starts = sorted(steps)
    counts = panel.groupBy("geoid", "year").agg(*[F.sum(c).alias(c) for c in columns])
    passed = reduce(lambda n, year: n + (F.col("year") >= year).cast("int"), starts, F.lit(0))
    tables = [chain([steps[y] for y in starts[k:]]).select("geoid", "new_geoid", "weight", F.lit(k).alias("set")) for k in range(len(starts))]
    weights = reduce(DataFrame.unionByName, tables)
    tagged = counts.withColumn("set", passed)
    # areas of the last set stay where they are, those without weights go to the NULL area
    last = F.col("set") == len(starts)
    target = F.when(last, F.col("geoid")).otherwise(F.col("new_geoid"))
    return (
        tagged.join(weights, ["geoid", "set"], "left")
        .groupBy(target.alias("geoid"), "year")
        .agg(*[F.sum(F.col(c) * F.coalesce("weight", F.lit(1.0))).alias(c) for c in columns])
    )
