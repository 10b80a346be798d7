"""Geographic levels that don't form one nested list.

A crosswalk has a row per block and a column per level, with the area the block lies in.
Levels are a directed graph: ``finer`` to ``coarser`` where every area of one lies in a
single area of the other. Between levels that don't nest, counts go through the blocks
two areas share, so that nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.operators.apportion import weights_of_blocks
from almoner.session import written

#: Rows of blocks and levels that one task sorts before they are summarized.
TASK_ROWS = 200_000


def _areas(crosswalk: DataFrame, levels: list[str]) -> DataFrame:
    """A row per block and level it has an area of, beside all its areas as ``in_<level>``."""
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).cast("string").alias("area")) for c in levels]))
    return crosswalk.select(entry.alias("own"), *[F.col(c).cast("string").alias(f"in_{c}") for c in levels]).where("own.area IS NOT NULL")


def nesting(crosswalk: DataFrame, levels: list[str]) -> DataFrame:
    """For every ordered pair of levels: how many areas the first has, how many of them
    lie in several areas of the second or partly in none (``n_split``), how many in
    none at all (``n_outside``), and whether it nests: none of the former, and not all
    of the latter.

    Areas are summarized before the shuffle by the least and the greatest area of every
    other level that their blocks lie in. Blocks are counted and dealt out first: a
    few small files become a row per block and level, which is much to sort in one task.
    """
    blocks = written(crosswalk.select(*[F.col(c).cast("string").alias(c) for c in levels]), "crosswalk")
    tasks = max(1, -(-blocks.count() * len(levels) // TASK_ROWS))
    place = "_" + "_".join(levels)
    blocks = blocks.withColumn(place, F.monotonically_increasing_id()).repartition(tasks, place)
    per_area = _areas(blocks, levels).groupBy("own.level", "own.area").agg(
        *[F.min(f"in_{c}").alias(f"least_{c}") for c in levels],
        *[F.max(f"in_{c}").alias(f"most_{c}") for c in levels],
        *[F.count_if(F.col(f"in_{c}").isNull()).alias(f"without_{c}") for c in levels],
    )

    def split(c: str):
        known = F.col(f"least_{c}").isNotNull()
        return known & ((F.col(f"least_{c}") != F.col(f"most_{c}")) | (F.col(f"without_{c}") > 0))

    per_level = per_area.groupBy("level").agg(
        F.count(F.lit(1)).alias("n_areas"),
        *[F.count_if(split(c)).alias(f"split_{c}") for c in levels],
        *[F.count_if(F.col(f"least_{c}").isNull()).alias(f"outside_{c}") for c in levels],
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("coarser"), F.col(f"split_{c}").alias("n_split"), F.col(f"outside_{c}").alias("n_outside")) for c in levels])
    return (
        per_level.select(F.col("level").alias("finer"), "n_areas", F.explode(pairs).alias("p"))
        .select("finer", "p.coarser", "n_areas", "p.n_split", "p.n_outside")
        .where("finer <> coarser")
        .withColumn("nested", (F.col("n_split") == 0) & (F.col("n_outside") < F.col("n_areas")))
    )


def direct(pairs: DataFrame) -> DataFrame:
    """Of nested pairs those without a level in between: the edges of the graph.

    Levels that nest in each other (the same areas under two names) keep their edges.
    """
    nested = pairs.where("nested").select("finer", "coarser")
    both = nested.join(nested.select(F.col("coarser").alias("finer"), F.col("finer").alias("coarser")), ["finer", "coarser"], "left_semi")
    strict = nested.join(both, ["finer", "coarser"], "left_anti")
    longer = strict.join(strict.select(F.col("finer").alias("coarser"), F.col("coarser").alias("top")), "coarser").select("finer", F.col("top").alias("coarser"))
    return nested.join(longer, ["finer", "coarser"], "left_anti")


def closure(edges: DataFrame) -> DataFrame:
    """Every level that can be reached from another one by ``edges`` (finer, coarser):
    the fewest steps and the number of ways. A cycle is an error."""
    known = written(edges.select("finer", "coarser").distinct(), "edges")
    return edges.sparkSession.sql(
        """
        WITH RECURSIVE reached(finer, coarser, steps) AS (
            SELECT finer, coarser, 1 FROM {edges}
            UNION ALL
            SELECT r.finer, e.coarser, r.steps + 1 FROM reached r JOIN {edges} e ON e.finer = r.coarser
        )
        SELECT finer, coarser, min(steps) AS steps, count(*) AS ways FROM reached GROUP BY finer, coarser
        """,
        edges=known,
    )


def converted(totals: DataFrame, crosswalk: DataFrame, source: str, targets: list[str], columns: list[str], population: str, by: list[str] | None = None) -> DataFrame:
    """Totals of ``source`` areas as totals of the areas of every level in ``targets``.

    ``totals`` has a row per area (``geoid``) and further keys ``by``. An area's total is
    dealt out to the areas of a level by what lives in the blocks they share: once, in
    whole, and to one area if the levels nest. What lies in no area of the level, or in
    no block, is under a NULL area, so that every level has the same grand total.
    """
    by = by or []
    summed = totals.groupBy("geoid", *by).agg(*[F.sum(c).alias(c) for c in columns])
    weights = None
    for target in targets:
        one = weights_of_blocks(crosswalk, source, target, population).select(
            F.col("geoid").cast("string").alias("geoid"), F.lit(target).alias("level"), F.col("new_geoid").cast("string").alias("area"), "weight"
        )
        weights = one if weights is None else weights.unionByName(one)
    # areas the crosswalk lacks need a row per level, too
    asked = summed.withColumn("level", F.explode(F.array(*map(F.lit, targets))))
    return (
        asked.join(weights, ["geoid", "level"], "left")
        .groupBy("level", F.col("area").alias("geoid"), *by)
        .agg(*[F.sum(F.col(c) * F.coalesce("weight", F.lit(1.0))).alias(c) for c in columns])
    )
