"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("least"))
    return (
        both.join(least, "src")
        .filter("dst > src")
        .select(F.col("dst").alias("src"), F.least("src", "least").alias("dst"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("src").agg(F.min("dst").alias("least"))
    moved = edges.join(least, "src").filter("dst > least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return moved.unionByName(least.select("src", F.col("least").alias("dst"))).distinct()


def _summary(edges: DataFrame) -> tuple:
    mark = F.xxhash64("src", "dst")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mark), F.min(mark), F.max(mark)).first())


def components(edges: DataFrame) -> DataFrame:
    """Every vertex that isn't the least of its component, with that one.

    ``edges`` has ``src > dst``. Large and small stars alternate until nothing
    moves; every round is a table in the shared folder, so a lost executor costs
    one round at most, and a hub is only ever counted or joined, never collected.
    """
    edges = written(edges.select("src", "dst").distinct(), "edges")
    state = _summary(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges)), "edges")
        before, state = state, _summary(edges)
        if state == before:
            break
    return edges
