"""Medians of larger areas from mergeable counts.

A summary counts values by bins whose width grows with the value: up to ``1 << BITS``
every whole number has its own bin, above that a bin is ``1 / (1 << BITS)`` of the power
of two below it. Counts of bins add up, so summaries of tracts make those of counties,
states and any other area; a median is interpolated at the very end, from at most a few
thousand rows an area. It lies in the same bin as the true one, hence is off by less
than one part in ``1 << BITS`` of it (less than 1 for small values), whatever was merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 7


def _log2(size: Column) -> Column:
    """Place of the highest bit of a positive whole number."""
    return F.length(F.bin(size)) - 1


def bin_of(value: Column) -> Column:
    """Number of a value's bin; bins stand in order of their values."""
    usable = F.abs(value.cast("double")) < float(1 << 62)  # no missing ones, nor infinite ones
    whole = F.floor(F.when(usable, value)).cast("long")
    size = F.abs(whole)
    shift = F.greatest(_log2(size) - BITS, F.lit(0))
    number = (shift.cast("long") * (1 << BITS)) + F.call_function("shiftright", size, shift)
    # the bins of one shift follow those of the one before
    return F.when(whole < 0, -number).when(whole >= 0, number)


def edges_of(number: Column) -> tuple[Column, Column]:
    """First whole number of a bin, and the first one above it."""
    size = F.abs(number)
    shift = F.greatest(F.floor((size - (1 << BITS)) / (1 << BITS)), F.lit(0)).cast("int")
    mantissa = size - shift.cast("long") * (1 << BITS)
    low, high = (F.call_function("shiftleft", m, shift) for m in (mantissa, mantissa + 1))
    return F.when(number < 0, -high + 1).otherwise(low), F.when(number < 0, -low + 1).otherwise(high)


def summarized(df: DataFrame, areas: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Counts of a value's bins per area. Missing and infinite values don't count."""
    count = F.sum(weight) if weight else F.count(F.lit(1))
    return df.withColumn("bin", bin_of(F.col(value))).where(F.col("bin").isNotNull()).groupBy(*areas, "bin").agg(count.cast("long").alias("n"))


def rolled_up(summary: DataFrame, crosswalk: DataFrame, areas: list[str], level: str) -> DataFrame:
    """Summaries of larger areas; areas the crosswalk lacks go under a NULL one."""
    finer, *other = areas
    return summary.join(crosswalk.select(finer, level), finer, "left").groupBy(level, *other, "bin").agg(F.sum("n").cast("long").alias("n"))


def quantile(summary: DataFrame, areas: list[str], share: float = 0.5) -> DataFrame:
    """Per area the number of values and the interpolated quantile.

    The value that ``ceil(share * n)`` of them don't exceed, spread evenly in its bin.
    """
    order = Window.partitionBy(*areas).orderBy("bin")
    rank = F.greatest(F.ceil(F.col("total") * share), F.lit(1))
    low, high = edges_of(F.col("bin"))
    inside = summary.where("n > 0").select(
        *areas,
        "bin",
        "n",
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(Window.partitionBy(*areas)).alias("total"),
    )
    found = inside.where((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank))
    place = (rank - (F.col("upto") - F.col("n")) - 0.5) / F.col("n")
    return found.select(*areas, F.col("total").cast("long").alias("n"), (low + (high - low - 1) * place).alias("value"))
