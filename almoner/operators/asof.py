"""Values between the years they were surveyed in.

Records ask for an area and a time; the panel knows an area at some times only. What is
asked for is made distinct first, then put in order with the surveys. Time is cut into
blocks: within a block of an area windows find the surveys before and after, across
blocks the last one before and the first one after are carried over from narrow rows. So
no window ever holds more than a block of an area, and nothing is joined by inequality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.operators.joins import lookup_join

HOW = ("earlier", "nearest", "linear")
#: Units of time (years) in a block.
SPAN = 16


def neighbours(asked: DataFrame, panel: DataFrame, area: str, time: str, columns: list[str], span: int = SPAN) -> DataFrame:
    """Per area and time asked for, the surveys ``before`` (or at) and ``after`` (or at)
    it: structs of ``at`` and the columns.

    Missing areas and times are not looked up. Of several panel rows for one area and
    time the one with the greatest values counts.
    """
    keys = asked.select(area, time).dropna().distinct()
    survey = F.struct(F.col(time).alias("at"), *columns)
    surveys = panel.dropna(subset=[area, time]).groupBy(area, time).agg(F.max(survey).alias("survey"))
    block = F.floor(F.col(time) / span).alias("block")
    rows = keys.select(area, time, block, F.lit(True).alias("asked"), F.lit(None).cast(surveys.schema["survey"].dataType).alias("survey")).unionByName(
        surveys.select(area, time, block, F.lit(False).alias("asked"), "survey")
    )
    known = F.when(F.col("survey").isNotNull(), F.col(time))
    ends = rows.groupBy(area, "block").agg(F.min_by("survey", known).alias("first"), F.max_by("survey", known).alias("last"))
    along = Window.partitionBy(area).orderBy("block")
    ends = ends.select(
        area,
        "block",
        F.last("last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("before_block"),
        F.first("first", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("after_block"),
    )
    inside = Window.partitionBy(area, "block").orderBy(time)
    before = F.last("survey", ignorenulls=True).over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("survey", ignorenulls=True).over(inside.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    placed = rows.select(area, time, "block", "asked", before.alias("before"), after.alias("after")).where("asked")
    return placed.join(ends, [area, "block"]).select(
        area, time, F.coalesce("before", "before_block").alias("before"), F.coalesce("after", "after_block").alias("after")
    )


def as_of(asked: DataFrame, panel: DataFrame, columns: list[str], how: str = "earlier", area: str = "geoid", time: str = "year", span: int = SPAN) -> DataFrame:
    """One row per area and time asked for, with the columns as of then.

    ``earlier``: of the last survey until then. ``nearest``: of the closest one, the
    earlier of two as close. ``linear``: between the surveys around it, NULL outside
    them or where one of the two has no value. ``from`` and ``to`` tell which surveys
    were used.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}, not {how!r}")
    found = neighbours(asked, panel, area, time, columns, span)
    t0, t1, t = F.col("before.at"), F.col("after.at"), F.col(time)
    if how == "linear":
        whole = t0.isNotNull() & t1.isNotNull()

        def value(c: str) -> Column:
            a, b = F.col(f"before.{c}").cast("double"), F.col(f"after.{c}").cast("double")
            return F.when(whole & (t0 == t1), a).when(whole, a + (b - a) * (t - t0) / (t1 - t0)).alias(c)

        return found.select(area, time, F.when(whole, t0).alias("from"), F.when(whole, t1).alias("to"), *map(value, columns))
    later = t0.isNull() | (t1 - t < t - t0) if how == "nearest" else F.lit(False)
    chosen = found.withColumn("chosen", F.when(later, F.col("after")).otherwise(F.col("before")))
    at = F.col("chosen.at")
    return chosen.select(area, time, at.alias("from"), at.alias("to"), *[F.col(f"chosen.{c}").alias(c) for c in columns])


def append_as_of(
    records: DataFrame, panel: DataFrame, columns: list[str], key: str, how: str = "earlier", area: str = "geoid", time: str = "year", span: int = SPAN
) -> DataFrame:
    """``records`` with the panel's columns as of their time; those of one area and time
    are spread by ``key``."""
    return lookup_join(records, as_of(records, panel, columns, how, area, time, span), [area, time], spread_by=key)
