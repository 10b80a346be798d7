"""Areas of coordinates: a spatial join through the cells of a quadtree.

Coordinates become whole millionths of a degree, so that every test is exact. Areas are
rings of corners: a point is in an area if a ray from it crosses the area's edges an odd
number of times (holes are just more rings), or if it lies on an edge. Of several such
areas the one with the smallest id is taken, which settles borders as well.

The join's keys are cells, from coarse to fine. An area is listed in every cell its
bounding box touches. In a cell with few enough points, these are compared with its first
areas in the order of ids, with just the edges that matter there: a point in one of them
is done, as the others have larger ids. What is left of points and areas goes on to finer
cells. So areas that lie over each other are listed in fine cells only where points are in
none of the first ones; a dense city gets small cells and an empty desert a large one, and
cells without points are given up at once. Equal coordinates are looked up once, however
many records have them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.operators.joins import lookup_join
from almoner.session import written

PER_DEGREE = 1_000_000
#: Side of the largest and the smallest cells, as powers of two, and the step between.
COARSEST, FINEST, STEP = 29, 11, 3
#: How many of a cell's areas its points are compared with first, or more if that is less
#: than this many tests; a cell with more tests is split before. And at most this many.
MOST_AREAS, MOST_TESTS, MOST_FIRST = 32, 1 << 20, 256
_BOX = ("area", "shape", "x0", "x1", "y0", "y1")
_EDGE = ("x1", "y1", "x2", "y2")


def fixed(degrees: Column) -> Column:
    """Millionths of a degree; NULL for what is no number or beyond a full turn."""
    value = degrees.cast("double")
    return F.when(F.abs(value) <= 360, F.floor(value * PER_DEGREE + 0.5)).cast("long")


def _edges(rings: Column) -> Column:
    """The edges of all rings; the last corner is joined to the first."""

    def of(ring: Column) -> Column:
        corners = F.filter(F.transform(ring, lambda p: F.struct(fixed(p["x"]).alias("x"), fixed(p["y"]).alias("y"))), lambda p: p["x"].isNotNull() & p["y"].isNotNull())
        after = F.concat(F.slice(corners, 2, F.greatest(F.size(corners), F.lit(1))), F.slice(corners, 1, 1))
        return F.zip_with(corners, after, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))

    return F.flatten(F.transform(F.filter(rings, lambda r: r.isNotNull()), of))


def _bound(least: bool, axis: str) -> Column:
    # a field of an array of structs is the array of that field
    ends = [F.col("edges").getField(f"{axis}{k}") for k in (1, 2)]
    return F.least(*map(F.array_min, ends)) if least else F.greatest(*map(F.array_max, ends))


def contains(edges: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside the edges or on one of them."""

    def side(e: Column) -> Column:
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])

    def touches(e: Column) -> Column:
        along = (x >= F.least(e["x1"], e["x2"])) & (x <= F.greatest(e["x1"], e["x2"]))
        up = (y >= F.least(e["y1"], e["y2"])) & (y <= F.greatest(e["y1"], e["y2"]))
        return along & up & (side(e) == 0)

    def crossed(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        return spans & F.when(e["y2"] > e["y1"], side(e) > 0).otherwise(side(e) < 0)

    odd = F.size(F.filter(edges, crossed)) % 2 == 1
    return odd | F.exists(edges, touches)


def _cells(boxes: DataFrame, shift: int, within: bool = False) -> DataFrame:
    """Boxes with the cells they touch; ``within``: only inside the cell of the level above."""

    def span(axis: str) -> Column:
        low, high = (F.shiftright(F.col(f"{axis}{k}"), shift) for k in (0, 1))
        if within:
            first = F.shiftleft(F.col(f"c{axis}"), STEP)
            low, high = F.greatest(low, first), F.least(high, first + (1 << STEP) - 1)
        return F.explode(F.sequence(low, high))

    narrow = boxes.select(*_BOX, span("x").alias("nx"), *(["cy"] if within else []))
    return narrow.select(*_BOX, F.col("nx").alias("cx"), span("y").alias("ncy")).withColumnRenamed("ncy", "cy")


def _in_cells(points: DataFrame, shift: int) -> DataFrame:
    return points.select("x", "y", F.shiftright("x", shift).alias("cx"), F.shiftright("y", shift).alias("cy"))


def _hits(points: DataFrame, listing: DataFrame, shapes: DataFrame, shift: int) -> DataFrame:
    """Points (with their cells) that lie in one of their cell's listed areas, with the first of these."""
    low = {axis: F.shiftleft(F.col(f"c{axis}"), shift) for axis in "xy"}
    top = low["y"] + (1 << shift) - 1

    def matters(e: Column) -> Column:
        # a ray to the right from inside the cell may meet it
        return (F.greatest(e["y1"], e["y2"]) >= low["y"]) & (F.least(e["y1"], e["y2"]) <= top) & (F.greatest(e["x1"], e["x2"]) >= low["x"])

    cells = listing.select(*_BOX, "cx", "cy").join(shapes.select("shape", "edges"), "shape").withColumn("edges", F.filter("edges", matters))
    boxed = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    inside = points.join(cells, ["cx", "cy"]).where(boxed & contains(F.col("edges"), F.col("x"), F.col("y")))
    return inside.groupBy("x", "y").agg(F.min("area").alias("area"))


def located(points: DataFrame, areas: DataFrame, most_areas: int = MOST_AREAS, most_tests: int = MOST_TESTS) -> DataFrame:
    """Distinct points (``x``, ``y``, whole numbers) that lie in an area, with the area.

    ``areas`` has ``area`` and ``rings``, an array of arrays of corners ``x``, ``y`` in
    degrees.
    """
    points = written(points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select("x", "y").distinct(), "points")
    edges = _edges(F.col("rings"))
    shapes = areas.where(F.col("area").isNotNull()).select("area", edges.alias("edges")).where(F.size("edges") > 0)
    # ids may repeat: shapes have numbers of their own
    shapes = written(shapes.withColumn("shape", F.monotonically_increasing_id()), "shapes")
    boxes = shapes.select("area", "shape", *(_bound(least, axis).alias(f"{axis}{0 if least else 1}") for axis in "xy" for least in (True, False)))
    found, active = [], _cells(boxes, COARSEST)
    for shift in range(COARSEST, FINEST - 1, -STEP):
        at = _in_cells(points, shift)
        finest = shift - STEP < FINEST
        covers = F.lit(True)
        for axis in ("x", "y"):
            low = F.shiftleft(F.col(f"c{axis}"), shift)
            covers = covers & (F.col(f"{axis}0") <= low) & (F.col(f"{axis}1") >= low + (1 << shift) - 1)
        cells = active.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n_areas"), F.count_if(~covers).alias("n_partial"))
        cells = cells.join(at.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n_points")), ["cx", "cy"])
        first = F.least("n_areas", F.greatest(F.lit(most_areas), F.floor(F.lit(most_tests) / F.col("n_points"))), F.lit(MOST_FIRST))
        # finer cells wouldn't list fewer areas
        last = F.lit(finest) | (F.col("n_partial") == 0)
        now = last | (F.col("n_areas") == 1) | (first * F.col("n_points") <= most_tests)
        cells = written(cells.select("cx", "cy", "n_areas", F.when(now, first).otherwise(0).cast("long").alias("n_first"), last.alias("last")), "cell-sizes")
        listed = written(active.join(cells, ["cx", "cy"]), "cells")
        order = Window.partitionBy("cx", "cy").orderBy("area", "shape")
        chosen = listed.where("n_first > 0").withColumn("rank", F.row_number().over(order)).where(f"rank <= {MOST_FIRST}").where("rank <= n_first")
        chosen = written(chosen, "first-areas")
        hits = written(_hits(at, chosen, shapes, shift), "hits")
        found.append(hits)
        # what is left
        more = F.col("n_areas") > F.col("n_first")
        left = at.join(cells.where(more).select("cx", "cy", "last"), ["cx", "cy"]).join(hits, ["x", "y"], "left_anti")
        left = written(left, "points")
        done = chosen.where("rank = n_first").select("cx", "cy", F.col("area").alias("area_"), F.col("shape").alias("shape_"))
        others = listed.where(more).join(done, ["cx", "cy"], "left").where("area_ IS NULL OR area > area_ OR (area = area_ AND shape > shape_)")
        if not left.where("last").isEmpty():
            found.append(written(_hits(left.where("last"), others.where("last"), shapes, shift), "hits"))
        points = left.where("NOT last").select("x", "y")
        if finest or points.isEmpty():
            break
        active = _cells(others.where("NOT last"), shift - STEP, within=True)
    return reduce(DataFrame.unionByName, found)


def locate(
    records: DataFrame, areas: DataFrame, key: str = "EIN", x: str = "LONGITUDE", y: str = "LATITUDE", area: str = "CENSUS_BLOCK_FIPS",
    most_areas: int = MOST_AREAS, most_tests: int = MOST_TESTS,
) -> DataFrame:
    """``records`` with the area their coordinates lie in, NULL where there is none.

    A column ``area`` they already have is replaced. Records that share one point are
    spread by ``key``.
    """
    placed = records.drop(area).withColumns({"_x": fixed(F.col(x)), "_y": fixed(F.col(y))})
    found = located(placed.select(F.col("_x").alias("x"), F.col("_y").alias("y")), areas, most_areas, most_tests)
    found = written(found.select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("area").alias(area)), "located")
    return lookup_join(placed, found, ["_x", "_y"], spread_by=key).drop("_x", "_y")
