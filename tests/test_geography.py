"""Coordinates, redrawn areas, medians, levels and survey years against brute force."""

from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from almoner.operators import apportion, asof, census, levels, quantiles, spatial
from almoner.session import recording

RINGS = "area string, rings array<array<struct<x:double,y:double>>>"

# --- coordinates ---------------------------------------------------------------------------


def inside(rings, x: int, y: int) -> bool:
    odd = False
    for ring in rings or []:
        corners = [(round(p[0] * 10**6), round(p[1] * 10**6)) for p in ring or [] if p]
        for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]):
            side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and Fraction(x2 - x1) * (y - y1) / (y2 - y1) + x1 > x:
                odd = not odd
    return odd


def square(x: float, y: float, side: float):
    return [(float(a), float(b)) for a, b in ((x, y), (x + side, y), (x + side, y + side), (x, y + side))]


def areas() -> list[tuple]:
    rng = np.random.default_rng(2)
    found = [(f"T{i}{j}", [square(i * 2 - 4, j * 2 - 4, 2)]) for i in range(4) for j in range(4)]  # tiles that share borders
    found += [("hole", [square(10, 10, 4), square(11, 11, 2)]), ("world", [square(-180, -89, 30)]), ("A over T00", [square(-4, -4, 1)])]
    for k in range(40):  # a dense place of stars that overlap
        angles = np.sort(rng.random(9)) * 2 * math.pi
        radius = rng.random(9) * 0.02 + 0.001
        at = rng.random(2) * 0.05 + 50
        found.append((f"star{k:02}", [[(float(at[0] + r * math.cos(a)), float(at[1] + r * math.sin(a))) for a, r in zip(angles, radius)]]))
    return found + [("none", None), ("empty", []), (None, [square(0, 0, 90)]), ("broken", [None, [], [None], [(1.0, 1.0)]])]


def points() -> list[tuple]:
    rng = np.random.default_rng(3)
    found = [(float(x), float(y)) for x in np.arange(-5, 5, 0.5) for y in np.arange(-5, 5, 0.5)]
    found += [(12.0, 12.0), (11.0, 12.0), (10.5, 12.0), (10.0, 10.0), (-170.0, -80.0), (1.0, 1.0), (179.9, 89.9)]
    found += [(float(50 + a), float(50 + b)) for a, b in rng.random((300, 2)) * 0.07 - 0.01]
    found += [(0.3, 0.3)] * 900 + [(None, 1.0), (1.0, None), (None, None), (float("nan"), 1.0), (400.0, 1.0), (float("inf"), 0.0)]
    return [(i, x, y) for i, (x, y) in enumerate(found)]


@pytest.mark.parametrize("limits", [(spatial.MOST_AREAS, spatial.MOST_TESTS), (2, 4)])
def test_locate(spark, limits):
    shapes = areas()
    where = spark.createDataFrame(points(), "EIN long, LONGITUDE double, LATITUDE double").withColumn("CENSUS_BLOCK_FIPS", F.lit("old"))
    blocks = spark.createDataFrame([(a, r and [r_ and [p and dict(x=p[0], y=p[1]) for p in r_] for r_ in r]) for a, r in shapes], RINGS).withColumn("x", F.lit(1))
    got = {r.EIN: r.CENSUS_BLOCK_FIPS for r in spatial.locate(where, blocks, most_areas=limits[0], most_tests=limits[1]).collect()}
    assert len(got) == len(points())
    for key, x, y in points():
        usable = all(v is not None and abs(v) <= 360 for v in (x, y))
        at = (math.floor(x * 10**6 + 0.5), math.floor(y * 10**6 + 0.5)) if usable else None
        assert got[key] == min((a for a, r in shapes if a and at and inside(r, *at)), default=None), (x, y)


def test_locate_in_empty_tables(spark):
    where = spark.createDataFrame([(1, 0.0, 0.0)], "EIN long, LONGITUDE double, LATITUDE double")
    blocks = spark.createDataFrame(areas()[:1], RINGS)
    assert [r.CENSUS_BLOCK_FIPS for r in spatial.locate(where, blocks.filter("false")).collect()] == [None]
    assert spatial.locate(where.filter("false"), blocks).collect() == []


def test_areas_over_each_other_are_not_listed_in_fine_cells(spark):
    rng = np.random.default_rng(4)
    shapes = [(f"S{k:03}", [[(0.0, 0.0), (4.0 + float(d), 0.0), (0.0, 4.0 + float(d))]]) for k, d in enumerate(rng.random(200) / 10)]
    places = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((600, 2)) * 2)]
    where = spark.createDataFrame(places, "EIN long, LONGITUDE double, LATITUDE double")
    blocks = spark.createDataFrame([(a, [[dict(x=x, y=y) for x, y in r] for r in rings]) for a, rings in shapes], RINGS)
    with recording() as tables:
        got = {r.EIN: r.CENSUS_BLOCK_FIPS for r in spatial.locate(where, blocks).collect()}
    least = {i: min((a for a, r in shapes if inside(r, math.floor(x * 10**6 + 0.5), math.floor(y * 10**6 + 0.5))), default=None) for i, x, y in places}
    assert got == least
    assert sum(spark.read.parquet(t).count() for t in tables if "/cells-" in t) <= 5 * len(shapes)


# --- redrawn areas -------------------------------------------------------------------------


def frame(spark, rows):
    return spark.createDataFrame(rows, "geoid string, new_geoid string, weight double")


def test_weights_of_blocks(spark):
    rows = [("a", "x", 30), ("a", "x", 10), ("a", "y", 60), ("b", "x", 0), ("b", "y", None), ("b", "y", -5), ("c", None, 3), ("c", "z", 1), (None, "x", 9)]
    rows += [("hot", f"n{i % 3}", 1) for i in range(3000)]
    weights = apportion.weights_of_blocks(spark.createDataFrame(rows, "old string, new string, people long"), "old", "new", "people")
    got = {(r.geoid, r.new_geoid): r.weight for r in weights.collect()}
    third = 1000 / 3000
    assert got == {
        ("a", "x"): 0.4, ("a", "y"): 0.6, ("b", "x"): 1 / 3, ("b", "y"): 2 / 3, ("c", None): 0.75, ("c", "z"): 0.25, ("hot", "n0"): third, ("hot", "n1"): third, ("hot", "n2"): third,
    }
    found = {(r.geoid, r.problem): r.value for r in apportion.problems(weights, spark.createDataFrame([("a",), ("q",), ("q",)], "geoid string")).collect()}
    assert found == {("c", "lost"): 0.75, ("q", "unknown"): 1.0}
    assert apportion.weights_of_blocks(spark.createDataFrame([], "old string, new string, people long"), "old", "new", "people").collect() == []


def test_chain_is_a_product_of_matrices(spark):
    rng = np.random.default_rng(1)
    sizes, tables, product = [7, 9, 5, 6], [], None
    for n, m in zip(sizes, sizes[1:]):
        w = rng.random((n, m)) * (rng.random((n, m)) < 0.5)
        w[w.sum(1) == 0, 0] = 1
        w /= w.sum(1, keepdims=True)
        product = w if product is None else product @ w
        tables.append(frame(spark, [(f"a{i}", f"a{j}", float(w[i, j])) for i in range(n) for j in range(m) if w[i, j]]))
    got = {(r.geoid, r.new_geoid): r.weight for r in apportion.chain(tables).collect()}
    assert got.keys() == {(f"a{i}", f"a{j}") for i, j in zip(*np.nonzero(product))}
    assert all(abs(w - product[int(a[1:]), int(b[1:])]) < 1e-12 for (a, b), w in got.items())
    assert apportion.problems(apportion.chain(tables)).collect() == []
    bad = apportion.problems(frame(spark, [("a", "x", 0.5), ("b", "x", 1.5), ("b", "y", -0.5)])).collect()
    assert sorted((r.geoid, r.problem) for r in bad) == [("a", "sum"), ("b", "negative")]
    with pytest.raises(ValueError):
        apportion.chain([])


def test_carried_keeps_totals(spark):
    first = frame(spark, [("a", "b", 0.5), ("a", "gone", 0.25), ("a", None, 0.25), ("c", "b", 1.0)])
    second = frame(spark, [("b", "d", 0.5), ("b", "e", 0.5)])
    rows = [("a", 1990, 8.0), ("c", 1990, 2.0), ("unknown", 1990, 1.0), ("b", 2000, 4.0), ("d", 2010, 5.0), (None, 1990, 3.0), ("a", 1990, None)]
    panel = spark.createDataFrame(rows, "geoid string, year int, n double")
    got = {(r.geoid, r.year): r.n for r in apportion.carried(panel, {2000: first, 2010: second}, ["n"]).collect()}
    assert got == {("d", 1990): 3.0, ("e", 1990): 3.0, (None, 1990): 8.0, ("d", 2000): 2.0, ("e", 2000): 2.0, ("d", 2010): 5.0}


# --- medians -------------------------------------------------------------------------------


def test_medians_of_merged_summaries(spark):
    rng = np.random.default_rng(5)
    rows = [("hot", f"t{i % 50}", float(v)) for i, v in enumerate(rng.lognormal(10, 1, 6000))]
    rows += [("small", "s", float(v)) for v in (3, 1, 2)] + [("negative", f"n{i % 3}", float(v)) for i, v in enumerate(rng.normal(-5e4, 1e5, 999))]
    rows += [("zero", "z", 0.0), ("one", "o", 123456.0), ("even", "e", 1e9), ("even", "e2", 2e9), ("missing", "m", None), (None, "m", 5.0), ("wild", "w", float("nan")), ("wild", "w", float("inf")), ("wild", "w", 7.0)]
    values = spark.createDataFrame([(t, "2000", v) for _, t, v in rows], "geoid string, year string, v double")
    crosswalk = spark.createDataFrame(sorted({(t, c) for c, t, _ in rows if c and t != "m"}), "geoid string, county string")
    fine = quantiles.summarized(values.repartition(6), ["geoid", "year"], "v")
    got = {r.county: r for r in quantiles.quantile(quantiles.rolled_up(fine, crosswalk, ["geoid", "year"], "county"), ["county", "year"]).collect()}
    exact = defaultdict(list)
    for county, tract, v in rows:
        if v is not None and math.isfinite(v):
            exact[county if tract != "m" else None].append(math.floor(v))
    assert got.keys() == exact.keys()
    for county, held in exact.items():
        true = sorted(held)[math.ceil(len(held) / 2) - 1]
        assert got[county].n == len(held)
        assert abs(got[county].value - true) <= max(1, abs(true) / (1 << quantiles.BITS)), county
    assert quantiles.quantile(fine.filter("false"), ["geoid", "year"]).collect() == []


def test_bins_cover_every_number(spark):
    numbers = sorted({s * v for k in range(62) for v in (2**k - 1, 2**k, 2**k + 1, 3 * 2**k // 2) for s in (1, -1)} - {2**62})
    numbers = [v for v in numbers if abs(v) < 2**53]
    df = spark.createDataFrame([(v,) for v in numbers], "v long").withColumn("bin", quantiles.bin_of(F.col("v")))
    low, high = quantiles.edges_of(F.col("bin"))
    got = df.select("v", "bin", low.alias("low"), high.alias("high")).orderBy("v").collect()
    assert [r.bin for r in got] == sorted(r.bin for r in got)
    for r in got:
        assert r.low <= r.v < r.high and (r.high - r.low - 1) * (1 << quantiles.BITS) <= abs(r.v)


def test_roll_up_with_summaries(spark):
    panel = spark.createDataFrame([("a", 2000, 2.0, 5.0), ("b", 2000, 3.0, 7.0), ("c", 2000, 1.0, 9.0), ("d", 2001, 1.0, 1.0)], "geoid string, year int, total_population double, median_value_adj double")
    crosswalk = spark.createDataFrame([("a", "x"), ("b", "x"), ("d", "y")], "geoid string, region string")
    values = spark.createDataFrame([("a", 2000, float(v)) for v in (1, 2, 9)] + [("b", 2000, float(v)) for v in (3, 4)] + [("c", 2000, 50.0)], "geoid string, year int, v double")
    summary = quantiles.summarized(values, ["geoid", "year"], "v")
    got = {(r.region, r.year): (r.total_population, r.median_value_adj) for r in census.roll_up(panel, crosswalk, "region", summaries={"median_value_adj": summary}).collect()}
    assert got == {("x", 2000): (5.0, 3.0), (None, 2000): (1.0, 50.0), ("y", 2001): (1.0, None)}
    assert {r.median_value_adj for r in census.roll_up(panel, crosswalk, "region").collect()} == {None}


# --- levels --------------------------------------------------------------------------------


def level_rows() -> list[tuple]:
    return [(str(k // 2), str(k // 4), str(k // 3), str(k // 8) if k % 24 < 16 else None, None, k % 5) for k in range(48)]


LEVELS = ["tract", "county", "zcta", "cbsa", "void"]


def test_nesting(spark):
    rows = level_rows() + [("0", "0", "0", "0", None, 1)]
    blocks = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in LEVELS) + ", people long").withColumn("area", F.lit(1))
    pairs = levels.nesting(blocks, LEVELS)
    got = {(r.finer, r.coarser): (r.n_areas, r.n_split, r.n_outside, r.nested) for r in pairs.collect()}
    for i, a in enumerate(LEVELS):
        for j, b in enumerate(LEVELS):
            if a == b or a == "void":
                assert (a, b) not in got
                continue
            lies = defaultdict(set)
            for r in rows:
                if r[i] is not None:
                    lies[r[i]].add(r[j])
            split, outside = sum(len(s) > 1 for s in lies.values()), sum(s == {None} for s in lies.values())
            assert got[a, b] == (len(lies), split, outside, split == 0 and outside < len(lies)), (a, b)
    assert got["tract", "county"][3] and not got["zcta", "tract"][3] and got["county", "cbsa"][3]
    edges = {tuple(r) for r in levels.direct(pairs).collect()}
    assert ("tract", "county") in edges and ("county", "cbsa") in edges and ("tract", "cbsa") not in edges
    assert levels.nesting(blocks.filter("false"), LEVELS).collect() == []


def test_nesting_is_dealt_out_by_rows(spark, monkeypatch):
    blocks = spark.createDataFrame(level_rows(), ", ".join(f"{c} string" for c in LEVELS) + ", people long").coalesce(1)
    whole = sorted(map(tuple, levels.nesting(blocks, LEVELS).collect()))
    monkeypatch.setattr(levels, "TASK_ROWS", 20, raising=False)
    with recording() as tables:
        pairs = levels.nesting(blocks, LEVELS)
        assert sorted(map(tuple, pairs.collect())) == whole
    assert [spark.read.parquet(t).count() for t in tables] == [48]
    # 48 blocks of 5 levels, 20 rows to a task
    assert ", 12), REPARTITION_BY_NUM" in pairs._jdf.queryExecution().executedPlan().toString()


def test_closure(spark):
    edges = [("block", "tract"), ("tract", "county"), ("county", "state"), ("block", "zcta"), ("zcta", "state"), ("county", "state")]
    got = {(r.finer, r.coarser): (r.steps, r.ways) for r in levels.closure(spark.createDataFrame(edges, "finer string, coarser string")).collect()}
    assert got["block", "state"] == (2, 2) and got["tract", "state"] == (2, 1) and ("zcta", "county") not in got and len(got) == 8


def test_conversion_counts_once(spark):
    rows = level_rows()
    blocks = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in LEVELS) + ", people long")
    totals = [(str(z), 2000, 10.0 * z + 1) for z in range(16)] + [("not there", 2000, 100.0), (None, 2000, 3.0)]
    got = levels.converted(spark.createDataFrame(totals, "geoid string, year int, n double"), blocks, "zcta", ["tract", "county", "cbsa", "void"], ["n"], "people", ["year"]).collect()
    people = defaultdict(lambda: defaultdict(int))
    for r in rows:
        for level, area in zip(LEVELS, r):
            people[level, r[2]][area] += r[5]
    for level in ("tract", "county", "cbsa", "void"):
        wanted = defaultdict(float)
        for z, _, n in totals:
            shares = people[level, z] or {None: 1}
            for area, p in shares.items():
                wanted[area] += n * p / sum(shares.values())
        found = {r.geoid: r.n for r in got if r.level == level}
        assert sum(found.values()) == pytest.approx(sum(n for _, _, n in totals))
        assert {a: v for a, v in found.items() if v} == pytest.approx({a: v for a, v in wanted.items() if v})


# --- survey years --------------------------------------------------------------------------


def asof_by_definition(surveys: dict, year: int, how: str):
    before, after = (f((y for y in surveys if ok(y)), default=None) for f, ok in ((max, lambda y: y <= year), (min, lambda y: y >= year)))
    if how == "linear":
        if before is None or after is None:
            return (None, None, None)
        a, b = surveys[before], surveys[after]
        if before == after:
            return (before, after, a)
        return (before, after, None if a is None or b is None else a + (b - a) * (year - before) / (after - before))
    if how == "nearest" and (before is None or (after is not None and after - year < year - before)):
        before = after
    return (before, before, surveys.get(before))


@pytest.mark.parametrize("how", asof.HOW)
@pytest.mark.parametrize("span", [1, 3, 16])
def test_as_of(spark, how, span):
    rng = np.random.default_rng(7)
    panel = [(f"a{i}", int(y), float(i * 100 + y) if rng.random() < 0.8 else None) for i in range(12) for y in rng.choice(np.arange(1985, 2025), rng.integers(0, 6), replace=False)]
    panel += [(None, 2000, 1.0), ("a1", None, 2.0), ("only", 2005, 5.0)]
    records = [(i, f"a{i % 14}", int(1980 + i % 50)) for i in range(700)] + [(1000 + i, "only", 2000 + i % 9) for i in range(900)] + [(5000, None, 2000), (5001, "a1", None)]
    frame_ = spark.createDataFrame(records, "id long, geoid string, year int").repartition(5)
    got = {r.id: (r["from"], r.to, r.n) for r in asof.append_as_of(frame_, spark.createDataFrame(panel, "geoid string, year int, n double"), ["n"], "id", how, span=span).collect()}
    surveys = defaultdict(dict)
    for area, year, n in panel:
        if area is not None and year is not None:
            surveys[area][year] = n
    assert len(got) == len(records)
    for key, area, year in records:
        wanted = asof_by_definition(surveys[area], year, how) if area is not None and year is not None else (None, None, None)
        assert got[key] == wanted, (area, year)


def test_as_of_ties_and_empty_tables(spark):
    records = spark.createDataFrame([(1, "a", 2001)], "id long, geoid string, year int")
    panel = spark.createDataFrame([("a", 2000, 1.0), ("a", 2000, 3.0), ("a", 2002, 9.0)], "geoid string, year int, n double")
    assert [r.n for r in asof.append_as_of(records, panel, ["n"], "id", "nearest").collect()] == [3.0]
    assert [r.n for r in asof.append_as_of(records, panel.filter("false"), ["n"], "id").collect()] == [None]
    assert asof.append_as_of(records.filter("false"), panel, ["n"], "id").collect() == []
    with pytest.raises(ValueError):
        asof.as_of(records, panel, ["n"], "later")


def test_plans_have_no_cross_join(spark, folder):
    from almoner.plans import geography

    for name in ("census_between", "level_convert", "apportion_chain", "median_rollup"):
        plan = geography.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan, name
    assert census.GEOGRAPHIES == ("msa", "county", "tract")
