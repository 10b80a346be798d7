"""Registered queries on coordinates, redrawn areas, levels, medians and survey years.

Their tables are derived from the given ones like those of ``fixtures``; beside each
query stands its SQL, which shares none of the library's expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.operators import apportion, asof, levels, quantiles, spatial
from almoner.plans import fixtures as fx
from almoner.session import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLE[function.__name__] = sql
        return function

    return register


# --- coordinates to areas ----------------------------------------------------------------

# a third of all addresses is one point, every fifth of the others lies on a full degree,
# some have no longitude or one no area has
_LONGITUDE = """CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN -100000000
    WHEN o_orderkey % 5 = 0 THEN (o_orderkey * 7919 % 360 - 180) * 1000000
    ELSE o_orderkey * 7919000 % 360000000 - 180000000 END"""
_LATITUDE = """CASE WHEN o_orderkey % 19 = 0 THEN 95000000 WHEN o_orderkey % 3 = 0 THEN 38000000
    WHEN o_orderkey % 5 = 0 THEN (o_orderkey * 104729 % 180 - 90) * 1000000
    ELSE o_orderkey * 104729000 % 180000000 - 90000000 END"""


def addresses(spark: SparkSession, folder: str) -> DataFrame:
    return fx.table(spark, folder, "orders").selectExpr(
        "o_orderkey AS RECORD_ID", f"({_LONGITUDE}) / 1000000D AS LONGITUDE", f"({_LATITUDE}) / 1000000D AS LATITUDE"
    )


def block_areas(spark: SparkSession, folder: str) -> DataFrame:
    """Triangles with common borders; parts beyond the fourth of a tile lie over the
    first ones, every seventh has a hole."""
    part = fx.table(spark, folder, "part").selectExpr(
        "p_partkey AS p",
        "p_partkey % 990 % 45 * 8 - 180 AS x0",
        "p_partkey % 990 div 45 * 8 - 88 AS y0",
        "p_partkey div 990 % 4 AS q",
    )
    corners = part.selectExpr(
        "p",
        "x0 + if(q IN (1, 2), 8, 0) AS ax",
        "y0 + if(q IN (2, 3), 8, 0) AS ay",
        "x0 + if(q IN (0, 1), 8, 0) AS bx",
        "y0 + if(q IN (1, 2), 8, 0) AS by",
        "x0 + 4 AS cx",
        "y0 + 4 AS cy",
    )

    def corner(x: str, y: str) -> str:
        return f"named_struct('x', cast({x} AS double), 'y', cast({y} AS double))"

    outer = ", ".join(corner(f"{c}x", f"{c}y") for c in "abc")
    inner = ", ".join(
        corner(*(f"floor(({a} * ax_ + {b} * bx_ + {c} * cx_) * 1000000D / 6) / 1000000D".replace("x_", axis) for axis in "xy"))
        for a, b, c in ((4, 1, 1), (1, 4, 1), (1, 1, 4))
    )
    return corners.selectExpr("concat('P', lpad(cast(p AS string), 7, '0')) AS area", f"if(p % 7 = 0, array(array({outer}), array({inner})), array(array({outer}))) AS rings")


_HOLES = ", ".join(
    f"CAST(floor(({a} * a_{axis} + {b} * b_{axis} + {c} * c_{axis}) * 1000000::DOUBLE / 6) AS BIGINT) AS h{i}{axis}"
    for i, (a, b, c) in enumerate(((4, 1, 1), (1, 4, 1), (1, 1, 4)))
    for axis in "xy"
)


@query(
    f"""
    WITH points AS (SELECT o_orderkey AS id, {_LONGITUDE} AS x, {_LATITUDE} AS y FROM orders),
    tiles AS (SELECT p_partkey AS p, p_partkey % 990 % 45 * 8 - 180 AS x0, p_partkey % 990 // 45 * 8 - 88 AS y0, p_partkey // 990 % 4 AS q FROM part),
    corners AS (
      SELECT p, x0 + CASE WHEN q IN (1, 2) THEN 8 ELSE 0 END AS a_x, y0 + CASE WHEN q IN (2, 3) THEN 8 ELSE 0 END AS a_y,
        x0 + CASE WHEN q IN (0, 1) THEN 8 ELSE 0 END AS b_x, y0 + CASE WHEN q IN (1, 2) THEN 8 ELSE 0 END AS b_y, x0 + 4 AS c_x, y0 + 4 AS c_y
      FROM tiles),
    holes AS (SELECT *, {_HOLES} FROM corners),
    edges AS (
      SELECT p, a_x * 1000000 AS x1, a_y * 1000000 AS y1, b_x * 1000000 AS x2, b_y * 1000000 AS y2 FROM holes
      UNION ALL SELECT p, b_x * 1000000, b_y * 1000000, c_x * 1000000, c_y * 1000000 FROM holes
      UNION ALL SELECT p, c_x * 1000000, c_y * 1000000, a_x * 1000000, a_y * 1000000 FROM holes
      UNION ALL SELECT p, h0x, h0y, h1x, h1y FROM holes WHERE p % 7 = 0
      UNION ALL SELECT p, h1x, h1y, h2x, h2y FROM holes WHERE p % 7 = 0
      UNION ALL SELECT p, h2x, h2y, h0x, h0y FROM holes WHERE p % 7 = 0),
    boxes AS (SELECT p, min(least(x1, x2)) AS left_, max(greatest(x1, x2)) AS right_, min(least(y1, y2)) AS low, max(greatest(y1, y2)) AS high FROM edges GROUP BY p),
    distinct_points AS (SELECT DISTINCT x, y FROM points WHERE x IS NOT NULL),
    candidates AS (SELECT x, y, p FROM distinct_points JOIN boxes ON x BETWEEN left_ AND right_ AND y BETWEEN low AND high),
    tests AS (
      SELECT x, y, p, (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1) AS side, x1, y1, x2, y2
      FROM candidates JOIN edges USING (p)),
    inside AS (
      SELECT x, y, p FROM tests GROUP BY x, y, p
      HAVING count(*) FILTER ((y1 > y) <> (y2 > y) AND CASE WHEN y2 > y1 THEN side > 0 ELSE side < 0 END) % 2 = 1
        OR count(*) FILTER (side = 0 AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) > 0),
    found AS (SELECT x, y, min(p) AS p FROM inside GROUP BY x, y)
    SELECT id AS RECORD_ID, x / 1000000::DOUBLE AS LONGITUDE, y / 1000000::DOUBLE AS LATITUDE,
      'P' || lpad(CAST(p AS VARCHAR), 7, '0') AS CENSUS_BLOCK_FIPS
    FROM points LEFT JOIN found USING (x, y)"""
)
def locate_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The area of every address, from its coordinates."""
    return spatial.locate(addresses(spark, folder), block_areas(spark, folder), key="RECORD_ID")


# --- redrawn areas -----------------------------------------------------------------------

_PEOPLE = """customer_people AS (
      SELECT c_custkey AS k, c_nationkey AS nation, count(o_orderkey) AS people
      FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)"""
#: First years of the second and the third set of areas.
SECOND, THIRD = 1997, 1999


def _people(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as blocks, with their orders as inhabitants."""
    n = fx.table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    blocks = fx.table(spark, folder, "customer").join(n, "c_custkey", "left")
    return blocks.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"), F.coalesce("n", F.lit(0)).alias("people"))


def redrawings(spark: SparkSession, folder: str) -> dict[int, DataFrame]:
    """Weights of two redrawings. In the first some blocks are in no new area, in the
    second an area isn't known."""
    blocks = _people(spark, folder).selectExpr(
        "cast(nation AS string) AS first", "if(k % 31 <> 0, concat('A', (nation + k % 3) % 29), NULL) AS second", "concat('B', k % 7) AS third", "people"
    )
    return {
        SECOND: apportion.weights_of_blocks(blocks, "first", "second", "people"),
        THIRD: apportion.weights_of_blocks(blocks.where("second <> 'A5'"), "second", "third", "people"),
    }


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    """A panel whose areas are those of its year."""
    nation = F.col("geoid").cast("int")
    area = F.when(F.col("year") < SECOND, F.col("geoid")).when(F.col("year") < THIRD, F.concat(F.lit("A"), F.col("geoid"))).otherwise(F.concat(F.lit("B"), nation % 7))
    return fx.census_panel(spark, folder).select(area.alias("geoid"), "year", "total_population", "housing_units")


_WEIGHTS = f"""{_PEOPLE},
    blocks AS (
      SELECT CAST(nation AS VARCHAR) AS first, CASE WHEN k % 31 <> 0 THEN 'A' || (nation + k % 3) % 29 END AS second, 'B' || k % 7 AS third, people
      FROM customer_people),
    w1 AS (
      SELECT first AS geoid, second AS new_geoid,
        CASE WHEN sum(sum(people)) OVER w > 0 THEN sum(people) / CAST(sum(sum(people)) OVER w AS DOUBLE) ELSE count(*) / CAST(sum(count(*)) OVER w AS DOUBLE) END AS weight
      FROM blocks GROUP BY first, second WINDOW w AS (PARTITION BY first)),
    w2 AS (
      SELECT second AS geoid, third AS new_geoid,
        CASE WHEN sum(sum(people)) OVER w > 0 THEN sum(people) / CAST(sum(sum(people)) OVER w AS DOUBLE) ELSE count(*) / CAST(sum(count(*)) OVER w AS DOUBLE) END AS weight
      FROM blocks WHERE second <> 'A5' GROUP BY second, third WINDOW w AS (PARTITION BY second))"""
_ORDERS_BY_NATION = f"""panel AS (
      SELECT CASE WHEN year(o_orderdate) < {SECOND} THEN CAST(c_nationkey AS VARCHAR) WHEN year(o_orderdate) < {THIRD} THEN 'A' || c_nationkey ELSE 'B' || c_nationkey % 7 END AS geoid,
        CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query(
    f"""
    WITH {_WEIGHTS}, {_ORDERS_BY_NATION},
    twice AS (
      SELECT w1.geoid, w2.new_geoid, sum(w1.weight * coalesce(w2.weight, 1)) AS weight
      FROM w1 LEFT JOIN w2 ON w2.geoid = w1.new_geoid GROUP BY ALL),
    moved AS (
      SELECT t.new_geoid AS geoid, year, n * coalesce(weight, 1) AS n FROM panel LEFT JOIN twice t USING (geoid) WHERE year < {SECOND}
      UNION ALL SELECT w2.new_geoid, year, n * coalesce(weight, 1) FROM panel LEFT JOIN w2 USING (geoid) WHERE year >= {SECOND} AND year < {THIRD}
      UNION ALL SELECT geoid, year, n FROM panel WHERE year >= {THIRD})
    SELECT geoid, year, round(sum(n), 6) AS total_population, round(sum(n) * 2, 6) AS housing_units FROM moved GROUP BY geoid, year"""
)
def apportion_chain(spark: SparkSession, folder: str) -> DataFrame:
    """A panel over three sets of areas, all on those of the last one."""
    moved = apportion.carried(_measured(spark, folder), redrawings(spark, folder), ["total_population", "housing_units"])
    return moved.select("geoid", "year", *[F.round(c, 6).alias(c) for c in ("total_population", "housing_units")])


@query(
    f"""
    WITH {_WEIGHTS},
    all_weights AS (SELECT '{SECOND}' AS step, * FROM w1 UNION ALL SELECT '{THIRD}', * FROM w2),
    lost AS (SELECT step, geoid, 'lost' AS problem, round(sum(weight), 6) AS value FROM all_weights WHERE new_geoid IS NULL AND weight > 0 GROUP BY ALL)
    SELECT * FROM lost
    UNION ALL SELECT DISTINCT '{THIRD}', new_geoid, 'unknown', 1.0::DOUBLE FROM w1 WHERE new_geoid IS NOT NULL AND weight > 0 AND new_geoid NOT IN (SELECT geoid FROM w2)"""
)
def apportion_problems(spark: SparkSession, folder: str) -> DataFrame:
    """What two redrawings lose: shares without a new area, areas the second doesn't know."""
    first, second = redrawings(spark, folder).values()
    between = first.where("new_geoid IS NOT NULL").select(F.col("new_geoid").alias("geoid"))
    found = apportion.problems(first).withColumn("step", F.lit(str(SECOND))).unionByName(apportion.problems(second, between).withColumn("step", F.lit(str(THIRD))))
    return found.select("step", "geoid", "problem", F.round("value", 6).alias("value"))


# --- medians of larger areas -------------------------------------------------------------


@query(
    """
    WITH v AS (
      SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(floor(o_totalprice) AS BIGINT) AS v
      FROM orders JOIN customer ON o_custkey = c_custkey),
    s AS (SELECT nation, year, v, CAST(greatest(length(bin(v)) - 8, 0) AS INTEGER) AS shift FROM v),
    b AS (SELECT nation, year, shift * 128 + (v >> shift) AS bin, (v >> shift) << shift AS low, ((v >> shift) + 1) << shift AS high FROM s),
    g AS (
      SELECT 'county' AS level, CAST(nation AS VARCHAR) AS geoid, year, bin, low, high FROM b
      UNION ALL SELECT 'region', CASE WHEN n_nationkey <> 24 THEN CAST(n_regionkey AS VARCHAR) END, year, bin, low, high FROM b JOIN nation ON n_nationkey = nation),
    c AS (SELECT level, geoid, year, bin, low, high, count(*) AS n FROM g GROUP BY ALL),
    r AS (
      SELECT *, sum(n) OVER (PARTITION BY level, geoid, year ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY level, geoid, year) AS total FROM c)
    SELECT level, geoid, year, CAST(total AS BIGINT) AS n,
      low + (high - low - 1) * ((ceil(total * 0.5::DOUBLE) - (upto - n) - 0.5::DOUBLE) / n) AS median
    FROM r WHERE upto >= ceil(total * 0.5::DOUBLE) AND upto - n < ceil(total * 0.5::DOUBLE)"""
)
def median_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Median order value per nation and region: those of regions from the nations' bins."""
    customer = fx.table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("string").alias("geoid"))
    orders = fx.table(spark, folder, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    fine = written(quantiles.summarized(orders.join(customer, "o_custkey"), ["geoid", "year"], "o_totalprice"), "bins")
    coarse = quantiles.rolled_up(fine, fx.area_crosswalk(spark, folder), ["geoid", "year"], "region").withColumnRenamed("region", "geoid")
    parts = [quantiles.quantile(s, ["geoid", "year"]).withColumn("level", F.lit(level)) for level, s in (("county", fine), ("region", coarse))]
    return parts[0].unionByName(parts[1]).select("level", "geoid", "year", "n", F.col("value").alias("median"))


# --- levels ------------------------------------------------------------------------------

#: Fourteen levels above blocks, by a block's number.
LEVELS = {
    "tract": "k div 4", "county": "k div 20", "state": "k div 100", "region": "k div 400",
    "culture": "k div 20 % 11", "culture_2": "k div 20 * 7 % 13", "puma": "k div 60",
    "cbsa": "CASE WHEN k div 20 % 3 <> 0 THEN k div 80 END", "csa": "CASE WHEN k div 20 % 3 <> 0 THEN k div 160 END",
    "place": "CASE WHEN k % 3 = 0 THEN k % 97 END", "urban": "k div 7 % 2", "locale": "k div 3 % 4", "district": "k div 9", "zcta": "k div 6",
}
_LEVELS_SQL = "blocks AS (SELECT k, people, " + ", ".join(f"CAST({e.replace('div', '//')} AS VARCHAR) AS {c}" for c, e in LEVELS.items()) + " FROM customer_people)"
_PAIRS_SQL = " UNION ALL ".join(
    f"""SELECT '{a}' AS finer, '{b}' AS coarser, count(*) AS n_areas, count(*) FILTER (least_ IS NOT NULL AND (least_ <> most OR without > 0)) AS n_split,
          count(*) FILTER (least_ IS NULL) AS n_outside
        FROM (SELECT min({b}) AS least_, max({b}) AS most, count(*) FILTER ({b} IS NULL) AS without FROM blocks WHERE {a} IS NOT NULL GROUP BY {a}) HAVING count(*) > 0"""
    for a in LEVELS
    for b in LEVELS
    if a != b
)
_NESTING_SQL = f"""{_PEOPLE}, {_LEVELS_SQL},
    pairs AS (SELECT *, n_split = 0 AND n_outside < n_areas AS nested FROM ({_PAIRS_SQL})),
    strict AS (
      SELECT a.finer, a.coarser FROM pairs a WHERE nested
        AND NOT EXISTS (SELECT 1 FROM pairs b WHERE b.nested AND b.finer = a.coarser AND b.coarser = a.finer)),
    direct AS (
      SELECT finer, coarser FROM pairs p WHERE nested AND NOT EXISTS (
        SELECT 1 FROM strict x JOIN strict y ON x.coarser = y.finer WHERE x.finer = p.finer AND y.coarser = p.coarser))"""


def level_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _people(spark, folder).selectExpr("k", "people", *[f"cast({e} AS string) AS {c}" for c, e in LEVELS.items()])


@query(f"WITH {_NESTING_SQL} SELECT * FROM pairs")
def level_nesting(spark: SparkSession, folder: str) -> DataFrame:
    """Which of 14 levels nest in which."""
    return levels.nesting(level_blocks(spark, folder), list(LEVELS))


@query(
    f"""
    WITH RECURSIVE {_NESTING_SQL},
    graph AS (SELECT DISTINCT finer, coarser FROM direct WHERE (finer, coarser) IN (SELECT (finer, coarser) FROM strict)),
    reached(finer, coarser, steps) AS (
      SELECT finer, coarser, 1 FROM graph UNION ALL SELECT r.finer, g.coarser, r.steps + 1 FROM reached r JOIN graph g ON g.finer = r.coarser)
    SELECT finer, coarser, CAST(min(steps) AS INTEGER) AS steps, count(*) AS ways FROM reached GROUP BY ALL"""
)
def level_closure(spark: SparkSession, folder: str) -> DataFrame:
    """What can be reached in the graph of levels, by its direct edges."""
    pairs = written(levels.nesting(level_blocks(spark, folder), list(LEVELS)), "pairs")
    nested = pairs.where("nested").select("finer", "coarser")
    mutual = nested.select(F.col("coarser").alias("finer"), F.col("finer").alias("coarser"))
    return levels.closure(levels.direct(pairs).join(mutual, ["finer", "coarser"], "left_anti"))


TARGETS = ["county", "cbsa", "csa", "urban", "place"]


@query(
    f"""
    WITH {_PEOPLE}, {_LEVELS_SQL},
    totals AS (
      SELECT CASE WHEN o_custkey % 50 = 0 THEN 'X' ELSE CAST(o_custkey // 6 AS VARCHAR) END AS geoid, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n
      FROM orders GROUP BY ALL),
    shares AS ({" UNION ALL ".join(f"SELECT '{t}' AS level, zcta, {t} AS area, sum(people) AS people, count(*) AS n_blocks FROM blocks GROUP BY ALL" for t in TARGETS)}),
    weights AS (
      SELECT level, zcta, area, CASE WHEN sum(people) OVER w > 0 THEN people / CAST(sum(people) OVER w AS DOUBLE) ELSE n_blocks / CAST(sum(n_blocks) OVER w AS DOUBLE) END AS weight
      FROM shares WINDOW w AS (PARTITION BY level, zcta)),
    asked AS (SELECT totals.*, unnest([{", ".join(f"'{t}'" for t in TARGETS)}]) AS level FROM totals)
    SELECT a.level, w.area AS geoid, year, round(sum(n * coalesce(weight, 1)), 6) AS total
    FROM asked a LEFT JOIN weights w ON w.level = a.level AND w.zcta = a.geoid AND w.weight > 0 GROUP BY ALL"""
)
def level_convert(spark: SparkSession, folder: str) -> DataFrame:
    """Orders counted by postal area, as totals of areas that don't nest with these."""
    area = F.when(F.col("o_custkey") % 50 == 0, F.lit("X")).otherwise(F.expr("cast(o_custkey div 6 AS string)"))
    totals = fx.table(spark, folder, "orders").groupBy(area.alias("geoid"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("total"))
    found = levels.converted(totals, level_blocks(spark, folder), "zcta", TARGETS, ["total"], "people", ["year"])
    return found.select("level", "geoid", "year", F.round("total", 6).alias("total"))


# --- between survey years ----------------------------------------------------------------

_SURVEYED = """surveys AS (
      SELECT CAST(c_nationkey AS VARCHAR) AS geoid, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS DOUBLE) AS people,
        CASE WHEN c_nationkey % 4 <> 1 THEN CAST((c_nationkey * 7 + year(o_orderdate)) % 100 AS DOUBLE) END AS poverty
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE (c_nationkey + year(o_orderdate)) % 3 = 0 GROUP BY c_nationkey, year(o_orderdate)),
    asked AS (SELECT o_orderkey AS id, CAST(o_custkey % 26 AS VARCHAR) AS geoid, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
    keys AS (SELECT DISTINCT geoid, year FROM asked),
    around AS (
      SELECT k.geoid, k.year, max(s.year) FILTER (s.year <= k.year) AS y0, min(s.year) FILTER (s.year >= k.year) AS y1
      FROM keys k LEFT JOIN surveys s ON s.geoid = k.geoid GROUP BY ALL),
    valued AS (
      SELECT r.geoid, r.year, r.y0, r.y1, a.people AS people0, b.people AS people1, a.poverty AS poverty0, b.poverty AS poverty1
      FROM around r LEFT JOIN surveys a ON a.geoid = r.geoid AND a.year = r.y0 LEFT JOIN surveys b ON b.geoid = r.geoid AND b.year = r.y1)"""


def _between(c: str) -> str:
    return f"CASE WHEN y0 = y1 THEN {c}0 WHEN y0 IS NOT NULL AND y1 IS NOT NULL THEN {c}0 + ({c}1 - {c}0) * (year - y0) / (y1 - y0) END"


def _closest(c: str, early: str, late: str) -> str:
    return f"CASE WHEN y0 IS NULL OR y1 - year < year - y0 THEN {late} ELSE {early} END AS {c}"


@query(
    f"""
    WITH {_SURVEYED},
    found AS (
      SELECT 'linear' AS how, geoid, year, CASE WHEN y1 IS NOT NULL THEN y0 END AS "from", CASE WHEN y0 IS NOT NULL THEN y1 END AS "to",
        {_between("people")} AS total_population, {_between("poverty")} AS poverty_perc FROM valued
      UNION ALL SELECT 'earlier', geoid, year, y0, y0, people0, poverty0 FROM valued
      UNION ALL SELECT 'nearest', geoid, year, {_closest('"from"', "y0", "y1")}, {_closest('"to"', "y0", "y1")},
        {_closest("total_population", "people0", "people1")}, {_closest("poverty_perc", "poverty0", "poverty1")} FROM valued)
    SELECT id AS RECORD_ID, a.geoid, a.year, how, "from", "to", total_population, poverty_perc
    FROM asked a JOIN found f ON f.geoid = a.geoid AND f.year = a.year"""
)
def census_between(spark: SparkSession, folder: str) -> DataFrame:
    """Census values of every appearance from surveys that areas had every third year
    only; every 26th area had none."""
    panel = fx.census_panel(spark, folder).where((F.col("geoid").cast("int") + F.col("year")) % 3 == 0)
    records = fx.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("RECORD_ID"), (F.col("o_custkey") % 26).cast("string").alias("geoid"), F.year("o_orderdate").alias("year")
    )
    columns = ["total_population", "poverty_perc"]
    found = [asof.append_as_of(records, panel, columns, "RECORD_ID", how).withColumn("how", F.lit(how)) for how in asof.HOW]
    return found[0].unionByName(found[1]).unionByName(found[2])
