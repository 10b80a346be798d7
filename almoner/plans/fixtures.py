"""Registry-shaped tables derived from the given test tables.

Codes are picked by integer arithmetic on a key, so that any SQL engine can
repeat them exactly. Every table grows with the table it is derived from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.fixed import dictionaries
from almoner.fixed.columns import UNIFIED_SCHEMA
from almoner.functions.codes import padded_ein

# --- fixed values: code cycles --------------------------------------------------
SUBSECTION = [3, 3, 3, 92, 4, 50, 91, None, 6, 7, 13, 80, 82, 2]
CLASSIFICATION = [1, 2, 12, 71, None, 9, 123, 3, 11, 0]
PF_FILING = [0, 1, None, 2, 3, 0, 4, 9]
FILING_REQ = [
    None, 10, 20, 1, 0, 2, 6, 60, 3, 11, 30, 13, 130, 140, 70, 21, 7, 40, 14, 4, 888,
]
GROUP_EXEMPT = [0, 0, 1234, None]
AFFILIATION = [1, 2, 3, 6, 7, 8, 9, None, 5]
STATUS = [1, 2, 12, 25, 99, None]
DEDUCTIBILITY = [0, 1, 2, 4, 3, None]
FOUNDATION = [0, 2, 3, 4, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 21, 22, 23, 24, 99]
LEVEL_1 = ["501CX NONPROFIT", "501C3 CHARITY", "501C3 PRIVATE FOUNDATION", "UNDEFINED", ""]
LEVEL_2 = ["O", "S", "M", ""]
LEVEL_3 = [code for code, _ in dictionaries.NCCS_LEVEL_3] + ["-", ""]
NTEE = ["B29", "B01", "B0129", "E20", "B40", "A12", "X20", "Z99", None, "C30"]
ADDRESS = [
    "12 Main St", "PO Box 7", "p.o. box 9", "RR 2 Box 4", "Harry Lane",
    "Suite #4 Elm", "Oak Street", None, "5 A&B Rd",
]
IN_CARE_OF = ["% JANE DOE", None, "% TREASURER"]
URBAN = ["URBAN", "RURAL", None, "URBAN"]
MATCHED = ["Y", "N", None]
MATCH_TYPE = ["M", "U", "T"]
# --- end of fixed values --------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _literal(value) -> str:
    return "NULL" if value is None else repr(value)


def pick(values: list, index: str) -> str:
    """SQL for element ``index mod len(values)``, counting from 0."""
    array = f"array({', '.join(map(_literal, values))})"
    return f"element_at({array}, cast(({index}) % {len(values)} AS int) + 1)"


def _digits(value: str, width: int) -> str:
    return f"lpad(cast({value} AS string), {width}, '0')"


def registry_rows(df: DataFrame, k: str, name: str, second_name: str, area: str) -> DataFrame:
    """The unified table before labelling: one organization per row. The
    arguments are SQL; ``k`` is the number the codes are derived from."""
    half, third = f"({k}) div 2", f"({k}) div 3"
    known_span = f"{k} % 23 <> 0"
    block = ", ".join(
        [_digits(f"{k} % 50 + 1", 2), _digits(f"{k} % 199", 3), _digits(f"{k} % 9999", 6), _digits(f"{k} % 4000", 4)]
    )
    columns = {
        "EIN": f"{k} + 10000001",
        "ORG_NAME_CURRENT": name,
        "ORG_NAME_SEC": second_name,
        "ORG_PERS_ICO": pick(IN_CARE_OF, k),
        "ORG_FISCAL_PERIOD": f"{k} % 13",
        "BMF_ORGANIZATION_CODE": f"{k} % 8",
        "ORG_RULING_DATE": f"concat(cast(1950 + {k} % 70 AS string), {_digits(f'{k} % 12 + 1', 2)})",
        "ORG_RULING_YEAR": f"CASE WHEN {k} % 17 <> 0 THEN 1950 + {k} % 70 END",
        "ORG_YEAR_FIRST": f"CASE WHEN {known_span} THEN 1989 + {k} % 20 END",
        "ORG_YEAR_LAST": f"CASE WHEN {known_span} THEN 1989 + {k} % 20 + ({third}) % 12 END",
        "ORG_YEAR_COUNT": f"CASE WHEN {known_span} THEN ({third}) % 12 + 1 END",
        "NTEE_IRS": pick(NTEE, k),
        "NTEE_NCCS": pick(NTEE, half),
        "NCCS_LEVEL_1": pick(LEVEL_1, k),
        "NCCS_LEVEL_2": pick(LEVEL_2, half),
        "NCCS_LEVEL_3": pick(LEVEL_3, third),
        "BMF_SUBSECTION_CODE": pick(SUBSECTION, k),
        "BMF_CLASSIFICATION_CODE": pick(CLASSIFICATION, third),
        "BMF_DEDUCTIBILITY_CODE": pick(DEDUCTIBILITY, half),
        "BMF_FILING_REQ_CODE": pick(FILING_REQ, half),
        "BMF_PF_FILING_REQ_CODE": pick(PF_FILING, f"({k}) div 5"),
        "BMF_FOUNDATION_CODE": pick(FOUNDATION, third),
        "BMF_STATUS_CODE": pick(STATUS, k),
        "BMF_AFFILIATION_CODE": pick(AFFILIATION, f"({k}) div 11"),
        "BMF_GROUP_EXEMPT_NUM": pick(GROUP_EXEMPT, f"({k}) div 7"),
        "BMF_INCOME_CODE": f"(({k}) div 4) % 11",
        "BMF_ASSET_CODE": f"{k} % 11",
        "ORG_FISCAL_YEAR": f"1990 + {k} % 31",
        "F990_TOTAL_REVENUE_RECENT": f"{k} * 97 % 1000003",
        "F990_TOTAL_INCOME_RECENT": f"{k} * 89 % 999983",
        "F990_TOTAL_ASSETS_RECENT": f"CASE WHEN {k} % 4 <> 0 THEN {k} * 83 % 999979 END",
        "F990_ORG_ADDR_STREET": pick(ADDRESS, f"{k} + 3"),
        "F990_ORG_ADDR_CITY": f"concat('CITY ', {k} % 97)",
        "F990_ORG_ADDR_STATE": f"concat('S', {_digits(area, 2)})",
        "F990_ORG_ADDR_ZIP": _digits(f"{k} % 99999", 5),
        "CENSUS_URBAN_AREA": pick(URBAN, k),
        "CENSUS_STATE_ABBR": f"concat('S', {_digits(area, 2)})",
        "CENSUS_COUNTY_NAME": f"concat('COUNTY ', {k} % 31)",
        "CENSUS_CBSA_NAME": f"CASE WHEN {k} % 5 <> 0 THEN concat('CBSA ', {k} % 19) END",
        "CENSUS_CBSA_FIPS": f"CASE WHEN {k} % 5 <> 0 THEN 10000 + {k} % 19 END",
        "CENSUS_BLOCK_FIPS": f"CASE WHEN {k} % 10 <> 9 THEN concat({block}) END",
        "ORG_ADDR_FULL": pick(ADDRESS, k),
        "ORG_ADDR_MATCH": pick(MATCHED, k),
        "LATITUDE": f"{k} % 180 - 90",
        "LONGITUDE": f"{k} % 360 - 180",
        "GEOCODER_SCORE": f"{k} % 101",
        "GEOCODER_MATCH": pick(MATCH_TYPE, k),
    }
    types = {f.name: f.dataType.simpleString() for f in UNIFIED_SCHEMA}
    return df.selectExpr(*[f"cast({sql} AS {types[c]}) AS {c}" for c, sql in columns.items()])


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """One organization per customer."""
    customer = table(spark, folder, "customer")
    return registry_rows(customer, "c_custkey", "c_name", "c_mktsegment", "c_nationkey")


def large_registry(spark: SparkSession, folder: str) -> DataFrame:
    """One organization per order, for timing."""
    orders = table(spark, folder, "orders")
    return registry_rows(orders, "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey % 25")


# years before this one use the older column names
NEW_LAYOUT_FROM = 1998


def vintages(spark: SparkSession, folder: str) -> dict[int, DataFrame]:
    """Raw releases as text, in the two layouts; the release is the order year.

    The older layout carries the group number in two columns, of which only one
    is filled, and both layouts carry a column the crosswalk does not know.
    """
    orders = table(spark, folder, "orders")
    year = "year(o_orderdate)"
    shared = [
        "cast(o_custkey + 10000001 AS string) AS EIN",
        f"{year} AS VINTAGE",
        "cast(o_orderkey AS string) AS RANDNUM",
    ]
    amount = "cast(o_totalprice AS string)"
    ntee = pick(NTEE, f"o_custkey + {year}")
    subsection = f"cast({pick(SUBSECTION, 'o_custkey + o_orderkey')} AS string)"
    group = _digits("o_orderkey % 10000", 4)
    first = f"timestamp'{NEW_LAYOUT_FROM}-01-01'"
    old = orders.where(f"o_orderdate < {first}").selectExpr(
        *shared,
        f"{amount} AS ASSETS",
        f"{ntee} AS NTEECC",
        f"{subsection} AS SUBSECCD",
        f"CASE WHEN o_orderkey % 2 = 0 THEN {group} END AS GEN",
        f"CASE WHEN o_orderkey % 2 = 1 THEN concat(' ', {group}) END AS GROUP",
        "o_orderstatus AS TAPE_REEL",
    )
    new = orders.where(f"o_orderdate >= {first}").selectExpr(
        *shared,
        f"{amount} AS ASSET_AMT",
        f"{ntee} AS NTEE_CD",
        f"{subsection} AS SUBSECTION",
        f"{group} AS GROUP",
        "o_orderstatus AS BATCH",
    )
    return {NEW_LAYOUT_FROM - 1: old, NEW_LAYOUT_FROM: new}


def appearances(spark: SparkSession, folder: str) -> DataFrame:
    """(EIN, YEAR) of every appearance, repeated years kept."""
    return table(spark, folder, "orders").select(
        _ein("o_custkey"), F.year("o_orderdate").alias("YEAR")
    )


def _ein(key: str) -> Column:
    return padded_ein(F.col(key) + 10000001).alias("EIN")


def filings(spark: SparkSession, folder: str) -> DataFrame:
    """E-filed returns: one per order, with revenue, most also with income and assets."""
    return table(spark, folder, "orders").select(
        _ein("o_custkey"),
        F.year("o_orderdate").alias("TAX_YEAR"),
        F.col("o_orderkey").alias("FILING_ID"),
        F.col("o_totalprice").alias("F990_TOTAL_REVENUE"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice") / 2).alias("F990_TOTAL_INCOME"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") * 2).alias("F990_TOTAL_ASSETS"),
    )


def block_crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """One row per census block an organization lies in."""
    block = F.col("CENSUS_BLOCK_FIPS")
    return (
        registry(spark, folder)
        .where(block.isNotNull())
        .select(block)
        .distinct()
        .select(
            block,
            F.substring(block, 1, 11).alias("TRACT_FIPS"),
            F.substring(block, 1, 5).alias("COUNTY_FIPS"),
            F.substring(block, 1, 2).alias("STATE_FIPS"),
            F.concat(F.lit("Z"), F.substring(block, 6, 5)).alias("ZCTA"),
        )
    )


def order_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per customer's nation, segment and year. Orders are counted per
    customer and year before they are joined, so a customer with very many
    orders is one row in the join."""
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "c_mktsegment", "year")
        .agg(F.sum("n").alias("n"))
    )


def census_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Area x year panel: nations as areas, orders as population."""
    nation = F.col("c_nationkey")
    population = F.col("n").cast("double")
    return (
        order_counts(spark, folder)
        .groupBy("c_nationkey", "year")
        .agg(F.sum("n").alias("n"))
        .select(
            nation.cast("string").alias("geoid"),
            "year",
            population.alias("total_population"),
            (population * 2).alias("housing_units"),
            F.when(nation % 4 != 1, (nation * 7 + F.col("year")) % 100).cast("double").alias("poverty_perc"),
            (50000 + nation * 1000).cast("double").alias("med_household_income_adj"),
        )
    )


def tract_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Tract x year panel: a nation's segments as its tracts."""
    nation, population = F.col("c_nationkey"), F.col("n").cast("double")
    return order_counts(spark, folder).select(
        F.concat_ws("-", nation.cast("string"), "c_mktsegment").alias("geoid"),
        "year",
        population.alias("total_population"),
        (population * 2).alias("housing_units"),
        F.when(nation % 4 != 1, (nation * 7 + F.col("year")) % 100).cast("double").alias("poverty_perc"),
        (50000 + nation * 1000).cast("double").alias("med_household_income_adj"),
    )


def area_crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """Nation -> region, standing for tract -> larger area. One area is missing."""
    return table(spark, folder, "nation").where("n_nationkey <> 24").select(
        F.col("n_nationkey").cast("string").alias("geoid"),
        F.col("n_regionkey").cast("string").alias("region"),
    )


def apportionment_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Each area keeps three quarters and passes one quarter to the next one; one
    area has no weights."""
    nation = table(spark, folder, "nation").where("n_nationkey <> 23").select(F.col("n_nationkey").alias("k"))
    parts = F.array(
        F.struct(F.col("k").alias("new"), F.lit(0.75).alias("weight")),
        F.struct(((F.col("k") + 1) % 25).alias("new"), F.lit(0.25).alias("weight")),
    )
    return nation.select(F.col("k").cast("string").alias("geoid"), F.explode(parts).alias("part")).select(
        "geoid", F.col("part.new").cast("string").alias("new_geoid"), "part.weight"
    )


def statistical_areas(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as areas with a population and, for most, a combined area."""
    n = (
        order_counts(spark, folder)
        .groupBy("c_nationkey")
        .agg((F.sum("n") * 100).alias("population"))
    )
    nation = table(spark, folder, "nation")
    return nation.join(n, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("n_nationkey").cast("string").alias("geoid"),
        "population",
        F.when(F.col("n_nationkey") % 6 != 0, F.col("n_regionkey").cast("string")).alias("csa"),
    )


def storage_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Storage listing: one key per document, in three folders, and the entries
    of the folders themselves."""
    folder_name = pick(["raw/bmf/", "legacy/bmf/", "other/"], "doc_id")
    ending = pick([".csv", ".dat"], "doc_id")
    name = f"CASE WHEN doc_id % 100 > 1 THEN concat(source, '-', doc_id, {ending}) ELSE '' END"
    return table(spark, folder, "documents").selectExpr(f"concat({folder_name}, {name}) AS key")
