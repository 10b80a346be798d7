"""Joins that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.session import written


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread_by: str,
    hot_keys: int = 1000,
    look_at: int = 64,
) -> DataFrame:
    """Left join to a lookup table of any size with unique keys.

    A key holding more than 1/``hot_keys`` of the rows is hot: its rows are
    spread over several salts (by the hash of ``spread_by``, so a retried task
    sends a row to the same place) and its lookup row is repeated once per
    salt. There are fewer than ``hot_keys`` such keys whatever the data, which
    is the bound on what is broadcast. Rows with a NULL key match nothing and
    are spread the same way.

    Key sizes are estimated from every ``look_at``-th row, chosen by hash and so
    the same ones each time. The estimate decides only how rows are spread:
    every row is joined, and a misjudged key changes no result. The hot keys are
    stored, so that the facts are read twice: once for their keys, once to join.
    """
    looked_at = facts.where(F.pmod(F.xxhash64(F.lit("size"), F.col(spread_by)), F.lit(look_at)) == 0)
    sizes = written(looked_at.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "key-sizes")
    unit = sizes.agg((F.sum("_n") / hot_keys).alias("_unit")).scalar()
    hot = sizes.where(F.col("_n") > unit).select(
        *on, F.ceil(F.col("_n") / unit).cast("int").alias("_parts")
    )
    hot = written(hot.coalesce(1), "hot-keys")

    null_key = F.lit(False)
    for key in on:
        null_key = null_key | F.col(key).isNull()
    parts = F.when(null_key, F.lit(hot_keys)).otherwise(F.coalesce("_parts", F.lit(1)))
    salted_facts = facts.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by), parts).cast("int")
    )
    salted_lookup = (
        lookup.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .drop("_parts")
    )
    return salted_facts.drop("_parts").join(salted_lookup, [*on, "_salt"], "left").drop("_salt")
