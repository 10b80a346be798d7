"""Hard-to-parse addresses: flag, filter, sample, keep the address columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.functions.addresses import difficulty_flags


def address_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns whose name contains ``ADDR_``, plus the ones asked for."""
    return df.select(*[c for c in df.columns if "ADDR_" in c or c in keep])


def with_difficulty_flags(df: DataFrame, address: str = "ORG_ADDR_FULL") -> DataFrame:
    return df.withColumns(difficulty_flags(F.col(address)))


def difficult_addresses(df: DataFrame, address: str = "ORG_ADDR_FULL") -> DataFrame:
    """Flagged rows where at least one flag is set; NULL addresses drop out."""
    flags = difficulty_flags(F.col(address))
    any_flag = reduce(lambda a, b: a | b, map(F.col, flags))
    return df.withColumns(flags).where(any_flag)


def sample_rows(df: DataFrame, key: str, n: int = 100, seed: int = 123) -> DataFrame:
    """``n`` rows without replacement, the same ones on every run.

    Rows are ordered by a hash of a unique key and the seed and the first ``n``
    are taken: each task keeps at most ``n`` rows, and neither the number of
    partitions nor a retry changes the draw. The hash is a column of its own so
    that it is computed once per row and not in every comparison.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_draw", draw).orderBy("_draw", key).limit(n).drop("_draw")
