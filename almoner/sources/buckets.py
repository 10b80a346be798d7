"""A table in buckets of its key, of which an update rewrites only those it touches.

Buckets are partition folders, so Spark reads the ones it needs and no others. A record
(``commits``) names the folder of every bucket; an update joins the touched buckets with
its rows, writes them anew and commits a record that points to the new folders and, for
all other buckets, to the old ones. Readers see the table before or after, never between.
The record holds a line per bucket, not per row or file.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.operators.unify import upsert as merged
from almoner.sources import commits

BUCKET = "_bucket"


def _bucket(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _write(df: DataFrame, root: str, key: str, n: int) -> str:
    folder = f"{root}/data-{uuid.uuid4().hex}"
    df.withColumn(BUCKET, _bucket(key, n)).repartition(BUCKET).sortWithinPartitions(BUCKET, key).write.partitionBy(BUCKET).parquet(folder)
    return folder


def _filled(df: DataFrame, key: str, n: int) -> list[int]:
    """The buckets rows lie in: at most ``n`` numbers."""
    return sorted(r[0] for r in df.select(_bucket(key, n)).distinct().collect())


def create(df: DataFrame, root: str, key: str, n: int) -> int:
    """A new table of ``n`` buckets; ``df`` has one row per key."""
    folder = _write(df, root, key, n)
    stored = df.sparkSession.read.schema(df.schema).parquet(folder)
    content = {"key": key, "n": n, "schema": df.schema.json(), "buckets": {str(b): folder for b in _filled(stored, key, n)}, "operations": []}
    return commits.commit(df.sparkSession, root, 0, content)


def _rows(spark: SparkSession, record: dict, wanted: list[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(record["schema"]))
    paths = [f"{folder}/{BUCKET}={b}" for b, folder in record["buckets"].items() if wanted is None or int(b) in wanted]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str) -> DataFrame:
    return _rows(spark, commits.newest(spark, root)[1])


def upsert(spark: SparkSession, root: str, update: DataFrame, operation: str, vintage: str = "VINTAGE") -> int:
    """Lay ``update`` (one row per key) over the table, by the rules of ``unify.upsert``.

    An ``operation`` that was committed is not done again, so a run after a failure gives
    the table the first one would have given.
    """
    version, record = commits.newest(spark, root)
    if operation in record["operations"]:
        return version
    key, n = record["key"], record["n"]
    touched = _filled(update, key, n)
    laid = merged(_rows(spark, record, touched), update, key, vintage)
    folder = _write(laid, root, key, n)
    old = T.StructType.fromJson(json.loads(record["schema"]))
    content = {
        **record,
        # new columns come last; buckets written before have them as NULL
        "schema": T.StructType([*old.fields, *(f for f in laid.schema.fields if f.name not in old.fieldNames())]).json(),
        "buckets": {**record["buckets"], **{str(b): folder for b in touched}},
        "operations": [*record["operations"], operation],
    }
    return commits.commit(spark, root, version, content)
