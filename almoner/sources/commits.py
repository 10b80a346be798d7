"""Outputs that become visible all at once.

What a job writes goes to folders of its own first. A small record then names them; it is
created under the next version's number by a rename that fails if the number is taken, and
readers follow the newest record alone. A job that fails before leaves folders nobody
reads, one that is run again leaves no second version under the same operation.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from almoner.sources.readers import read_table
from almoner.sources.writers import write_csv, write_parquet


class Conflict(RuntimeError):
    """Somebody else committed the version first."""


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _read(spark: SparkSession, path: str) -> dict:
    files, where = _files(spark, path)
    source = files.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def newest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest record below ``root``; 0 and nothing if none."""
    files, where = _files(spark, f"{root}/_records")
    if not files.exists(where):
        return 0, {}
    names = [f.getPath().getName() for f in files.listStatus(where)]
    numbers = [int(n) for n in names if n.isdigit()]
    return (max(numbers), _read(spark, f"{root}/_records/{max(numbers):012d}")) if numbers else (0, {})


def commit(spark: SparkSession, root: str, after: int, content: dict) -> int:
    """Make ``content`` the record that follows version ``after``."""
    version = after + 1
    files, draft = _files(spark, f"{root}/_records/_draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    _, target = _files(spark, f"{root}/_records/{version:012d}")
    if files.exists(target) or not files.rename(draft, target):
        raise Conflict(f"version {version} of {root} exists")
    return version


def stage(df: DataFrame, root: str, name: str) -> dict[str, str]:
    """``df`` in both formats, in folders no record names yet. The rows are computed
    once; the CSV is written from the stored ones."""
    folder = f"{root}/{name}-{uuid.uuid4().hex}"
    paths = {"parquet": f"{folder}/{name}.parquet", "csv": f"{folder}/{name}.csv"}
    write_parquet(df, paths["parquet"], "error")
    write_csv(df.sparkSession.read.parquet(paths["parquet"]), paths["csv"], "error")
    return paths


def publish(df: DataFrame, root: str, name: str, operation: str | None = None) -> int:
    """Stage and commit; the new version. An ``operation`` that is the newest record's
    already is not done again."""
    spark = df.sparkSession
    version, record = newest(spark, root)
    if operation and record.get("operation") == operation:
        return version
    return commit(spark, root, version, {"operation": operation, "outputs": {**record.get("outputs", {}), name: stage(df, root, name)}})


def published(spark: SparkSession, root: str, name: str, schema: T.StructType, multiline: bool = False) -> dict[str, DataFrame]:
    """Both formats of the newest committed version; ``multiline`` if values of the CSV
    may hold line breaks."""
    _, record = newest(spark, root)
    paths = record["outputs"][name]
    return {"parquet": spark.read.schema(schema).parquet(paths["parquet"]), "csv": read_table(spark, paths["csv"], schema, multiline)}
