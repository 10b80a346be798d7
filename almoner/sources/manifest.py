"""File manifests from storage key listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys below a path, without reading the files (only ``path`` is used)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("key"))


def folder_manifest(keys: DataFrame, folder: str, base_url: str) -> DataFrame:
    """``key, filename, url`` of the files in a folder.

    ``folder`` is a pattern matched anywhere in the key; the file name is what follows it.
    The folder's own entry and names of a single character are left out.
    """
    after = F.regexp_extract("key", f"{folder}(.*)$", 1)
    return (
        keys.where(F.col("key").rlike(folder))
        .select("key", after.alias("filename"))
        .where(F.length("filename") > 1)
        .withColumn("url", F.concat(F.lit(base_url), F.lit(folder), "filename"))
    )


def manifest(keys: DataFrame, folders: list[str], base_url: str) -> DataFrame:
    """Manifest of several folders, one after the other."""
    out = folder_manifest(keys, folders[0], base_url)
    for folder in folders[1:]:
        out = out.unionByName(folder_manifest(keys, folder, base_url))
    return out
