"""Readers for the unified table, the crosswalk and raw releases."""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.fixed.columns import UNIFIED_SCHEMA
from almoner.fixed.crosswalk import CROSSWALK_SCHEMA
from almoner.sources.writers import write_csv

CORRUPT = "_corrupt_record"


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False
) -> DataFrame:
    """CSV with a known schema, so identifiers keep their leading zeros and no
    inference pass runs. ``NA`` and blanks are NULL, a quoted ``""`` is empty text.
    ``multiline`` allows line breaks inside values; a file is then one task."""
    return spark.read.schema(schema).csv(
        path, header=True, nullValue="NA", escape='"', multiLine=multiline
    )


def read_unified(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Unified table from CSV."""
    return read_table(spark, path, UNIFIED_SCHEMA, multiline)


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Column crosswalk: quoted descriptions run over several lines."""
    return spark.read.schema(CROSSWALK_SCHEMA).csv(
        path, header=True, multiLine=True, quote='"', escape='"'
    )


def read_csv_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Raw CSV release, every column as text. ``multiline`` allows line breaks
    inside quotes; a file is then one task."""
    return spark.read.csv(path, header=True, nullValue="NA", escape='"', multiLine=multiline)


def read_whitespace_table(spark: SparkSession, path: str) -> DataFrame:
    """Raw whitespace-separated release with a header line, every column as text.

    Only the header line comes to the driver; short lines give NULL at the end.
    A quoted value may hold white space and doubled quotes.
    """
    lines = spark.read.text(path)
    header = lines.where(F.trim("value") != "").first()["value"]
    names = [n.strip('"') for n in header.split()]
    parts = F.regexp_extract_all(F.col("value"), F.lit(r'"(?:[^"]|"")*"|\S+'), F.lit(0))
    rows = lines.where((F.trim("value") != "") & (F.col("value") != header)).select(parts.alias("p"))
    return rows.select(
        *[_unquoted(F.nullif(F.get("p", F.lit(i)), F.lit("NA"))).alias(name) for i, name in enumerate(names)]
    )


def _unquoted(value: Column) -> Column:
    inner = F.replace(F.substring(value, F.lit(2), F.length(value) - 2), F.lit('""'), F.lit('"'))
    return F.when(value.rlike(r'(?s)^".*"$'), inner).otherwise(value)


READERS = {"dat": read_whitespace_table, "csv": read_csv_text}


COMPRESSED = ("gz", "bz2", "zst", "lz4", "deflate", "snappy")


def reader_for(filename: str):
    """Reader by file extension, ``dat`` first, then ``csv``; the suffix of a
    compressed file doesn't count."""
    parts = filename.lower().split(".")
    extension = parts[-2] if len(parts) > 2 and parts[-1] in COMPRESSED else parts[-1]
    for kind, reader in READERS.items():
        if extension == kind:
            return reader
    raise ValueError(f"no reader for {filename!r}")


@dataclass
class Ingested:
    """Readable releases by file name, and one log line per file."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    log: list[tuple[str, str, str | None]] = field(default_factory=list)


def ingest(spark: SparkSession, files: dict[str, str]) -> Ingested:
    """Open every release in a manifest (name -> path). A release that cannot be
    opened is logged and skipped; the rest go on. There is one entry per
    release, not per record, so the loop is as long as the manifest."""
    result = Ingested()
    for name, path in files.items():
        try:
            result.tables[name] = reader_for(name)(spark, path)
            result.log.append((name, "ok", None))
        except (PySparkException, ValueError, TypeError) as problem:
            result.log.append((name, "error", type(problem).__name__))
    return result


def ingest_to(spark: SparkSession, files: dict[str, str], folder: str) -> list[tuple[str, str, str | None]]:
    """Read every release of a manifest (name -> path) by its name and write it as
    ``<root>.csv`` below ``folder``; one log line per file. A file that fails,
    even midway, is logged and leaves no table; the rest go on."""
    log = []
    for name, path in files.items():
        target = f"{folder}/{name.split('.')[0]}.csv"
        try:
            write_csv(reader_for(name)(spark, path), target)
            log.append((name, "ok", None))
        except (PySparkException, Py4JJavaError, ValueError, TypeError) as problem:
            log.append((name, "error", type(problem).__name__))
    return log


def read_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a schema that never fails a job: ``_problem`` names the first
    column whose text does not fit its type, or says ``structure`` when the
    number of fields is wrong; ``_record`` keeps such a record as text.

    Columns are read as text and cast here. The reader's own check looks only at
    the columns a query happens to use, and would miss errors in the others.
    """
    fields = [T.StructField(f.name, T.StringType()) for f in schema]
    raw = (
        spark.read.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]))
        .option("columnPruning", False)
        .csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, escape='"')
    )
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema}
    problem = F.when(F.col(CORRUPT).isNotNull(), F.lit("structure"))
    for name, value in typed.items():
        problem = problem.when(F.col(name).isNotNull() & value.isNull(), F.lit(name))
    record = F.coalesce(CORRUPT, F.to_csv(F.struct(*typed)))
    return raw.select(
        *[value.alias(name) for name, value in typed.items()],
        problem.alias("_problem"),
        F.when(problem.isNotNull(), record).alias("_record"),
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, bad records) of a checked read."""
    good = F.col("_problem").isNull()
    return df.where(good).drop("_problem", "_record"), df.where(~good)
