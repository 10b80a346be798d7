"""Writers for raw releases, the labelled table, side tables and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CSV = {"header": True, "escape": '"', "nullValue": "", "emptyValue": '""'}
EXACT_TEXT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; NULL is written as nothing, empty text as ``""``."""
    df.write.mode(mode).csv(path, **CSV, **EXACT_TEXT)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_labelled(df: DataFrame, folder: str) -> tuple[str, str]:
    """The labelled table twice: parquet for further work, CSV for exchange. The
    CSV is written from the parquet files, so the pipeline runs once."""
    parquet, csv = f"{folder}/labelled.parquet", f"{folder}/labelled.csv"
    write_parquet(df, parquet)
    write_csv(df.sparkSession.read.parquet(parquet), csv)
    return parquet, csv


def write_purposes(purposes: DataFrame, folder: str) -> tuple[str, str]:
    """(EIN2, purpose) without NULLs, in both formats."""
    parquet, csv = f"{folder}/purposes.parquet", f"{folder}/purposes.csv"
    write_parquet(purposes.dropna(), parquet)
    write_csv(purposes.sparkSession.read.parquet(parquet), csv)
    return parquet, csv


def write_raw(df: DataFrame, folder: str, filename: str = "filename") -> None:
    """Ingested records as CSV, one subfolder per source file, named by the file
    name up to its first dot. No shuffle: tasks write the files they hold."""
    root = F.regexp_replace(filename, r"\..*", "")
    (
        df.withColumn("file_root", root)
        .drop(filename)
        .write.mode("overwrite")
        .partitionBy("file_root")
        .csv(folder, **CSV, **EXACT_TEXT)
    )
