"""What several operators share: reading, column choice, names that clash."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as ``bytes.split()`` splits; a word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text as a string, a missing one as the empty one."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a row number; only stable once the result is written."""
    return df.withColumn(name, F.monotonically_increasing_id())


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: send its files with the job, once."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).parents[2]
    archive = Path(tempfile.mkdtemp(prefix="almoner-")) / "almoner.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for name in sorted(Path(__file__).parents[1].rglob("*.py")):
            out.write(name, name.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
