"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a generated method above 8000 bytecodes is never JIT-compiled; fall back
    # to split methods instead of running it in the interpreter
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "almoner",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the jobs were tuned with."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="almoner-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for written tables, below the cluster's shared folder.

    The folder is the one named in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_RECORDINGS: list[list[str]] = []


@contextlib.contextmanager
def recording() -> Iterator[list[str]]:
    """The paths of the tables that ``written`` makes inside."""
    paths: list[str] = []
    _RECORDINGS.append(paths)
    try:
        yield paths
    finally:
        # by identity: an inner recording may hold what an outer one does
        _RECORDINGS[:] = [r for r in _RECORDINGS if r is not paths]


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove written tables nobody reads any more, and let Spark remove the shuffles of
    plans nobody holds any more."""
    jvm = spark._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    gc.collect()
    jvm.System.gc()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: computed once, and
    still there when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    for paths in _RECORDINGS:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: send its files with the job, once."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="almoner-")) / "almoner.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for name in sorted(package.rglob("*.py")):
            out.write(name, name.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
