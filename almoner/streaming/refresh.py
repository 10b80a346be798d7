"""Refresh of the unified table whenever releases are published.

The update is a periodic batch. Structured Streaming is used for the one thing
a plain batch lacks: knowing which published files have been taken in already,
also after a failed run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.fixed.crosswalk import COLUMN_NAMES
from almoner.operators.changes import full_report, report_changes, updated
from almoner.plans.unified import current, merged_states, named_release, record_state
from almoner.session import written

# a published release: any of the legacy columns as text, and its release
RAW_SCHEMA = T.StructType(
    [T.StructField(old, T.StringType()) for old, _ in COLUMN_NAMES]
    + [T.StructField("VINTAGE", T.IntegerType())]
)


def publish_release(raw: DataFrame, vintage: int, landing: str) -> None:
    """Put a release, read as text, where the refresh looks for it."""
    raw.withColumn("VINTAGE", F.lit(vintage)).write.mode("append").parquet(landing)


def version_path(table: str, version: int) -> str:
    return f"{table}/version={version}"


def state_path(table: str, version: int) -> str:
    return f"{table}/state={version}"


def report_path(table: str, version: int) -> str:
    return f"{table}/report={version}"


def refresh(spark: SparkSession, landing: str, table: str, checkpoint: str, reported: tuple[str, ...] = ()) -> None:
    """Take in every release published since the last call, then stop.

    Each batch merges its releases with the state the batch before it wrote and
    writes its own state and table, so a batch that is run again after a failure
    replaces its own output and nothing else. The newest version is the current
    table; states carry ages, so late releases may come in any order. Versions
    before the newest two are not read again and may be deleted.

    Columns that are ``reported`` have their organizations counted by value
    (``report_path``): from the whole state in the first version, after that from what
    each batch changes. The columns must be the same in every call.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        reader, own = batch.sparkSession.read, state_path(table, batch_id)
        delivery = state = record_state(named_release(batch))
        if batch_id > 0:
            before = reader.parquet(state_path(table, batch_id - 1))
            if reported:
                delivery = written(delivery, "delivery")
                report = updated(reader.parquet(report_path(table, batch_id - 1)), report_changes(before, delivery, list(reported)))
            state = merged_states(before, delivery)
        state.write.mode("overwrite").parquet(own)
        if reported:
            if batch_id == 0:
                report = full_report(reader.parquet(own), list(reported))
            report.write.mode("overwrite").parquet(report_path(table, batch_id))
        current(reader.parquet(own)).write.mode("overwrite").parquet(version_path(table, batch_id))

    (
        spark.readStream.schema(RAW_SCHEMA)
        .parquet(landing)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
