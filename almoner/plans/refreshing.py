"""Registered queries on ingest in ranges, kept reports and tables in buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.operators import changes, unify
from almoner.plans import fixtures as fx
from almoner.plans import unified
from almoner.session import scratch_path, written
from almoner.sources import buckets, commits, ranges, writers

RECORD = "cast(NCCS_RANDOM_NUMBER AS long)"
REPORTED = ["NTEE_IRS", "BMF_SUBSECTION_CODE"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# --- ingest in ranges --------------------------------------------------------------------

#: With the line break of the dialect.
NOTE = """CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN ''
    ELSE concat(event_type, ' said "', props, '"', {newline}, 'and, more', {newline}) END"""


@query
def ingest_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Events in three releases of different layouts, with line breaks inside values,
    records of a wrong number of fields, and a release that isn't there: one plan, in
    ranges of 64 KB."""
    root = scratch_path(spark, "ranges")
    events = fx.table(spark, folder, "events")
    notes = events.selectExpr("event_id", "user_id", f"{NOTE.format(newline='char(10)')} AS note")
    writers.write_csv(notes.where("event_id % 2 = 0"), f"{root}/first")
    writers.write_csv(notes.where("event_id % 2 = 1").select("note", "event_id"), f"{root}/second")
    line = F.concat_ws(",", "event_id", F.when(F.col("event_id") % 50 == 0, "one,too many").otherwise("ok"))
    events.select(line.alias("event_id,note")).write.option("sep", "\t").csv(f"{root}/third", header=True)
    absent = spark.range(1).select(F.lit(f"{root}/absent.csv").alias("path"), F.lit(1).cast("long").alias("length"))
    files = ranges.listed(spark, [f"{root}/first", f"{root}/second", f"{root}/third"]).where("path LIKE '%.csv'").unionByName(absent)
    found = ranges.ingest(files, ["event_id", "user_id", "note"], 1 << 16)
    source = F.regexp_extract("path", "([^/]+)/[^/]*$", 1)
    name = F.when(source.isin("first", "second", "third"), source).otherwise(F.element_at(F.split("path", "/"), -1))
    return found.select(name.alias("source"), "event_id", "user_id", "note", F.col("_problem").alias("problem"))


# --- kept reports ------------------------------------------------------------------------

def _deliveries(spark: SparkSession, folder: str) -> list[DataFrame]:
    """States of six deliveries that arrive out of order."""
    return [
        unified.record_state(unified.named_release(raw.where(F.col("VINTAGE") % 3 == part)), tie=RECORD)
        for part in (1, 2, 0)
        for raw in fx.vintages(spark, folder).values()
    ]


@query
def kept_report(spark: SparkSession, folder: str) -> DataFrame:
    """Counts by code after six deliveries, from the changes of each alone."""
    state = report = None
    for delivery in _deliveries(spark, folder):
        delivery = written(delivery, "delivery")
        if state is None:
            state, report = delivery, written(changes.full_report(delivery, REPORTED), "report")
            continue
        report = written(changes.updated(report, changes.report_changes(state, delivery, REPORTED)), "report")
        state = written(unified.merged_states(state, delivery), "state")
    return report


# --- tables in buckets -------------------------------------------------------------------


@query
def bucket_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The newest release over the table of all earlier ones, rewriting only the buckets
    it touches; run twice, as after a failure."""
    root = scratch_path(spark, "buckets")
    layouts = [unified.named_release(raw) for raw in fx.vintages(spark, folder).values()]
    releases = written(layouts[0].unionByName(layouts[1], allowMissingColumns=True), "releases")
    newest = releases.agg(F.max("VINTAGE").alias("newest")).scalar()
    order = [F.desc_nulls_last("VINTAGE"), F.expr(RECORD).desc()]
    existing = unify.latest_by(releases.where(F.col("VINTAGE") < newest), "EIN", *order)
    update = unify.latest_by(releases.where(F.col("VINTAGE") == newest), "EIN", *order)
    buckets.create(existing, root, "EIN", 16)
    buckets.upsert(spark, root, update, "first")
    buckets.upsert(spark, root, update, "first")
    return buckets.read(spark, root).select("EIN", "VINTAGE", "F990_TOTAL_ASSETS", "NTEE_IRS", "BMF_SUBSECTION_CODE", "BMF_GROUP_EXEMPT_NUM")


# --- committed sinks ---------------------------------------------------------------------


@query
def committed_sink(spark: SparkSession, folder: str) -> DataFrame:
    """A table in two formats, which become visible together; a later version that was
    never committed isn't seen."""
    root = scratch_path(spark, "committed")
    rows = fx.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    commits.publish(rows, root, "labelled")
    commits.stage(rows.limit(0), root, "labelled")
    both = commits.published(spark, root, "labelled", rows.schema)
    return both["parquet"].withColumn("format", F.lit("parquet")).unionByName(both["csv"].withColumn("format", F.lit("csv")))
