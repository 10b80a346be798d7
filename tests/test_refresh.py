"""The periodic refresh against the one-shot computation."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.fixed.columns import FINAL_COLUMNS
from almoner.operators import unify
from almoner.plans import fixtures as fx
from almoner.plans.labelling import label_registry
from almoner.plans.unified import build_unified, complete, prepare_release, update_unified
from almoner.session import scratch_path
from almoner.streaming.refresh import publish_release, refresh, version_path


def rows(df):
    names = sorted(df.columns)
    return sorted(map(str, df.select(names).collect()))


def test_refreshing_in_any_order_equals_building_at_once(spark, folder):
    old, new = fx.vintages(spark, folder).values()
    stacked = old.unionByName(new, allowMissingColumns=True)
    years = [1996, 1999, 2001]
    releases = {y: stacked.where(F.col("VINTAGE") == y).drop("VINTAGE") for y in years}
    for order in (years, years[::-1], [1999, 2001, 1996]):
        landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "table", "progress"))
        for i, year in enumerate(order):
            publish_release(releases[year], year, landing)
            refresh(spark, landing, table, checkpoint)
            expected = build_unified({y: releases[y] for y in order[: i + 1]})
            current = spark.read.parquet(version_path(table, i))
            shared = [c for c in expected.columns if c in current.columns]
            assert {"ORG_YEAR_FIRST", "ORG_YEAR_LAST", "ORG_YEAR_COUNT", "ACTIVE"} <= set(shared)
            assert rows(current.select(shared)) == rows(expected.select(shared))
    refresh(spark, landing, table, checkpoint)
    assert rows(spark.read.parquet(version_path(table, 2)).select(shared)) == rows(expected.select(shared))


def test_release_has_one_row_per_organization(spark, folder):
    old, _ = fx.vintages(spark, folder).values()
    prepared = prepare_release(old)
    assert prepared.count() == prepared.select("EIN").distinct().count() == old.select("EIN").distinct().count()


def test_update_with_filings_and_blocks(spark, folder):
    unified = fx.registry(spark, folder).transform(unify.with_ein2)
    new = unified.select("EIN", "EIN2").withColumn("CENSUS_URBAN_AREA", F.lit("NEW"))
    out = update_unified(unified, new, fx.filings(spark, folder), fx.block_crosswalk(spark, folder))
    assert out.count() == unified.count()
    assert out.where("CENSUS_URBAN_AREA = 'NEW'").count() == unified.count()
    assert out.where("TRACT_FIPS IS NOT NULL").count() > 0
    assert set(unify.RECENT.values()) <= set(out.columns)


def test_from_raw_releases_to_labels(spark, folder):
    """The whole way: two layouts of raw text in, labelled organizations out."""
    unified = build_unified(fx.vintages(spark, folder))
    orders = fx.table(spark, folder, "orders")
    assert unified.count() == orders.select("o_custkey").distinct().count()
    spans = fx.appearances(spark, folder).transform(unify.year_span)
    assert rows(unified.select(spans.columns)) == rows(spans)
    status = unify.activity_status(fx.appearances(spark, folder), vintage="YEAR")
    assert unified.where("ACTIVE").count() == status.where("STATUS = 'ACTIVE'").count()
    labelled = label_registry(complete(unified))
    assert labelled.columns == FINAL_COLUMNS and labelled.count() == unified.count()
    assert labelled.where("ORG_TYPE_501C = '501C_03'").count() > 0
    text = unified._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(EIN") <= 3
