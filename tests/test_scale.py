"""Plans and skew: what keeps the jobs balanced on large, uneven data."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.operators import unify
from almoner.operators.joins import lookup_join
from almoner.plans import queries
from almoner.plans.labelling import label_in_steps, label_registry


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_labelling_never_shuffles(spark, folder):
    text = plan(label_registry(queries._unified(spark, folder)))
    assert "Exchange" not in text and "Python" not in text


def test_one_projection_gives_what_the_steps_give(spark, folder):
    unified = queries._unified(spark, folder)
    one, steps = label_registry(unified), label_in_steps(unified)
    assert one.schema.simpleString() == steps.schema.simpleString()
    assert sorted(map(str, one.collect())) == sorted(map(str, steps.collect()))


def test_reports_read_only_what_they_need(spark, folder):
    text = plan(queries.QUERIES["freq_counts"](spark, folder))
    assert "ReadSchema: struct<c_custkey:bigint>" in text


def test_latest_record_drops_rows_before_the_shuffle(spark, folder):
    text = plan(queries.QUERIES["unified_latest"](spark, folder))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_no_cartesian_products_or_python(spark, folder):
    for name, run in queries.QUERIES.items():
        text = plan(run(spark, folder))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
        assert "Python" not in text and "ArrowEval" not in text, name


def skewed(spark):
    """A third of the rows under one key, a sixth without a key, the rest spread."""
    return spark.range(60_000).select(
        F.col("id").cast("string").alias("EIN"),
        F.when(F.col("id") % 6 < 2, F.lit("hot"))
        .when(F.col("id") % 6 == 2, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
        .alias("block"),
    )


def test_lookup_join_spreads_hot_and_null_keys(spark):
    facts = skewed(spark)
    lookup = (
        spark.range(4000)
        .select(F.concat(F.lit("k"), "id").alias("block"), F.col("id").alias("v"))
        .unionByName(spark.range(1).select(F.lit("hot").alias("block"), F.lit(-1).cast("long").alias("v")))
    )
    expected = facts.join(lookup, "block", "left").select("EIN", "block", "v")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(facts, lookup, ["block"], spread_by="EIN").select("EIN", "block", "v")
        assert joined.count() == 60_000
        assert joined.exceptAll(expected).count() == 0 and expected.exceptAll(joined).count() == 0
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) == 8 and max(per_task) < 1.3 * min(per_task)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_record_of_a_hot_key(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("EIN"),
        (F.col("id") % 7).cast("int").alias("VINTAGE"),
        F.col("id").alias("RECORD_ID"),
    )
    latest = unify.latest_record(rows)
    assert latest.count() == 40_001
    hot = latest.where("EIN = 'hot'").first()
    assert (hot.VINTAGE, hot.RECORD_ID) == (6, max(i for i in range(0, 60_000, 3) if i % 7 == 6))
