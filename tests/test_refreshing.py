"""Kept reports, tables in buckets and committed outputs, also after failures."""

from __future__ import annotations

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from almoner.operators import changes, unify
from almoner.plans import unified
from almoner.sources import buckets, commits

COLUMNS = ["NTEE_IRS", "BMF_STATUS_CODE"]


def deliveries(spark) -> list:
    """States of four deliveries: late ones, missing values, one organization in all."""
    rows = [
        [("1", 2001, "A01", "1"), ("2", 2001, None, "1"), ("3", 2001, "B02", None), *[(f"h{i}", 2001, "H", "9") for i in range(300)]],
        [("1", 2003, "A02", None), ("4", 2003, None, None), ("2", 2003, "C03", "2"), *[(f"h{i}", 2003, "H", "8") for i in range(0, 300, 2)]],
        [("1", 2002, "Z99", "7"), ("3", 2000, "late", "3"), ("5", 2000, "A01", "1")],
        [("1", 2003, "A02", None)],
    ]
    named = [spark.createDataFrame(r, "EIN string, VINTAGE int, NTEE_IRS string, BMF_STATUS_CODE string") for r in rows]
    return [unified.record_state(d, tie="0") for d in named]


def counts(report) -> Counter:
    return Counter({(r.variable, r.value): r.n for r in report.collect()})


def test_kept_report_equals_a_full_count(spark):
    parts = deliveries(spark)
    full = counts(changes.full_report(unified.merged_states(*parts), COLUMNS))
    assert full["NTEE_IRS", None] == 1 and full["BMF_STATUS_CODE", "8"] == 150
    for order in itertools.islice(itertools.permutations(range(4)), 0, 24, 5):
        state, report = parts[order[0]], changes.full_report(parts[order[0]], COLUMNS)
        for k in order[1:]:
            report = changes.updated(report, changes.report_changes(state, parts[k], COLUMNS))
            state = unified.merged_states(state, parts[k])
        assert counts(report) == full, order


def test_changes_add_up_in_any_order(spark):
    a, b, c, _ = deliveries(spark)
    first = changes.full_report(a, COLUMNS)
    one = changes.report_changes(a, b, COLUMNS)
    two = changes.report_changes(unified.merged_states(a, b), c, COLUMNS)
    wanted = counts(changes.full_report(unified.merged_states(a, b, c), COLUMNS))
    assert counts(changes.updated(first, one, two)) == counts(changes.updated(first, two, one)) == wanted
    assert counts(changes.updated(first, changes.counted(one.unionByName(two)))) == wanted
    empty = changes.report_changes(a, b.filter("false"), COLUMNS)
    assert empty.collect() == [] and counts(changes.updated(first, empty)) == counts(first)
    assert counts(changes.updated(changes.full_report(a.filter("false"), COLUMNS), changes.report_changes(a.filter("false"), a, COLUMNS))) == counts(first)


TABLE = "EIN string, VINTAGE int, a string"


def table_rows(df) -> set:
    return {tuple(r) for r in df.collect()}


def test_upsert_rewrites_touched_buckets_alone(spark, tmp_path):
    root = str(tmp_path / "table")
    old = spark.createDataFrame([(f"e{i}", 2000, f"v{i}") for i in range(200)] + [(None, 2000, "nobody")], TABLE)
    assert buckets.create(old, root, "EIN", 8) == 1
    assert table_rows(buckets.read(spark, root)) == table_rows(old)
    before = commits.newest(spark, root)[1]["buckets"]
    update = spark.createDataFrame([("e3", 2001, None), ("new", 2001, "n"), ("e5", 1999, "older")], TABLE)
    assert buckets.upsert(spark, root, update, "one") == 2
    after = commits.newest(spark, root)[1]["buckets"]
    moved = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(moved) <= 3 and after.keys() >= before.keys()
    wanted = table_rows(unify.upsert(old, update))
    assert table_rows(buckets.read(spark, root)) == wanted and ("e3", 2001, "v3") in wanted
    assert buckets.upsert(spark, root, update, "one") == 2  # the same operation again
    wider = spark.createDataFrame([("e9", 2002, "w", 1)], TABLE + ", extra int")
    buckets.upsert(spark, root, wider, "two")
    got = {r.EIN: (r.a, r.extra) for r in buckets.read(spark, root).collect()}
    assert got["e9"] == ("w", 1) and got["e3"] == ("v3", None) and len(got) == 202
    assert buckets.upsert(spark, root, update.filter("false"), "none") == 4 and buckets.read(spark, root).count() == 202


def test_failed_upsert_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    old = spark.createDataFrame([(f"e{i}", 2000, f"v{i}") for i in range(50)], TABLE)
    buckets.create(old, root, "EIN", 4)
    update = spark.createDataFrame([("e1", 2001, "x"), ("e99", 2001, "y")], TABLE)

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(buckets.commits, "commit", fails)
        with pytest.raises(OSError):
            buckets.upsert(spark, root, update, "one")
    assert table_rows(buckets.read(spark, root)) == table_rows(old)
    buckets.upsert(spark, root, update, "one")
    assert table_rows(buckets.read(spark, root)) == table_rows(unify.upsert(old, update))


def test_empty_table_in_buckets(spark, tmp_path):
    root = str(tmp_path / "table")
    none = spark.createDataFrame([], TABLE)
    buckets.create(none, root, "EIN", 4)
    assert buckets.read(spark, root).collect() == []
    buckets.upsert(spark, root, spark.createDataFrame([("a", 2001, None)], TABLE), "one")
    assert table_rows(buckets.read(spark, root)) == {("a", 2001, None)}


def test_two_writers_conflict(spark, tmp_path):
    root = str(tmp_path)
    assert commits.newest(spark, root) == (0, {})
    assert commits.commit(spark, root, 0, {"a": 1}) == 1
    with pytest.raises(commits.Conflict):
        commits.commit(spark, root, 0, {"a": 2})
    assert commits.newest(spark, root) == (1, {"a": 1})


def test_outputs_appear_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = spark.createDataFrame([(1, 'a "b"\nc'), (2, None), (3, "")], "id int, text string")
    assert commits.publish(rows, root, "labelled", "run 1") == 1
    later = rows.withColumn("id", F.col("id") + 10)

    def fails(*_, **__):
        raise OSError("disk")

    with monkeypatch.context() as m:  # between the two formats
        m.setattr(commits, "write_csv", fails)
        with pytest.raises(OSError):
            commits.publish(later, root, "labelled", "run 2")
    for name, df in commits.published(spark, root, "labelled", rows.schema, multiline=True).items():
        assert name in ("parquet", "csv") and {r.id for r in df.collect()} == {1, 2, 3}
    assert commits.publish(later, root, "labelled", "run 2") == 2 == commits.publish(rows, root, "labelled", "run 2")
    assert {r.id for r in commits.published(spark, root, "labelled", rows.schema)["parquet"].collect()} == {11, 12, 13}
    commits.publish(rows, root, "purposes")
    assert commits.newest(spark, root)[1]["outputs"].keys() == {"labelled", "purposes"}


def test_refresh_keeps_reports(spark, folder):
    from almoner.plans import fixtures as fx
    from almoner.session import scratch_path
    from almoner.streaming.refresh import publish_release, refresh, report_path, state_path

    old, new = fx.vintages(spark, folder).values()
    stacked = old.unionByName(new, allowMissingColumns=True)
    landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "table", "progress"))
    columns = ("BMF_SUBSECTION_CODE", "NTEE_IRS", "no such column")
    for i, year in enumerate([1999, 2001, 1996]):
        publish_release(stacked.where(F.col("VINTAGE") == year).drop("VINTAGE"), year, landing)
        refresh(spark, landing, table, checkpoint, columns)
        report = spark.read.parquet(report_path(table, i))
        state = spark.read.parquet(state_path(table, i))
        assert counts(report) == counts(changes.full_report(state, list(columns)))
        assert report.where("variable = 'no such column'").first()["n"] == state.count()
