"""Readers and writers on small files."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from almoner.fixed import crosswalk as xw
from almoner.operators.derive import literal_frame
from almoner.session import scratch_path
from almoner.sources import manifest, readers, writers


def test_crosswalk_with_line_breaks(spark):
    path = scratch_path(spark, "xw")
    writers.write_csv(literal_frame(spark, xw.crosswalk_rows(), xw.CROSSWALK_SCHEMA).coalesce(1), path)
    back = readers.read_crosswalk(spark, path)
    assert [tuple(r) for r in back.collect()] == xw.crosswalk_rows()
    assert back.where("DESC IS NOT NULL").count() == 4


def test_whitespace_table(spark, tmp_path):
    file = tmp_path / "release.dat"
    file.write_text("EIN  NTEECC\tASSETS\n\n 1 B29   10\n2 NA 20\n3 C30\n")
    rows = [tuple(r) for r in readers.read_whitespace_table(spark, str(file)).collect()]
    assert rows == [("1", "B29", "10"), ("2", None, "20"), ("3", "C30", None)]


def test_csv_text_keeps_zeros_and_reads_na(spark, tmp_path):
    file = tmp_path / "release.csv"
    file.write_text('EIN,NAME\n00123,"A, ""B"""\nNA,\n')
    rows = [tuple(r) for r in readers.read_csv_text(spark, str(file)).collect()]
    assert rows == [("00123", 'A, "B"'), (None, None)]


def test_reader_goes_by_extension(spark):
    assert readers.reader_for("a.csv.dat") is readers.read_whitespace_table
    assert readers.reader_for("data.csv") is readers.read_csv_text
    assert readers.reader_for("bmf.csv.gz") is readers.read_csv_text
    with pytest.raises(ValueError):
        readers.reader_for("a.xyz")


def test_quoted_values_of_a_whitespace_table(spark, tmp_path):
    (tmp_path / "q.dat").write_text('EIN NAME X\n1 "A  ""B""" 2\n2 "" NA\n')
    rows = [tuple(r) for r in readers.read_whitespace_table(spark, str(tmp_path / "q.dat")).collect()]
    assert rows == [("1", 'A  "B"', "2"), ("2", "", None)]


def test_ingest_writes_what_can_be_read(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv").write_text('x,y\n1,"p\nq"\n')
    whole = gzip.compress(b"x,y\n" + b"".join(b"%d,%d\n" % (i, i * 7919 % 1000003) for i in range(200000)))
    (tmp_path / "cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    files = {n: str(tmp_path / n) for n in ("a.csv", "cut.csv.gz", "none.dat", "b.xyz")}
    log = readers.ingest_to(spark, files, str(tmp_path / "out"))
    assert [(n, s) for n, s, _ in log] == [("a.csv", "ok"), ("cut.csv.gz", "error"), ("none.dat", "error"), ("b.xyz", "error")]
    assert not list((tmp_path / "out" / "cut.csv").glob("part-*")) if (tmp_path / "out" / "cut.csv").exists() else True
    whole_record = readers.read_csv_text(spark, files["a.csv"], multiline=True)
    assert [tuple(r) for r in whole_record.collect()] == [("1", "p\nq")]


def test_a_bad_release_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "empty.dat").write_text("\n")
    files = {n: str(tmp_path / n) for n in ("missing.csv", "a.csv", "b.xyz", "empty.dat")}
    result = readers.ingest(spark, files)
    assert list(result.tables) == ["a.csv"]
    assert [(n, s) for n, s, _ in result.log] == [
        ("missing.csv", "error"), ("a.csv", "ok"), ("b.xyz", "error"), ("empty.dat", "error"),
    ]


def test_bad_records_are_split_off(spark, tmp_path):
    file = tmp_path / "r.csv"
    file.write_text("id,v\n1,1.5\n2,oops\n3,2.5,extra\n4,\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.DoubleType())])
    good, bad = readers.split_corrupt(readers.read_checked(spark, str(file), schema))
    assert [tuple(r) for r in good.collect()] == [(1, 1.5), (4, None)]
    assert [(r.id, r._problem, r._record) for r in bad.collect()] == [(2, "v", "2,oops"), (3, "structure", "3,2.5,extra")]
    assert bad.select("id").count() == 2


def test_key_listing(spark, tmp_path):
    folder = tmp_path / "raw" / "bmf"
    folder.mkdir(parents=True)
    (folder / "one.csv").write_text("x\n")
    (folder / "two.dat").write_text("x\n")
    keys = manifest.list_keys(spark, str(tmp_path))
    rows = manifest.manifest(keys, ["raw/bmf/", "legacy/bmf/"], "https://files.example.org/").collect()
    assert sorted((r.filename, r.url) for r in rows) == [
        ("one.csv", "https://files.example.org/raw/bmf/one.csv"),
        ("two.dat", "https://files.example.org/raw/bmf/two.dat"),
    ]


def test_raw_files_are_named_up_to_the_first_dot(spark, tmp_path):
    df = literal_frame(spark, [("a.v1.dat", 1), ("b.csv", 2), ("a.v2.dat", 3)], "filename string, x int")
    path = scratch_path(spark, "raw")
    writers.write_raw(df, path)
    rows = readers.read_table(spark, path, "x int, file_root string").collect()
    assert sorted(tuple(r) for r in rows) == [(1, "a"), (2, "b"), (3, "a")]


def test_empty_text_and_null_survive_csv(spark):
    df = literal_frame(spark, [("", "a"), (None, " b "), ("x\ny", 'q"q')], "p string, r string")
    path = scratch_path(spark, "csv")
    writers.write_csv(df, path)
    back = readers.read_table(spark, path, df.schema, multiline=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
