"""Files in ranges against a plain reader, whatever the size of the ranges."""

from __future__ import annotations

import csv
import gzip
import io
from collections import Counter

import numpy as np
import pytest

from almoner.sources import ranges

VALUES = ["plain", "", None, "NA", 'a "quoted" word', "two\nlines", "crlf\r\nend", '"', '""\n""', "comma, and\n\n more", "ünïcödé 日本", "x" * 300, " lead", "\n"]


def rows(n: int, seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    return [(str(i), *(VALUES[k] for k in rng.integers(0, len(VALUES), 2))) for i in range(n)]


def as_csv(header: list[str], records: list[tuple], end: str = "\n") -> str:
    out = io.StringIO()
    quoted = [",".join("" if v is None else f'"{v.replace(chr(34), chr(34) * 2)}"' for v in r) for r in records]
    out.write(end.join([",".join(header), *quoted]))
    return out.getvalue()


@pytest.mark.parametrize("size", [1, 7, 64, 1000, 1 << 26])
def test_ranges_find_every_record(spark, tmp_path, size):
    n = 12 if size == 1 else 60
    a, b, c = rows(n, 1), rows(n, 2), rows(5, 3)
    (tmp_path / "a.csv").write_text(as_csv(["id", "first", "second"], a), newline="")
    (tmp_path / "b.v2.CSV").write_text(as_csv(["second", "id", "extra"], [(r[2], r[0], r[1]) for r in b], "\r\n") + "\r\n", newline="")
    with gzip.open(tmp_path / "c.csv.gz", "wt", newline="") as out:
        out.write(as_csv(["id", "first", "second"], c))
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,first\n")
    (tmp_path / "sheet.xyz").write_text("?")
    (tmp_path / "old.dat").write_text('id  first second\n1 "two\nlines" x\n2 NA\n3 "say ""so""" "NA"\n4 a b c\n')
    files = ranges.listed(spark, [str(tmp_path)]).unionByName(spark.createDataFrame([(str(tmp_path / "absent.csv"), 5)], "path string, length long"))
    got = ranges.ingest(files, ["id", "first", "second"], size).collect()

    def of(name: str):
        return Counter((r.id, r.first, r.second) for r in got if r.path.endswith(name) and r._problem is None)

    assert of("/a.csv") == Counter(a)
    assert of("b.v2.CSV") == Counter((r[0], None, r[2]) for r in b)
    assert of("c.csv.gz") == Counter(c)
    assert of("old.dat") == Counter([("1", "two\nlines", "x"), ("2", None, None), ("3", 'say "so"', "NA")])
    problems = Counter((r.path.rsplit("/", 1)[-1], r._problem) for r in got if r._problem)
    assert problems == Counter([("sheet.xyz", "no reader"), ("absent.csv", "FileNotFoundError"), ("old.dat", "structure")])
    assert len(list(csv.reader(io.StringIO(as_csv(["id"], [("1",)]))))) == 2


def test_wrong_number_of_fields(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('id,first\n1,a\n2,"b\nc",d\n3\n4,NA\n5,"NA"\n')
    got = ranges.ingest(ranges.listed(spark, [str(tmp_path)]), ["id", "first"], 5).collect()
    assert Counter((r.id, r.first, r._problem, r._record) for r in got) == Counter(
        [("1", "a", None, None), (None, None, "structure", '2,"b\nc",d'), (None, None, "structure", "3"), ("4", None, None, None), ("5", "NA", None, None)]
    )


def test_no_files(spark):
    assert ranges.ingest(spark.createDataFrame([], "path string, length long"), ["id"]).collect() == []
