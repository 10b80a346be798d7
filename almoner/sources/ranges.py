"""Many releases in one job: every file in byte ranges, one plan for all of them.

A quoted value may hold line breaks, so where a record begins depends on the quotes
before it. Each range is read twice: once to count its quotes, which tells, added up over
the ranges before, whether the range begins inside a value; then to read the records
that begin in it, from the first true border to the first one at or behind its end. So a
single large file is as parallel as many small ones, and what a task holds is a range and
the rest of one record.

The listing is a DataFrame and never passes through the driver. Files are read through
Arrow's file systems: local or mounted paths, HDFS and object stores by URI. Quotes
inside values are doubled; a compressed file can't be split and is one range.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almoner.session import ship
from almoner.sources.readers import COMPRESSED

RANGE, BLOCK = 64 << 20, 4 << 20
MOST_TASKS = 20_000
_TOKEN = re.compile(r'"(?:[^"]|"")*"|[^\s"]\S*|\n')


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, length`` of all files below folders; no file is opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length")


def split_files(files: DataFrame, size: int = RANGE) -> DataFrame:
    """Ranges of files: ``path, number, begin, end``. Empty files have one empty range."""
    whole = F.element_at(F.split(F.lower("path"), r"\."), -1).isin(*COMPRESSED)
    length = F.coalesce(F.col("length"), F.lit(0)).cast("long")
    n = F.when(whole, F.lit(1)).otherwise(F.greatest(F.ceil(length / size), F.lit(1)))
    numbered = files.select("path", length.alias("length"), whole.alias("whole"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("number"))
    begin = F.col("number") * size
    return numbered.select("path", "number", begin.alias("begin"), F.when(F.col("whole"), F.lit(1 << 62)).otherwise(F.least(begin + size, F.col("length"))).alias("end"))


def _opened(path: str):
    """The bytes of a file, decompressed if need be, from any place on."""
    if "://" in path or path.startswith("file:"):
        files, path = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    else:
        files = pafs.LocalFileSystem()
    if path.lower().rsplit(".", 1)[-1] in COMPRESSED:
        return io.BytesIO(files.open_input_stream(path).read())
    return files.open_input_file(path)


def _spread(ranges: DataFrame) -> DataFrame:
    return ranges.repartition(max(1, min(ranges.count(), MOST_TASKS)), "path", "number")


def with_states(ranges: DataFrame) -> DataFrame:
    """Ranges with ``inside``: whether they begin inside a quoted value; ``problem`` if a
    file can't be read."""

    def run(batches):
        for batch in batches:
            odd, problems = [], []
            for path, begin, end in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                n, problem = 0, None
                try:
                    with _opened(path) as source:
                        source.seek(begin)
                        while begin < end and (block := source.read(min(BLOCK, end - begin))):
                            n += block.count(b'"')
                            begin += len(block)
                except (OSError, pa.ArrowException) as failed:
                    problem = type(failed).__name__
                odd.append(n % 2)
                problems.append(problem)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(odd, pa.int32()), pa.array(problems, pa.string())], names=["path", "number", "begin", "end", "odd", "problem"])

    ship(ranges.sparkSession)
    counted = _spread(ranges).mapInArrow(run, "path string, number long, begin long, end long, odd int, problem string")
    # a row per range of a file: a few thousand for a file of terabytes
    before = Window.partitionBy("path").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).drop("odd")


def _border(data: bytes, inside: bool) -> int:
    """Place behind the first line break outside quotes, or -1."""
    b = np.frombuffer(data, np.uint8)
    outside = (np.cumsum(b == 34) + inside) % 2 == 0
    found = np.flatnonzero((b == 10) & outside)
    return int(found[0]) + 1 if len(found) else -1


def _upto_border(source, at: int, inside: bool) -> tuple[bytes, bool]:
    """What stands from ``at`` up to and with the next border (or the end)."""
    parts = []
    source.seek(at)
    while block := source.read(BLOCK):
        stop = _border(block, inside)
        if stop >= 0:
            parts.append(block[:stop])
            return b"".join(parts), True
        parts.append(block)
        inside ^= block.count(b'"') % 2 == 1
    return b"".join(parts), False


def _records(source, begin: int, end: int, inside: bool) -> bytes:
    """The records that begin in a range."""
    if begin:
        source.seek(begin - 1)
        inside ^= source.read(1) == b'"'
        skipped, found = _upto_border(source, begin - 1, inside)
        start = begin - 1 + len(skipped)
        if not found or start >= end:
            return b""
    else:
        start = 0
    source.seek(start)
    held = source.read(end - 1 - start)
    tail, _ = _upto_border(source, start + len(held), held.count(b'"') % 2 == 1)
    return held + tail


def _csv(data: bytes, names: list[str]) -> tuple[pa.Table, list[tuple[str, str]]]:
    bad: list[tuple[str, str]] = []

    def skip(row) -> str:
        bad.append(("structure", row.text))
        return "skip"

    table = pacsv.read_csv(
        pa.BufferReader(data),
        pacsv.ReadOptions(use_threads=False, column_names=names, block_size=max(len(data), 1 << 20)),
        pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=skip),
        pacsv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), null_values=["", "NA"], strings_can_be_null=True, quoted_strings_can_be_null=False),
    )
    return table, bad


def _whitespace(data: bytes, names: list[str]) -> tuple[pa.Table, list[tuple[str, str]]]:
    """Records of values between white space; short ones are filled with NULL."""
    rows, bad, row = [], [], []

    def end() -> None:
        if len(row) > len(names):
            bad.append(("structure", " ".join(row)))
        elif row:
            rows.append([None if v == "NA" else v[1:-1].replace('""', '"') if v.startswith('"') else v for v in row] + [None] * (len(names) - len(row)))
        row.clear()

    for token in _TOKEN.findall(data.decode("utf-8", "replace")):
        if token == "\n":
            end()
        else:
            row.append(token)
    end()
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.string()) for n, c in zip(names, columns)}), bad


_PARSERS = {"csv": (_csv, ","), "dat": (_whitespace, None)}


def _kind(path: str) -> str:
    parts = path.lower().rsplit("/", 1)[-1].split(".")
    return parts[-2] if len(parts) > 2 and parts[-1] in COMPRESSED else parts[-1]


def _header(source, separator: str | None) -> tuple[list[str], int]:
    first, _ = _upto_border(source, 0, False)
    text = first.decode("utf-8-sig", "replace").strip("\r\n")
    names = text.split(separator) if separator else text.split()
    return [n.strip('"') for n in names], len(first)


def ingest(files: DataFrame, columns: list[str], size: int = RANGE) -> DataFrame:
    """All records of all files (``path, length``) as text, dispatched by file name.

    Columns a file lacks are NULL, columns not asked for are left out. ``_problem`` is
    set for what isn't a record: one with a wrong number of fields (``structure``, with
    its text in ``_record``), a file of no known kind (``no reader``), one that can't be
    read (the error's name). ``_begin`` is where the record's range begins.
    """
    fields = ["path", "_begin", *columns, "_problem", "_record"]

    def batch_of(path: str, begin: int, table: pa.Table | None, bad: list[tuple[str, str | None]]) -> Iterator[pa.RecordBatch]:
        n, m = (table.num_rows if table is not None else 0), len(bad)
        found = [table[c].combine_chunks() if table is not None and c in table.column_names else pa.nulls(n, pa.string()) for c in columns]
        arrays = [pa.concat_arrays([pa.concat_arrays(f.chunks) if isinstance(f, pa.ChunkedArray) else f, pa.nulls(m, pa.string())]) for f in found]
        problems, records = ([b[i] for b in bad] for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([path] * (n + m), pa.string()),
                pa.array([begin] * (n + m), pa.int64()),
                *arrays,
                pa.array([None] * n + problems, pa.string()),
                pa.array([None] * n + records, pa.string()),
            ],
            names=fields,
        )

    def run(batches):
        for batch in batches:
            for path, number, begin, end, problem, inside in zip(*(c.to_pylist() for c in batch.columns)):
                parser, separator = _PARSERS.get(_kind(path), (None, None))
                if problem or not parser:
                    if number == 0:
                        yield from batch_of(path, 0, None, [(problem or "no reader", None)])
                    continue
                try:
                    with _opened(path) as source:
                        names, header = _header(source, separator)
                        data = _records(source, begin, end, inside)
                    data = data[header:] if begin == 0 else data
                    table, bad = parser(data, names) if data else (None, [])
                except (OSError, pa.ArrowException) as failed:
                    table, bad = None, [(type(failed).__name__, None)]
                if table is not None or bad:
                    yield from batch_of(path, begin, table, bad)

    schema = ", ".join(f"`{c}` {'long' if c == '_begin' else 'string'}" for c in fields)
    stated = with_states(split_files(files, size)).select("path", "number", "begin", "end", "problem", "inside")
    return stated.repartition(max(1, min(stated.sparkSession.sparkContext.defaultParallelism * 4, MOST_TASKS)), "path", "number").mapInArrow(run, schema)
