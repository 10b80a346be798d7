"""Exact dedup by tree-merging sorted runs of digests.

Every input partition is a run: its texts' digests in order, each once, with the winning
row and the number of rows. In binomial rounds neighbouring runs are exchanged and merged
by sort-merge joins: two sorted streams go side by side, a digest that both have becomes
one entry with the better winner. ``FAN_IN`` runs meet in a tree of such merges between
two stored tables, so after ``log(runs)`` rounds one run is left, and a lost executor
costs one round. A digest is in a run once at most, also when a third of all rows are
copies of one text, so no merge has a hot key; only digests travel, never texts.

A match is verified at every level by a second independent hash and the length in
bytes, which are part of what is compared: texts that share a digest by accident stay
apart.

Missing texts count as empty ones; empty texts are equal to each other. Of equal
texts the row with the largest ``doc_id`` stays (a missing id loses against any
other); of repeated rows, with the same id and text, one stays. An empty table
gives an empty result; other columns are ignored or, in ``deduplicated``, kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import fresh, numbered, text_of
from almoner.session import written

FAN_IN = 8
KEY = ["digest", "second", "n_bytes"]


def digests(docs: DataFrame, row: str | None = None) -> DataFrame:
    """One narrow row per document, stored: row number, run, id and digests."""
    text = text_of(docs)
    number = F.col(row) if row else F.monotonically_increasing_id()
    return written(
        docs.select(
            number.alias("row"),
            F.spark_partition_id().alias("run"),
            docs["doc_id"].cast("long").alias("doc_id"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.xxhash64(text).alias("second"),
            F.octet_length(text).alias("n_bytes"),
        ),
        "digests",
    )


def merged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two families of runs, merged run by run: both are read in order of their digests."""
    ours = left.withColumnsRenamed({"winner": "winner0", "group_size": "size0"})
    theirs = right.withColumnsRenamed({"winner": "winner1", "group_size": "size1"})
    none = F.lit(0).cast("long")
    return ours.hint("merge").join(theirs, ["run", *KEY], "full").select(
        "run",
        *KEY,
        F.greatest("winner0", "winner1").alias("winner"),
        (F.coalesce("size0", none) + F.coalesce("size1", none)).alias("group_size"),
    )


def merge_round(runs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Each ``fan_in`` neighbouring runs as one: a tree of merges, its result stored in order."""
    run = F.col("run")
    members = [runs.where(run % fan_in == k).withColumn("run", F.floor(run / fan_in).cast("int")) for k in range(fan_in)]
    while len(members) > 1:
        members = [merged(*members[i : i + 2]) if i + 1 < len(members) else members[i] for i in range(0, len(members), 2)]
    return written(members[0].sortWithinPartitions("run", *KEY), "runs")


def classes(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: its key, the row that stays, the group's size."""
    last = rows.agg(F.max("run")).first()[0] or 0
    own = rows.groupBy("run", *KEY).agg(
        F.max(F.struct("doc_id", "row")).alias("winner"),
        F.count(F.lit(1)).alias("group_size"),
    )
    runs = written(own.sortWithinPartitions("run", *KEY), "runs")
    while last > 0:
        runs, last = merge_round(runs, fan_in), last // fan_in
    return runs.select(*KEY, "winner", "group_size")


def marked(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Every row with the id that stays, its group's size and whether it stays."""
    return rows.join(classes(rows, fan_in), KEY).select(
        "row",
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("winner.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def duplicates(docs: DataFrame) -> DataFrame:
    """One row per document, dropped ones too."""
    return marked(digests(docs)).drop("row")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    row = fresh(docs, "row")
    stored = written(numbered(docs, row), "dedup")
    dropped = marked(digests(stored, row)).filter(~F.col("kept")).select(F.col("row").alias(row))
    return stored.join(dropped, row, "left_anti").drop(row)
