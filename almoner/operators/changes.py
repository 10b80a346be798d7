"""Reports kept up to date by what a refresh changes.

A report counts organizations by the values of some columns. Between two states of the
unified table (``plans.unified``) only organizations change that a delivery mentions: each
gives -1 for the values it had and +1 for those it has now. A report is a table of such
counts by version; adding the changes of a version to it gives the next one without
reading the table. Changes are sums, so they may be added in any order and grouping, and
late releases, which states sort out by age, need nothing special.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.plans.unified import YEARS, merged_states


def _values(state: DataFrame, columns: list[str]) -> DataFrame:
    """Per organization the values of a state's columns, as text."""
    known = {c.lower() for c in state.columns}
    return state.select("EIN", *[(F.col(f"{c}.value") if c.lower() in known else F.lit(None)).cast("string").alias(c) for c in columns])


def _rows(values: DataFrame, columns: list[str], sign: int) -> DataFrame:
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("value")) for c in columns]))
    return values.select(entry.alias("e")).select("e.variable", "e.value", F.lit(sign).cast("long").alias("n"))


def counted(changes: DataFrame) -> DataFrame:
    """Counts by variable and value, without those that cancel out."""
    return changes.groupBy("variable", "value").agg(F.sum("n").alias("n")).where("n <> 0")


def full_report(state: DataFrame, columns: list[str]) -> DataFrame:
    """The report of a whole state; every organization counts once a variable, also with
    a missing value."""
    return counted(_rows(_values(state, columns), columns, 1))


def report_changes(state: DataFrame, delivery: DataFrame, columns: list[str]) -> DataFrame:
    """What the state of a ``delivery`` changes in the report of ``state``.

    Only the delivery's organizations are merged; they are few beside the state's, which
    is read once, for the columns of the report, and filtered by their EIN.
    """
    wanted = [c for c in (*columns, YEARS) if c in state.columns or c in delivery.columns]
    mentioned = delivery.select("EIN").distinct()
    before = state.select("EIN", *[c for c in wanted if c in state.columns]).join(mentioned, "EIN", "left_semi")
    after = merged_states(before, delivery.select("EIN", *[c for c in wanted if c in delivery.columns]))
    gone, come = _rows(_values(before, columns), columns, -1), _rows(_values(after, columns), columns, 1)
    return counted(gone.unionByName(come))


def updated(report: DataFrame, *changes: DataFrame) -> DataFrame:
    """A report with the changes of one or more refreshes."""
    for change in changes:
        report = report.unionByName(change)
    return counted(report)
