"""Frequency tables, crosstabs and the tables behind the report figures.

Every count is aggregated before it is shuffled, so a value that makes up a
large part of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.fixed import dictionaries
from almoner.functions import codes
from almoner.operators.derive import dictionary_frame, literal_frame

MISSING = "NA"


def counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Rows (or total weight) per value, with a row for NULL if there is one."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")
    return df.groupBy(F.col(column).alias("value")).agg(n.alias("n"))


def frequency(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Counts per value, most frequent first, ties in value order, NULL last."""
    return counts(df, column, weight).orderBy(F.desc("n"), F.asc_nulls_last("value"))


def proportions(df: DataFrame, column: str, digits: int = 3) -> DataFrame:
    """Share of all rows, NULL included, per value, largest first."""
    per_value = counts(df, column)
    total = per_value.agg(F.sum("n").alias("total")).scalar()
    return per_value.select(
        "value", "n", F.round(F.col("n") / total, digits).alias("share")
    ).orderBy(F.desc("n"), F.asc_nulls_last("value"))


def frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts per value of several columns in one pass over the data."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        text.unpivot([], columns, "variable", "value")
        .groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def level_frequencies(df: DataFrame, variables: dict[str, bool]) -> DataFrame:
    """Counts per dictionary level of several labelled columns in one pass, with
    a row for NULL if there is one. A variable mapped to True keeps the levels
    nobody uses, with 0. Columns: variable, ord, label, n."""
    one, none = F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("n")
    observed = (
        df.select(*variables)
        .unpivot([], list(variables), "variable", "label")
        .select("variable", "label", one)
    )
    unused = [
        (variable, label)
        for variable, keep in variables.items()
        for _, label in dictionaries.code_labels(variable)
        if keep and label is not None
    ]
    if unused:
        levels = literal_frame(df.sparkSession, unused, "variable string, label string")
        observed = observed.unionByName(levels.select("variable", "label", none))
    order = F.lit(None).cast("int")
    for variable in variables:
        order = F.when(F.col("variable") == variable, label_order(variable, F.col("label"))).otherwise(order)
    return (
        observed.groupBy("variable", "label")
        .agg(F.sum("n").alias("n"))
        .select("variable", order.alias("ord"), "label", "n")
        .orderBy("variable", F.asc_nulls_last("ord"))
    )


def level_frequency(df: DataFrame, variable: str) -> DataFrame:
    """Counts per dictionary level of a labelled column: level order, levels
    nobody uses kept with 0, and a last row for NULL if there is one."""
    return level_frequencies(df, {variable: True}).drop("variable")


def used_level_frequency(df: DataFrame, variable: str) -> DataFrame:
    """Counts per used level of a labelled column, in level order."""
    return level_frequencies(df, {variable: False}).drop("variable")


def alphabetical_frequency(df: DataFrame, column: str) -> DataFrame:
    """Counts per value in value order, NULL last."""
    return counts(df, column).orderBy(F.asc_nulls_last("value"))


def label_order(variable: str, label: Column) -> Column:
    """1-based level position of a label."""
    order = {
        text: str(i)
        for i, (_, text) in enumerate(dictionaries.code_labels(variable), start=1)
        if text is not None
    }
    return codes.lookup_text(order, label).cast("int")


def formatted(df: DataFrame, column: str, decimals: int = 0) -> DataFrame:
    """Display text of a number: thousands separators, fixed decimals."""
    return df.withColumn(column, F.format_number(column, decimals))


def crosstab(df: DataFrame, rows: str, columns: str, values: list, with_missing: bool = True) -> DataFrame:
    """Two-way counts: one output column per listed value, ``n_other`` for all
    values that aren't listed, zeros filled in. With ``with_missing``, NULL is a
    row (with NULL as its value) and a column ``n_missing`` of its own; without
    it, rows with a NULL on either side are left out. Either way the counts of a
    row add up to its number of records."""
    names = [str(v) for v in values]
    other = F.col("other")
    pair = df.select(F.col(rows).cast("string").alias("value"), F.col(columns).cast("string").alias("other"))
    if not with_missing:
        pair = pair.dropna()
    counts = [F.count_if(other == v).alias(f"n_{v}") for v in names]
    counts.append(F.count_if(other.isNotNull() & ~other.isin(names)).alias("n_other"))
    if with_missing:
        counts.append(F.count_if(other.isNull()).alias("n_missing"))
    return pair.groupBy("value").agg(*counts)


def agreement(df: DataFrame, left: str, right: str) -> DataFrame:
    """Counts of every pair of values two columns take, NULLs left out."""
    return (
        df.select(left, right)
        .dropna()
        .groupBy(left, right)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def gathered_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Several columns gathered to key and value, counted per pair, NULL counted."""
    return (
        df.select(*columns)
        .unpivot([], columns, "key", "value")
        .groupBy("key", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def histograms(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bar heights of several integer columns, one pass, NULL not drawn."""
    return (
        gathered_counts(df, columns)
        .where(F.col("value").isNotNull())
        .select(F.col("key").alias("measure"), "value", "n")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def codebook(df: DataFrame, variable: str, column: str, show: list[str]) -> DataFrame:
    """Codebook entries of a variable (the chosen dictionary columns) next to
    the number of organizations carrying each code; unused codes show 0."""
    entries = dictionary_frame(df.sparkSession, [variable])
    used = counts(df.select(codes.level_of(variable, F.col(column)).alias("ord")), "ord")
    return (
        entries.join(used, F.col("ord") == F.col("value"), "left")
        .select("ord", *show, F.coalesce("n", F.lit(0).cast("long")).alias("n"))
        .orderBy("ord")
    )


def subtype_counts(df: DataFrame, column: str = "ORG_TYPE_501C", weight: str | None = None) -> DataFrame:
    """Counts per 501(c) type with its function group; types without a group drop out."""
    groups = dict(dictionaries.EXEMPT_SUBTYPE)
    return (
        counts(df, column, weight)
        .select(
            F.col("value").alias("type_501c"),
            "n",
            codes.lookup_text(groups, F.col("value")).alias("exempt_subtype"),
        )
        .where(F.col("exempt_subtype").isNotNull())
    )


def hierarchy(subtypes: DataFrame) -> DataFrame:
    """Edges and vertices of the group -> type hierarchy, told apart by ``kind``.

    Edges lead from ``source`` to ``name``. Vertices are the types, sized by the
    root of their count, and the groups, without a size. Each type contributes
    its rows where it is, so the counts are made once.
    """
    def row(kind: str, source: Column, name: str, size: Column, kind_of: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), source.alias("source"), F.col(name).alias("name"),
            size.alias("size"), kind_of.alias("type"),
        )

    group, text, number = F.col("exempt_subtype"), F.lit(None).cast("string"), F.lit(None).cast("double")
    rows = F.array(
        row("edge", group, "type_501c", number, text),
        row("vertex", text, "type_501c", F.sqrt("n"), group),
        row("vertex", text, "exempt_subtype", F.lit(0.0), F.concat(group, F.lit("_X"))),
    )
    return subtypes.select(F.explode(rows).alias("row")).select("row.*").distinct()


def hierarchy_edges(subtypes: DataFrame) -> DataFrame:
    return hierarchy(subtypes).where(F.col("kind") == "edge").select("source", F.col("name").alias("target"))


def hierarchy_vertices(subtypes: DataFrame) -> DataFrame:
    return hierarchy(subtypes).where(F.col("kind") == "vertex").select("name", "size", "type")


def treemap(df: DataFrame, variable: str) -> DataFrame:
    """Counts per level with the colour slot (rank by count) and the running id
    (level order). Windows run over the levels of one dictionary, never over
    organizations."""
    levels = level_frequency(df, variable).where(F.col("label").isNotNull())
    by_count = Window.orderBy(F.desc("n"), F.asc("ord"))
    by_level = Window.orderBy("ord")
    return levels.select(
        "label",
        "n",
        F.row_number().over(by_count).alias("colour_slot"),
        F.row_number().over(by_level).alias("id"),
    )


def imputation_effect(before: DataFrame, after_values: dict[str, Column], digits: int = 3) -> DataFrame:
    """Distribution of columns before and after an imputation, from one pass:
    every row contributes its old and its new value."""
    cases = F.array(
        *[
            F.struct(
                F.lit(stage).alias("stage"),
                F.lit(name).alias("variable"),
                value.cast("string").alias("value"),
            )
            for name, after in after_values.items()
            for stage, value in (("before", F.col(name)), ("after", after))
        ]
    )
    per_value = (
        before.select(F.explode(cases).alias("case"))
        .groupBy("case.stage", "case.variable", "case.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    everything = Window.partitionBy("stage", "variable")
    return per_value.withColumn(
        "share", F.round(F.col("n") / F.sum("n").over(everything), digits)
    )


def reconcile_subsections(df: DataFrame, column: str = "BMF_SUBSECTION_CODE", weight: str | None = None) -> DataFrame:
    """Observed subsection codes against the two official code lists: which list
    has a code, and a note where only one does or the two mean different things."""
    from almoner.fixed.crosswalk import SUBSECTION_CODES

    first = SUBSECTION_CODES
    second = dict(dictionaries.SECOND_SUBSECTION_LIST)
    listed = literal_frame(
        df.sparkSession,
        [(code, first.get(code), second.get(code)) for code in sorted({*first, *second})],
        "code string, first_label string, second_label string",
    )
    observed = counts(
        df.select(codes.pad_code(F.col(column)).alias("code"), *([weight] if weight else [])), "code", weight
    ).where(F.col("value").isNotNull())
    return (
        listed.join(observed.withColumnRenamed("value", "code"), "code", "full")
        .select(
            "code",
            F.coalesce("n", F.lit(0).cast("long")).alias("n"),
            "first_label",
            "second_label",
            F.when(F.col("code").isin(*dictionaries.SUBSECTION_DIFFERS), "different meaning")
            .when(F.col("first_label").isNull() & F.col("second_label").isNotNull(), "missing from first list")
            .when(F.col("second_label").isNull() & F.col("first_label").isNotNull(), "missing from second list")
            .when(F.col("first_label").isNull(), "in neither list")
            .alias("note"),
        )
    )
