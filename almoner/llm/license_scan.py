"""License scan by ordered signature rules, within one projection.

Texts become lower-case words between single blanks. A few contained strings gate
all rules, each rule is gated by its keyword, and only then its regex runs. An
interval that lies in a longer one of the same or a better priority is dropped;
of equal intervals the rule that is first in priority and order stays.

Missing texts count as empty; texts without words have no words, places or labels
and score 0. Rows are scanned one by one and whole, so repeated rows, ids and
other columns make no difference, and an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import text_of
from almoner.llm.license_rules import CONFIDENCE, GATES, UNDER, UNDER_HINTS, UNDER_NAMES, Rule, rules

#: The contract's phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_line(text: Column) -> Column:
    """Lower-case words with one blank before, between and after them; ``' '`` for none."""
    line = F.regexp_replace(F.translate(text, UPPER, LOWER), NO_WORD, " ")
    return F.when(F.trim(line) == "", " ").otherwise(F.concat(F.lit(" "), F.trim(line), F.lit(" ")))


def blanks(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" ")))


def contains_any(line: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(line, F.lit(p)) for p in parts])


def detections(line: Column, under: Column, found: list[Rule]) -> Column:
    """Every match of every rule whose keyword is there: start, end, rank, label.
    ``under`` says whether a rule with the keyword ``UNDER`` can match."""
    table = F.array(
        *[
            F.struct(
                F.lit(r.label).alias("label"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.pattern).alias("pattern"),
                F.lit(r.priority).alias("priority"),
                F.lit(i).alias("rank"),
            )
            for i, r in enumerate(found)
        ]
    )

    def matches(rule: Column) -> Column:
        hits = F.regexp_extract_all(line, rule["pattern"], F.lit(0))
        gaps = F.split(line, rule["pattern"], -1)

        def place(hit: Column, i: Column) -> Column:
            before = F.aggregate(F.slice(gaps, F.lit(1), i + 1), F.lit(0), lambda n, g: n + F.char_length(g))
            start = F.aggregate(F.slice(hits, F.lit(1), i), before, lambda n, h: n + F.char_length(h))
            return F.struct(
                start.alias("start"),
                (start + F.char_length(hit)).alias("end"),
                rule["priority"].alias("priority"),
                rule["rank"].alias("rank"),
                rule["label"].alias("label"),
            )

        return F.transform(hits, place)

    kept = F.filter(table, lambda r: F.contains(line, r["keyword"]) | (under & (r["keyword"] == UNDER)))
    return F.flatten(F.transform(kept, matches))


def unsuppressed(found: Column) -> Column:
    """Detections that no better interval contains."""

    def beats(e: Column, d: Column) -> Column:
        longer = (e["end"] - e["start"]) > (d["end"] - d["start"])
        first = (e["priority"] < d["priority"]) | ((e["priority"] == d["priority"]) & (e["rank"] < d["rank"]))
        inside = (e["start"] <= d["start"]) & (e["end"] >= d["end"])
        return inside & ((longer & (e["priority"] <= d["priority"])) | (~longer & first))

    return F.filter(found, lambda d: ~F.exists(found, lambda e: beats(e, d)))


def base_places(line: Column, n_words: Column) -> list[Column]:
    """Per phrase a struct: places, first and last start."""
    out = []
    for phrase in PHRASES:
        at = F.instr(line, f" {phrase} ")
        back = F.instr(F.reverse(line), f" {phrase[::-1]} ")
        after = blanks(F.substring(F.reverse(line), F.lit(1), back)) - 1
        out.append(
            F.when(
                F.contains(line, F.lit(f" {phrase} ")),
                F.struct(
                    (F.size(F.split(line, f" {phrase}(?= )", -1)) - 1).cast("long").alias("n"),
                    (blanks(F.substring(line, F.lit(1), at)) - 1).cast("long").alias("first"),
                    (n_words - after - len(phrase.split())).cast("long").alias("last"),
                ),
            )
        )
    return out


def scanned(docs: DataFrame) -> DataFrame:
    """Per document its words, the base phrases' places, and the detections that stay.

    A detection: label, first word, number of words, priority.
    """
    line = F.col("line")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), words_line(text_of(docs)).alias("line"))
    rows = rows.withColumn("n_words", F.greatest(F.lit(0), blanks(line) - 1).cast("long"))
    rows = rows.withColumn("under", contains_any(line, UNDER_HINTS) & line.rlike(UNDER_NAMES))
    gate = contains_any(line, GATES) | F.col("under")
    rows = rows.select("doc_id", "n_words", "line", "under", F.when(gate, F.array_compact(F.array(*base_places(line, F.col("n_words"))))).alias("base"), gate.alias("gate"))
    rows = rows.withColumn("found", F.when(F.col("gate"), detections(line, F.col("under"), rules())))
    spans = F.transform(
        unsuppressed(F.col("found")),
        lambda d: F.struct(
            d["label"].alias("label"),
            (blanks(F.substring(line, F.lit(1), d["start"])) - 1).cast("long").alias("first_word"),
            (blanks(F.substring(line, d["start"] + 1, d["end"] - d["start"])) + 1).cast("long").alias("n_words"),
            d["priority"].alias("priority"),
        ),
    )
    labels = F.array_compact(F.array(*[F.when(F.contains(line, F.lit(f" {p} ")), F.lit(label)) for p, label in PHRASES.items()]))
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce("base", F.array().cast("array<struct<n:bigint,first:bigint,last:bigint>>")).alias("base"),
        F.array_sort(F.when(F.col("gate"), labels).otherwise(F.array().cast("array<string>"))).alias("base_labels"),
        F.when(F.col("gate"), spans).otherwise(F.array().cast("array<struct<label:string,first_word:bigint,n_words:bigint,priority:int>>")).alias("detections"),
    )


def licenses(docs: DataFrame) -> DataFrame:
    """The scan in a row per document."""
    best = F.array_min(F.transform("detections", lambda d: d["priority"]))
    return scanned(docs).select(
        "doc_id",
        "n_words",
        F.aggregate("base", F.lit(0).cast("long"), lambda n, b: n + b["n"]).alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.transform("detections", lambda d: d["label"]))), ",").alias("labels"),
        F.when(F.size("detections") > 0, F.get(F.array(*[F.lit(c) for c in CONFIDENCE]), best))
        .when(F.size("base_labels") > 0, 0.5)
        .otherwise(0.0)
        .alias("score"),
        "detections",
    )
