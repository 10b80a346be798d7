"""Published counts replayed as weighted rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from almoner.functions import codes, taxonomy
from almoner.operators import derive, reports
from almoner.operators.derive import literal_frame
from tests import golden


@pytest.fixture(scope="module")
def by_pf_code(spark):
    """(type, PF code, n), one row per cell of the published crosstab."""
    cells = [
        (None if t is None else "501C_" + t, code, n)
        for t, *row in golden.TYPE_BY_PF_CODE
        for code, n in zip([0, 1, 2, 3, None], row)
        if n
    ]
    frame = literal_frame(spark, cells, "ORG_TYPE_501C string, BMF_PF_FILING_REQ_CODE int, n long")
    return frame.withColumn("ORG_TYPE_PF", codes.org_type_pf(F.col("BMF_PF_FILING_REQ_CODE")))


def totals(df, column):
    rows = df.groupBy(F.col(column).cast("string").alias("v")).agg(F.sum("n").alias("n")).collect()
    return {r.v: r.n for r in rows}


def test_published_tables_agree():
    assert sum(n for _, n in golden.TYPE_COUNTS) == golden.TOTAL
    assert sum(n for _, n in golden.FILING_COUNTS) == golden.TOTAL
    assert {t: sum(row) for t, *row in golden.TYPE_BY_PF_CODE} == dict(golden.TYPE_COUNTS)


def test_pf_codes_before_and_after_imputation(by_pf_code):
    assert totals(by_pf_code, "BMF_PF_FILING_REQ_CODE") == golden.PF_COUNTS
    imputed = derive.impute_non_pf(by_pf_code)
    assert totals(imputed, "BMF_PF_FILING_REQ_CODE") == golden.PF_IMPUTED
    assert totals(imputed, "ORG_TYPE_PF") == {
        "0": golden.PF_IMPUTED["0"], "1": 150656 + 21 + 237, None: golden.PF_IMPUTED[None],
    }


def test_filing_codes(spark):
    raw = literal_frame(spark, golden.FILING_COUNTS, "code int, n long")
    padded = raw.select(codes.pad_code(codes.strip_filing_code(F.col("code"))).alias("code"), "n")
    assert totals(padded, "code") == golden.FILING_RECODED
    labelled = padded.select(codes.label_of("BMF_FILING_REQ_CODE", F.col("code")).alias("code"), "n")
    found = totals(labelled, "code")
    assert found[None] == golden.FILING_RECODED[None] + golden.FILING_RECODED["21"]
    assert found["990-N (02)"] == 1602190
    assert sum(found.values()) == golden.TOTAL


@pytest.fixture(scope="module")
def types(spark):
    rows = [(None if t is None else int(t), n) for t, n in golden.TYPE_COUNTS]
    frame = literal_frame(spark, rows, "BMF_SUBSECTION_CODE int, n long")
    return frame.withColumn("ORG_TYPE_501C", codes.org_type_501c(F.col("BMF_SUBSECTION_CODE")))


def test_type_frequencies(types):
    rows = reports.frequency(types, "ORG_TYPE_501C", weight="n").collect()
    assert len(rows) == 40
    assert (rows[0].value, rows[0].n) == ("501C_03", 2503387)
    assert [r.n for r in rows] == sorted((r.n for r in rows), reverse=True)
    assert {r.value: r.n for r in rows}[None] == 187369


def test_hierarchy(types):
    subtypes = reports.subtype_counts(types, weight="n")
    assert subtypes.count() == 33
    assert reports.hierarchy_edges(subtypes).count() == 33
    vertices = {r.name: r for r in reports.hierarchy_vertices(subtypes).collect()}
    assert len(vertices) == 41
    for name, size in golden.VERTEX_SIZES.items():
        assert vertices[name].size == pytest.approx(size, abs=1e-5)
    groups = [v for v in vertices.values() if v.type.endswith("_X")]
    assert len(groups) == 8 and all(v.size == 0 for v in groups)


def test_subsection_notes(types):
    rows = {r.code: r for r in reports.reconcile_subsections(types, weight="n").collect()}
    notes = {code: r.note for code, r in rows.items()}
    assert [c for c in sorted(notes) if notes[c] == "missing from first list"] == ["80", "82", "90", "91", "93", "CO"]
    assert [c for c in sorted(notes) if notes[c] == "different meaning"] == ["92"]
    assert notes["29"] == "missing from second list" and notes["00"] == "in neither list"
    assert rows["03"].n == 2503387 and rows["22"].n == 0 and notes["03"] is None


def test_mission_codes(spark):
    rows = literal_frame(spark, [(c,) for c in golden.NTEEV2], "code string")
    found = {r.code: r.v for r in rows.select("code", taxonomy.nteev2(F.col("code")).alias("v")).collect()}
    assert found == golden.NTEEV2


PURPOSES = [
    (3, 1, "Charitable Organization (501C3-1)"),
    (3, 7, "Religious Organization (501C3-7)"),
    (3, 12, "Charitable Organization (501C3-1) ;; Educational Organization (501C3-2)"),
    (3, 21, "Charitable Organization (501C3-1) ;; Educational Organization (501C3-2)"),
    (3, 17, "Charitable Organization (501C3-1) ;; Religious Organization (501C3-7)"),
    (3, 11, "Charitable Organization (501C3-1) ;; Charitable Organization (501C3-1)"),
    (4, 3, "Social Welfare Organization (501C4-3)"),
    (19, 1, "Post or Organization of War Veterans (501C19-1)"),
    (3, 9, ""),
    (98, 1, ""),
    (3, 90, ""),
    (None, 1, None),
    (3, None, None),
]


def test_purposes(spark):
    rows = literal_frame(spark, PURPOSES, "s int, c int, expected string")
    got = rows.select("*", codes.tax_exempt_purpose(F.col("s"), F.col("c")).alias("got")).collect()
    assert [r.got for r in got] == [r.expected for r in got]
