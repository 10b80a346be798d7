"""NULL handling, padding and order rules, one unit each."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from almoner.fixed import crosswalk as xw
from almoner.fixed import dictionaries
from almoner.fixed.columns import FINAL_COLUMNS, LABELLING_COLUMNS
from almoner.functions import codes, geography, taxonomy
from almoner.operators import address, census, derive, harmonize, reports, unify
from almoner.operators.derive import literal_frame

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def values(df, *columns):
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_fixed_tables_have_the_expected_size():
    sizes = {v: len(dictionaries.entries(v)) for v in dictionaries.VARIABLES}
    assert len(sizes) == 14
    assert sizes["BMF_TAX_EXEMPT_PURP"] == 55 and sizes["BMF_FOUNDATION_CODE"] == 18
    assert len(xw.crosswalk_rows()) == 70 and len(xw.legacy_names()) == 55
    assert sum(len(olds) > 1 for olds in xw.legacy_names().values()) == 14
    assert len(xw.SUBSECTION_CODES) == 35 and len(xw.CLASSIFICATION_CODES) == 55
    assert len(FINAL_COLUMNS) == 52 and len(LABELLING_COLUMNS) == 51
    assert len(dictionaries.EXEMPT_SUBTYPE) == 37


def test_padding_never_truncates(spark):
    df = literal_frame(spark, [("3",), ("12",), ("888",), (None,)], "c string")
    assert values(df, codes.pad_code(F.col("c"))) == ["03", "12", "888", None]


def test_ein2(spark):
    df = literal_frame(spark, [(10000001,), (123456789,)], "EIN long")
    assert values(unify.with_ein2(df), "EIN", "EIN2") == [
        ("010000001", "EIN-01-0000001"), ("123456789", "EIN-12-3456789"),
    ]


def test_pf_flag_keeps_null(spark):
    df = literal_frame(spark, [(0,), (1,), (3,), (4,), (None,)], "c int")
    assert values(df, codes.org_type_pf(F.col("c"))) == [0, 1, 1, 0, None]


def test_imputation_overwrites_but_not_for_unknown_types(spark):
    rows = [("501C_50", 1, 1), ("501C_03", 1, 1), ("501C_92", None, None), (None, 1, 1), ("501C_04", None, None)]
    df = literal_frame(spark, rows, "ORG_TYPE_501C string, ORG_TYPE_PF int, BMF_PF_FILING_REQ_CODE int")
    out = values(derive.impute_non_pf(df), "ORG_TYPE_PF", "BMF_PF_FILING_REQ_CODE")
    assert out == [(0, 0), (1, 1), (None, None), (1, 1), (0, 0)]


def test_affiliation_counts_null_as_outside_the_network(spark):
    rows = [(0, None), (0, 1), (0, 2), (0, 9), (1234, 9), (None, 9), (1234, None)]
    df = literal_frame(spark, rows, "BMF_GROUP_EXEMPT_NUM int, BMF_AFFILIATION_CODE int")
    assert values(derive.impute_affiliation(df), "BMF_AFFILIATION_CODE") == [3, 1, 2, 3, 9, 9, None]


@pytest.mark.parametrize(
    "code, stripped",
    [("10", "1"), ("130", "13"), ("100", "1"), ("0", "0"), ("888", None), ("21", "21"), (None, None), ("00", "0"), ("8880", None), ("A0", "A0")],
)
def test_filing_strip(spark, code, stripped):
    df = literal_frame(spark, [(code,)], "c string")
    assert values(df, codes.strip_filing_code(F.col("c"))) == [stripped]


def test_pf_override_reaches_null_filing_codes(spark):
    df = literal_frame(spark, [(None, 1), (0, 2), (20, 0), (888, None), (10, None)], "f int, p int")
    assert values(df, codes.filing_code(F.col("f"), F.col("p"))) == ["PF", "PF", "02", None, "01"]


def test_labels_of_text_and_number_codes_agree(spark):
    df = literal_frame(spark, [("1",), ("01",), ("99",), ("CO",), (None,)], "c string")
    label = codes.label_of("BMF_STATUS_CODE", F.col("c"))
    one = "Unconditional Exemption (01)"
    assert values(df, label) == [one, one, None, None, None]
    df = literal_frame(spark, [("",), ("O",), ("o",)], "c string")
    assert values(df, codes.label_of("NCCS_LEVEL_2", F.col("c"))) == [None, "OPERATING (O)", None]


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 99)), st.one_of(st.none(), st.integers(0, 10**7))), min_size=1, max_size=60))
def test_purposes_match_brute_force(spark, pairs):
    labels = dict(dictionaries.code_labels("BMF_TAX_EXEMPT_PURP"))

    def brute(s, c):
        if s is None or c is None:
            return None
        keys = sorted(f"{s}-{d}" for d in str(c))
        return " ;; ".join(labels[k] for k in keys if k in labels)

    df = literal_frame(spark, pairs, "s int, c int")
    assert values(df, codes.tax_exempt_purpose(F.col("s"), F.col("c"))) == [brute(*p) for p in pairs]


def test_mission_code_edges(spark):
    rows = ["B40", "B4012", "E2001", "E0120", "A12", "A04", "Z99", "b29", "B2", "", "B290", "B2912", "B01"]
    df = literal_frame(spark, [(r,) for r in rows], "c string")
    found = dict(values(df, "c", taxonomy.nteev2(F.col("c"))))
    assert found["B40"] == "UNI-B40-RG"
    assert found["B4012"] == "UNI-B40-RG"
    assert found["E0120"] == "HOS-E20-AA"
    assert found["A12"] == "ART-A00-MM"
    assert found["A04"] == "ART-A00-RG"
    assert found["Z99"] == "UNU-Z99-RG"
    assert found["B290"] == "EDU-B29-RG"
    assert found["b29"] is None and found["B2"] is None and found[""] is None


def test_mission_levels(spark):
    df = literal_frame(spark, [("EDU-B29-RG",), (None,)], "NTEEV2 string")
    out = values(derive.with_ntee_levels(df), *[f"NTEE{i}" for i in range(1, 6)])
    assert out == [("EDU", "B", "B2", "B29", "RG"), (None,) * 5]
    with pytest.raises(ValueError):
        taxonomy.ntee_level(F.col("NTEEV2"), 6)


def test_rename_takes_the_first_filled_legacy_column(spark):
    df = literal_frame(
        spark,
        [("1", " ", "0777", "x"), ("2", "0555", "0777", "y"), ("3", None, None, "z")],
        "EIN string, GROUP string, GEN string, TAPE string",
    )
    renamed = harmonize.rename_columns(df)
    assert values(renamed, "F990_ORG_EIN", "BMF_GROUP_EXEMPT_NUM") == [("1", "0777"), ("2", "0555"), ("3", None)]
    assert "TAPE" in renamed.columns
    assert "TAPE" not in harmonize.drop_unknown(renamed).columns


def test_casts(spark):
    df = literal_frame(
        spark,
        [("3", "12", " 01 ", "10.5", "10000001"), ("CO", "1", "x", "n/a", ""), (None, "", "", "", None)],
        "SUBSECTION string, CLASSIFICATION string, STATUS string, ASSETS string, EIN string",
    )
    out = harmonize.harmonize(df)
    assert values(out, "BMF_SUBSECTION_CODE", "BMF_CLASSIFICATION_CODE", "BMF_STATUS_CODE", "F990_TOTAL_ASSETS", "F990_ORG_EIN") == [
        ("03", "12", 1, 10.5, "010000001"), ("CO", "1", None, None, None), (None,) * 5,
    ]


def test_select_strict_rejects_absent_columns(spark):
    with pytest.raises(AnalysisException):
        derive.select_strict(spark.range(1), ["id", "absent"])


def test_upsert_keeps_known_values(spark):
    old = literal_frame(spark, [("1", "a", 1), ("2", "b", 2)], "EIN string, x string, y int")
    new = literal_frame(spark, [("2", None, 5, "n"), ("3", "c", 6, "n")], "EIN string, x string, y int, z string")
    out = {r.EIN: tuple(r) for r in unify.upsert(old, new).collect()}
    assert out == {"1": ("1", "a", 1, None), "2": ("2", "b", 5, "n"), "3": ("3", "c", 6, "n")}


def test_a_late_release_does_not_overwrite(spark):
    old = literal_frame(spark, [("1", 2001, "new", None)], "EIN string, VINTAGE int, name string, x int")
    late = literal_frame(spark, [("1", 1990, "old", 5)], "EIN string, VINTAGE int, name string, x int")
    assert values(unify.upsert(old, late), "EIN", "VINTAGE", "name", "x") == [("1", 2001, "new", 5)]


def test_eins_are_checked(spark):
    df = literal_frame(spark, [("12-3456789",), ("1234567890",), ("x",), (" 12 ",), (None,)], "e string")
    assert values(df, codes.padded_ein(F.col("e"))) == ["123456789", None, None, "000000012", None]


def test_activity_codes_keep_zeros_and_losses_are_counted(spark):
    df = literal_frame(spark, [("029059179", "x", "7"), ("1", "2", None)], "BMF_ACTIVITY_CODE string, BMF_ASSET_CODE string, F990_ORG_EIN string")
    assert values(harmonize.cast_columns(df), "BMF_ACTIVITY_CODE", "BMF_ASSET_CODE") == [("029059179", None), ("1", 2)]
    assert values(harmonize.lost_values(df), "column", "n") == [("BMF_ASSET_CODE", 1)]


def test_purpose_merge_kinds(spark):
    orgs = literal_frame(spark, [("EIN-1", 3, 1), ("EIN-2", None, 1), ("EIN-3", 3, 9)], "EIN2 string, BMF_SUBSECTION_CODE int, BMF_CLASSIFICATION_CODE int")
    side = derive.purpose_table(orgs)
    assert derive.merge_purpose(orgs, side, "inner").count() == 2
    kept = {r.EIN2: r.BMF_TAX_EXEMPT_PURP for r in derive.merge_purpose(orgs, side).collect()}
    assert kept == {"EIN-1": "Charitable Organization (501C3-1)", "EIN-2": None, "EIN-3": ""}


def test_frequency_order(spark):
    df = literal_frame(spark, [("b",), ("a",), ("a",), ("c",), (None,), (None,), ("b",)], "c string")
    assert values(reports.frequency(df, "c"), "value", "n") == [("a", 2), ("b", 2), (None, 2), ("c", 1)]
    assert values(reports.alphabetical_frequency(df, "c"), "value") == ["a", "b", "c", None]
    assert values(reports.proportions(df, "c"), "share") == [0.286, 0.286, 0.286, 0.143]


def test_levels_keep_their_order_and_zeros(spark):
    df = literal_frame(spark, [("$1 to $10k",), ("$0",), (None,), ("$0",)], "BMF_ASSET_LEVEL string")
    every = values(reports.level_frequency(df, "BMF_ASSET_LEVEL"), "ord", "label", "n")
    assert every[0] == (1, "$0", 2) and every[1] == (2, "$1 to $10k", 1) and every[2][2] == 0
    assert every[-1] == (None, None, 1) and len(every) == 11
    used = values(reports.used_level_frequency(df, "BMF_ASSET_LEVEL"), "label", "n")
    assert used == [("$0", 2), ("$1 to $10k", 1), (None, 1)]


def test_crosstab_has_na_and_zeros(spark):
    df = literal_frame(spark, [("a", 1), ("a", None), (None, 1)], "r string, c int")
    out = {r.value: (r.n_1, r.n_2, r.n_other, r.n_missing) for r in reports.crosstab(df, "r", "c", [1, 2]).collect()}
    assert out == {"a": (1, 0, 0, 1), None: (1, 0, 0, 0)}
    assert values(reports.crosstab(df, "r", "c", [1, 2], with_missing=False), "value", "n_1", "n_2") == [("a", 1, 0)]


def test_crosstab_counts_every_row(spark):
    df = literal_frame(spark, [("x", "1"), ("x", "9"), ("x", "NA"), ("x", None)], "r string, c string")
    row = reports.crosstab(df, "r", "c", [1]).collect()[0]
    assert tuple(row) == ("x", 1, 2, 1)


def test_treemap_ties_follow_level_order(spark):
    df = literal_frame(spark, [("TRUST (2)",), ("UDC (0)",)], "ORG_CORP_FORM string")
    rows = {r.label: (r.n, r.colour_slot, r.id) for r in reports.treemap(df, "ORG_CORP_FORM").collect()}
    assert rows["UDC (0)"] == (1, 1, 1) and rows["TRUST (2)"] == (1, 2, 3)
    assert rows["UDC (6)"] == (0, 7, 7)


ADDRESSES = {
    "12 Main St": (False, False, False, False),
    "PO Box 7": (False, True, False, False),
    "p.o. BOX 9": (False, True, False, False),
    "RR 2": (False, False, True, False),
    "Harry Lane": (False, False, True, True),
    "5 A&B Rd": (True, False, False, False),
    "٣ Street": (False, False, False, False),
}


def test_address_flags(spark):
    df = literal_frame(spark, [(a,) for a in ADDRESSES] + [(None,)], "ORG_ADDR_FULL string")
    flagged = {r[0]: tuple(r)[1:] for r in address.with_difficulty_flags(df).collect()}
    assert flagged == {**ADDRESSES, None: (None,) * 4}
    hard = values(address.difficult_addresses(df), "ORG_ADDR_FULL")
    assert hard == [a for a, flags in ADDRESSES.items() if any(flags)]


def test_sample_ignores_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "EIN")
    a = values(address.sample_rows(df.repartition(3), "EIN"), "EIN")
    b = values(address.sample_rows(df.repartition(17), "EIN"), "EIN")
    assert a == b and len(set(a)) == 100
    assert values(address.sample_rows(df, "EIN", seed=7), "EIN") != a


@pytest.mark.parametrize(
    "population, kind",
    [(50_001, "Metropolitan"), (50_000, "Micropolitan"), (10_000, "Micropolitan"), (9_999, None), (None, None)],
)
def test_area_bands(spark, population, kind):
    df = literal_frame(spark, [(population,)], "p long")
    assert values(df, geography.cbsa_class(F.col("p"))) == [kind]


def test_area_lists_that_overlap_are_marked(spark):
    metro = literal_frame(spark, [("1",), ("2",)], "geoid string")
    micro = literal_frame(spark, [("2",), ("3",)], "geoid string")
    out = sorted(values(census.core_based_areas(metro, micro), "geoid", "in_both"))
    assert out == [("1", False), ("2", True), ("2", True), ("3", False)]


def test_census_arguments(spark):
    panel = literal_frame(spark, [("1", 1990, 5.0), ("1", 2000, 6.0)], "geoid string, year int, total_population double")
    wide = census.census_data({"msa": panel}, "msa", [1990, 2000], "wide")
    assert wide.columns == ["geoid", "total_population_1990", "total_population_2000"]
    assert values(wide, *wide.columns) == [("1", 5.0, 6.0)]
    assert census.census_data({"msa": panel}, "msa", [1990]).count() == 1
    with pytest.raises(ValueError):
        census.census_data({"msa": panel}, "zip")
    later = panel.withColumn("year", F.col("year") + 21)
    assert census.census_data({"msa": later}, "msa", format="wide").columns[1:] == ["total_population_2011", "total_population_2021"]
    assert census.census_data({"msa": panel}, "msa", []).count() == 0


def test_roll_up_keeps_totals_and_skips_unknown_shares(spark):
    rows = [("a", 2000, 5.0, 10.0, 1.0), ("b", 2000, 5.0, None, 1.0), ("c", 2000, 7.0, 50.0, 1.0)]
    panel = literal_frame(spark, rows, "geoid string, year int, total_population double, poverty_perc double, median_value_adj double")
    crosswalk = literal_frame(spark, [("a", "x"), ("b", "x")], "geoid string, region string")
    out = values(census.roll_up(panel, crosswalk, "region"), "region", "total_population", "poverty_perc", "median_value_adj")
    assert set(out) == {("x", 10.0, 10.0, None), (None, 7.0, 50.0, None)}


def test_apportionment_keeps_the_total(spark):
    panel = literal_frame(spark, [("a", 2000, 8.0), ("b", 2000, 4.0)], "geoid string, year int, pop double")
    weights = literal_frame(spark, [("a", "x", 0.75), ("a", "y", 0.25), ("b", "y", 1.0)], "geoid string, new_geoid string, weight double")
    out = dict(values(census.apportion(panel, weights, ["pop"]), "geoid", "pop"))
    assert out == {"x": 6.0, "y": 6.0}
    lone = panel.unionByName(literal_frame(spark, [("c", 2000, 3.0)], "geoid string, year int, pop double"))
    assert dict(values(census.apportion(lone, weights, ["pop"]), "geoid", "pop")) == {"x": 6.0, "y": 6.0, None: 3.0}


def test_embedded_json(spark):
    rows = [(old, desc) for old, _, _, desc, _ in xw.crosswalk_rows()]
    df = literal_frame(spark, rows, "NAME_OLD string, DESC string")
    out = harmonize.json_dictionary(df, "NAME_OLD", "DESC")
    assert dict(values(out.groupBy("NAME_OLD").count(), "NAME_OLD", "count")) == {"SUBSECTION": 35, "CLASSIFICATION": 55}


def test_dictionaries_compare_equal_up_to_their_suffix(spark):
    left = literal_frame(spark, list(xw.CLASSIFICATION_CODES.items()), "code string, label string")
    right = derive.dictionary_frame(spark, ["BMF_TAX_EXEMPT_PURP"])
    assert set(values(harmonize.compare_dictionaries(left, right), "status")) == {"same up to suffix"}


def test_accessors(spark):
    df = literal_frame(spark, [("010010201001000",), (None,)], "CENSUS_BLOCK_FIPS string")
    found = [unify.get_fips(df, level).collect()[0][1] for level in ("state", "county", "tract")]
    assert found == ["01", "01001", "01001020100"]
    with pytest.raises(ValueError):
        unify.get_fips(df, "zip")
    assert values(derive.dd(spark, "BMF_STATUS_CODE"), "code") == ["1", "2", "12", "25"]
    with pytest.raises(ValueError):
        derive.dd(spark, "ABSENT")
