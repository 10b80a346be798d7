"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.fixed import crosswalk as xw
from almoner.fixed import dictionaries
from almoner.fixed.columns import LABELLING_COLUMNS, UNIFIED_SCHEMA
from almoner.functions import codes, taxonomy
from almoner.operators import address, census, derive, harmonize, reports, unify
from almoner.plans import fixtures as fx
from almoner.plans import geography, refreshing
from almoner.plans import unified
from almoner.plans.labelling import label_registry, labelling_input
from almoner.session import scratch_path, written
from almoner.sources import manifest, readers, writers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _unified(spark: SparkSession, folder: str) -> DataFrame:
    """Test registry with the derived identifiers and mission code."""
    return fx.registry(spark, folder).transform(unify.with_ein2).transform(derive.with_nteev2)


def _labelling_input(spark: SparkSession, folder: str) -> DataFrame:
    return _unified(spark, folder).transform(labelling_input)


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return label_registry(_unified(spark, folder))


# --- sources and sinks ---------------------------------------------------------


@query("src_unified_csv")
def src_unified_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "unified-csv")
    writers.write_csv(_unified(spark, folder).select(UNIFIED_SCHEMA.names), path)
    return readers.read_unified(spark, path)


@query("src_crosswalk")
def src_crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "crosswalk")
    rows = fx.table(spark, folder, "documents").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("NAME_OLD"),
        F.col("source").alias("NAME_NEW"),
        F.concat(F.lit("CHAR("), F.col("n_chars").cast("string"), F.lit(")")).alias("SQL_DTYPE"),
        F.col("text").alias("DESC"),
        F.lit(None).cast("string").alias("SERIES"),
    )
    writers.write_csv(rows, path)
    return readers.read_crosswalk(spark, path)


BASE_URL = "https://files.example.org/"


@query("src_manifest")
def src_manifest(spark: SparkSession, folder: str) -> DataFrame:
    keys = fx.storage_keys(spark, folder)
    return manifest.manifest(keys, ["raw/bmf/", "legacy/bmf/"], BASE_URL)


def _write_releases(spark: SparkSession, folder: str) -> dict[str, str]:
    """Raw release files in both formats: name -> path."""
    root = scratch_path(spark, "raw")
    old, new = fx.vintages(spark, folder).values()
    files = {"older.dat": f"{root}/older.dat", "newer.csv": f"{root}/newer.csv"}
    old.write.csv(
        files["older.dat"], sep=" ", header=True, nullValue="NA", escape='"', **writers.EXACT_TEXT
    )
    writers.write_csv(new, files["newer.csv"])
    return files


@query("src_multiformat")
def src_multiformat(spark: SparkSession, folder: str) -> DataFrame:
    tables = readers.ingest(spark, _write_releases(spark, folder)).tables
    named = {
        i: harmonize.rename_columns(t).withColumn("source_file", F.lit(name))
        for i, (name, t) in enumerate(tables.items())
    }
    return harmonize.union_vintages(named).select(
        "source_file", "F990_ORG_EIN", "VINTAGE", "F990_TOTAL_ASSETS", "BMF_NTEE",
        "BMF_SUBSECTION_CODE", "BMF_GROUP_EXEMPT_NUM", "TAPE_REEL", "BATCH",
    )


@query("src_ingest_errors")
def src_ingest_errors(spark: SparkSession, folder: str) -> DataFrame:
    """One release of events per file type; numbers are broken in some records,
    one file is absent, one has no reader."""
    root = scratch_path(spark, "checked")
    value = F.when(F.col("value") < 1, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    fx.table(spark, folder, "events").select("event_id", "event_type", value.alias("value")).write.csv(
        f"{root}/events.csv", header=True
    )
    files = {
        "events.csv": f"{root}/events.csv",
        "absent.csv": f"{root}/absent.csv",
        "sheet.xyz": f"{root}/sheet.xyz",
    }
    log = readers.ingest(spark, files).log
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    good, bad = readers.split_corrupt(readers.read_checked(spark, files["events.csv"], schema))
    records = good.select("event_type", F.lit(0).alias("bad")).unionByName(
        bad.select("event_type", F.lit(1).alias("bad"))
    )
    per_type = records.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("bad").alias("n_bad")
    )
    read = per_type.select(
        F.lit("events.csv").alias("filename"), F.lit("ok").alias("status"), "event_type", "n_records", "n_bad"
    )
    failed = [(name, status) for name, status, _ in log if status != "ok"]
    skipped = derive.literal_frame(spark, failed, "filename string, status string")
    return read.unionByName(skipped, allowMissingColumns=True)


@query("sink_raw_csv")
def sink_raw_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "raw-csv")
    events = fx.table(spark, folder, "events").select(
        F.concat("event_type", F.lit(".v1.dat")).alias("filename"),
        "event_id",
        "user_id",
        "props",
    )
    writers.write_raw(events, path)
    schema = "event_id long, user_id long, props string, file_root string"
    return readers.read_table(spark, path, schema)


@query("sink_labeled")
def sink_labeled(spark: SparkSession, folder: str) -> DataFrame:
    labelled = _labelled(spark, folder)
    parquet, csv = writers.write_labelled(labelled, scratch_path(spark, "labelled"))
    return (
        readers.read_table(spark, csv, labelled.schema)
        .withColumn("format", F.lit("csv"))
        .unionByName(spark.read.parquet(parquet).withColumn("format", F.lit("parquet")))
    )


@query("sink_purpose")
def sink_purpose(spark: SparkSession, folder: str) -> DataFrame:
    purposes = derive.purpose_table(_unified(spark, folder))
    parquet, csv = writers.write_purposes(purposes, scratch_path(spark, "purposes"))
    both = spark.read.parquet(parquet).withColumn("format", F.lit("parquet"))
    return both.unionByName(
        readers.read_table(spark, csv, purposes.schema).withColumn("format", F.lit("csv"))
    )


def _level_usage(df: DataFrame, variables: dict[str, str]) -> DataFrame:
    """Number of organizations per dictionary level of several code columns, in
    one pass: (variable, ord, n)."""
    levels = df.select(*[codes.level_of(v, F.col(c)).alias(v) for v, c in variables.items()])
    return (
        levels.unpivot([], list(variables), "variable", "ord")
        .where(F.col("ord").isNotNull())
        .groupBy("variable", "ord")
        .agg(F.count(F.lit(1)).alias("n"))
    )


DICTIONARY_SOURCES = {
    "ORG_CORP_FORM": "BMF_ORGANIZATION_CODE",
    "ORG_FISCAL_PERIOD": "ORG_FISCAL_PERIOD",
    "BMF_AFFILIATION_CODE": "BMF_AFFILIATION_CODE",
    "BMF_ASSET_LEVEL": "BMF_ASSET_CODE",
    "BMF_DEDUCTIBILITY_CODE": "BMF_DEDUCTIBILITY_CODE",
    "BMF_FOUNDATION_CODE": "BMF_FOUNDATION_CODE",
    "BMF_INCOME_LEVEL": "BMF_INCOME_CODE",
    "BMF_PF_FILING_REQ_CODE": "BMF_PF_FILING_REQ_CODE",
    "BMF_STATUS_CODE": "BMF_STATUS_CODE",
    "NCCS_LEVEL_1": "NCCS_LEVEL_1",
    "NCCS_LEVEL_2": "NCCS_LEVEL_2",
    "NCCS_LEVEL_3": "NCCS_LEVEL_3",
}


@query("sink_dictionaries")
def sink_dictionaries(spark: SparkSession, folder: str) -> DataFrame:
    """All dictionaries in one table, with the number of organizations per level."""
    path = scratch_path(spark, "dictionaries")
    usage = _level_usage(fx.registry(spark, folder), DICTIONARY_SOURCES)
    every_level = (
        derive.dictionary_frame(spark)
        .join(usage, ["variable", "ord"], "left")
        .na.fill(0, ["n"])
    )
    writers.write_parquet(every_level, path)
    return spark.read.parquet(path)


def _address_sample(spark: SparkSession, folder: str) -> DataFrame:
    hard = address.difficult_addresses(
        address.address_columns(_unified(spark, folder), keep=("EIN",))
    )
    return address.sample_rows(hard, "EIN")


@query("sink_addr_sample")
def sink_addr_sample(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "address-sample")
    sample = _address_sample(spark, folder)
    writers.write_csv(sample, path)
    return readers.read_table(spark, path, sample.schema)


@query("src_stage")
def src_stage(spark: SparkSession, folder: str) -> DataFrame:
    """The stored labelled table read back; only the columns asked for are read."""
    path = scratch_path(spark, "stage")
    writers.write_parquet(_labelled(spark, folder), path)
    return spark.read.parquet(path).select(
        "EIN2", "ORG_TYPE_501C", "NTEE_IRS", "BMF_STATUS_CODE", "F990_FORM_YEAR", "CENSUS_STATE_ABBR"
    )


# --- harmonization ---------------------------------------------------------------


def _harmonized(spark: SparkSession, folder: str) -> DataFrame:
    releases = fx.vintages(spark, folder)
    return harmonize.union_vintages({y: harmonize.harmonize(df) for y, df in releases.items()})


@query("harmonize_rename")
def harmonize_rename(spark: SparkSession, folder: str) -> DataFrame:
    releases = fx.vintages(spark, folder)
    renamed = {y: harmonize.rename_columns(df) for y, df in releases.items()}
    return harmonize.union_vintages(renamed)


@query("harmonize_cast")
def harmonize_cast(spark: SparkSession, folder: str) -> DataFrame:
    releases = fx.vintages(spark, folder)
    typed = {
        y: df.transform(harmonize.rename_columns).transform(harmonize.cast_columns)
        for y, df in releases.items()
    }
    return harmonize.union_vintages(typed)


@query("harmonize_drop_meta")
def harmonize_drop_meta(spark: SparkSession, folder: str) -> DataFrame:
    releases = fx.vintages(spark, folder)
    known = {
        y: df.transform(harmonize.rename_columns).transform(harmonize.drop_unknown)
        for y, df in releases.items()
    }
    return harmonize.union_vintages(known)


@query("xwalk_json_dict")
def xwalk_json_dict(spark: SparkSession, folder: str) -> DataFrame:
    """Code lists in JSON inside a longer description, one row per code."""
    events = fx.table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("Codes of a "), "event_type", F.lit(":\n"), "props").alias("text")
    )
    return harmonize.json_dictionary(events, "event_id", "text")


@query("xwalk_dict_check")
def xwalk_dict_check(spark: SparkSession, folder: str) -> DataFrame:
    """Both code lists of the crosswalk against their dictionaries, with the number of
    organizations that carry each code (codes nobody lists included)."""
    lists = derive.literal_frame(spark, xw.crosswalk_rows(), xw.CROSSWALK_SCHEMA)
    orgs = fx.registry(spark, folder)
    purposes = codes.purpose_keys(F.col("BMF_SUBSECTION_CODE"), F.col("BMF_CLASSIFICATION_CODE"))
    subsections = derive.literal_frame(spark, dictionaries.SECOND_SUBSECTION_LIST, "code string, label string")

    def check(name: str, right: DataFrame, observed: DataFrame) -> DataFrame:
        left = harmonize.json_dictionary(lists.where(F.col("NAME_OLD") == name), "NAME_OLD", "DESC")
        counted = observed.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
        listed = F.col("left_label").isNotNull() | F.col("right_label").isNotNull()
        return harmonize.compare_dictionaries(left, right).join(counted, "code", "full").select(
            F.lit(name).alias("list"),
            "code",
            "left_label",
            "right_label",
            F.coalesce(F.when(listed, F.col("status")), F.lit("in neither")).alias("status"),
            F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        )

    by_purpose = orgs.select(F.explode(purposes).alias("code"))
    by_subsection = orgs.where(F.col("BMF_SUBSECTION_CODE").isNotNull()).select(F.col("BMF_SUBSECTION_CODE").cast("string").alias("code"))
    purpose = check("CLASSIFICATION", derive.dictionary_frame(spark, ["BMF_TAX_EXEMPT_PURP"]), by_purpose)
    return purpose.unionByName(check("SUBSECTION", subsections, by_subsection))


@query("ein2")
def ein2(spark: SparkSession, folder: str) -> DataFrame:
    return unify.with_ein2(fx.registry(spark, folder).select("EIN"))


@query("vintage_union")
def vintage_union(spark: SparkSession, folder: str) -> DataFrame:
    return _harmonized(spark, folder)


def _releases(spark: SparkSession, folder: str) -> DataFrame:
    """Prepared releases with a record id to break ties within a release."""
    named = _harmonized(spark, folder).transform(harmonize.to_unified_names)
    return unify.with_ein2(named).withColumn("RECORD_ID", F.col("NCCS_RANDOM_NUMBER").cast("long"))


@query("unified_latest")
def unified_latest(spark: SparkSession, folder: str) -> DataFrame:
    return unify.latest_record(_releases(spark, folder))


@query("org_year_span")
def org_year_span(spark: SparkSession, folder: str) -> DataFrame:
    return unify.year_span(fx.appearances(spark, folder))


@query("active_inactive")
def active_inactive(spark: SparkSession, folder: str) -> DataFrame:
    return unify.activity_status(fx.appearances(spark, folder), vintage="YEAR")


@query("f990_recent")
def f990_recent(spark: SparkSession, folder: str) -> DataFrame:
    orgs = _unified(spark, folder).select("EIN", "EIN2", *unify.RECENT.values())
    orgs = orgs.withColumns({c: F.col(c).cast("double") for c in unify.RECENT.values()})
    return unify.recent_financials(orgs, fx.filings(spark, folder))


@query("unified_upsert")
def unified_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The newest release over the table built from all earlier ones."""
    path = scratch_path(spark, "releases")
    _releases(spark, folder).write.partitionBy("VINTAGE").parquet(path)
    releases = spark.read.parquet(path)
    newest = releases.agg(F.max("VINTAGE").alias("newest")).scalar()
    existing = unify.latest_record(releases.where(F.col("VINTAGE") < newest))
    update = unify.latest_record(releases.where(F.col("VINTAGE") == newest))
    return unify.upsert(existing, update)


def _unified_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "EIN", "VINTAGE", "F990_TOTAL_ASSETS", "NTEE_IRS", "BMF_SUBSECTION_CODE", "BMF_GROUP_EXEMPT_NUM",
        "ORG_YEAR_FIRST", "ORG_YEAR_LAST", "ORG_YEAR_COUNT", "ACTIVE",
    )


RECORD = "cast(NCCS_RANDOM_NUMBER AS long)"


@query("build_unified")
def build_unified(spark: SparkSession, folder: str) -> DataFrame:
    """Every organization from all raw releases at once."""
    return _unified_columns(unified.build_unified(fx.vintages(spark, folder), tie=RECORD))


@query("unified_refresh")
def unified_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The same from three deliveries of releases that arrive out of order: a state of
    each, all merged in one aggregate."""
    states = [
        unified.record_state(unified.named_release(raw.where(F.col("VINTAGE") % 3 == part)), tie=RECORD)
        for part in (1, 2, 0)
        for raw in fx.vintages(spark, folder).values()
    ]
    state = unified.merged_states(*states)
    return _unified_columns(unified.current(written(state, "state")))


@query("append_fips")
def append_fips(spark: SparkSession, folder: str) -> DataFrame:
    """Geographies of every organization's block. Every 26th organization lies in a
    block of a later census, under a state number that doesn't exist."""
    block = F.col("CENSUS_BLOCK_FIPS")
    later = F.when(F.col("EIN").cast("long") % 26 == 0, F.concat(F.lit("99"), F.substring(block, 3, 13))).otherwise(block)
    orgs = _unified(spark, folder).select("EIN", "EIN2", later.alias("CENSUS_BLOCK_FIPS"))
    return unify.append_fips(orgs, fx.block_crosswalk(spark, folder))


# --- derivation and labelling ------------------------------------------------------


@query("pad_code")
def pad_code(spark: SparkSession, folder: str) -> DataFrame:
    return fx.registry(spark, folder).select(
        "EIN",
        codes.pad_code(F.col("BMF_SUBSECTION_CODE")).alias("subsection"),
        codes.pad_code(F.col("BMF_FILING_REQ_CODE")).alias("filing"),
    )


@query("org_type_501c")
def org_type_501c(spark: SparkSession, folder: str) -> DataFrame:
    typed = fx.registry(spark, folder).transform(derive.with_org_types)
    return typed.select("EIN", "BMF_SUBSECTION_CODE", "ORG_TYPE_501C")


@query("org_type_pf")
def org_type_pf(spark: SparkSession, folder: str) -> DataFrame:
    typed = fx.registry(spark, folder).transform(derive.with_org_types)
    return typed.select("EIN", "BMF_PF_FILING_REQ_CODE", "ORG_TYPE_PF")


@query("rename_final")
def rename_final(spark: SparkSession, folder: str) -> DataFrame:
    return fx.registry(spark, folder).transform(derive.rename_final)


@query("schema_diff")
def schema_diff(spark: SparkSession, folder: str) -> DataFrame:
    before_rename = _unified(spark, folder).transform(derive.with_org_types)
    return derive.column_coverage(before_rename, LABELLING_COLUMNS)


@query("select_strict")
def select_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _labelling_input(spark, folder)


@query("impute_nonpf")
def impute_nonpf(spark: SparkSession, folder: str) -> DataFrame:
    imputed = _labelling_input(spark, folder).transform(derive.impute_non_pf)
    return imputed.select("EIN", "ORG_TYPE_501C", "ORG_TYPE_PF", "BMF_PF_FILING_REQ_CODE")


@query("impute_affiliation")
def impute_affiliation(spark: SparkSession, folder: str) -> DataFrame:
    imputed = _labelling_input(spark, folder).transform(derive.impute_affiliation)
    return imputed.select("EIN", "BMF_GROUP_EXEMPT_NUM", "BMF_AFFILIATION_CODE")


@query("sentinel_to_null")
def sentinel_to_null(spark: SparkSession, folder: str) -> DataFrame:
    return fx.registry(spark, folder).select(
        "EIN",
        codes.sentinel_to_null(F.col("NCCS_LEVEL_1"), "").alias("NCCS_LEVEL_1"),
        codes.sentinel_to_null(F.col("NCCS_LEVEL_2"), "").alias("NCCS_LEVEL_2"),
        codes.sentinel_to_null(F.col("NCCS_LEVEL_3"), "-", "").alias("NCCS_LEVEL_3"),
    )


@query("label_factor")
def label_factor(spark: SparkSession, folder: str) -> DataFrame:
    """Label and level position of one code column; unknown codes give NULL."""
    return fx.registry(spark, folder).select(
        "EIN",
        "BMF_STATUS_CODE",
        codes.label_of("BMF_STATUS_CODE", F.col("BMF_STATUS_CODE")).alias("label"),
        codes.level_of("BMF_STATUS_CODE", F.col("BMF_STATUS_CODE")).alias("ord"),
    )


LABEL_QUERIES = {
    "label_fiscal_period": "ORG_FISCAL_PERIOD",
    "label_status": "BMF_STATUS_CODE",
    "label_affiliation": "BMF_AFFILIATION_CODE",
    "label_deductibility": "BMF_DEDUCTIBILITY_CODE",
    "label_asset_level": "BMF_ASSET_LEVEL",
    "label_income_level": "BMF_INCOME_LEVEL",
    "label_corp_form": "ORG_CORP_FORM",
    "label_foundation": "BMF_FOUNDATION_CODE",
    "label_nccs_level1": "NCCS_LEVEL_1",
    "label_nccs_level2": "NCCS_LEVEL_2",
    "label_nccs_level3": "NCCS_LEVEL_3",
    "label_filing_req": "BMF_FILING_REQ_CODE",
    "label_pf_filing": "BMF_PF_FILING_REQ_CODE",
}


def _label_query(variable: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        labelled = (
            _labelling_input(spark, folder)
            .transform(derive.impute_non_pf)
            .transform(derive.impute_affiliation)
            .transform(derive.clean_sentinels)
            .transform(derive.recode_filing_requirement)
        )
        return labelled.select("EIN", codes.label_of(variable, F.col(variable)).alias(variable))

    return run


for _name, _variable in LABEL_QUERIES.items():
    query(_name)(_label_query(_variable))


@query("tax_exempt_purpose")
def tax_exempt_purpose(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _unified(spark, folder)
        .transform(derive.with_purpose)
        .select("EIN2", "BMF_SUBSECTION_CODE", "BMF_CLASSIFICATION_CODE", "BMF_TAX_EXEMPT_PURP")
    )


@query("purpose_merge")
def purpose_merge(spark: SparkSession, folder: str) -> DataFrame:
    orgs = _unified(spark, folder)
    merged = derive.merge_purpose(orgs, derive.purpose_table(orgs), how="inner")
    return merged.select("EIN2", "BMF_SUBSECTION_CODE", "BMF_TAX_EXEMPT_PURP")


@query("filing_req_strip")
def filing_req_strip(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("BMF_FILING_REQ_CODE")
    return fx.registry(spark, folder).select("EIN", code, codes.strip_filing_code(code).alias("stripped"))


@query("filing_req_pad")
def filing_req_pad(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("BMF_FILING_REQ_CODE")
    return fx.registry(spark, folder).select(
        "EIN", code, codes.pad_code(codes.strip_filing_code(code)).alias("padded")
    )


@query("filing_req_pf_override")
def filing_req_pf_override(spark: SparkSession, folder: str) -> DataFrame:
    recoded = (
        _labelling_input(spark, folder)
        .transform(derive.impute_non_pf)
        .transform(derive.recode_filing_requirement)
    )
    return recoded.select("EIN", "BMF_PF_FILING_REQ_CODE", "BMF_FILING_REQ_CODE")


@query("label_registry")
def labelled_registry(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder)


@query("subsection_reconcile")
def subsection_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return reports.reconcile_subsections(fx.registry(spark, folder))


# --- reports -------------------------------------------------------------------------


@query("freq_counts")
def freq_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.frequency(_labelled(spark, folder), "BMF_FOUNDATION_CODE")


@query("freq_props")
def freq_props(spark: SparkSession, folder: str) -> DataFrame:
    return reports.proportions(_labelled(spark, folder), "NCCS_LEVEL_3")


@query("freq_factor_levels")
def freq_factor_levels(spark: SparkSession, folder: str) -> DataFrame:
    return reports.level_frequency(_labelled(spark, folder), "BMF_FILING_REQ_CODE")


@query("freq_alpha")
def freq_alpha(spark: SparkSession, folder: str) -> DataFrame:
    """Text columns in alphabetical order, a labelled column in level order."""
    labelled = _labelled(spark, folder)
    text = reports.alphabetical_frequency(labelled, "ORG_TYPE_501C")
    levels = reports.used_level_frequency(labelled, "BMF_ASSET_LEVEL")
    return text.select(F.lit("ORG_TYPE_501C").alias("variable"), F.lit(None).cast("int").alias("ord"), "value", "n").unionByName(
        levels.select(F.lit("BMF_ASSET_LEVEL").alias("variable"), "ord", F.col("label").alias("value"), "n")
    )


@query("freq_format")
def freq_format(spark: SparkSession, folder: str) -> DataFrame:
    shares = reports.proportions(label_registry(fx.large_registry(spark, folder).transform(unify.with_ein2).transform(derive.with_nteev2)), "ORG_TYPE_501C")
    return shares.transform(reports.formatted, "n").transform(reports.formatted, "share", 3)


@query("crosstab_with_na")
def crosstab_with_na(spark: SparkSession, folder: str) -> DataFrame:
    return reports.crosstab(
        _labelling_input(spark, folder), "ORG_TYPE_501C", "BMF_PF_FILING_REQ_CODE", [0, 1, 2, 3, 4]
    )


LETTERS = [chr(c) for c in range(ord("A"), ord("Z") + 1)]


@query("crosstab_no_na")
def crosstab_no_na(spark: SparkSession, folder: str) -> DataFrame:
    letters = fx.registry(spark, folder).select(
        taxonomy.major_group(F.col("NTEE_IRS")).alias("first_letter"),
        taxonomy.major_group(F.col("NTEE_NCCS")).alias("second_letter"),
    )
    return reports.crosstab(letters, "first_letter", "second_letter", LETTERS, with_missing=False)


@query("ntee_major")
def ntee_major(spark: SparkSession, folder: str) -> DataFrame:
    return fx.registry(spark, folder).select(
        "EIN",
        taxonomy.major_group(F.col("NTEE_IRS")).alias("first_letter"),
        taxonomy.major_group(F.col("NTEE_NCCS")).alias("second_letter"),
    )


@query("ntee_agreement")
def ntee_agreement(spark: SparkSession, folder: str) -> DataFrame:
    return reports.agreement(ntee_major(spark, folder), "first_letter", "second_letter")


@query("year_gather_count")
def year_gather_count(spark: SparkSession, folder: str) -> DataFrame:
    return reports.gathered_counts(
        _labelled(spark, folder), ["ORG_YEAR_FIRST", "ORG_YEAR_LAST"]
    )


@query("year_histograms")
def year_histograms(spark: SparkSession, folder: str) -> DataFrame:
    return reports.histograms(
        _labelled(spark, folder),
        ["ORG_RULING_YEAR", "ORG_YEAR_FIRST", "ORG_YEAR_LAST", "ORG_YEAR_COUNT"],
    )


@query("exempt_subtype_join")
def exempt_subtype_join(spark: SparkSession, folder: str) -> DataFrame:
    return reports.subtype_counts(_labelling_input(spark, folder))


@query("exempt_hierarchy")
def exempt_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hierarchy(reports.subtype_counts(_labelling_input(spark, folder)))


@query("treemap_prep")
def treemap_prep(spark: SparkSession, folder: str) -> DataFrame:
    return reports.treemap(_labelled(spark, folder), "BMF_FOUNDATION_CODE")


@query("level_bars")
def level_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Used asset levels, and all income levels."""
    return reports.level_frequencies(
        _labelled(spark, folder), {"BMF_ASSET_LEVEL": False, "BMF_INCOME_LEVEL": True}
    ).withColumnRenamed("variable", "measure")


@query("codebook_rows")
def codebook_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Codebook of the affiliation codes next to their use."""
    orgs = fx.registry(spark, folder)
    return reports.codebook(
        orgs, "BMF_AFFILIATION_CODE", "BMF_AFFILIATION_CODE", ["code", "role", "affiliation", "label", "description"]
    )


@query("distinct_codes")
def distinct_codes(spark: SparkSession, folder: str) -> DataFrame:
    return reports.distinct_values(fx.registry(spark, folder), "BMF_FILING_REQ_CODE")


@query("before_after_impute")
def before_after_impute(spark: SparkSession, folder: str) -> DataFrame:
    before = _labelling_input(spark, folder)
    never = codes.never_pf(F.col("ORG_TYPE_501C"))
    after = {
        c: F.when(never, F.lit(0)).otherwise(F.col(c))
        for c in ("ORG_TYPE_PF", "BMF_PF_FILING_REQ_CODE")
    }
    return reports.imputation_effect(before, after)


# --- addresses -------------------------------------------------------------------------


@query("addr_columns")
def addr_columns(spark: SparkSession, folder: str) -> DataFrame:
    return address.address_columns(fx.registry(spark, folder))


@query("addr_flags")
def addr_flags(spark: SparkSession, folder: str) -> DataFrame:
    return fx.registry(spark, folder).select("EIN", "ORG_ADDR_FULL").transform(address.with_difficulty_flags)


@query("addr_difficult")
def addr_difficult(spark: SparkSession, folder: str) -> DataFrame:
    return address.difficult_addresses(fx.registry(spark, folder).select("EIN", "ORG_ADDR_FULL"))


@query("addr_sample")
def addr_sample(spark: SparkSession, folder: str) -> DataFrame:
    return _address_sample(spark, folder)


# --- taxonomy and geography ------------------------------------------------------------


@query("ntee_industry")
def ntee_industry(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("NTEE_IRS")
    return fx.registry(spark, folder).select("EIN", code, taxonomy.industry(code).alias("industry"))


@query("ntee_org_type")
def ntee_org_type(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("NTEE_IRS")
    return fx.registry(spark, folder).select("EIN", code, taxonomy.org_type(code).alias("org_type"))


@query("ntee_division")
def ntee_division(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("NTEE_NCCS")
    return fx.registry(spark, folder).select("EIN", code, taxonomy.division(code).alias("division"))


@query("nteev2")
def nteev2(spark: SparkSession, folder: str) -> DataFrame:
    return fx.registry(spark, folder).transform(derive.with_nteev2).select("EIN", "NTEE_IRS", "NTEEV2")


@query("ntee_levels")
def ntee_levels(spark: SparkSession, folder: str) -> DataFrame:
    coded = fx.registry(spark, folder).transform(derive.with_nteev2)
    return derive.with_ntee_levels(coded.select("EIN", "NTEEV2"))


@query("fips_levels")
def fips_levels(spark: SparkSession, folder: str) -> DataFrame:
    return unify.with_fips_levels(fx.registry(spark, folder).select("EIN", "CENSUS_BLOCK_FIPS"))


@query("dictionary_lookup")
def dictionary_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Dictionary of one variable next to its use."""
    orgs = fx.registry(spark, folder)
    return reports.codebook(orgs, "BMF_STATUS_CODE", "BMF_STATUS_CODE", ["code", "label", "desc"])


# --- census ------------------------------------------------------------------------------

YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


def _panels(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    county = fx.census_panel(spark, folder)
    msa = census.roll_up(
        county, fx.area_crosswalk(spark, folder), "region"
    ).withColumnRenamed("region", "geoid")
    return {"tract": fx.tract_panel(spark, folder), "county": county, "msa": msa}


def _stacked(frames: dict[str, DataFrame]) -> DataFrame:
    tagged = [frame.withColumn("geo", F.lit(geo)) for geo, frame in frames.items()]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


@query("census_long")
def census_long(spark: SparkSession, folder: str) -> DataFrame:
    panels = _panels(spark, folder)
    return _stacked({geo: census.census_data(panels, geo) for geo in panels})


@query("census_wide")
def census_wide(spark: SparkSession, folder: str) -> DataFrame:
    panels = _panels(spark, folder)
    return _stacked({geo: census.census_data(panels, geo, YEARS, "wide") for geo in panels})


INFLATION = {year: 1 + (2021 - year) / 32 for year in YEARS[1:]}


@query("census_inflation")
def census_inflation(spark: SparkSession, folder: str) -> DataFrame:
    panel = fx.census_panel(spark, folder)
    return census.adjust_inflation(panel, INFLATION, ["med_household_income_adj"])


@query("census_apportion")
def census_apportion(spark: SparkSession, folder: str) -> DataFrame:
    return census.apportion(
        fx.census_panel(spark, folder),
        fx.apportionment_weights(spark, folder),
        ["total_population", "housing_units"],
    )


@query("geo_rollup")
def geo_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return census.roll_up(
        fx.census_panel(spark, folder),
        fx.area_crosswalk(spark, folder),
        "region",
    )


@query("geo_hierarchy")
def geo_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """Region > nation > market segment, standing for state > county > tract."""
    nation = fx.table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    parts = fx.order_counts(spark, folder).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    named = parts.select(
        F.col("n_regionkey").alias("state"),
        F.col("n_nationkey").alias("county"),
        F.col("c_mktsegment").alias("tract"),
        F.col("n").alias("population"),
    )
    return census.hierarchy_totals(named, ["state", "county", "tract"], ["population"])


@query("cbsa_classify")
def cbsa_classify(spark: SparkSession, folder: str) -> DataFrame:
    return census.classify_areas(fx.statistical_areas(spark, folder))


@query("cbsa_union")
def cbsa_union(spark: SparkSession, folder: str) -> DataFrame:
    areas = census.classify_areas(fx.statistical_areas(spark, folder))
    return census.core_based_areas(
        areas.where(F.col("cbsa_class") == "Metropolitan"),
        areas.where(F.col("cbsa_class") == "Micropolitan"),
    )


@query("csa_rollup")
def csa_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Combined areas, and the areas that belong to none, told apart by ``kind``."""
    return census.area_summary(fx.statistical_areas(spark, folder))


@query("append_census")
def append_census(spark: SparkSession, folder: str) -> DataFrame:
    """Every appearance of an organization with the census values of the area its
    key is assigned to, in that year; every 26th area is in no panel."""
    orders = fx.table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year")
    )
    orgs = orders.select(
        F.col("o_orderkey").alias("RECORD_ID"),
        (F.col("o_custkey") % 26).cast("string").alias("geoid"),
        "year",
    )
    return census.append_census(orgs, fx.census_panel(spark, folder), ["geoid", "year"], key="RECORD_ID")


@query("geo_reports")
def geo_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Organizations by state, urban area and statistical area."""
    return reports.frequencies(
        _labelled(spark, folder), ["CENSUS_STATE_ABBR", "CENSUS_URBAN_AREA", "CENSUS_CBSA_NAME"]
    )


QUERIES.update(geography.QUERIES)
QUERIES.update(refreshing.QUERIES)
