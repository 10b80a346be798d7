"""Headline queries, timed; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` (comma-separated) limits the run to some queries.

The unified table the labelling and report jobs start from is written once
before the clock starts (one organization per order), as it would be found in
storage. ``*_published_size`` runs on 3,462,999 generated organizations, the
size of the published table.
"""

from __future__ import annotations

import json
import os
import time

from almoner.operators import address, derive, reports, unify
from almoner.plans import fixtures as fx
from almoner.plans.labelling import label_registry, labelling_input
from almoner.plans.queries import QUERIES
from almoner.session import build_session, scratch_path

REPEATS = 5
PUBLISHED_ROWS = 3_462_999


def stored(spark, rows):
    path = scratch_path(spark, "bench")
    (
        rows.transform(unify.with_ein2)
        .transform(derive.with_nteev2)
        .repartition(spark.sparkContext.defaultParallelism)
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def purpose(unified):
    return derive.with_purpose(unified).select("EIN2", "BMF_TAX_EXEMPT_PURP")


ON_UNIFIED = {
    "label_registry": label_registry,
    "tax_exempt_purpose": purpose,
    "nteev2": lambda u: derive.with_nteev2(u).select("EIN2", "NTEEV2"),
    "freq_counts": lambda u: reports.frequency(label_registry(u), "BMF_FOUNDATION_CODE"),
    "freq_props": lambda u: reports.proportions(label_registry(u), "NCCS_LEVEL_3"),
    "level_bars": lambda u: reports.level_frequencies(
        label_registry(u), {"BMF_ASSET_LEVEL": False, "BMF_INCOME_LEVEL": True}
    ),
    "crosstab_with_na": lambda u: reports.crosstab(
        labelling_input(u), "ORG_TYPE_501C", "BMF_PF_FILING_REQ_CODE", [0, 1, 2, 3, 4]
    ),
    "addr_sample": lambda u: address.sample_rows(address.difficult_addresses(u), "EIN"),
}

ON_TABLES = [
    "unified_latest", "org_year_span", "active_inactive", "f990_recent", "unified_upsert", "build_unified", "unified_refresh",
    "append_fips", "append_census", "geo_hierarchy", "census_apportion", "src_unified_csv",
    "locate_blocks", "census_between", "level_convert", "median_rollup", "apportion_chain",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "almoner-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    unified = stored(spark, fx.large_registry(spark, folder))
    published = stored(
        spark, fx.registry_rows(spark.range(PUBLISHED_ROWS), "id", "id", "id", "id % 25")
    )
    jobs = {
        "label_registry_published_size": lambda: label_registry(published),
        "tax_exempt_purpose_published_size": lambda: purpose(published),
    }
    for name, job in ON_UNIFIED.items():
        jobs[name] = lambda job=job: job(unified)
    for name in ON_TABLES:
        jobs[name] = lambda name=name: QUERIES[name](spark, folder)

    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(jobs)
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            jobs[name]().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": f"headline queries, best of {REPEATS} runs, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
