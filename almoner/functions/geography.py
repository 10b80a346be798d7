"""Expressions on census block identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: leading digits of a 15-digit block identifier ----------------
FIPS_WIDTH = {"state": 2, "county": 5, "tract": 11, "block": 15}
# core-based area bands: above 50,000 metropolitan, 10,000 to 50,000 micropolitan
METRO_ABOVE = 50_000
MICRO_FROM = 10_000
# --- end of fixed values --------------------------------------------------------


def fips(block_fips: Column, level: str) -> Column:
    """State, county, tract or block part of a block identifier."""
    return F.substring(block_fips, 1, FIPS_WIDTH[level])


def cbsa_class(population: Column) -> Column:
    """Area class by population; exactly 50,000 is still micropolitan, areas
    below 10,000 have no class."""
    return (
        F.when(population > METRO_ABOVE, F.lit("Metropolitan"))
        .when(population >= MICRO_FROM, F.lit("Micropolitan"))
    )
