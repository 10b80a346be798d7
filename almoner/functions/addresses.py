"""Expressions that flag addresses a parser is likely to get wrong."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: patterns ---------------------------------------------------
SPECIAL_CHARS = r"[#@&%*]"
PO_BOX = r"(?i)P\.?O\.? Box"
RURAL_ROUTE = r"(?i)RR|Rural Route"
DIGIT = r"\p{Nd}"
# --- end of fixed values --------------------------------------------------------


def difficulty_flags(address: Column) -> dict[str, Column]:
    """Flag name -> boolean; every flag is NULL for a NULL address."""
    return {
        "has_special_chars": address.rlike(SPECIAL_CHARS),
        "has_po_box": address.rlike(PO_BOX),
        "has_rural_route": address.rlike(RURAL_ROUTE),
        "missing_number": ~address.rlike(DIGIT),
    }
