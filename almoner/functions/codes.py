"""Expressions that derive and clean registry codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almoner.fixed import dictionaries

# 501(c) types a private foundation can have
PF_TYPES = ("501C_03", "501C_92")


def pad_code(code: Column, width: int = 2) -> Column:
    """Left-pad with zeros to ``width``; longer codes are kept whole, NULL stays."""
    text = code.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def padded_ein(ein: Column) -> Column:
    """Nine-digit EIN text from a number or text with or without separators;
    NULL for anything that hasn't one to nine digits."""
    digits = F.regexp_replace(ein.cast("string"), "[^0-9]", "")
    return F.when(F.length(digits).between(1, 9), F.lpad(digits, 9, "0"))


def ein2(ein: Column) -> Column:
    """``EIN-XX-XXXXXXX``, a form no CSV reader takes for a number."""
    digits = padded_ein(ein)
    return F.concat(F.lit("EIN-"), F.substring(digits, 1, 2), F.lit("-"), F.substring(digits, 3, 7))


def org_type_501c(subsection: Column) -> Column:
    return F.concat(F.lit("501C_"), pad_code(subsection))


def org_type_pf(pf_code: Column) -> Column:
    """1 for private foundations, 0 for others, NULL when the code is unknown."""
    return pf_code.isin(1, 2, 3).cast("int")


def never_pf(org_type: Column) -> Column:
    """True when the 501(c) type rules out a private foundation; NULL type -> NULL."""
    return ~org_type.isin(*PF_TYPES)


def independent_affiliation(group_exemption: Column, affiliation: Column) -> Column:
    """Organizations outside any group exemption are independent (3) unless they
    are a network parent (1) or intermediate (2); a NULL code counts as neither."""
    in_network = F.coalesce(affiliation.isin(1, 2), F.lit(False))
    return F.when((group_exemption == 0) & ~in_network, F.lit(3)).otherwise(affiliation)


def sentinel_to_null(code: Column, *sentinels: str) -> Column:
    return F.when(~code.isin(*sentinels), code)


def strip_filing_code(code: Column) -> Column:
    """Drop one spurious trailing zero (130 -> 13, 20 -> 2, 100 -> 1); 888 -> NULL.

    The two passes run one after the other on purpose: the second one sees what
    the first one left. Only codes ending in zero are matched at all.
    """
    text = code.cast("string")
    once = F.regexp_replace(text, "([0-9]{2})0$", "$1")
    twice = F.regexp_replace(once, "([0-9])0$", "$1")
    stripped = F.when(F.endswith(text, F.lit("0")), twice).otherwise(text)
    return F.nullif(stripped, F.lit("888"))


def filing_code(code: Column, pf_code: Column) -> Column:
    """Two-character filing requirement; private foundations become ``PF``."""
    return F.when(pf_code.isin(1, 2, 3), F.lit("PF")).otherwise(pad_code(strip_filing_code(code)))


def _sql(value) -> str:
    if isinstance(value, list):
        return f"array({', '.join(map(_sql, value))})"
    if value is None:
        return "cast(NULL AS string)"
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def literal_map(pairs: list[tuple]) -> Column:
    """Constant map column. It folds to one literal, and a lookup in it stays a
    small loop in generated code, where a CASE of the same size outgrows what
    the JIT compiles."""
    return F.expr(f"map({', '.join(_sql(v) for pair in pairs for v in pair)})")


def _lookup(pairs: list[tuple], key: Column) -> Column:
    return F.try_element_at(literal_map(pairs), key)


def lookup_text(mapping: dict[str, str], key: Column, default: str | None = None) -> Column:
    found = _lookup(list(mapping.items()), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def _keyed(variable: str, code: Column, position: int) -> Column:
    levels = [
        (c, (label, i)[position])
        for i, (c, label) in enumerate(dictionaries.code_labels(variable), start=1)
        if label is not None
    ]
    if variable in INTEGER_VARIABLES:
        return _lookup([(int(c), v) for c, v in levels], code.try_cast("int"))
    return _lookup(levels, code.cast("string"))


# variables whose codes are numbers: 1, "1" and "01" are the same level
INTEGER_VARIABLES = {
    "ORG_CORP_FORM",
    "ORG_FISCAL_PERIOD",
    "BMF_AFFILIATION_CODE",
    "BMF_ASSET_LEVEL",
    "BMF_DEDUCTIBILITY_CODE",
    "BMF_FOUNDATION_CODE",
    "BMF_INCOME_LEVEL",
    "BMF_PF_FILING_REQ_CODE",
    "BMF_STATUS_CODE",
}


def label_of(variable: str, code: Column) -> Column:
    """Label of a code; codes outside the dictionary become NULL."""
    return _keyed(variable, code, 0)


def level_of(variable: str, code: Column) -> Column:
    """1-based position of a code in its dictionary, NULL outside it."""
    return _keyed(variable, code, 1)


def purpose_keys(subsection: Column, classification: Column) -> Column:
    """``<subsection>-<digit>`` for every digit of the classification code, sorted;
    NULL if either code is NULL."""
    digits = F.split(classification.cast("string"), "")
    keys = F.sort_array(
        F.transform(digits, lambda d: F.concat(subsection.cast("string"), F.lit("-"), d))
    )
    return F.when(subsection.isNotNull(), keys)


def _purpose_labels(subsection: Column) -> Column:
    """Array of the labels of one subsection, indexed by classification digit."""
    by_subsection: dict[int, list] = {}
    for code, label in dictionaries.code_labels("BMF_TAX_EXEMPT_PURP"):
        number, digit = code.split("-")
        by_subsection.setdefault(int(number), [None] * 10)[int(digit)] = label
    return _lookup(list(by_subsection.items()), subsection.try_cast("int"))


def tax_exempt_purpose(subsection: Column, classification: Column) -> Column:
    """Labels of all purposes, in digit order, joined by `` ;; ``.

    Every digit of the classification is one purpose; a repeated digit repeats
    its label. NULL if either code is NULL, empty text if no digit is known.
    """
    digits = F.sort_array(F.split(classification.cast("string"), ""))
    labels = F.transform(
        digits, lambda d: F.get(_purpose_labels(subsection), d.try_cast("int"))
    )
    return F.when(subsection.isNotNull(), F.array_join(labels, " ;; "))
