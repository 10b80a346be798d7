"""Expressions on mission codes (NTEE) and their three-part second version."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almoner.functions.codes import lookup_text

# --- fixed values -------------------------------------------------------------

# industry group -> major-group letters
INDUSTRY_LETTERS = {
    "ART": "A",
    "EDU": "B",
    "ENV": "CD",
    "HEL": "EFGH",
    "HMS": "IJKLMNOP",
    "IFA": "Q",
    "PSB": "RSTUVW",
    "REL": "X",
    "MMB": "Y",
    "UNU": "Z",
}

# divisions with an industry group of their own
INDUSTRY_DIVISIONS = {
    "UNI": ["B40", "B41", "B42", "B43", "B50"],
    "HOS": ["E20", "E21", "E22", "E24"],
}

# common codes that name a kind of organization instead of a mission
ORG_TYPES = {
    "01": "AA",
    "02": "MT",
    "03": "PA",
    "05": "RP",
    "11": "MS",
    "12": "MM",
    "19": "NS",
}
REGULAR = "RG"

# a letter and two digits; specialty organizations may have two more
CODE_PATTERN = "^[A-Z][0-9]{2}"
DETAIL_PATTERN = "^[A-Z][0-9]{4}"

# --- end of fixed values --------------------------------------------------------


def _valid(code: Column, value: Column) -> Column:
    return F.when(code.rlike(CODE_PATTERN), value)


def _number(code: Column) -> Column:
    return F.substring(code, 2, 2)


def _division(code: Column) -> Column:
    specialty = _number(code).between("01", "19")
    digits = (
        F.when(specialty & code.rlike(DETAIL_PATTERN), F.substring(code, 4, 2))
        .when(specialty, F.lit("00"))
        .otherwise(_number(code))
    )
    return F.concat(major_group(code), digits)


def _industry(code: Column) -> Column:
    by_division = {d: group for group, ds in INDUSTRY_DIVISIONS.items() for d in ds}
    by_letter = {c: group for group, letters in INDUSTRY_LETTERS.items() for c in letters}
    return F.coalesce(
        lookup_text(by_division, _division(code)), lookup_text(by_letter, major_group(code))
    )


def _org_type(code: Column) -> Column:
    return lookup_text(ORG_TYPES, _number(code), REGULAR)


def major_group(code: Column) -> Column:
    """First letter of a mission code."""
    return F.substring(code, 1, 1)


def org_type(code: Column) -> Column:
    """Kind of organization: the meaning of codes x01-x19, else regular."""
    return _valid(code, _org_type(code))


def division(code: Column) -> Column:
    """Letter + two digits. Specialty codes x01-x19 give x00, or the division
    named by two further digits (B0129 -> B29)."""
    return _valid(code, _division(code))


def industry(code: Column) -> Column:
    """Industry group, decided by the division first and the letter second."""
    return _valid(code, _industry(code))


def nteev2(code: Column) -> Column:
    """``INDUSTRY-DIVISION-TYPE``; NULL for anything that is not a mission code."""
    parts = F.concat(_industry(code), F.lit("-"), _division(code), F.lit("-"), _org_type(code))
    return _valid(code, parts)


def ntee_level(v2: Column, level: int) -> Column:
    """Levels 1-5 of a second-version code: industry, letter, letter + digit,
    division, organization type (``EDU``, ``B``, ``B2``, ``B29``, ``RG``)."""
    if level == 1:
        return F.split_part(v2, F.lit("-"), F.lit(1))
    if level == 5:
        return F.split_part(v2, F.lit("-"), F.lit(3))
    if level in (2, 3, 4):
        return F.substring(F.split_part(v2, F.lit("-"), F.lit(2)), 1, level - 1)
    raise ValueError(f"level must be 1-5, not {level}")
