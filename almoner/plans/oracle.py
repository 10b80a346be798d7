"""ANSI SQL for the registered queries, for checking results with another engine.

Written against the given tables only; shares the fixed values with the library
but none of its expressions.
"""

from __future__ import annotations

from almoner.fixed import crosswalk as xw
from almoner.fixed import dictionaries
from almoner.fixed.columns import FINAL_COLUMNS, FINAL_NAMES, LABELLING_COLUMNS, UNIFIED_SCHEMA
from almoner.functions import taxonomy
from almoner.plans import fixtures as fx
from almoner.plans import geography, refreshing
from almoner.plans import queries as q


def _lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def _list(values: list) -> str:
    kind = "VARCHAR[]" if any(isinstance(v, str) for v in values) else "INTEGER[]"
    return f"CAST([{', '.join(map(_lit, values))}] AS {kind})"


def _pick(values: list, index: str) -> str:
    return f"list_extract({_list(values)}, CAST(({index}) % {len(values)} AS INTEGER) + 1)"


def _values(rows: list[tuple], name: str, columns: str) -> str:
    body = ", ".join("(" + ", ".join(map(_lit, row)) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def _registry_cte(k: str = "c_custkey") -> str:
    block = (
        f"lpad(CAST({k} % 50 + 1 AS VARCHAR), 2, '0') || lpad(CAST({k} % 199 AS VARCHAR), 3, '0') || "
        f"lpad(CAST({k} % 9999 AS VARCHAR), 6, '0') || lpad(CAST({k} % 4000 AS VARCHAR), 4, '0')"
    )
    columns = {
        "EIN": f"CAST({k} + 10000001 AS VARCHAR)",
        "ORG_NAME_CURRENT": "c_name",
        "ORG_NAME_SEC": "c_mktsegment",
        "ORG_PERS_ICO": _pick(fx.IN_CARE_OF, k),
        "ORG_FISCAL_PERIOD": f"{k} % 13",
        "BMF_ORGANIZATION_CODE": f"{k} % 8",
        "ORG_RULING_DATE": f"CAST(1950 + {k} % 70 AS VARCHAR) || lpad(CAST({k} % 12 + 1 AS VARCHAR), 2, '0')",
        "ORG_RULING_YEAR": f"CASE WHEN {k} % 17 <> 0 THEN 1950 + {k} % 70 END",
        "ORG_YEAR_FIRST": f"CASE WHEN {k} % 23 <> 0 THEN 1989 + {k} % 20 END",
        "ORG_YEAR_LAST": f"CASE WHEN {k} % 23 <> 0 THEN 1989 + {k} % 20 + ({k} // 3) % 12 END",
        "ORG_YEAR_COUNT": f"CASE WHEN {k} % 23 <> 0 THEN ({k} // 3) % 12 + 1 END",
        "NTEE_IRS": _pick(fx.NTEE, k),
        "NTEE_NCCS": _pick(fx.NTEE, f"{k} // 2"),
        "NCCS_LEVEL_1": _pick(fx.LEVEL_1, k),
        "NCCS_LEVEL_2": _pick(fx.LEVEL_2, f"{k} // 2"),
        "NCCS_LEVEL_3": _pick(fx.LEVEL_3, f"{k} // 3"),
        "BMF_SUBSECTION_CODE": _pick(fx.SUBSECTION, k),
        "BMF_CLASSIFICATION_CODE": _pick(fx.CLASSIFICATION, f"{k} // 3"),
        "BMF_DEDUCTIBILITY_CODE": _pick(fx.DEDUCTIBILITY, f"{k} // 2"),
        "BMF_FILING_REQ_CODE": _pick(fx.FILING_REQ, f"{k} // 2"),
        "BMF_PF_FILING_REQ_CODE": _pick(fx.PF_FILING, f"{k} // 5"),
        "BMF_FOUNDATION_CODE": _pick(fx.FOUNDATION, f"{k} // 3"),
        "BMF_STATUS_CODE": _pick(fx.STATUS, k),
        "BMF_AFFILIATION_CODE": _pick(fx.AFFILIATION, f"{k} // 11"),
        "BMF_GROUP_EXEMPT_NUM": _pick(fx.GROUP_EXEMPT, f"{k} // 7"),
        "BMF_INCOME_CODE": f"({k} // 4) % 11",
        "BMF_ASSET_CODE": f"{k} % 11",
        "ORG_FISCAL_YEAR": f"1990 + {k} % 31",
        "F990_TOTAL_REVENUE_RECENT": f"{k} * 97 % 1000003",
        "F990_TOTAL_INCOME_RECENT": f"{k} * 89 % 999983",
        "F990_TOTAL_ASSETS_RECENT": f"CASE WHEN {k} % 4 <> 0 THEN {k} * 83 % 999979 END",
        "F990_ORG_ADDR_STREET": _pick(fx.ADDRESS, f"{k} + 3"),
        "F990_ORG_ADDR_CITY": f"'CITY ' || CAST({k} % 97 AS VARCHAR)",
        "F990_ORG_ADDR_STATE": "'S' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')",
        "F990_ORG_ADDR_ZIP": f"lpad(CAST({k} % 99999 AS VARCHAR), 5, '0')",
        "CENSUS_URBAN_AREA": _pick(fx.URBAN, k),
        "CENSUS_STATE_ABBR": "'S' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')",
        "CENSUS_COUNTY_NAME": f"'COUNTY ' || CAST({k} % 31 AS VARCHAR)",
        "CENSUS_CBSA_NAME": f"CASE WHEN {k} % 5 <> 0 THEN 'CBSA ' || CAST({k} % 19 AS VARCHAR) END",
        "CENSUS_CBSA_FIPS": f"CASE WHEN {k} % 5 <> 0 THEN CAST(10000 + {k} % 19 AS VARCHAR) END",
        "CENSUS_BLOCK_FIPS": f"CASE WHEN {k} % 10 <> 9 THEN {block} END",
        "ORG_ADDR_FULL": _pick(fx.ADDRESS, k),
        "ORG_ADDR_MATCH": _pick(fx.MATCHED, k),
        "LATITUDE": f"{k} % 180 - 90",
        "LONGITUDE": f"{k} % 360 - 180",
        "GEOCODER_SCORE": f"{k} % 101",
        "GEOCODER_MATCH": _pick(fx.MATCH_TYPE, k),
    }
    types = {"string": "VARCHAR", "integer": "INTEGER", "long": "BIGINT", "double": "DOUBLE"}
    kinds = {f.name: types[f.dataType.typeName()] for f in UNIFIED_SCHEMA}
    body = ", ".join(f"CAST({expr} AS {kinds[c]}) AS {c}" for c, expr in columns.items())
    return f"registry AS (SELECT {body} FROM customer)"


def _pad(text: str, width: int = 2) -> str:
    text = f"CAST({text} AS VARCHAR)"
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"


_DIVISIONS = [(d, g) for g, ds in taxonomy.INDUSTRY_DIVISIONS.items() for d in ds]
_LETTERS = [(c, g) for g, letters in taxonomy.INDUSTRY_LETTERS.items() for c in letters]


def _case(key: str, pairs: list[tuple], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {key} = {_lit(a)} THEN {_lit(b)}" for a, b in pairs)
    return f"CASE {arms} ELSE {default} END"


def _is_ntee(code: str) -> str:
    return f"regexp_matches({code}, '^[A-Z][0-9][0-9]')"


def _division(code: str) -> str:
    full = f"regexp_matches({code}, '^[A-Z][0-9][0-9][0-9][0-9]')"
    special = f"CAST(substr({code}, 2, 2) AS INTEGER) BETWEEN 1 AND 19"
    return (
        f"CASE WHEN NOT {_is_ntee(code)} THEN NULL "
        f"WHEN {special} AND {full} THEN substr({code}, 1, 1) || substr({code}, 4, 2) "
        f"WHEN {special} THEN substr({code}, 1, 1) || '00' ELSE substr({code}, 1, 3) END"
    )


def _industry(code: str) -> str:
    by_letter = _case(f"substr({code}, 1, 1)", _LETTERS)
    return f"CASE WHEN {_is_ntee(code)} THEN {_case(_division(code), _DIVISIONS, by_letter)} END"


def _org_type(code: str) -> str:
    kinds = _case(f"substr({code}, 2, 2)", list(taxonomy.ORG_TYPES.items()), "'RG'")
    return f"CASE WHEN {_is_ntee(code)} THEN {kinds} END"


def _nteev2(code: str) -> str:
    return f"({_industry(code)}) || '-' || ({_division(code)}) || '-' || ({_org_type(code)})"


_EIN9 = "lpad(EIN, 9, '0')"
_EIN2 = f"'EIN-' || substr({_EIN9}, 1, 2) || '-' || substr({_EIN9}, 3, 7)"

_UNIFIED = (
    f"unified AS (SELECT * EXCLUDE (EIN), {_EIN9} AS EIN, {_EIN2} AS EIN2, "
    f"{_nteev2('NTEE_IRS')} AS NTEEV2 FROM registry)"
)

_RENAMES = ", ".join(f"{old} AS {new}" for old, new in FINAL_NAMES.items())
_INPUT = f"""input AS (
  SELECT * EXCLUDE ({", ".join(FINAL_NAMES)}), {_RENAMES},
    '501C_' || {_pad("BMF_SUBSECTION_CODE")} AS ORG_TYPE_501C,
    CASE WHEN BMF_PF_FILING_REQ_CODE IS NULL THEN NULL
         WHEN BMF_PF_FILING_REQ_CODE BETWEEN 1 AND 3 THEN 1 ELSE 0 END AS ORG_TYPE_PF
  FROM unified)"""

_NEVER = "ORG_TYPE_501C IS NOT NULL AND ORG_TYPE_501C NOT IN ('501C_03', '501C_92')"


def _strip(code: str) -> str:
    once = f"regexp_replace(CAST({code} AS VARCHAR), '([0-9][0-9])0$', '\\1')"
    return f"nullif(regexp_replace({once}, '([0-9])0$', '\\1'), '888')"


_IMPUTED = f"""imputed AS (
  SELECT * REPLACE (
    CASE WHEN {_NEVER} THEN 0 ELSE ORG_TYPE_PF END AS ORG_TYPE_PF,
    CASE WHEN {_NEVER} THEN 0 ELSE BMF_PF_FILING_REQ_CODE END AS BMF_PF_FILING_REQ_CODE,
    CASE WHEN BMF_GROUP_EXEMPT_NUM = 0 AND (BMF_AFFILIATION_CODE IS NULL OR BMF_AFFILIATION_CODE NOT IN (1, 2))
         THEN 3 ELSE BMF_AFFILIATION_CODE END AS BMF_AFFILIATION_CODE,
    CASE WHEN NCCS_LEVEL_3 IN ('-', '') THEN NULL ELSE NCCS_LEVEL_3 END AS NCCS_LEVEL_3)
  FROM input)"""

_RECODED = f"""recoded AS (
  SELECT * REPLACE (
    CASE WHEN BMF_PF_FILING_REQ_CODE IN (1, 2, 3) THEN 'PF' ELSE {_pad(_strip("BMF_FILING_REQ_CODE"))} END
      AS BMF_FILING_REQ_CODE)
  FROM imputed)"""

_DICTIONARY = _values(
    dictionaries.long_rows(),
    "dictionary",
    'variable, code, label, ord, "role", affiliation, description, "desc", form',
)

_PURPOSES = """purposes AS (
  SELECT o.EIN2, string_agg(p.label, ' ;; ' ORDER BY p.code) AS purpose
  FROM (SELECT EIN2, BMF_SUBSECTION_CODE AS s,
          unnest(string_split(CAST(BMF_CLASSIFICATION_CODE AS VARCHAR), '')) AS d
        FROM unified WHERE BMF_CLASSIFICATION_CODE IS NOT NULL) o
  JOIN dictionary p ON p.variable = 'BMF_TAX_EXEMPT_PURP' AND p.code = CAST(o.s AS VARCHAR) || '-' || o.d
  GROUP BY o.EIN2)"""

_WITH_PURPOSE = """with_purpose AS (
  SELECT u.*, CASE WHEN u.BMF_SUBSECTION_CODE IS NULL OR u.BMF_CLASSIFICATION_CODE IS NULL THEN NULL
                   ELSE coalesce(p.purpose, '') END AS BMF_TAX_EXEMPT_PURP
  FROM unified u LEFT JOIN purposes p ON p.EIN2 = u.EIN2)"""

_LABELLED_VARIABLES = sorted(q.LABEL_QUERIES.values())


def _labelled_ctes() -> list[str]:
    joins = " ".join(
        f"LEFT JOIN dictionary d{i} ON d{i}.variable = '{v}' AND d{i}.code = CAST(r.{v} AS VARCHAR)"
        for i, v in enumerate(_LABELLED_VARIABLES)
    )
    replaced = ", ".join(f"d{i}.label AS {v}" for i, v in enumerate(_LABELLED_VARIABLES))
    return [
        f"labels AS (SELECT r.EIN, {replaced} FROM recoded r {joins})",
        f"""labelled AS (
          SELECT {", ".join(("l." + c if c in _LABELLED_VARIABLES else "p." + c if c == "BMF_TAX_EXEMPT_PURP" else "r." + c) + " AS " + c for c in FINAL_COLUMNS)}
          FROM recoded r JOIN labels l ON l.EIN = r.EIN JOIN with_purpose p ON p.EIN = r.EIN)""",
    ]


_STAGES = [
    _registry_cte(), _UNIFIED, _INPUT, _IMPUTED, _RECODED, _DICTIONARY, _PURPOSES, _WITH_PURPOSE,
    *_labelled_ctes(),
]


def _with(select: str, *extra: str) -> str:
    return "WITH " + ",\n".join([*_STAGES, *extra]) + "\n" + select


def _freq(table: str, column: str) -> str:
    return f"SELECT {column} AS value, count(*) AS n FROM {table} GROUP BY 1"


# --- releases ---------------------------------------------------------------------

_YEAR = "CAST(year(o_orderdate) AS INTEGER)"
_GROUP = "lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0')"
_RAW = f"""raw AS (
  SELECT CAST(o_custkey + 10000001 AS VARCHAR) AS EIN, {_YEAR} AS VINTAGE,
    CAST(o_orderkey AS VARCHAR) AS NCCS_RANDOM_NUMBER, o_totalprice AS amount,
    CAST(o_totalprice AS VARCHAR) AS amount_text,
    {_pick(fx.NTEE, f"o_custkey + {_YEAR}")} AS BMF_NTEE,
    CAST({_pick(fx.SUBSECTION, "o_custkey + o_orderkey")} AS VARCHAR) AS BMF_SUBSECTION_CODE,
    {_YEAR} < {fx.NEW_LAYOUT_FROM} AS older, {_GROUP} AS group_number, o_orderkey, o_orderstatus
  FROM orders)"""

_GROUP_TEXT = "CASE WHEN older AND o_orderkey % 2 = 1 THEN ' ' || group_number ELSE group_number END"
_RENAMED = f"""SELECT EIN AS F990_ORG_EIN, VINTAGE, NCCS_RANDOM_NUMBER, amount_text AS F990_TOTAL_ASSETS, BMF_NTEE,
    BMF_SUBSECTION_CODE, {_GROUP_TEXT} AS BMF_GROUP_EXEMPT_NUM"""
_TYPED = f"""SELECT lpad(EIN, 9, '0') AS F990_ORG_EIN, VINTAGE, NCCS_RANDOM_NUMBER, amount AS F990_TOTAL_ASSETS, BMF_NTEE,
    {_pad("BMF_SUBSECTION_CODE")} AS BMF_SUBSECTION_CODE, group_number AS BMF_GROUP_EXEMPT_NUM"""
_META = "CASE WHEN older THEN o_orderstatus END AS TAPE_REEL, CASE WHEN NOT older THEN o_orderstatus END AS BATCH"

_RELEASES = f"""releases AS (
  SELECT lpad(EIN, 9, '0') AS EIN, 'EIN-' || substr(lpad(EIN, 9, '0'), 1, 2) || '-' || substr(lpad(EIN, 9, '0'), 3, 7) AS EIN2,
    VINTAGE, NCCS_RANDOM_NUMBER, amount AS F990_TOTAL_ASSETS, BMF_NTEE AS NTEE_IRS,
    CAST(BMF_SUBSECTION_CODE AS INTEGER) AS BMF_SUBSECTION_CODE,
    CAST(group_number AS INTEGER) AS BMF_GROUP_EXEMPT_NUM, o_orderkey AS RECORD_ID
  FROM raw)"""

_RELEASE_COLUMNS = [
    "EIN2", "VINTAGE", "NCCS_RANDOM_NUMBER", "F990_TOTAL_ASSETS", "NTEE_IRS",
    "BMF_SUBSECTION_CODE", "BMF_GROUP_EXEMPT_NUM", "RECORD_ID",
]


def _latest(where: str = "TRUE") -> str:
    return (
        f"SELECT * FROM releases WHERE {where} "
        "QUALIFY row_number() OVER (PARTITION BY EIN ORDER BY VINTAGE DESC, RECORD_ID DESC) = 1"
    )


_BUILT = (
    "SELECT EIN, max(VINTAGE) AS VINTAGE, "
    + ", ".join(
        f"arg_max({c}, VINTAGE * 10000000000 + RECORD_ID) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in ("F990_TOTAL_ASSETS", "NTEE_IRS", "BMF_SUBSECTION_CODE", "BMF_GROUP_EXEMPT_NUM")
    )
    + """, min(VINTAGE) AS ORG_YEAR_FIRST, max(VINTAGE) AS ORG_YEAR_LAST,
      CAST(count(DISTINCT VINTAGE) AS INTEGER) AS ORG_YEAR_COUNT,
      max(VINTAGE) = (SELECT max(VINTAGE) FROM releases) AS ACTIVE
    FROM releases GROUP BY EIN"""
)

_ORG = "lpad(CAST(o_custkey + 10000001 AS VARCHAR), 9, '0')"

_FILINGS = f"""filings AS (
  SELECT {_ORG} AS EIN, o_totalprice AS revenue,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 2 END AS income,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * 2 END AS assets
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderkey DESC) = 1)"""

# --- census ------------------------------------------------------------------------

_PANEL = """panel AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS geoid, CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey AS k,
    CAST(count(*) AS DOUBLE) AS total_population, CAST(count(*) * 2 AS DOUBLE) AS housing_units,
    CASE WHEN c_nationkey % 4 <> 1 THEN CAST((c_nationkey * 7 + year(o_orderdate)) % 100 AS DOUBLE) END AS poverty_perc,
    CAST(50000 + c_nationkey * 1000 AS DOUBLE) AS med_household_income_adj
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, year(o_orderdate))"""

_REGIONS = """regions AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS region, year,
    sum(total_population) AS total_population, sum(housing_units) AS housing_units,
    sum(poverty_perc * total_population) / sum(total_population) FILTER (WHERE poverty_perc IS NOT NULL) AS poverty_perc,
    CAST(NULL AS DOUBLE) AS med_household_income_adj
  FROM panel LEFT JOIN nation ON n_nationkey = k AND n_nationkey <> 24 GROUP BY 1, 2)"""

_AREAS = """areas AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS geoid, CAST(count(*) * 100 AS BIGINT) AS population,
    CASE WHEN n_nationkey % 6 <> 0 THEN CAST(n_regionkey AS VARCHAR) END AS csa
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY n_nationkey, n_regionkey)"""

_CLASS = (
    "CASE WHEN population > 50000 THEN 'Metropolitan' WHEN population >= 10000 THEN 'Micropolitan' END"
)


def _plain(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select if ctes else select


def _years(expr: str) -> str:
    return ", ".join(expr.format(y=y) for y in q.YEARS)


_TRACTS = """tracts AS (
  SELECT c_nationkey || '-' || c_mktsegment AS geoid, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(count(*) AS DOUBLE) AS total_population, CAST(count(*) * 2 AS DOUBLE) AS housing_units,
    CASE WHEN c_nationkey % 4 <> 1 THEN CAST((c_nationkey * 7 + year(o_orderdate)) % 100 AS DOUBLE) END AS poverty_perc,
    CAST(50000 + c_nationkey * 1000 AS DOUBLE) AS med_household_income_adj
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, c_mktsegment, year(o_orderdate))"""
_GEOGRAPHIES = [("tract", "geoid", "tracts"), ("county", "geoid", "panel"), ("msa", "region", "regions")]

_FLAGS = r"""regexp_matches(ORG_ADDR_FULL, '[#@&%*]') AS has_special_chars,
    regexp_matches(ORG_ADDR_FULL, '(?i)P\.?O\.? Box') AS has_po_box,
    regexp_matches(ORG_ADDR_FULL, '(?i)(RR|Rural Route)') AS has_rural_route,
    NOT regexp_matches(ORG_ADDR_FULL, '[0-9]') AS missing_number"""
_ANY_FLAG = "has_special_chars OR has_po_box OR has_rural_route OR missing_number"
_ADDRESS_COLUMNS = [c for c in UNIFIED_SCHEMA.names if "ADDR_" in c]


def _sample() -> str:
    return _with(
        f"""SELECT EIN, {", ".join(_ADDRESS_COLUMNS)}, has_special_chars, has_po_box, has_rural_route, missing_number
        FROM flagged WHERE {_ANY_FLAG} ORDER BY md5('123:' || EIN), EIN LIMIT 100""",
        f"flagged AS (SELECT *, {_FLAGS} FROM unified)",
    )


def _codebook(variable: str, columns: str) -> str:
    return _with(
        f"""SELECT d.ord, {columns}, count(r.EIN) AS n FROM dictionary d
        LEFT JOIN registry r ON CAST(r.{variable} AS VARCHAR) = d.code
        WHERE d.variable = '{variable}' GROUP BY ALL"""
    )


def _label_sql(variable: str) -> str:
    return _with(f"SELECT EIN, {variable} FROM labels")


def _coverage() -> str:
    present = [*UNIFIED_SCHEMA.names, "ORG_TYPE_501C", "ORG_TYPE_PF"]
    back = {new: old for old, new in FINAL_NAMES.items()}
    back.update({old: new for old, new in FINAL_NAMES.items()})
    rows = []
    for c in present:
        kind = "kept" if c in LABELLING_COLUMNS else "dropped"
        stored = back.get(c, c) if c in FINAL_NAMES else c
        rows.append(f"SELECT '{c}' AS column_name, '{kind}' AS kind, count({stored}) AS n_not_null FROM input")
    rows += [
        f"SELECT '{c}', 'missing', CAST(0 AS BIGINT)" for c in LABELLING_COLUMNS if c not in present
    ]
    return _with(" UNION ALL ".join(rows))


_LISTS = _values(
    [
        (c, xw.SUBSECTION_CODES.get(c), dict(dictionaries.SECOND_SUBSECTION_LIST).get(c))
        for c in sorted({*xw.SUBSECTION_CODES, *dict(dictionaries.SECOND_SUBSECTION_LIST)})
    ],
    "lists",
    "code, first_label, second_label",
)

_CLASSIFICATION = _values(list(xw.CLASSIFICATION_CODES.items()), "classification", "code, label")


def _plain_label(label: str) -> str:
    bare = f"regexp_replace({label}, ' \\(501C[0-9]+-[0-9]\\)$', '')"
    bare = f"regexp_replace({bare}, ' \\(Created Before [0-9/]+\\)', '')"
    return f"replace(replace(replace({bare}, '.', ''), '''', ''), ',', '')"


_SUBTYPES = _values(dictionaries.EXEMPT_SUBTYPE, "subtype", "type_501c, exempt_subtype")
_TYPE_COUNTS = """typed AS (
  SELECT i.ORG_TYPE_501C AS type_501c, count(*) AS n, s.exempt_subtype
  FROM input i JOIN subtype s ON s.type_501c = i.ORG_TYPE_501C GROUP BY ALL)"""

_EFFECT = [
    f"SELECT '{stage}' AS stage, '{v}' AS variable, CAST({v} AS VARCHAR) AS value FROM {table}"
    for stage, table in (("before", "input"), ("after", "imputed"))
    for v in ("ORG_TYPE_PF", "BMF_PF_FILING_REQ_CODE")
]


def _usage() -> str:
    cases = [
        f"SELECT '{v}' AS variable, CAST({c} AS VARCHAR) AS code FROM registry"
        for v, c in q.DICTIONARY_SOURCES.items()
    ]
    return " UNION ALL ".join(cases)


ORACLE: dict[str, str] = {
    # sources and sinks
    "src_unified_csv": _with(f"SELECT {', '.join(UNIFIED_SCHEMA.names)} FROM unified"),
    "src_crosswalk": (
        "SELECT 'D' || CAST(doc_id AS VARCHAR) AS NAME_OLD, source AS NAME_NEW, "
        "'CHAR(' || CAST(n_chars AS VARCHAR) || ')' AS SQL_DTYPE, text AS \"DESC\", "
        "CAST(NULL AS VARCHAR) AS SERIES FROM documents"
    ),
    "src_manifest": f"""
        WITH keys AS (
          SELECT {_pick(["raw/bmf/", "legacy/bmf/", "other/"], "doc_id")} ||
            CASE WHEN doc_id % 100 > 1
                 THEN source || '-' || CAST(doc_id AS VARCHAR) || {_pick([".csv", ".dat"], "doc_id")}
                 ELSE '' END AS key
          FROM documents),
        split AS (
          SELECT key, f.folder, split_part(key, f.folder, 2) AS filename
          FROM keys JOIN (VALUES ('raw/bmf/'), ('legacy/bmf/')) f(folder) ON contains(key, f.folder))
        SELECT key, filename, '{q.BASE_URL}' || folder || filename AS url FROM split WHERE length(filename) > 1""",
    "src_multiformat": _plain(
        f"""SELECT CASE WHEN older THEN 'older.dat' ELSE 'newer.csv' END AS source_file, EIN AS F990_ORG_EIN,
          CAST(VINTAGE AS VARCHAR) AS VINTAGE, amount_text AS F990_TOTAL_ASSETS, BMF_NTEE, BMF_SUBSECTION_CODE,
          {_GROUP_TEXT} AS BMF_GROUP_EXEMPT_NUM, {_META}
        FROM raw""",
        _RAW,
    ),
    "src_ingest_errors": """
        SELECT 'events.csv' AS filename, 'ok' AS status, event_type, count(*) AS n_records,
          count(*) FILTER (WHERE value < 1) AS n_bad
        FROM events GROUP BY event_type
        UNION ALL SELECT 'absent.csv', 'error', NULL, NULL, NULL
        UNION ALL SELECT 'sheet.xyz', 'error', NULL, NULL, NULL""",
    "sink_raw_csv": "SELECT event_id, user_id, props, event_type AS file_root FROM events",
    "sink_labeled": _with(
        "SELECT *, 'csv' AS format FROM labelled UNION ALL SELECT *, 'parquet' AS format FROM labelled"
    ),
    "sink_purpose": _with(
        """SELECT EIN2, BMF_TAX_EXEMPT_PURP, f.format FROM with_purpose,
        (VALUES ('csv'), ('parquet')) f(format) WHERE BMF_TAX_EXEMPT_PURP IS NOT NULL"""
    ),
    "sink_dictionaries": _with(
        """SELECT d.*, coalesce(u.n, 0) AS n FROM dictionary d LEFT JOIN
        (SELECT variable, code, count(*) AS n FROM used GROUP BY ALL) u
        ON u.variable = d.variable AND u.code = d.code AND d.label IS NOT NULL""",
        f"used AS ({_usage()})",
    ),
    "sink_addr_sample": _sample(),
    "src_stage": _with(
        "SELECT EIN2, ORG_TYPE_501C, NTEE_IRS, BMF_STATUS_CODE, F990_FORM_YEAR, CENSUS_STATE_ABBR FROM labelled"
    ),
    # harmonization
    "harmonize_rename": _plain(f"{_RENAMED}, {_META} FROM raw", _RAW),
    "harmonize_cast": _plain(f"{_TYPED}, {_META} FROM raw", _RAW),
    "harmonize_drop_meta": _plain(f"{_RENAMED} FROM raw", _RAW),
    "vintage_union": _plain(f"{_TYPED} FROM raw", _RAW),
    "xwalk_json_dict": """
        SELECT event_id, k AS code, json_extract_string(props, '$.' || k) AS label
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""",
    "xwalk_dict_check": _with(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS list, coalesce(a.code, b.code, o.code) AS code, a.label AS left_label, b.label AS right_label,
          CASE WHEN a.label IS NULL AND b.label IS NULL THEN 'in neither'
               WHEN a.label IS NULL THEN 'right only' WHEN b.label IS NULL THEN 'left only'
               WHEN a.label = b.label THEN 'same'
               WHEN {_plain_label("a.label")} = {_plain_label("b.label")} THEN 'same up to suffix'
               ELSE 'different' END AS status,
          coalesce(o.n, 0) AS n
        FROM (SELECT ltrim(code, '0') AS code, label FROM {left}) a
        FULL JOIN (SELECT ltrim(code, '0') AS code, label FROM {right}) b ON a.code = b.code
        FULL JOIN {observed} o ON o.code = coalesce(a.code, b.code)"""
            for name, left, right, observed in (
                ("CLASSIFICATION", "classification", "(SELECT * FROM dictionary WHERE variable = 'BMF_TAX_EXEMPT_PURP')", "observed_purposes"),
                ("SUBSECTION", "subsection", "second_subsection", "observed_subsections"),
            )
        ),
        _CLASSIFICATION,
        _values(list(xw.SUBSECTION_CODES.items()), "subsection", "code, label"),
        _values(dictionaries.SECOND_SUBSECTION_LIST, "second_subsection", "code, label"),
        """observed_purposes AS (
          SELECT CAST(BMF_SUBSECTION_CODE AS VARCHAR) || '-' || d AS code, count(*) AS n
          FROM (SELECT BMF_SUBSECTION_CODE, unnest(string_split(CAST(BMF_CLASSIFICATION_CODE AS VARCHAR), '')) AS d
                FROM registry WHERE BMF_SUBSECTION_CODE IS NOT NULL AND BMF_CLASSIFICATION_CODE IS NOT NULL)
          GROUP BY 1)""",
        """observed_subsections AS (
          SELECT CAST(BMF_SUBSECTION_CODE AS VARCHAR) AS code, count(*) AS n
          FROM registry WHERE BMF_SUBSECTION_CODE IS NOT NULL GROUP BY 1)""",
    ),
    "ein2": _with(f"SELECT {_EIN9} AS EIN, {_EIN2} AS EIN2 FROM registry"),
    "unified_latest": _plain(_latest(), _RAW, _RELEASES),
    "org_year_span": f"""
        SELECT {_ORG} AS EIN, CAST(min(year(o_orderdate)) AS INTEGER) AS ORG_YEAR_FIRST,
          CAST(max(year(o_orderdate)) AS INTEGER) AS ORG_YEAR_LAST,
          CAST(count(DISTINCT year(o_orderdate)) AS INTEGER) AS ORG_YEAR_COUNT
        FROM orders GROUP BY 1""",
    "active_inactive": f"""
        SELECT {_ORG} AS EIN, CAST(max(year(o_orderdate)) AS INTEGER) AS LAST_VINTAGE,
          CASE WHEN max(year(o_orderdate)) = (SELECT max(year(o_orderdate)) FROM orders)
               THEN 'ACTIVE' ELSE 'INACTIVE' END AS STATUS
        FROM orders GROUP BY 1""",
    "f990_recent": _with(
        """SELECT u.EIN, EIN2,
          coalesce(revenue, CAST(F990_TOTAL_REVENUE_RECENT AS DOUBLE)) AS F990_TOTAL_REVENUE_RECENT,
          coalesce(income, CAST(F990_TOTAL_INCOME_RECENT AS DOUBLE)) AS F990_TOTAL_INCOME_RECENT,
          coalesce(assets, CAST(F990_TOTAL_ASSETS_RECENT AS DOUBLE)) AS F990_TOTAL_ASSETS_RECENT
        FROM unified u LEFT JOIN filings f ON f.EIN = u.EIN""",
        _FILINGS,
    ),
    "unified_upsert": _plain(
        "SELECT coalesce(n.EIN, o.EIN) AS EIN, "
        + ", ".join(f"coalesce(n.{c}, o.{c}) AS {c}" for c in _RELEASE_COLUMNS)
        + " FROM older_table o FULL JOIN newer_table n ON n.EIN = o.EIN",
        _RAW,
        _RELEASES,
        f"older_table AS ({_latest('VINTAGE < (SELECT max(VINTAGE) FROM releases)')})",
        f"newer_table AS ({_latest('VINTAGE = (SELECT max(VINTAGE) FROM releases)')})",
    ),
    "build_unified": _plain(_BUILT, _RAW, _RELEASES),
    "unified_refresh": _plain(_BUILT, _RAW, _RELEASES),
    "append_fips": _with(
        """SELECT EIN, EIN2, u.block AS CENSUS_BLOCK_FIPS, substr(b.block, 1, 11) AS TRACT_FIPS,
          substr(b.block, 1, 5) AS COUNTY_FIPS, substr(b.block, 1, 2) AS STATE_FIPS,
          'Z' || substr(b.block, 6, 5) AS ZCTA
        FROM (SELECT EIN, EIN2, CASE WHEN CAST(EIN AS BIGINT) % 26 = 0 THEN '99' || substr(CENSUS_BLOCK_FIPS, 3)
                                     ELSE CENSUS_BLOCK_FIPS END AS block FROM unified) u
        LEFT JOIN (SELECT DISTINCT CENSUS_BLOCK_FIPS AS block FROM registry) b ON b.block = u.block"""
    ),
    # derivation and labelling
    "pad_code": _with(
        f"SELECT EIN, {_pad('BMF_SUBSECTION_CODE')} AS subsection, {_pad('BMF_FILING_REQ_CODE')} AS filing FROM registry"
    ),
    "org_type_501c": _with(
        "SELECT CAST(CAST(EIN AS BIGINT) AS VARCHAR) AS EIN, BMF_SUBSECTION_CODE, ORG_TYPE_501C FROM input"
    ),
    "org_type_pf": _with(
        "SELECT CAST(CAST(EIN AS BIGINT) AS VARCHAR) AS EIN, BMF_PF_FILING_REQ_CODE, ORG_TYPE_PF FROM input"
    ),
    "rename_final": _with(
        f"SELECT * EXCLUDE ({', '.join(FINAL_NAMES)}), {_RENAMES} FROM registry"
    ),
    "schema_diff": _coverage(),
    "select_strict": _with(f"SELECT {', '.join(LABELLING_COLUMNS)} FROM input"),
    "impute_nonpf": _with("SELECT EIN, ORG_TYPE_501C, ORG_TYPE_PF, BMF_PF_FILING_REQ_CODE FROM imputed"),
    "impute_affiliation": _with("SELECT EIN, BMF_GROUP_EXEMPT_NUM, BMF_AFFILIATION_CODE FROM imputed"),
    "sentinel_to_null": _with(
        """SELECT EIN, nullif(NCCS_LEVEL_1, '') AS NCCS_LEVEL_1, nullif(NCCS_LEVEL_2, '') AS NCCS_LEVEL_2,
        nullif(nullif(NCCS_LEVEL_3, ''), '-') AS NCCS_LEVEL_3 FROM registry"""
    ),
    "label_factor": _with(
        """SELECT EIN, BMF_STATUS_CODE, d.label, d.ord FROM registry LEFT JOIN dictionary d
        ON d.variable = 'BMF_STATUS_CODE' AND d.code = CAST(BMF_STATUS_CODE AS VARCHAR)"""
    ),
    **{name: _label_sql(variable) for name, variable in q.LABEL_QUERIES.items()},
    "tax_exempt_purpose": _with(
        "SELECT EIN2, BMF_SUBSECTION_CODE, BMF_CLASSIFICATION_CODE, BMF_TAX_EXEMPT_PURP FROM with_purpose"
    ),
    "purpose_merge": _with(
        """SELECT EIN2, BMF_SUBSECTION_CODE, BMF_TAX_EXEMPT_PURP FROM with_purpose
        WHERE BMF_TAX_EXEMPT_PURP IS NOT NULL"""
    ),
    "filing_req_strip": _with(
        f"SELECT EIN, BMF_FILING_REQ_CODE, {_strip('BMF_FILING_REQ_CODE')} AS stripped FROM registry"
    ),
    "filing_req_pad": _with(
        f"SELECT EIN, BMF_FILING_REQ_CODE, {_pad(_strip('BMF_FILING_REQ_CODE'))} AS padded FROM registry"
    ),
    "filing_req_pf_override": _with("SELECT EIN, BMF_PF_FILING_REQ_CODE, BMF_FILING_REQ_CODE FROM recoded"),
    "label_registry": _with("SELECT * FROM labelled"),
    "subsection_reconcile": _with(
        """SELECT coalesce(l.code, o.code) AS code, coalesce(o.n, 0) AS n, first_label, second_label,
          CASE WHEN coalesce(l.code, o.code) = '92' THEN 'different meaning'
               WHEN first_label IS NULL AND second_label IS NOT NULL THEN 'missing from first list'
               WHEN second_label IS NULL AND first_label IS NOT NULL THEN 'missing from second list'
               WHEN first_label IS NULL THEN 'in neither list' END AS note
        FROM lists l FULL JOIN
          (SELECT substr(ORG_TYPE_501C, 6) AS code, count(*) AS n FROM input
           WHERE ORG_TYPE_501C IS NOT NULL GROUP BY 1) o ON o.code = l.code""",
        _LISTS,
    ),
    # reports
    "freq_counts": _with(_freq("labelled", "BMF_FOUNDATION_CODE")),
    "freq_props": _with(
        """SELECT NCCS_LEVEL_3 AS value, count(*) AS n,
          round(count(*) / CAST((SELECT count(*) FROM labelled) AS DOUBLE), 3) AS share
        FROM labelled GROUP BY 1"""
    ),
    "freq_factor_levels": _with(
        """SELECT d.ord, d.label, count(l.EIN) AS n FROM dictionary d
          LEFT JOIN labelled l ON l.BMF_FILING_REQ_CODE = d.label
        WHERE d.variable = 'BMF_FILING_REQ_CODE' GROUP BY ALL
        UNION ALL SELECT NULL, NULL, count(*) FROM labelled WHERE BMF_FILING_REQ_CODE IS NULL HAVING count(*) > 0"""
    ),
    "freq_alpha": _with(
        """SELECT 'ORG_TYPE_501C' AS variable, CAST(NULL AS INTEGER) AS ord, ORG_TYPE_501C AS value, count(*) AS n
        FROM labelled GROUP BY ALL
        UNION ALL
        SELECT 'BMF_ASSET_LEVEL', d.ord, l.BMF_ASSET_LEVEL, count(*) FROM labelled l
          LEFT JOIN dictionary d ON d.variable = 'BMF_ASSET_LEVEL' AND d.label = l.BMF_ASSET_LEVEL GROUP BY ALL"""
    ),
    "freq_format": f"""
        WITH t AS (SELECT '501C_' || lpad(CAST({_pick(fx.SUBSECTION, "o_orderkey")} AS VARCHAR), 2, '0') AS value FROM orders)
        SELECT value, format('{{:,}}', count(*)) AS n,
          format('{{:.3f}}', round(count(*) / CAST((SELECT count(*) FROM t) AS DOUBLE), 3)) AS share
        FROM t GROUP BY 1""",
    "crosstab_with_na": _with(
        "SELECT ORG_TYPE_501C AS value, "
        + ", ".join(f"count(*) FILTER (WHERE BMF_PF_FILING_REQ_CODE = {v}) AS n_{v}" for v in range(5))
        + ", count(*) FILTER (WHERE BMF_PF_FILING_REQ_CODE NOT BETWEEN 0 AND 4) AS n_other"
        + ", count(*) FILTER (WHERE BMF_PF_FILING_REQ_CODE IS NULL) AS n_missing FROM input GROUP BY 1"
    ),
    "crosstab_no_na": _with(
        "SELECT substr(NTEE_IRS, 1, 1) AS value, "
        + ", ".join(f"count(*) FILTER (WHERE substr(NTEE_NCCS, 1, 1) = '{c}') AS \"n_{c}\"" for c in q.LETTERS)
        + ", count(*) FILTER (WHERE substr(NTEE_NCCS, 1, 1) NOT BETWEEN 'A' AND 'Z') AS n_other"
        + " FROM registry WHERE NTEE_IRS IS NOT NULL AND NTEE_NCCS IS NOT NULL GROUP BY 1"
    ),
    "ntee_major": _with("SELECT EIN, substr(NTEE_IRS, 1, 1) AS first_letter, substr(NTEE_NCCS, 1, 1) AS second_letter FROM registry"),
    "ntee_agreement": _with(
        """SELECT substr(NTEE_IRS, 1, 1) AS first_letter, substr(NTEE_NCCS, 1, 1) AS second_letter, count(*) AS n
        FROM registry WHERE NTEE_IRS IS NOT NULL AND NTEE_NCCS IS NOT NULL GROUP BY 1, 2"""
    ),
    "year_gather_count": _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS key, {c} AS value, count(*) AS n FROM labelled GROUP BY 2"
            for c in ("ORG_YEAR_FIRST", "ORG_YEAR_LAST")
        )
    ),
    "year_histograms": _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS measure, {c} AS value, count(*) AS n FROM labelled WHERE {c} IS NOT NULL GROUP BY 2"
            for c in ("ORG_RULING_YEAR", "ORG_YEAR_FIRST", "ORG_YEAR_LAST", "ORG_YEAR_COUNT")
        )
    ),
    "exempt_subtype_join": _with("SELECT type_501c, n, exempt_subtype FROM typed", _SUBTYPES, _TYPE_COUNTS),
    "exempt_hierarchy": _with(
        """SELECT 'edge' AS kind, exempt_subtype AS source, type_501c AS name,
          CAST(NULL AS DOUBLE) AS size, CAST(NULL AS VARCHAR) AS type FROM typed
        UNION ALL SELECT 'vertex', NULL, type_501c, sqrt(n), exempt_subtype FROM typed
        UNION ALL SELECT DISTINCT 'vertex', NULL, exempt_subtype, CAST(0 AS DOUBLE), exempt_subtype || '_X' FROM typed""",
        _SUBTYPES,
        _TYPE_COUNTS,
    ),
    "treemap_prep": _with(
        """SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, ord) AS INTEGER) AS colour_slot,
          CAST(row_number() OVER (ORDER BY ord) AS INTEGER) AS id
        FROM (SELECT d.ord, d.label, count(l.EIN) AS n FROM dictionary d
                LEFT JOIN labelled l ON l.BMF_FOUNDATION_CODE = d.label
              WHERE d.variable = 'BMF_FOUNDATION_CODE' GROUP BY ALL)"""
    ),
    "level_bars": _with(
        """SELECT 'BMF_ASSET_LEVEL' AS measure, d.ord, l.BMF_ASSET_LEVEL AS label, count(*) AS n FROM labelled l
          LEFT JOIN dictionary d ON d.variable = 'BMF_ASSET_LEVEL' AND d.label = l.BMF_ASSET_LEVEL GROUP BY ALL
        UNION ALL
        SELECT 'BMF_INCOME_LEVEL', d.ord, d.label, count(l.EIN) FROM dictionary d
          LEFT JOIN labelled l ON l.BMF_INCOME_LEVEL = d.label WHERE d.variable = 'BMF_INCOME_LEVEL' GROUP BY ALL
        UNION ALL
        SELECT 'BMF_INCOME_LEVEL', NULL, NULL, count(*) FROM labelled WHERE BMF_INCOME_LEVEL IS NULL HAVING count(*) > 0"""
    ),
    "codebook_rows": _codebook(
        "BMF_AFFILIATION_CODE", 'd.code, d."role", d.affiliation, d.label, d.description'
    ),
    "dictionary_lookup": _codebook("BMF_STATUS_CODE", 'd.code, d.label, d."desc"'),
    "distinct_codes": _with("SELECT DISTINCT BMF_FILING_REQ_CODE FROM registry"),
    "before_after_impute": _with(
        """SELECT stage, variable, value, count(*) AS n,
          round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY stage, variable) AS DOUBLE), 3) AS share
        FROM cases GROUP BY stage, variable, value""",
        f"cases AS ({' UNION ALL '.join(_EFFECT)})",
    ),
    # addresses
    "addr_columns": _with(f"SELECT {', '.join(_ADDRESS_COLUMNS)} FROM registry"),
    "addr_flags": _with(f"SELECT EIN, ORG_ADDR_FULL, {_FLAGS} FROM registry"),
    "addr_difficult": _with(
        f"SELECT * FROM (SELECT EIN, ORG_ADDR_FULL, {_FLAGS} FROM registry) WHERE {_ANY_FLAG}"
    ),
    "addr_sample": _sample(),
    # taxonomy and geography
    "ntee_industry": _with(f"SELECT EIN, NTEE_IRS, {_industry('NTEE_IRS')} AS industry FROM registry"),
    "ntee_org_type": _with(f"SELECT EIN, NTEE_IRS, {_org_type('NTEE_IRS')} AS org_type FROM registry"),
    "ntee_division": _with(f"SELECT EIN, NTEE_NCCS, {_division('NTEE_NCCS')} AS division FROM registry"),
    "nteev2": _with(f"SELECT EIN, NTEE_IRS, {_nteev2('NTEE_IRS')} AS NTEEV2 FROM registry"),
    "ntee_levels": _with(
        f"""SELECT EIN, NTEEV2, split_part(NTEEV2, '-', 1) AS NTEE1, substr(split_part(NTEEV2, '-', 2), 1, 1) AS NTEE2,
          substr(split_part(NTEEV2, '-', 2), 1, 2) AS NTEE3, split_part(NTEEV2, '-', 2) AS NTEE4,
          split_part(NTEEV2, '-', 3) AS NTEE5
        FROM (SELECT EIN, {_nteev2("NTEE_IRS")} AS NTEEV2 FROM registry)"""
    ),
    "fips_levels": _with(
        """SELECT EIN, CENSUS_BLOCK_FIPS, substr(CENSUS_BLOCK_FIPS, 1, 2) AS STATE_FIPS,
          substr(CENSUS_BLOCK_FIPS, 1, 5) AS COUNTY_FIPS, substr(CENSUS_BLOCK_FIPS, 1, 11) AS TRACT_FIPS,
          CENSUS_BLOCK_FIPS AS BLOCK_FIPS FROM registry"""
    ),
    # census
    "census_long": _plain(
        " UNION ALL ".join(
            f"""SELECT {area} AS geoid, year, total_population, housing_units, poverty_perc, med_household_income_adj, '{geo}' AS geo
        FROM {panel}"""
            for geo, area, panel in _GEOGRAPHIES
        ),
        _PANEL,
        _REGIONS,
        _TRACTS,
    ),
    "census_wide": _plain(
        " UNION ALL ".join(
            f"SELECT {area} AS geoid, '{geo}' AS geo, "
            + ", ".join(
                _years(f"max({c}) FILTER (WHERE year = {{y}}) AS {c}_{{y}}")
                for c in ("total_population", "housing_units", "poverty_perc", "med_household_income_adj")
            )
            + f" FROM {panel} GROUP BY {area}"
            for geo, area, panel in _GEOGRAPHIES
        ),
        _PANEL,
        _REGIONS,
        _TRACTS,
    ),
    "census_inflation": _plain(
        f"""SELECT geoid, year, total_population, housing_units, poverty_perc, CASE WHEN year BETWEEN 1996 AND 2001
          THEN med_household_income_adj * (1 + (2021 - year) / CAST(32 AS DOUBLE)) END AS med_household_income_adj
        FROM panel""",
        _PANEL,
    ),
    "census_apportion": _plain(
        """SELECT CAST(new AS VARCHAR) AS geoid, year, sum(total_population * weight) AS total_population,
          sum(housing_units * weight) AS housing_units
        FROM (SELECT k AS new, year, total_population, housing_units, 0.75::DOUBLE AS weight FROM panel WHERE k <> 23
              UNION ALL SELECT (k + 1) % 25, year, total_population, housing_units, 0.25::DOUBLE FROM panel WHERE k <> 23
              UNION ALL SELECT NULL, year, total_population, housing_units, 1.0::DOUBLE FROM panel WHERE k = 23)
        GROUP BY 1, 2""",
        _PANEL,
    ),
    "geo_rollup": _plain("SELECT * FROM regions", _PANEL, _REGIONS),
    "geo_hierarchy": """
        SELECT n_regionkey AS state, n_nationkey AS county, c_mktsegment AS tract, count(*) AS population,
          CAST(GROUPING(n_regionkey, n_nationkey, c_mktsegment) AS BIGINT) AS level
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
        GROUP BY ROLLUP (n_regionkey, n_nationkey, c_mktsegment)""",
    "cbsa_classify": _plain(f"SELECT *, {_CLASS} AS cbsa_class FROM areas", _AREAS),
    "cbsa_union": _plain(
        f"""SELECT geoid, population, csa, {_CLASS} AS cbsa_class, FALSE AS in_both FROM areas
        WHERE population >= 10000""",
        _AREAS,
    ),
    "csa_rollup": _plain(
        """SELECT 'combined' AS kind, csa AS id, count(*) AS n_areas, CAST(sum(population) AS BIGINT) AS population
        FROM areas WHERE csa IS NOT NULL GROUP BY csa
        UNION ALL SELECT 'unattached', geoid, 1, population FROM areas WHERE csa IS NULL""",
        _AREAS,
    ),
    "append_census": _plain(
        """SELECT o_orderkey AS RECORD_ID, CAST(o_custkey % 26 AS VARCHAR) AS geoid,
          CAST(year(o_orderdate) AS INTEGER) AS year, total_population, housing_units, poverty_perc,
          med_household_income_adj
        FROM orders LEFT JOIN panel p ON p.k = o_custkey % 26 AND p.year = year(o_orderdate)""",
        _PANEL,
    ),
    "geo_reports": _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, {c} AS value, count(*) AS n FROM labelled GROUP BY 2"
            for c in ("CENSUS_STATE_ABBR", "CENSUS_URBAN_AREA", "CENSUS_CBSA_NAME")
        )
    ),
}

ORACLE.update(geography.ORACLE)

_NOTES = f"notes AS (SELECT event_id, user_id, {refreshing.NOTE.format(newline='chr(10)')} AS note FROM events)"
_UPDATED = ["F990_TOTAL_ASSETS", "NTEE_IRS", "BMF_SUBSECTION_CODE", "BMF_GROUP_EXEMPT_NUM"]
ORACLE.update(
    {
        "ingest_ranges": _plain(
            """SELECT 'first' AS source, CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, note, NULL AS problem
            FROM notes WHERE event_id % 2 = 0
            UNION ALL SELECT 'second', CAST(event_id AS VARCHAR), NULL, note, NULL FROM notes WHERE event_id % 2 = 1
            UNION ALL SELECT 'third', CASE WHEN event_id % 50 <> 0 THEN CAST(event_id AS VARCHAR) END, NULL,
              CASE WHEN event_id % 50 <> 0 THEN 'ok' END, CASE WHEN event_id % 50 = 0 THEN 'structure' END FROM events
            UNION ALL SELECT 'absent.csv', NULL, NULL, NULL, 'FileNotFoundError'""",
            _NOTES,
        ),
        "kept_report": _plain(
            " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM built GROUP BY 2" for c in refreshing.REPORTED),
            _RAW,
            _RELEASES,
            f"built AS ({_BUILT})",
        ),
        "bucket_upsert": _plain(
            "SELECT coalesce(n.EIN, o.EIN) AS EIN, "
            + ", ".join(f"coalesce(n.{c}, o.{c}) AS {c}" for c in ("VINTAGE", *_UPDATED))
            + " FROM older_table o FULL JOIN newer_table n ON n.EIN = o.EIN",
            _RAW,
            _RELEASES,
            f"older_table AS ({_latest('VINTAGE < (SELECT max(VINTAGE) FROM releases)')})",
            f"newer_table AS ({_latest('VINTAGE = (SELECT max(VINTAGE) FROM releases)')})",
        ),
        "committed_sink": """
            SELECT format, o_orderkey, o_custkey, o_orderpriority FROM orders, (VALUES ('parquet'), ('csv')) f(format)""",
    }
)
