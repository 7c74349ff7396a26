"""Queries for parsing functions, authors and journals.

Dirty inputs are derived from keys by indexing fixed arrays, so both engines
build exactly the same strings from the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bindings import query
from .session import materialize
from .functions import numbers as nu
from .functions import text as tx
from .plans.analogue import _sql_array, load

# ---------------------------------------------------------------------------
# SQL forms of the parsing expressions
# ---------------------------------------------------------------------------


def sql_roman(s: str) -> str:
    total = " + ".join(f"{v} * (length({s}) - length(replace({s}, '{ch}', '')))"
                       for ch, v in nu.ROMAN_VALUES.items())
    pattern = nu.ROMAN_PATTERN.strip("^$")
    return (f"(CASE WHEN regexp_full_match({s}, '{pattern}') AND length({s}) > 0 THEN CAST("
            f"{total} - CASE WHEN contains({s}, 'CM') OR contains({s}, 'CD') THEN 200 ELSE 0 END"
            f" - CASE WHEN contains({s}, 'XC') OR contains({s}, 'XL') THEN 20 ELSE 0 END"
            f" - CASE WHEN contains({s}, 'IX') OR contains({s}, 'IV') THEN 2 ELSE 0 END"
            f" AS INTEGER) END)")


def sql_volume(s: str) -> str:
    v = f"coalesce(TRY_CAST({s} AS INTEGER), {sql_roman(s)}, 0)"
    return f"(CASE WHEN {v} > 10000 THEN 0 ELSE {v} END)"


def sql_issue(s: str) -> str:
    return f"coalesce(TRY_CAST({s} AS INTEGER), TRY_CAST(substr({s}, 1, 1) AS INTEGER), 0)"


def sql_page(s: str) -> str:
    return f"coalesce(TRY_CAST({s} AS INTEGER), {sql_roman(f'upper({s})')}, 0)"


def sql_page_count(s: str) -> str:
    end, start = f"string_split({s}, '-')[2]", f"string_split({s}, '-')[1]"
    d = f"({sql_page(end)} - {sql_page(start)})"
    return f"(CASE WHEN {d} > 0 AND {d} < 2000000000 THEN {d} ELSE 0 END)"


def sql_clean_name(s: str) -> str:
    x = f"regexp_replace({s}, '[0-9]+', '', 'g')"
    x = rf"regexp_replace({x}, '&\w+', '', 'g')"
    x = rf"regexp_replace({x}, '@\w+', '', 'g')"
    x = rf"regexp_replace({x}, '\| ', '', 'g')"
    x = f"regexp_replace({x}, '[;().|]', '', 'g')"
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_name_parts(s: str) -> tuple[str, str, str]:
    parts = f"string_split({s}, ', ')"
    fm = f"string_split({parts}[2], ' ')"
    return f"{parts}[1]", f"{fm}[1]", f"{fm}[2]"


# ---------------------------------------------------------------------------
# X11 / X12 / X13 / P11 on part keys
# ---------------------------------------------------------------------------

# fixed values: dirty volume, issue and numeral cells (indexed by key % length)
VOLUMES = ("12", " 7 ", "XIV", "xiv", "IIII", "MMMM", "10000", "10001", "-3", "12a",
           "III", "MCMXCIX")
ISSUES = ("3", "3-4", "12-13", "Suppl", "", "7", " 2 ")
NUMERALS = ("XIV", "MCMXCIX", "CDXLIV", "XL", "DCCC", "IIII", "iv", "12", "", "MMMM",
            "IX", "MMMCMXCIX", "XC", "VV", "CM")


def _cell(values, key: str):
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.col(key) % len(values) + 1).cast("int"))


def _sql_cell(values, key: str) -> str:
    return f"{_sql_array(values)}[CAST({key} % {len(values)} AS INTEGER) + 1]"


def _parse_query(name: str, values, fn, sql_fn):
    sql = (f"SELECT p_partkey, raw, {sql_fn('raw')} AS value FROM "
           f"(SELECT p_partkey, {_sql_cell(values, 'p_partkey')} AS raw FROM part)")

    def run(spark: SparkSession, sf: str) -> DataFrame:
        p = load(spark, sf, "part").select("p_partkey", _cell(values, "p_partkey").alias("raw"))
        return p.withColumn("value", fn("raw"))
    query(name, sql)(run)


_parse_query("volume_to_int", VOLUMES, nu.volume_to_int, sql_volume)
_parse_query("issue_to_int", ISSUES, nu.issue_to_int, sql_issue)
_parse_query("roman_to_int", NUMERALS,
             lambda c: F.coalesce(nu.roman_to_int(c), F.lit(0)),
             lambda s: f"coalesce({sql_roman(s)}, 0)")


# ---------------------------------------------------------------------------
# X14 / X15 / X2 / X27 / P11 on line items
# ---------------------------------------------------------------------------

# fixed values: page ranges of every form (null included)
PAGE_RANGES = ("10-20", "iv-x", "17", "20-10", "1-2-3", None, "xiv-xx", "e12-14",
               "IX-XII", "5-5")


@query("page_count", f"""
SELECT l_orderkey, l_linenumber, pages, CAST({sql_page_count('pages')} AS INTEGER) AS no_of_pages
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber % 4 = 0
                  THEN [{", ".join("NULL" if v is None else repr(v) for v in PAGE_RANGES)}][CAST(l_orderkey % {len(PAGE_RANGES)} AS INTEGER) + 1]
                  ELSE CAST(l_partkey % 500 AS VARCHAR) || '-' || CAST(l_partkey % 500 + CAST(floor(l_quantity) AS BIGINT) AS VARCHAR)
             END AS pages
      FROM lineitem)
""")
def page_count(spark: SparkSession, sf: str) -> DataFrame:
    ranges = F.array(*[F.lit(v).cast("string") for v in PAGE_RANGES])
    li = load(spark, sf, "lineitem")
    pages = F.when(F.col("l_linenumber") % 4 == 0,
                   F.element_at(ranges, (F.col("l_orderkey") % len(PAGE_RANGES) + 1).cast("int"))
                   ).otherwise(F.concat((F.col("l_partkey") % 500).cast("string"), F.lit("-"),
                                        (F.col("l_partkey") % 500 + F.floor("l_quantity").cast("bigint"))
                                        .cast("string")))
    return li.select("l_orderkey", "l_linenumber", pages.alias("pages")).withColumn(
        "no_of_pages", nu.page_count("pages").cast("int"))


# ---------------------------------------------------------------------------
# Raw years, some out of range or missing -> 1 January
# ---------------------------------------------------------------------------

# fixed values: shifts applied to order years to reach the range edges
YEAR_SHIFTS = (0, -320, 270, -318, 264, 0, -319)


@query("year_date", f"""
SELECT o_orderkey, raw_year,
       CAST(CASE WHEN raw_year > 1676 AND raw_year < 2263 THEN make_date(raw_year, 1, 1)
                 ELSE DATE '1678-01-01' END AS VARCHAR) AS year
FROM (SELECT o_orderkey,
             CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                  ELSE CAST(year(o_orderdate) + [{", ".join(map(str, YEAR_SHIFTS))}][CAST(o_orderkey % {len(YEAR_SHIFTS)} AS INTEGER) + 1] AS INTEGER)
             END AS raw_year
      FROM orders)
""")
def year_date(spark: SparkSession, sf: str) -> DataFrame:
    shifts = F.array(*[F.lit(v) for v in YEAR_SHIFTS])
    o = load(spark, sf, "orders")
    raw = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("int")).otherwise(
        (F.year("o_orderdate") + F.element_at(shifts, (F.col("o_orderkey") % len(YEAR_SHIFTS) + 1)
                                              .cast("int"))).cast("int"))
    return o.select("o_orderkey", raw.alias("raw_year")).withColumn(
        "year", nu.year_to_date("raw_year").cast("string"))


# ---------------------------------------------------------------------------
# Author names built from part names with noise
# ---------------------------------------------------------------------------

# fixed values: noise appended to names
NAME_NOISE = ("", "1", " A", "@uni", " &amp; (PhD)", " J. R.", "| x", " B C D")


def _raw_names(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    full = F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(", "),
                    F.split_part("p_name", F.lit(" "), F.lit(1)), _cell(NAME_NOISE, "p_partkey"))
    return p.select("p_partkey", "p_type", "p_brand", "p_size", full.alias("fullname"))


SQL_RAW_NAMES = (f"SELECT p_partkey, p_type, p_brand, p_size, split_part(p_name, ' ', 2) || ', ' "
                 f"|| split_part(p_name, ' ', 1) || {_sql_cell(NAME_NOISE, 'p_partkey')} AS fullname FROM part")


@query("name_clean", f"SELECT p_partkey, fullname, {sql_clean_name('fullname')} AS clean FROM ({SQL_RAW_NAMES})")
def name_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_names(spark, sf).select("p_partkey", "fullname", tx.clean_name("fullname").alias("clean"))


_S, _F, _M = sql_name_parts("clean")


@query("name_split", f"""
SELECT p_partkey, {_S} AS surname, {_F} AS firstname, {_M} AS middlename
FROM (SELECT p_partkey, {sql_clean_name('fullname')} AS clean FROM ({SQL_RAW_NAMES}))
""")
def name_split(spark: SparkSession, sf: str) -> DataFrame:
    n = tx.split_fullname(tx.clean_name("fullname"))
    return _raw_names(spark, sf).select("p_partkey", n["surname"].alias("surname"),
                                        n["firstname"].alias("firstname"),
                                        n["middlename"].alias("middlename"))


# ---------------------------------------------------------------------------
# A4 / A5 / A9 / PL2: conform authors (mode per attribute per name)
# ---------------------------------------------------------------------------

def _author_rows(spark: SparkSession, sf: str) -> DataFrame:
    r = _raw_names(spark, sf)
    return r.select(
        "fullname",
        F.when(F.col("p_size") % 4 == 0, F.lit(None)).otherwise(
            F.concat(F.lower("p_type"), F.lit("@example.org"))).alias("email"),
        F.col("p_brand").alias("departments"),
        F.when(F.col("p_size") % 3 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("Inst "), (F.col("p_size") % 5).cast("string"))).alias("institutions"),
        F.concat(F.lit("C"), (F.col("p_size") % 7).cast("string")).alias("countries"))


SQL_AUTHOR_ROWS = f"""SELECT fullname,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE lower(p_type) || '@example.org' END AS email,
  p_brand AS department,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'Inst ' || CAST(p_size % 5 AS VARCHAR) END AS institution,
  'C' || CAST(p_size % 7 AS VARCHAR) AS country
FROM ({SQL_RAW_NAMES})"""

ATTRS = ["email", "department", "institution", "country"]
NAME = ["surname", "firstname", "middlename"]


def _ns(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def sql_mode_per_attribute(src: str, group: list[str], first: list[str], prefix: str) -> str:
    """CTEs ``{prefix}_*``; the last one, ``{prefix}``, has group + first + ATTRS."""
    ctes = []
    gl = ", ".join(group)
    for a in ATTRS:
        ctes.append(f"{prefix}_{a} AS (SELECT {gl}, {a} FROM (SELECT {gl}, {a}, row_number() OVER "
                    f"(PARTITION BY {gl} ORDER BY count(*) DESC, {a}) AS rn FROM {src} "
                    f"WHERE {a} IS NOT NULL GROUP BY {gl}, {a}) WHERE rn = 1)")
    firsts = "".join(f", min({c}) AS {c}" for c in first)
    ctes.append(f"{prefix}_g AS (SELECT {gl}{firsts} FROM {src} GROUP BY {gl})")
    joins = " ".join(f"LEFT JOIN {prefix}_{a} ON {_ns('g', prefix + '_' + a, group)}" for a in ATTRS)
    sel = ", ".join([f"g.{c}" for c in group + first] + [f"{prefix}_{a}.{a}" for a in ATTRS])
    ctes.append(f"{prefix} AS (SELECT {sel} FROM {prefix}_g g {joins})")
    return ",\n".join(ctes)


def _conform_sql() -> str:
    s, f, m = sql_name_parts("fullname")
    rows = (f"rows AS (SELECT fullname, {s} AS surname, {f} AS firstname, {m} AS middlename, "
            f"{', '.join(ATTRS)} FROM (SELECT {sql_clean_name('fullname')} AS fullname, "
            f"{', '.join(ATTRS)} FROM ({SQL_AUTHOR_ROWS})))")
    lvl1 = sql_mode_per_attribute("rows", ["fullname"], NAME, "per_name")
    lvl2 = sql_mode_per_attribute("per_name", NAME, [], "authors_a")
    return ",\n".join([rows, lvl1, lvl2])


@query("author_conform", "WITH " + _conform_sql() + "\nSELECT * FROM authors_a")
def author_conform(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.author import conform_authors
    return conform_authors(_author_rows(spark, sf))


# ---------------------------------------------------------------------------
# Reference author strings per order
# ---------------------------------------------------------------------------

def _author_token(k, w1, w2):
    """One author written in one of five forms (k = 0..4)."""
    return (F.when(k == 0, F.concat(w2, F.lit(", "), w1))
            .when(k == 1, F.concat(w2, F.lit(" "), w1))
            .when(k == 2, F.concat(w2, F.lit(", Van, "), w1))
            .when(k == 3, F.concat(w2, F.lit(", "), w1, F.lit(", Extra Name")))
            .otherwise(F.lit("ab")))


def _author_strings(spark: SparkSession, sf: str) -> DataFrame:
    """One reference per line item with two authors in varying forms."""
    li = load(spark, sf, "lineitem").join(
        load(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    w1 = F.split_part("p_name", F.lit(" "), F.lit(1))
    w2 = F.split_part("p_name", F.lit(" "), F.lit(2))
    first = _author_token(F.col("l_linenumber") % 5, w1, w2)
    second = _author_token((F.col("l_linenumber") + 2) % 5, w2, w1)
    return li.select("l_orderkey", "l_linenumber",
                     F.concat(first, F.lit("; "), second).alias("authors"))


def _sql_author_token(k: str, a: str, b: str) -> str:
    return (f"CASE {k} WHEN 0 THEN {b} || ', ' || {a} WHEN 1 THEN {b} || ' ' || {a} "
            f"WHEN 2 THEN {b} || ', Van, ' || {a} WHEN 3 THEN {b} || ', ' || {a} || ', Extra Name' "
            f"ELSE 'ab' END")


_W1, _W2 = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
SQL_AUTHOR_STRINGS = f"""SELECT l_orderkey, l_linenumber,
  {_sql_author_token('l_linenumber % 5', _W1, _W2)} || '; ' || {_sql_author_token('(l_linenumber + 2) % 5', _W2, _W1)} AS authors
FROM lineitem JOIN part ON l_partkey = p_partkey"""

_WORDS = "flatten(list_transform(l, lambda x: string_split(x, ' ')))"
_PAIRS = (f"CASE WHEN len({_WORDS}) // 2 >= 1 THEN list_transform(range(len({_WORDS}) // 2), "
          f"lambda i: {_WORDS}[2 * i + 1:2 * i + 2]) ELSE [] END")

SQL_AUTHOR_PAIRS = f"""
strings AS (SELECT row_number() OVER () AS rid, * FROM ({SQL_AUTHOR_STRINGS})),
authors AS (SELECT rid, l_orderkey, l_linenumber, unnest(range(len(parts))) AS apos, unnest(parts) AS author
            FROM (SELECT *, string_split(authors, '; ') AS parts FROM strings)),
lists AS (SELECT rid, l_orderkey, l_linenumber, apos, string_split(author, ', ') AS l0 FROM authors),
novan AS (SELECT rid, l_orderkey, l_linenumber, apos,
            CASE WHEN len(l0) >= 3 AND list_position(l0, 'Van') IS NOT NULL
                 THEN l0[1:list_position(l0, 'Van') - 1] || l0[list_position(l0, 'Van') + 1:]
                 ELSE l0 END AS l FROM lists),
parsed AS (SELECT rid, l_orderkey, l_linenumber, apos,
             CASE WHEN len(l) = 2 THEN [l]
                  WHEN len(l) > 2 THEN {_PAIRS}
                  WHEN len(l) = 1 AND length(l[1]) > 2 THEN {_PAIRS}
                  ELSE [] END AS ps FROM novan),
per_row AS (SELECT rid, l_orderkey, l_linenumber, flatten(list(ps ORDER BY apos)) AS ps
            FROM parsed GROUP BY rid, l_orderkey, l_linenumber),
pairs AS (SELECT l_orderkey, l_linenumber, unnest(range(len(ps))) AS author_position, unnest(ps) AS p
          FROM per_row)"""


@query("author_string_parse", "WITH " + SQL_AUTHOR_PAIRS.strip() + """
SELECT l_orderkey, l_linenumber, CAST(author_position AS INTEGER) AS author_position,
       p[1] AS surname, p[2] AS firstname
FROM pairs
""")
def author_string_parse(spark: SparkSession, sf: str) -> DataFrame:
    s = _author_strings(spark, sf)
    return s.select("l_orderkey", "l_linenumber", F.posexplode(tx.parse_author_string("authors"))
                    .alias("author_position", "p")).select(
        "l_orderkey", "l_linenumber", "author_position", F.get("p", 0).alias("surname"),
        F.get("p", 1).alias("firstname"))


# ---------------------------------------------------------------------------
# Two loads of the author dimension
# ---------------------------------------------------------------------------

def _supplier_refs(spark: SparkSession, sf: str) -> DataFrame:
    s = load(spark, sf, "part").join(load(spark, sf, "supplier"), F.col("s_suppkey") == F.col("p_partkey"), "left")
    w1 = F.split_part("p_name", F.lit(" "), F.lit(1))
    w2 = F.split_part("p_name", F.lit(" "), F.lit(2))
    first = F.when(F.col("s_nationkey") % 3 == 0,
                   F.concat(F.lit("Sup"), F.col("s_nationkey").cast("string"))).otherwise(w1)
    return s.select(F.concat(w2, F.lit(", "), first).alias("authors"))


SQL_SUPPLIER_REFS = """SELECT split_part(p_name, ' ', 2) || ', ' ||
  CASE WHEN s_nationkey % 3 = 0 THEN 'Sup' || CAST(s_nationkey AS VARCHAR) ELSE split_part(p_name, ' ', 1) END AS authors
FROM part LEFT JOIN supplier ON s_suppkey = p_partkey"""


def _author_merge_sql() -> str:
    allc = ", ".join(NAME + ATTRS)
    filled = ", ".join(f"coalesce({c}, 'MISSING') AS {c}" for c in NAME + ATTRS)
    grouped = ", ".join(NAME) + ", " + ", ".join(f"min({a}) AS {a}" for a in ATTRS)
    return "WITH " + _conform_sql() + f""",
first_src AS (SELECT {", ".join(NAME)}, {", ".join(f"min({a}) AS {a}" for a in ATTRS)}
              FROM (SELECT {filled} FROM authors_a) GROUP BY ALL),
first_load AS (SELECT CAST(row_number() OVER (ORDER BY {", ".join(NAME)}) AS BIGINT) AS author_pk, {allc}
               FROM first_src
               UNION ALL SELECT 0, 'MISSING', 'MISSING', 'MISSING', 'MISSING', 'MISSING', 'MISSING', 'MISSING'),
refs AS (SELECT DISTINCT p[1] AS surname, p[2] AS firstname, CAST(NULL AS VARCHAR) AS middlename
         FROM (SELECT unnest(ps) AS p FROM (
           SELECT flatten(list_transform(string_split(authors, '; '), lambda a:
             CASE WHEN len(string_split(a, ', ')) = 2 THEN [string_split(a, ', ')]
                  ELSE [] END)) AS ps
           FROM ({SQL_SUPPLIER_REFS})))),
merged AS (SELECT coalesce(a.surname, r.surname) AS surname, coalesce(a.firstname, r.firstname) AS firstname,
                  coalesce(a.middlename, r.middlename) AS middlename, a.email, a.department, a.institution, a.country
           FROM authors_a a FULL OUTER JOIN refs r ON {_ns('a', 'r', NAME)}),
second_src AS (SELECT {grouped} FROM (SELECT {filled} FROM merged) GROUP BY ALL),
delta AS (SELECT * FROM second_src s WHERE NOT EXISTS (
            SELECT 1 FROM first_load f WHERE f.surname = s.surname AND f.firstname = s.firstname
            AND f.middlename = s.middlename)),
mx AS (SELECT max(author_pk) AS m FROM first_load)
SELECT author_pk, {allc} FROM first_load
UNION ALL
SELECT CAST(m + row_number() OVER (ORDER BY {", ".join(NAME)}) AS BIGINT), {allc} FROM delta, mx
"""


@query("author_merge_dim", _author_merge_sql())
def author_merge_dim(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.author import author_delta, conform_authors, merge_authors, reference_authors
    a = conform_authors(_author_rows(spark, sf))
    first = materialize(author_delta(a, None))
    merged = merge_authors(a, reference_authors(_supplier_refs(spark, sf)))
    second = author_delta(merged, first)
    cols = ["author_pk"] + NAME + ATTRS
    return first.select(*cols).unionByName(second.select(*cols))


# ---------------------------------------------------------------------------
# PL3 / U1 / P2 / P5 / X11 / X12 / D1 / C4 / W2: two loads of the journal dimension
# ---------------------------------------------------------------------------

# fixed values: publisher names by nation for the supplier-side journals
PUBLISHERS = ("ECONOMY", "SMALL", "MEDIUM", "LARGE", "PROMO", "STANDARD")


def _journal_sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    p = load(spark, sf, "part")
    blank = F.col("p_size") > 45   # rows with no journal information at all (P2)
    papers = p.select(
        F.when(~blank, F.col("p_brand")).alias("journal"),
        F.when(~blank, _cell(VOLUMES, "p_partkey")).alias("volume"),
        F.when(~blank, _cell(ISSUES, "p_partkey")).alias("issue"),
        F.when(~blank, F.col("p_type")).alias("publisher"),
        F.when(~blank & (F.col("p_size") % 5 != 0),
               F.concat(F.lit("City"), (F.col("p_size") % 5).cast("string"))).alias("place"))
    s = load(spark, sf, "supplier")
    refs = s.select(
        F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 30).cast("string")).alias("journal"),
        _cell(VOLUMES, "s_suppkey").alias("volume"),
        _cell(ISSUES, "s_suppkey").alias("issue"),
        _cell(PUBLISHERS, "s_nationkey").alias("publisher"),
        F.when(F.col("s_nationkey") % 5 != 0,
               F.concat(F.lit("City"), (F.col("s_nationkey") % 5).cast("string"))).alias("place"))
    return papers, refs


def _journal_sql() -> str:
    vol, iss = sql_volume("coalesce(volume, '0')"), sql_issue("coalesce(issue, '0')")
    norm = (f"coalesce(journal, 'MISSING') AS title, {vol} AS volume, {iss} AS issue, "
            f"coalesce(publisher, 'MISSING') AS publisher, coalesce(place, 'MISSING') AS place")
    cols = "title, volume, issue, publisher, place"
    return f"""WITH
papers AS (SELECT CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS journal,
                  CASE WHEN p_size > 45 THEN NULL ELSE {_sql_cell(VOLUMES, 'p_partkey')} END AS volume,
                  CASE WHEN p_size > 45 THEN NULL ELSE {_sql_cell(ISSUES, 'p_partkey')} END AS issue,
                  CASE WHEN p_size > 45 THEN NULL ELSE p_type END AS publisher,
                  CASE WHEN p_size > 45 OR p_size % 5 = 0 THEN NULL ELSE 'City' || CAST(p_size % 5 AS VARCHAR) END AS place
           FROM part),
refs AS (SELECT 'Brand#' || CAST(s_suppkey % 30 AS VARCHAR) AS journal,
                {_sql_cell(VOLUMES, 's_suppkey')} AS volume, {_sql_cell(ISSUES, 's_suppkey')} AS issue,
                {_sql_cell(PUBLISHERS, 's_nationkey')} AS publisher,
                CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE 'City' || CAST(s_nationkey % 5 AS VARCHAR) END AS place
         FROM supplier),
first_src AS (SELECT DISTINCT {norm} FROM refs
              WHERE NOT (journal IS NULL AND volume IS NULL AND issue IS NULL AND publisher IS NULL AND place IS NULL)),
first_load AS (SELECT CAST(row_number() OVER (ORDER BY {cols}) AS BIGINT) AS journal_pk, {cols} FROM first_src
               UNION ALL SELECT 0, 'MISSING', 0, 0, 'MISSING', 'MISSING'),
second_src AS (SELECT DISTINCT {norm} FROM (SELECT * FROM refs UNION ALL SELECT * FROM papers)
               WHERE NOT (journal IS NULL AND volume IS NULL AND issue IS NULL AND publisher IS NULL AND place IS NULL)),
delta AS (SELECT {cols} FROM second_src EXCEPT SELECT {cols} FROM first_load),
mx AS (SELECT max(journal_pk) AS m FROM first_load)
SELECT journal_pk, {cols} FROM first_load
UNION ALL
SELECT CAST(m + row_number() OVER (ORDER BY {cols}) AS BIGINT), {cols} FROM delta, mx
"""


@query("journal_dim", _journal_sql())
def journal_dim(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.journal import JOURNAL, journal_delta, journal_source
    papers, refs = _journal_sources(spark, sf)
    first = materialize(journal_delta(journal_source(papers.filter(F.lit(False)), refs), None))
    second = journal_delta(journal_source(papers, refs), first)
    cols = ["journal_pk"] + JOURNAL
    return first.select(*cols).unionByName(second.select(*cols))

