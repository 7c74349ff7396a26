"""Queries for papers, paragraphs, sentences, entities, closure, facts, CDC and
integrity (SURVEY 7.4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bindings import query
from .session import materialize
from .operators import delta as dl
from .operators.closure import closure as closure_rows
from .operators.closure import closure_keys as closure_keys_op
from .operators.closure import leaves_by_count
from .operators.keys import dense_keys
from .plans.analogue import SQL_LINES, SQL_SENTENCES, lines, load, sentences
from .queries_parsing import sql_page_count

# ---------------------------------------------------------------------------
# Articles (orders) ⟗ references (line items)
# ---------------------------------------------------------------------------


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    # every eleventh customer's papers cite under a key that no reference has, every thirteenth's have none
    prefix = F.when(F.col("o_custkey") % 13 != 0, F.when(F.col("o_custkey") % 11 == 0, F.lit("X")).otherwise(F.lit("K")))
    return o.select(
        F.col("o_orderkey").alias("article_id"), F.lit(1).alias("author_position"),
        F.concat(prefix, F.col("o_orderkey").cast("string")).alias("citekey"),
        F.col("o_orderpriority").alias("abstract"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.concat(F.col("o_orderpriority"), F.lit(" order")).alias("title"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 100).alias("author_pk"),
        (F.col("o_custkey") % 40).cast("int").alias("number_of_pages"),
        (F.col("o_custkey") % 13).alias("journal_pk"), (F.col("o_custkey") % 17).alias("keyword_pk"))


def _references(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.numbers import page_count
    li = load(spark, sf, "lineitem")
    g = li.groupBy("l_orderkey").agg(
        F.year(F.min("l_shipdate")).alias("y"), F.min("l_linenumber").alias("lo"),
        F.max("l_linenumber").alias("hi"), F.min("l_suppkey").alias("s"),
        F.min("l_partkey").alias("p"))
    pages = F.concat(F.col("lo").cast("string"), F.lit("-"), (F.col("hi") * 10).cast("string"))
    return g.select(
        F.concat(F.lit("K"), F.col("l_orderkey").cast("string")).alias("citekey"),
        F.concat(F.lit("ref "), F.col("l_orderkey").cast("string")).alias("title"),
        (F.col("y") + F.when(F.col("l_orderkey") % 9 == 0, -400).otherwise(0)).cast("string").alias("year"),
        (F.col("s") % 100).alias("author_pk"), (F.col("p") % 13).alias("journal_pk"),
        F.lit(0).cast("bigint").alias("keyword_pk"), page_count(pages).alias("number_of_pages"))


@query("paper_merge", f"""
WITH art AS (
  SELECT o_orderkey AS article_id, 1 AS author_position, CASE WHEN o_custkey % 13 = 0 THEN NULL
         WHEN o_custkey % 11 = 0 THEN 'X' ELSE 'K' END || CAST(o_orderkey AS VARCHAR) AS citekey,
         o_orderpriority AS abstract, CAST(year(o_orderdate) AS VARCHAR) AS year,
         o_orderpriority || ' order' AS title,
         CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 100 END AS author_pk,
         CAST(o_custkey % 40 AS INTEGER) AS number_of_pages, o_custkey % 13 AS journal_pk,
         o_custkey % 17 AS keyword_pk
  FROM orders),
ref0 AS (
  SELECT l_orderkey, year(min(l_shipdate)) AS y, min(l_linenumber) AS lo, max(l_linenumber) AS hi,
         min(l_suppkey) AS s, min(l_partkey) AS p
  FROM lineitem GROUP BY l_orderkey),
ref AS (
  SELECT 'K' || CAST(l_orderkey AS VARCHAR) AS citekey, 'ref ' || CAST(l_orderkey AS VARCHAR) AS title,
         CAST(y + CASE WHEN l_orderkey % 9 = 0 THEN -400 ELSE 0 END AS VARCHAR) AS year,
         s % 100 AS author_pk, p % 13 AS journal_pk, 0 AS keyword_pk,
         {sql_page_count("(CAST(lo AS VARCHAR) || '-' || CAST(hi * 10 AS VARCHAR))")} AS number_of_pages
  FROM ref0),
m AS (
  SELECT a.article_id, a.author_position, coalesce(a.citekey, r.citekey) AS citekey, a.abstract,
         coalesce(TRY_CAST(a.year AS INTEGER), TRY_CAST(r.year AS INTEGER)) AS y,
         coalesce(a.title, r.title) AS title, coalesce(a.author_pk, r.author_pk) AS author_pk,
         coalesce(a.number_of_pages, r.number_of_pages) AS np,
         coalesce(a.journal_pk, r.journal_pk) AS journal_pk, a.keyword_pk
  FROM art a FULL OUTER JOIN ref r ON a.citekey = r.citekey)
SELECT CAST(coalesce(article_id, 0) AS BIGINT) AS article_id,
       CAST(coalesce(author_position, 0) AS INTEGER) AS author_position,
       coalesce(citekey, 'MISSING') AS citekey, coalesce(abstract, 'MISSING') AS abstract,
       CAST(CASE WHEN y > 1676 AND y < 2263 THEN make_date(y, 1, 1) ELSE DATE '1678-01-01' END AS VARCHAR) AS year,
       coalesce(title, 'MISSING') AS title, CAST(coalesce(author_pk, 0) AS BIGINT) AS author_pk,
       CAST(CASE WHEN np > 0 AND np < 2000000000 THEN np ELSE 0 END AS INTEGER) AS no_of_pages,
       CAST(coalesce(journal_pk, 0) AS BIGINT) AS journal_pk, CAST(coalesce(keyword_pk, 0) AS BIGINT) AS keyword_pk
FROM m
""")
def paper_merge(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.paper import merge_papers
    m = merge_papers(_articles(spark, sf), _references(spark, sf))
    return m.select(
        F.col("article_id").cast("bigint"), F.col("author_position").cast("int"), "citekey",
        "abstract", F.col("year").cast("string"), "title", F.col("author_pk").cast("bigint"),
        F.col("no_of_pages").cast("int"), F.col("journal_pk").cast("bigint"),
        F.col("keyword_pk").cast("bigint"))


# ---------------------------------------------------------------------------
# Composite-key lookups with 0 for unknown
# ---------------------------------------------------------------------------

@query("paper_lookup", """
WITH dim_author AS (
  SELECT surname, firstname, row_number() OVER (ORDER BY surname, firstname) AS author_pk
  FROM (SELECT DISTINCT split_part(p_name, ' ', 2) AS surname, split_part(p_name, ' ', 1) AS firstname
        FROM part)),
dim_journal AS (
  SELECT title, volume, row_number() OVER (ORDER BY title, volume) AS journal_pk
  FROM (SELECT DISTINCT 'J' || CAST(s_nationkey AS VARCHAR) AS title, s_suppkey % 5 AS volume FROM supplier)),
li AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN 'x' || split_part(p_name, ' ', 2)
         ELSE split_part(p_name, ' ', 2) END AS surname, split_part(p_name, ' ', 1) AS firstname,
         'J' || CAST(l_suppkey % 30 AS VARCHAR) AS jt, l_linenumber % 5 AS jv
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, l_linenumber, CAST(coalesce(a.author_pk, 0) AS BIGINT) AS author_pk,
       CAST(coalesce(j.journal_pk, 0) AS BIGINT) AS journal_pk
FROM li LEFT JOIN dim_author a ON li.surname = a.surname AND li.firstname = a.firstname
        LEFT JOIN dim_journal j ON li.jt = j.title AND li.jv = j.volume
""")
def paper_lookup(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.lookup import lookup_key
    part = load(spark, sf, "part")
    w1 = F.split_part("p_name", F.lit(" "), F.lit(1))
    w2 = F.split_part("p_name", F.lit(" "), F.lit(2))
    names = part.select(w2.alias("surname"), w1.alias("firstname"))
    # authors that the dimension doesn't have, and rows without a surname
    foreign = F.when(F.col("l_partkey") % 11 == 0, F.lit(None)).when(F.col("l_partkey") % 7 == 0, F.concat(F.lit("x"), w2)).otherwise(w2)
    dim_author = dense_keys(names, ["surname", "firstname"], "author_pk")
    sup = load(spark, sf, "supplier").select(
        F.concat(F.lit("J"), F.col("s_nationkey").cast("string")).alias("title"),
        (F.col("s_suppkey") % 5).alias("volume"))
    dim_journal = dense_keys(sup, ["title", "volume"], "journal_pk")
    li = load(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", foreign.alias("surname"), w1.alias("firstname"),
        F.concat(F.lit("J"), (F.col("l_suppkey") % 30).cast("string")).alias("jt"),
        (F.col("l_linenumber") % 5).alias("jv"))
    li = lookup_key(li, dim_author, ["surname", "firstname"], "author_pk")
    li = lookup_key(li, dim_journal, {"jt": "title", "jv": "volume"}, "journal_pk")
    return li.select("l_orderkey", "l_linenumber", "author_pk", "journal_pk")


# ---------------------------------------------------------------------------
# PL4 / W1 / W3 / M1 / M2 / M4 / D1 / D2: paper groups, bridges, owners
# ---------------------------------------------------------------------------

def _paper_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The tables of PL4 as a load builds them, from articles, their keywords and authors, and references,
    over dimensions that lack some of the keywords and authors."""
    from .plans.paper import article_parts, paper_tables, reference_parts
    o, li, part = load(spark, sf, "orders"), load(spark, sf, "lineitem"), load(spark, sf, "part")
    ck = F.when(F.col("o_custkey") % 13 != 0, F.concat(F.to_date("o_orderdate").cast("string"), F.lit("/"), F.col("o_orderpriority")))
    papers = o.select(
        F.col("o_orderkey").alias("article_id"), ck.alias("citekey"), F.lit("t ").alias("t"), "o_orderstatus",
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderpriority")).alias("abstract"),
        F.year("o_orderdate").cast("string").alias("year"), (F.col("o_custkey") % 40).cast("string").alias("number_of_pages"),
        *[F.lit(None).cast("string").alias(c) for c in ("journal", "journal_akronym", "publisher", "place", "volume", "issue",
                                                        "keywords", "authors")]) \
        .withColumn("title", F.concat("t", "o_orderstatus")).drop("t", "o_orderstatus")
    keywords = li.select(F.col("l_orderkey").alias("article_id"), F.concat(F.lit("Key "), (F.col("l_partkey") % 50).cast("string")).alias("keyword"))
    def name(number):  # names keep no digits
        return F.concat(F.lit("Sur"), F.translate(number.cast("string"), "0123456789", "abcdefghij"))
    authors = li.select(F.col("l_orderkey").alias("article_id"), F.col("l_linenumber").alias("author_position"),
                        F.concat(name(F.col("l_suppkey") % 40), F.lit(", Fi")).alias("fullname"))
    references = part.select(
        F.concat(F.date_add(F.lit("1992-01-01").cast("date"), (F.col("p_partkey") * 7 % 3000).cast("int")).cast("string"),
                 F.when(F.col("p_size") % 2 == 0, F.lit("/1-URGENT")).otherwise(F.lit("/none"))).alias("citekey"),
        F.col("p_name").alias("title"), F.concat(name(F.col("p_partkey") % 45), F.lit(", Fi")).alias("authors"),
        (F.col("p_size") + 1950).cast("string").alias("year"), F.lit("3-9").alias("pages"),
        *[F.lit(None).cast("string").alias(c) for c in ("journal", "publisher", "place", "volume", "issue")])
    n = spark.range(50)
    dim_keyword = n.filter("id % 9 <> 0").select((F.col("id") + 1).alias("keyword_pk"), F.concat(F.lit("key "), F.col("id").cast("string")).alias("keyword_string"))
    dim_author = n.filter("id % 7 <> 0").select((F.col("id") + 1).alias("author_pk"), name(F.col("id")).alias("surname"),
                                                F.lit("Fi").alias("firstname"), F.lit("MISSING").alias("middlename"))
    dim_journal = spark.range(1).select(F.lit(9).cast("bigint").alias("journal_pk"), *[F.lit("x").alias(c) for c in ("title", "publisher", "place")],
                                        F.lit(1).alias("volume"), F.lit(1).alias("issue"))
    return paper_tables(article_parts(papers, keywords, authors, dim_keyword, dim_author, dim_journal),
                        reference_parts(references, dim_author, dim_journal), None)


_SQL_PAPERS = """
art AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 13 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '/' || o_orderpriority END AS citekey,
  CASE WHEN o_custkey % 5 <> 0 THEN o_orderpriority END AS abstract, CAST(year(o_orderdate) AS INTEGER) AS y,
  't ' || o_orderstatus AS title, CAST(o_custkey % 40 AS INTEGER) AS np FROM orders
  UNION ALL SELECT DISTINCT l_orderkey, NULL, NULL, NULL, NULL, NULL FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)),
ref AS (SELECT CAST(DATE '1992-01-01' + CAST(p_partkey * 7 % 3000 AS INTEGER) AS VARCHAR) || CASE WHEN p_size % 2 = 0 THEN '/1-URGENT' ELSE '/none' END AS citekey,
  p_name AS title, CAST(p_size + 1950 AS INTEGER) AS y, 6 AS np, p_partkey % 45 AS au FROM part),
merged AS (SELECT a.id, coalesce(a.citekey, r.citekey) AS ck, a.abstract, coalesce(a.y, r.y) AS y, coalesce(a.title, r.title) AS title,
  coalesce(a.np, r.np) AS np, a.id IS NOT NULL AS own, r.citekey AS rkey FROM art a FULL JOIN ref r ON a.citekey = r.citekey),
full_rows AS (SELECT CAST(coalesce(id, 0) AS BIGINT) AS article_source_id, coalesce(ck, 'MISSING') AS citekey, coalesce(abstract, 'MISSING') AS abstract,
  CASE WHEN y > 1676 AND y < 2263 THEN make_date(y, 1, 1) ELSE DATE '1678-01-01' END AS year, coalesce(title, 'MISSING') AS title,
  CASE WHEN np > 0 THEN np ELSE 0 END AS no_of_pages, CAST(0 AS BIGINT) AS journal_pk, id, own, rkey FROM merged),
grp AS (SELECT citekey, CAST(row_number() OVER (ORDER BY citekey) AS BIGINT) AS g FROM (SELECT DISTINCT citekey FROM full_rows)),
r AS (SELECT f.*, g FROM full_rows f JOIN grp USING (citekey)),
kw AS (SELECT DISTINCT l_orderkey AS id, CASE WHEN l_partkey % 50 % 9 <> 0 THEN l_partkey % 50 + 1 ELSE 0 END AS keyword_pk FROM lineitem),
au AS (SELECT DISTINCT l_orderkey AS id, l_linenumber AS pos, CASE WHEN l_suppkey % 40 % 7 <> 0 THEN l_suppkey % 40 + 1 END AS author_pk FROM lineitem),
ref_au AS (SELECT DISTINCT citekey AS rkey, CASE WHEN au % 7 <> 0 THEN au + 1 END AS author_pk FROM ref),
members AS (
  SELECT g, author_pk, pos FROM r JOIN au USING (id) WHERE own AND author_pk IS NOT NULL
  UNION ALL SELECT g, 0, 0 FROM r WHERE own AND id NOT IN (SELECT id FROM au)
  UNION ALL SELECT g, coalesce(f.author_pk, 0), pos FROM r JOIN au USING (id) LEFT JOIN ref_au f USING (rkey) WHERE own AND au.author_pk IS NULL
  UNION ALL SELECT g, coalesce(f.author_pk, 0), 0 FROM r LEFT JOIN ref_au f USING (rkey) WHERE NOT own)"""


@query("paper_delta_groups_owner", "WITH " + _SQL_PAPERS.strip() + """,
owners AS (SELECT DISTINCT article_source_id, citekey, abstract, year, title, no_of_pages, journal_pk, g FROM r)
SELECT g AS keywordgroup_pk, g AS authorgroup_pk, journal_pk, CAST(year AS VARCHAR) AS year, title, citekey,
       abstract, CAST(no_of_pages AS INTEGER) AS no_of_pages, article_source_id FROM owners
UNION ALL SELECT 0, 0, 0, '1678-01-01', 'MISSING', 'MISSING', 'MISSING', 0, 0
""")
def paper_delta_groups_owner(spark: SparkSession, sf: str) -> DataFrame:
    out = _paper_tables(spark, sf)["dim_paper"]
    return out.drop("paper_pk").withColumn("year", F.col("year").cast("string"))


@query("paper_delta_keys", "WITH " + _SQL_PAPERS.strip() + """,
owners AS (SELECT DISTINCT article_source_id, citekey, abstract, year, title, no_of_pages, journal_pk, g FROM r)
SELECT g AS keywordgroup_pk, count(*) AS n_papers, CAST(min(before) + 1 AS BIGINT) AS first_pk, CAST(max(before) + 1 AS BIGINT) AS last_pk
FROM (SELECT g, row_number() OVER (ORDER BY g) - 1 AS before FROM owners) GROUP BY g
""")
def paper_delta_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The papers of a group have consecutive keys, in the order of the groups."""
    out = _paper_tables(spark, sf)["dim_paper"].filter("paper_pk > 0")
    return out.groupBy("keywordgroup_pk").agg(F.count(F.lit(1)).alias("n_papers"), F.min("paper_pk").alias("first_pk"),
                                              F.max("paper_pk").alias("last_pk"))


@query("paper_delta_groups_group", "WITH " + _SQL_PAPERS.strip() + """
SELECT 'keyword' AS kind, g AS group_pk FROM grp UNION ALL SELECT 'author', g FROM grp
UNION ALL SELECT 'keyword', 0 UNION ALL SELECT 'author', 0
""")
def paper_delta_groups_group(spark: SparkSession, sf: str) -> DataFrame:
    out = _paper_tables(spark, sf)
    return out["dim_keywordgroup"].select(F.lit("keyword").alias("kind"), F.col("keywordgroup_pk").alias("group_pk")).unionByName(
        out["dim_authorgroup"].select(F.lit("author").alias("kind"), F.col("authorgroup_pk").alias("group_pk")))


@query("paper_delta_groups_bridge", "WITH " + _SQL_PAPERS.strip() + """
SELECT author_pk, g AS authorgroup_pk, CAST(min(pos) AS INTEGER) AS author_position FROM members GROUP BY g, author_pk
UNION ALL SELECT 0, 0, 0
""")
def paper_delta_groups_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return _paper_tables(spark, sf)["bridge_paper_author"]


@query("paper_delta_groups_keywords", "WITH " + _SQL_PAPERS.strip() + """
SELECT DISTINCT coalesce(keyword_pk, 0) AS keyword_pk, g AS keywordgroup_pk FROM r LEFT JOIN kw USING (id)
UNION ALL SELECT 0, 0
""")
def paper_delta_groups_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return _paper_tables(spark, sf)["bridge_paper_keyword"]


# ---------------------------------------------------------------------------
# PL5 / J1 / P5 / C4 / W2: paragraphs = lines of documents, two loads
# ---------------------------------------------------------------------------

def _paragraph_source(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = load(spark, sf, "documents")
    ln = lines(docs).join(docs.select("doc_id", "lang"), "doc_id")
    src = ln.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("line_no").cast("string")).alias("para_id"),
        F.col("doc_id").alias("article_id"), F.col("heading").alias("last_section_title"),
        F.when(F.col("line_no") % 3 != 0, F.concat(F.lit("Part "), (F.col("line_no") % 3).cast("string")))
        .alias("last_subsection_title"),
        F.col("lang").alias("paragraph_type"))
    papers = docs.filter(F.col("source") != "src3").select(
        (F.col("doc_id") + 1).alias("paper_pk"), F.col("doc_id").alias("article_source_id"))
    return src, papers


_PARA_COLS = "para_source_id, heading, subheading, paragraph_type, paper_pk"


@query("paragraph_dim", "WITH " + SQL_LINES.strip() + f""",
src AS (
  SELECT CAST(l.doc_id AS VARCHAR) || ':' || CAST(l.line_no AS VARCHAR) AS para_source_id, l.doc_id AS article_id,
         l.heading, CASE WHEN l.line_no % 3 <> 0 THEN 'Part ' || CAST(l.line_no % 3 AS VARCHAR) END AS subheading,
         d.lang AS paragraph_type
  FROM lines l JOIN documents d ON l.doc_id = d.doc_id),
papers AS (SELECT doc_id + 1 AS paper_pk, doc_id AS article_source_id FROM documents WHERE source <> 'src3'),
rows AS (
  SELECT para_source_id, coalesce(heading, 'MISSING') AS heading, coalesce(subheading, 'MISSING') AS subheading,
         coalesce(paragraph_type, 'MISSING') AS paragraph_type, CAST(coalesce(p.paper_pk, 0) AS BIGINT) AS paper_pk
  FROM src LEFT JOIN papers p ON src.article_id = p.article_source_id AND src.article_id <> 0),
first_load AS (
  SELECT CAST(row_number() OVER (ORDER BY {_PARA_COLS}) AS BIGINT) AS paragraph_pk, {_PARA_COLS}
  FROM (SELECT DISTINCT * FROM rows WHERE paragraph_type = 'en')
  UNION ALL SELECT 0, '0', 'MISSING', 'MISSING', 'MISSING', 0),
delta AS (SELECT {_PARA_COLS} FROM rows EXCEPT SELECT {_PARA_COLS} FROM first_load),
mx AS (SELECT max(paragraph_pk) AS m FROM first_load)
SELECT paragraph_pk, {_PARA_COLS} FROM first_load
UNION ALL
SELECT CAST(m + row_number() OVER (ORDER BY {_PARA_COLS}) AS BIGINT), {_PARA_COLS} FROM delta, mx
""")
def paragraph_dim(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.text_units import PARAGRAPH, paragraph_delta, paragraph_rows
    src, papers = _paragraph_source(spark, sf)
    rows = paragraph_rows(src, papers)
    first = materialize(paragraph_delta(rows.filter(F.col("paragraph_type") == "en"), None))
    second = paragraph_delta(rows, first)
    cols = ["paragraph_pk"] + PARAGRAPH
    return first.select(*cols).unionByName(second.select(*cols))


# ---------------------------------------------------------------------------
# Sentence filters (null, blank, structural types; null type kept)
# ---------------------------------------------------------------------------

# fixed values: sentence types assigned by (line_no + sent_no) % 12
SENTENCE_TYPES = ("BODY", "TAG", "TABLE", "ABSTRACT", "EMPTY", "FORMULA", None,
                  "TABLE_HEADER", "FIGURE_HEADER", "FIGURE", "HYP_NUMBER", "RQ_NUMBER")


@query("sentence_filter", "WITH " + SQL_SENTENCES.strip() + f""",
src AS (
  SELECT CAST(doc_id AS VARCHAR) || ':' || CAST(line_no AS VARCHAR) || ':' || CAST(sent_no AS VARCHAR) AS sentence_id,
         CASE WHEN sent_no = 3 THEN '   ' WHEN sent_no = 5 THEN NULL ELSE sentence END AS sentence,
         [{", ".join("NULL" if t is None else repr(t) for t in SENTENCE_TYPES)}][CAST((line_no + sent_no) % {len(SENTENCE_TYPES)} AS INTEGER) + 1] AS sentence_type
  FROM sentences)
SELECT sentence_id, sentence_type, sentence FROM src
WHERE sentence IS NOT NULL AND NOT regexp_full_match(sentence, '\\s+')
  AND (sentence_type IS NULL OR sentence_type NOT IN ('TAG', 'TABLE', 'EMPTY', 'FORMULA', 'TABLE_HEADER',
       'FIGURE_HEADER', 'FIGURE', 'HYP_NUMBER', 'RQ_NUMBER'))
""")
def sentence_filter(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.text_units import clean_sentences
    types = F.array(*[F.lit(t).cast("string") for t in SENTENCE_TYPES])
    s = sentences(load(spark, sf, "documents"))
    src = s.select(
        F.concat_ws(":", F.col("doc_id").cast("string"), F.col("line_no").cast("string"),
                    F.col("sent_no").cast("string")).alias("sentence_id"),
        F.concat_ws(":", F.col("doc_id").cast("string"), F.col("line_no").cast("string")).alias("para_id"),
        F.when(F.col("sent_no") == 3, F.lit("   ")).when(F.col("sent_no") == 5, F.lit(None))
        .otherwise(F.col("sentence")).alias("sentence"),
        F.element_at(types, ((F.col("line_no") + F.col("sent_no")) % len(SENTENCE_TYPES) + 1).cast("int"))
        .alias("sentence_type"))
    return clean_sentences(src).select("sentence_id", "sentence_type", "sentence")


# ---------------------------------------------------------------------------
# PL6 / C3 / J6 / M3 / W1: orders as sentences citing parts
# ---------------------------------------------------------------------------

_SQL_SENTENCE_DELTA = """
wh AS (SELECT CAST(o_orderkey AS VARCHAR) AS sentence_source_id FROM orders
       WHERE CAST(o_orderdate AS DATE) < DATE '1996-01-01'),
mx AS (SELECT count(*) AS m FROM wh),
papers AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS citekey, p_partkey + 1 AS paper_pk FROM part WHERE p_size <= 40),
paras AS (SELECT o_orderpriority AS para_source_id, row_number() OVER (ORDER BY o_orderpriority) AS paragraph_pk
          FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW')),
cit AS (SELECT CAST(l_orderkey AS VARCHAR) AS sentence_id, coalesce(p.paper_pk, 0) AS paper_pk
        FROM lineitem LEFT JOIN papers p ON 'P' || CAST(l_partkey AS VARCHAR) = p.citekey),
s AS (SELECT CAST(o_orderkey AS VARCHAR) AS sentence_id, o_orderpriority AS para_id,
             o_orderstatus AS sentence, 'BODY' AS sentence_type FROM orders),
rows AS (SELECT s.sentence_id, s.sentence, s.sentence_type, coalesce(c.paper_pk, 0) AS paper_pk,
                coalesce(pp.paragraph_pk, 0) AS paragraph_pk
         FROM s LEFT JOIN cit c USING (sentence_id) LEFT JOIN paras pp ON s.para_id = pp.para_source_id),
delta AS (SELECT * FROM rows WHERE sentence_id NOT IN (SELECT sentence_source_id FROM wh)),
grp AS (SELECT sentence_id, m + row_number() OVER (ORDER BY sentence_id) AS citationgroup_pk
        FROM (SELECT DISTINCT sentence_id FROM delta), mx)"""


def _sentence_delta(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    from .plans.text_units import sentence_delta, sentence_rows
    o = load(spark, sf, "orders")
    wh_ids = o.filter(F.to_date("o_orderdate") < F.lit("1996-01-01").cast("date")).select(
        F.col("o_orderkey").cast("string").alias("sentence_source_id"))
    wh = dense_keys(wh_ids, ["sentence_source_id"], "sentence_pk").withColumn(
        "citationgroup_pk", F.col("sentence_pk"))
    papers = load(spark, sf, "part").filter(F.col("p_size") <= 40).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("citekey"),
        (F.col("p_partkey") + 1).alias("paper_pk"))
    paras = dense_keys(o.filter(F.col("o_orderpriority") != "5-LOW").select(
        F.col("o_orderpriority").alias("para_source_id")), ["para_source_id"], "paragraph_pk")
    cits = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("sentence_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("reference_citekey"))
    sents = o.select(F.col("o_orderkey").cast("string").alias("sentence_id"),
                     F.col("o_orderpriority").alias("para_id"),
                     F.col("o_orderstatus").alias("sentence"), F.lit("BODY").alias("sentence_type"))
    return sentence_delta(sentence_rows(sents, cits, papers, paras), wh)


@query("sentence_citation", "WITH " + _SQL_SENTENCE_DELTA.strip() + """,
sent AS (SELECT DISTINCT d.sentence_id, d.sentence, d.sentence_type, d.paragraph_pk, g.citationgroup_pk
         FROM delta d JOIN grp g USING (sentence_id))
SELECT CAST(m + row_number() OVER (ORDER BY sentence_id) AS BIGINT) AS sentence_pk,
       CAST(citationgroup_pk AS BIGINT) AS citationgroup_pk, CAST(paragraph_pk AS BIGINT) AS paragraph_pk,
       sentence_type, sentence AS sentence_string, sentence_id AS sentence_source_id
FROM sent, mx
""")
def sentence_citation(spark: SparkSession, sf: str) -> DataFrame:
    return _sentence_delta(spark, sf)["dim_sentence"]


@query("sentence_citation_bridge", "WITH " + _SQL_SENTENCE_DELTA.strip() + """
SELECT DISTINCT CAST(g.citationgroup_pk AS BIGINT) AS citationgroup_pk, CAST(d.paper_pk AS BIGINT) AS paper_pk
FROM delta d JOIN grp g USING (sentence_id)
""")
def sentence_citation_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return _sentence_delta(spark, sf)["bridge_sentence_citation"]


# ---------------------------------------------------------------------------
# PL7 / X10 / D1 / C5: entity dimension, two loads
# ---------------------------------------------------------------------------

def _entities(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    w2 = F.split_part("p_name", F.lit(" "), F.lit(2))
    ent = F.when(F.col("p_size") % 5 == 0, F.concat(w2, F.lit("'s"))).otherwise(w2)
    return p.select(F.col("p_partkey").cast("string").alias("sentence_id"),
                    F.col("p_type").alias("label"), ent.alias("ent_id"),
                    F.concat_ws("/", "p_type", F.split_part("p_name", F.lit(" "), F.lit(1)), ent)
                    .alias("ent_path"))


_SQL_ENTITIES = """
ents AS (SELECT p_type AS label,
                CASE WHEN p_size % 5 = 0 THEN split_part(p_name, ' ', 2) || '''s' ELSE split_part(p_name, ' ', 2) END AS ent_id
         FROM part),
src AS (SELECT DISTINCT label AS entity_label, replace(ent_id, '''', '') AS entity_name FROM ents)"""


@query("entity_dim", "WITH " + _SQL_ENTITIES.strip() + """,
first_load AS (
  SELECT CAST(row_number() OVER (ORDER BY entity_label, entity_name) AS BIGINT) AS entity_pk, entity_label, entity_name
  FROM src WHERE entity_label = 'ECONOMY'
  UNION ALL SELECT 0, 'MISSING', 'MISSING'),
delta AS (SELECT entity_label, entity_name FROM src EXCEPT SELECT entity_label, entity_name FROM first_load),
mx AS (SELECT max(entity_pk) AS m FROM first_load)
SELECT entity_pk, entity_label, entity_name FROM first_load
UNION ALL
SELECT CAST(m + row_number() OVER (ORDER BY entity_label, entity_name) AS BIGINT), entity_label, entity_name FROM delta, mx
""")
def entity_dim(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.text_units import entity_delta, entity_source
    src = entity_source(_entities(spark, sf))
    first, _ = entity_delta(src.filter(F.col("entity_label") == "ECONOMY"), None)
    first = materialize(first)
    second, _ = entity_delta(src, first)
    cols = ["entity_pk", "entity_label", "entity_name"]
    return first.select(*cols).unionByName(second.select(*cols))


# ---------------------------------------------------------------------------
# PL7 / J12 / H1-H5 / A8 / P3: region/nation/segment closure
# ---------------------------------------------------------------------------

def _paths(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer")
    n = load(spark, sf, "nation")
    r = load(spark, sf, "region")
    return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.concat_ws("/", "r_name", "n_name", "c_mktsegment").alias("path")))


_SQL_CLOSURE = """
paths AS (SELECT DISTINCT r_name || '/' || n_name || '/' || c_mktsegment AS path
          FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ij AS (SELECT ns, unnest(range(len(ns))) AS i FROM (SELECT string_split(path, '/') AS ns FROM paths)),
pairs AS (SELECT DISTINCT ns[i + 1] AS parent, ns[j + 1] AS child, CAST(j - i AS INTEGER) AS depth_from_parent,
                 i = 0 AS highest_parent_flag
          FROM (SELECT ns, i, unnest(range(i, len(ns))) AS j FROM ij)),
inner_nodes AS (SELECT DISTINCT parent AS node FROM pairs WHERE depth_from_parent > 0),
closure AS (SELECT p.*, n.node IS NULL AS lowest_child_flag FROM pairs p LEFT JOIN inner_nodes n ON p.child = n.node)"""


@query("closure", "WITH " + _SQL_CLOSURE.strip() + "\nSELECT * FROM closure")
def closure(spark: SparkSession, sf: str) -> DataFrame:
    return closure_rows(_paths(spark, sf), "path")


@query("closure_leaf", "WITH " + _SQL_CLOSURE.strip() + """
SELECT parent AS node FROM pairs GROUP BY parent HAVING count(*) = 1
""")
def closure_leaf(spark: SparkSession, sf: str) -> DataFrame:
    pairs = closure_rows(_paths(spark, sf), "path")
    return leaves_by_count(pairs.select("parent", "child", "depth_from_parent", "highest_parent_flag"))


@query("closure_keys", "WITH " + _SQL_CLOSURE.strip() + """,
ents AS (SELECT name AS entity_name, row_number() OVER (ORDER BY name) AS entity_pk
         FROM (SELECT DISTINCT parent AS name FROM pairs) WHERE name <> 'ASIA')
SELECT DISTINCT CAST(c.entity_pk AS BIGINT) AS child_entity_pk, CAST(p.entity_pk AS BIGINT) AS parent_entity_pk,
       depth_from_parent, highest_parent_flag, lowest_child_flag
FROM closure JOIN ents p ON closure.parent = p.entity_name JOIN ents c ON closure.child = c.entity_name
""")
def closure_keys(spark: SparkSession, sf: str) -> DataFrame:
    cl = closure_rows(_paths(spark, sf), "path")
    names = cl.select(F.col("parent").alias("entity_name")).filter(F.col("entity_name") != "ASIA")
    ents = dense_keys(names, ["entity_name"], "entity_pk")
    return closure_keys_op(cl, ents)


# ---------------------------------------------------------------------------
# A1 / PL8 / J1 / P3: detections from events
# ---------------------------------------------------------------------------

@query("fact_counts", """
WITH src AS (
  SELECT CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS sentence_id,
         'EVENT' AS label, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS ent_id
  FROM events),
facts AS (SELECT sentence_id, label, ent_id, count(*) AS entity_count FROM src
          WHERE sentence_id IS NOT NULL AND ent_id IS NOT NULL GROUP BY ALL),
dim_sentence AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS sentence_source_id, user_id + 1 AS sentence_pk
                 FROM events WHERE user_id < 100),
dim_entity AS (SELECT event_type AS entity_name, 'EVENT' AS entity_label,
                      row_number() OVER (ORDER BY event_type) AS entity_pk
               FROM (SELECT DISTINCT event_type FROM events WHERE event_type <> 'view'))
SELECT CAST(e.entity_pk AS BIGINT) AS entity_pk, CAST(s.sentence_pk AS BIGINT) AS sentence_pk,
       CAST(entity_count AS BIGINT) AS entity_count
FROM facts f JOIN dim_sentence s ON f.sentence_id = s.sentence_source_id
JOIN dim_entity e ON f.ent_id = e.entity_name AND f.label = e.entity_label
""")
def fact_counts(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.text_units import fact_delta, fact_source
    ev = load(spark, sf, "events")
    src = ev.select(
        F.when(F.col("user_id") % 11 != 0, F.col("user_id").cast("string")).alias("sentence_id"),
        F.lit("EVENT").alias("label"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("ent_id"))
    dim_sentence = ev.filter(F.col("user_id") < 100).select(
        F.col("user_id").cast("string").alias("sentence_source_id"),
        (F.col("user_id") + 1).alias("sentence_pk")).distinct()
    types = ev.filter(F.col("event_type") != "view").select(
        F.col("event_type").alias("entity_name"), F.lit("EVENT").alias("entity_label"))
    dim_entity = dense_keys(types, ["entity_name", "entity_label"], "entity_pk")
    new, _ = fact_delta(fact_source(src), dim_sentence, dim_entity, None)
    return new


# ---------------------------------------------------------------------------
# Fact delta against an earlier load; changed counts apart (Q9)
# ---------------------------------------------------------------------------

_SQL_FACT_DELTA = """
wh AS (SELECT user_id, event_type, count(*) AS entity_count FROM events
       WHERE ts < TIMESTAMP '2024-01-03 00:00:00' GROUP BY ALL),
src AS (SELECT user_id, event_type, count(*) AS entity_count FROM events GROUP BY ALL)"""


def _fact_delta(spark: SparkSession, sf: str):
    ev = load(spark, sf, "events")

    def counts(df):
        return df.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("entity_count"))
    wh = counts(ev.filter(F.col("ts") < F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")))
    return dl.fact_delta(counts(ev), wh, ["user_id", "event_type"], "entity_count")


@query("fact_delta", "WITH " + _SQL_FACT_DELTA.strip() + """
SELECT s.user_id, s.event_type, s.entity_count FROM src s
WHERE NOT EXISTS (SELECT 1 FROM wh WHERE wh.user_id = s.user_id AND wh.event_type = s.event_type)
""")
def fact_delta(spark: SparkSession, sf: str) -> DataFrame:
    return _fact_delta(spark, sf)[0]


@query("fact_delta_changed", "WITH " + _SQL_FACT_DELTA.strip() + """
SELECT s.user_id, s.event_type, s.entity_count, wh.entity_count AS previous_entity_count
FROM src s JOIN wh ON wh.user_id = s.user_id AND wh.event_type = s.event_type
WHERE s.entity_count <> wh.entity_count
""")
def fact_delta_changed(spark: SparkSession, sf: str) -> DataFrame:
    return _fact_delta(spark, sf)[1]


# ---------------------------------------------------------------------------
# Set operators on customers
# ---------------------------------------------------------------------------

@query("rows_once", """
SELECT c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band
FROM customer GROUP BY ALL HAVING count(*) = 1
""")
def rows_once(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select(
        "c_nationkey", "c_mktsegment", F.floor(F.col("c_acctbal") / 1000).cast("bigint").alias("band"))
    return dl.rows_once(c)


@query("symmetric_difference", """
WITH a AS (SELECT DISTINCT c_nationkey, c_mktsegment, CAST(floor(c_acctbal) AS BIGINT) AS balance FROM customer WHERE c_custkey % 3 <> 0),
b AS (SELECT DISTINCT c_nationkey, c_mktsegment, CAST(floor(c_acctbal) AS BIGINT) AS balance FROM customer WHERE c_custkey % 3 <> 1)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)
""")
def symmetric_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Two sets of rows that share a third of the customers."""
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment",
                                           F.floor("c_acctbal").cast("bigint").alias("balance"))
    return dl.symmetric_difference(c.filter("c_custkey % 3 <> 0").drop("c_custkey"), c.filter("c_custkey % 3 <> 1").drop("c_custkey"))


@query("union_missing_columns", """
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer
UNION
SELECT DISTINCT s_nationkey AS c_nationkey, CAST(NULL AS VARCHAR) AS c_mktsegment FROM supplier
""")
def union_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    """U1 + U2: union by name where one side lacks a column (filled with null)."""
    c = load(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("c_nationkey"))
    return c.unionByName(s, allowMissingColumns=True).distinct()


@query("full_row_delta", """
WITH src AS (SELECT c_mktsegment, c_nationkey,
                    CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey % 5 AS INTEGER) END AS tier,
                    c_acctbal FROM customer)
SELECT c_mktsegment, c_nationkey, tier FROM src
EXCEPT
SELECT c_mktsegment, c_nationkey, tier FROM src WHERE c_acctbal > 3000
""")
def full_row_delta(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select(
        "c_mktsegment", "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, (F.col("c_nationkey") % 5).cast("int")).alias("tier"),
        "c_acctbal")
    cols = ["c_mktsegment", "c_nationkey", "tier"]
    return dl.full_row_delta(c, c.filter(F.col("c_acctbal") > 3000), cols)


# ---------------------------------------------------------------------------
# Unknown members
# ---------------------------------------------------------------------------

@query("unknown_member", """
SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey <> 0
UNION ALL SELECT 0, 'MISSING', 0
""")
def unknown_member(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.impute import replace_unknown_member
    n = load(spark, sf, "nation")
    schema = T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                           T.StructField("n_name", T.StringType()),
                           T.StructField("n_regionkey", T.IntegerType())])
    return replace_unknown_member(n, "n_nationkey", schema)


@query("unknown_member_first_load", """
SELECT CAST(r_regionkey + 1 AS BIGINT) AS region_pk, r_name FROM region
UNION ALL SELECT 0, 'MISSING'
""")
def unknown_member_first_load(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.impute import with_unknown_member
    r = load(spark, sf, "region").select((F.col("r_regionkey") + 1).cast("bigint").alias("region_pk"),
                                         "r_name")
    schema = T.StructType([T.StructField("region_pk", T.LongType()),
                           T.StructField("r_name", T.StringType())])
    return with_unknown_member(r, schema, first_load=True)


# ---------------------------------------------------------------------------
# Re-running a load against its own result appends nothing
# ---------------------------------------------------------------------------

@query("idempotent_rerun", """
SELECT 1 AS load_no, count(*) + 1 AS rows_appended
FROM (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders)
UNION ALL SELECT 2, CAST(0 AS BIGINT)
""")
def idempotent_rerun(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.impute import with_unknown_member
    cols = ["o_orderpriority", "o_orderstatus"]
    o = load(spark, sf, "orders").select(*cols)
    schema = T.StructType([T.StructField("status_pk", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in cols])

    def load_once(existing):
        delta = dl.full_row_delta(o, existing, cols)
        keyed = dl.append_keys(delta, existing, "status_pk", cols)
        return with_unknown_member(keyed, schema, existing is None)
    first = materialize(load_once(None))
    second = load_once(first)
    return (first.agg(F.count(F.lit(1)).alias("rows_appended")).withColumn("load_no", F.lit(1))
            .unionByName(second.agg(F.count(F.lit(1)).alias("rows_appended"))
                         .withColumn("load_no", F.lit(2))))


# ---------------------------------------------------------------------------
# Integrity checks
# ---------------------------------------------------------------------------

@query("pk_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def pk_violations(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.integrity import pk_violations as pkv
    return pkv(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_profile", """
WITH t AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS returnflag,
         CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_linestatus END AS linestatus,
         CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_partkey END AS partkey,
         l_orderkey AS orderkey
  FROM lineitem)
SELECT 'returnflag' AS column_name, count(*) - count(returnflag) AS null_count FROM t
UNION ALL SELECT 'linestatus', count(*) - count(linestatus) FROM t
UNION ALL SELECT 'partkey', count(*) - count(partkey) FROM t
UNION ALL SELECT 'orderkey', count(*) - count(orderkey) FROM t
""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.integrity import null_profile as npf
    li = load(spark, sf, "lineitem")
    t = li.select(
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("returnflag"),
        F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")).alias("linestatus"),
        F.when(F.col("l_partkey") % 13 != 0, F.col("l_partkey")).alias("partkey"),
        F.col("l_orderkey").alias("orderkey"))
    return npf(t)


@query("fk_orphans", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN -1 - l_partkey WHEN l_suppkey % 9 <> 0 THEN l_partkey END AS l_partkey
FROM lineitem WHERE l_linenumber = 7 OR l_suppkey % 9 = 0
""")
def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.integrity import fk_orphans as fko
    key = F.when(F.col("l_linenumber") == 7, -1 - F.col("l_partkey")).when(F.col("l_suppkey") % 9 != 0, F.col("l_partkey"))
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", key.alias("l_partkey"))
    return fko(li, ["l_partkey"], load(spark, sf, "part"), ["p_partkey"])

