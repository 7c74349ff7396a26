"""Queries for modes, number modes, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bindings import SQL_DOC_DETS, _doc_dets, _sql_list, query, sql_summary
from .functions import weights as wt
from .operators import mode as md
from .plans.analogue import HEADINGS, _sql_array, load
from .sources.files import MISSING_TOKENS

# ---------------------------------------------------------------------------
# A2 plain mode
# ---------------------------------------------------------------------------


@query("mode_plain", """
SELECT user_id, event_type AS mode_event_type FROM (
  SELECT user_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
  FROM events GROUP BY user_id, event_type)
WHERE rn = 1
""")
def mode_plain(spark: SparkSession, sf: str) -> DataFrame:
    return md.mode(load(spark, sf, "events"), ["user_id"], "event_type", "mode_event_type")


# ---------------------------------------------------------------------------
# X23 + A3: weighted mode by sentence type, per (document, label)
# ---------------------------------------------------------------------------

@query("weighted_mode_type", "WITH " + SQL_DOC_DETS.strip() + """,
totals AS (
  SELECT paper_pk, entity_label, entity_name,
         sum(CASE WHEN sentence_type = 'ABSTRACT' THEN 15 ELSE 10 END * entity_count) AS w
  FROM dets GROUP BY ALL)
SELECT paper_pk, entity_label, entity_name FROM (
  SELECT *, row_number() OVER (PARTITION BY paper_pk, entity_label ORDER BY w DESC, entity_name) AS rn
  FROM totals)
WHERE rn = 1
""")
def weighted_mode_type(spark: SparkSession, sf: str) -> DataFrame:
    d = _doc_dets(spark, sf).withColumn(
        "w", wt.weight_by_sentence_type("sentence_type", "entity_count", ["ABSTRACT"]))
    return md.weighted_mode(d, ["paper_pk", "entity_label"], "entity_name", "w")


# ---------------------------------------------------------------------------
# X24 + X22 + A3: weighted mode by heading with excluded entities, per document
# ---------------------------------------------------------------------------

HEADING_PATTERN = r".*data.*|.*method.*|.*result.*|.*discuss.*"
# fixed values: entities voted down to weight 1 in this query
HEADING_EXCLUDED = ("that", "with")


@query("weighted_mode_heading", "WITH " + SQL_DOC_DETS.strip() + f""",
totals AS (
  SELECT paper_pk, entity_name,
         sum(CASE WHEN entity_name IN ({_sql_list(HEADING_EXCLUDED)}) THEN 1
                  WHEN regexp_matches(heading, '(?i)^(?:{HEADING_PATTERN})') THEN 15 * entity_count
                  ELSE 10 * entity_count END) AS w
  FROM dets GROUP BY ALL)
SELECT paper_pk, entity_name FROM (
  SELECT *, row_number() OVER (PARTITION BY paper_pk ORDER BY w DESC, entity_name) AS rn
  FROM totals)
WHERE rn = 1
""")
def weighted_mode_heading(spark: SparkSession, sf: str) -> DataFrame:
    d = _doc_dets(spark, sf).withColumn(
        "w", wt.weight_by_heading("heading", "entity_name", "entity_count", HEADING_PATTERN,
                                  list(HEADING_EXCLUDED)))
    return md.weighted_mode(d, ["paper_pk"], "entity_name", "w")


# ---------------------------------------------------------------------------
# A6 + X17-X21 + J11 on lineitem text: one "sentence" per line item
# ---------------------------------------------------------------------------

def _lineitem_dets(spark: SparkSession, sf: str, label: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    heads = F.array(*[F.lit(h) for h in HEADINGS])
    sentence = F.concat_ws(
        " ",
        F.floor("l_quantity").cast("bigint").cast("string"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string")),
        F.lit("START_CITE"), F.col("l_partkey").cast("string"), F.lit("END_CITE"),
        (F.col("l_partkey") % 1000).cast("string"))
    return li.select(
        F.col("l_orderkey").alias("paper_pk"),
        F.element_at(heads, (F.col("l_linenumber") % len(HEADINGS) + 1).cast("int")).alias("heading"),
        sentence.alias("sentence_string"),
        F.when(F.col("l_linenumber") == 1, "ABSTRACT").otherwise("BODY").alias("sentence_type"),
        (F.col("l_linenumber") % 3 + 1).cast("bigint").alias("entity_count"),
        F.lit(label).alias("entity_label"),
        F.concat("l_returnflag", "l_linestatus").alias("entity_name"))


def _lineitem_dets_sql(label: str) -> str:
    return f"""dets AS (
  SELECT l_orderkey AS paper_pk,
         {_sql_array(HEADINGS)}[CAST(l_linenumber % {len(HEADINGS)} AS INTEGER) + 1] AS heading,
         CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || ' ' || CAST(l_suppkey AS VARCHAR)
           || '.' || CAST(l_linenumber AS VARCHAR) || ' START_CITE ' || CAST(l_partkey AS VARCHAR)
           || ' END_CITE ' || CAST(l_partkey % 1000 AS VARCHAR) AS sentence_string,
         CASE WHEN l_linenumber = 1 THEN 'ABSTRACT' ELSE 'BODY' END AS sentence_type,
         CAST(l_linenumber % 3 + 1 AS BIGINT) AS entity_count,
         '{label}' AS entity_label,
         l_returnflag || l_linestatus AS entity_name
  FROM lineitem)"""


_ORDER_PAPERS_SQL = "SELECT o_orderkey AS paper_pk, o_orderpriority AS citekey FROM orders"


def _order_papers(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(F.col("o_orderkey").alias("paper_pk"),
                                            F.col("o_orderpriority").alias("citekey"))


def _number_query(label: str):
    rule = wt.RULES_BY_LABEL[label]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        from .plans.paper_summary import summarise
        return summarise(_lineitem_dets(spark, sf, label), _order_papers(spark, sf), rules=(rule,))
    return run, sql_summary(_lineitem_dets_sql(label), _ORDER_PAPERS_SQL, ["citekey"], (rule,))


_int_run, _int_sql = _number_query("PARTICIPANTS")
_float_run, _float_sql = _number_query("METRIC")
query("number_mode_int", _int_sql)(_int_run)
query("number_mode_float", _float_sql)(_float_run)


# ---------------------------------------------------------------------------
# S1 + S8 + P5: missing tokens -> null -> default
# ---------------------------------------------------------------------------

# fixed values: raw cell values assigned to documents (by doc_id % 12); exact
# pandas tokens become null, near misses (' NA', 'None') stay text
RAW_CELLS = ("NA", "n/a", "", "null", "NULL", "NaN", "#N/A", " NA", "value", "None",
             "<NA>", "-nan")


@query("na_normalise", f"""
SELECT doc_id, raw, coalesce(CASE WHEN raw IN ({_sql_list(MISSING_TOKENS)}) THEN NULL ELSE raw END, 'MISSING') AS value,
       coalesce(CASE WHEN lang IN ({_sql_list(MISSING_TOKENS)}) THEN NULL ELSE lang END, 'MISSING') AS lang
FROM (SELECT doc_id, lang, {_sql_array(RAW_CELLS)}[CAST(doc_id % {len(RAW_CELLS)} AS INTEGER) + 1] AS raw
      FROM documents)
""")
def na_normalise(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.impute import fill
    from .sources.files import normalise_missing
    cells = F.array(*[F.lit(v) for v in RAW_CELLS])
    d = load(spark, sf, "documents").select(
        "doc_id", "lang",
        F.element_at(cells, (F.col("doc_id") % len(RAW_CELLS) + 1).cast("int")).alias("raw"))
    d = normalise_missing(d.withColumn("value", F.col("raw")), ["value", "lang"])
    return fill(d, {"value": "MISSING", "lang": "MISSING"}).select("doc_id", "raw", "value", "lang")


# ---------------------------------------------------------------------------
# S2 + S7 + P1
# ---------------------------------------------------------------------------

@query("table_scan_project", """
SELECT o_orderkey AS article_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS published,
       o_orderpriority AS citekey
FROM orders
""")
def table_scan_project(spark: SparkSession, sf: str) -> DataFrame:
    from .sources.files import project, read_table
    t = read_table(spark, f"{sf.rstrip('/')}/orders.parquet")
    p = project(t, {"o_orderkey": "article_id", "o_custkey": "author_id",
                    "o_orderdate": "published", "o_orderpriority": "citekey"})
    return p.drop("author_id").withColumn("published", F.to_date("published").cast("string"))


# ---------------------------------------------------------------------------
# S3 + J8 + J9: the same SQL text on both engines, over tables passed in
# ---------------------------------------------------------------------------

DETECTION_SQL = """
SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, c.c_mktsegment, n.n_name
FROM {lineitem} l
JOIN {orders} o ON o.o_orderkey = l.l_orderkey
LEFT JOIN {customer} c ON c.c_custkey = o.o_custkey
LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey
"""
DETECTION_TABLES = ("lineitem", "orders", "customer", "nation")


@query("sql_detection_join", DETECTION_SQL.format(**{t: t for t in DETECTION_TABLES}))
def sql_detection_join(spark: SparkSession, sf: str) -> DataFrame:
    from .sources.files import read_query
    return read_query(spark, DETECTION_SQL, {t: load(spark, sf, t) for t in DETECTION_TABLES})


# ---------------------------------------------------------------------------
# S4 + S6 + I1: checked appends onto a Parquet table, read back
# ---------------------------------------------------------------------------

@query("append_after_check", """
SELECT o_orderstatus, count(*) AS n_orders, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY o_orderstatus
""")
def append_after_check(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.integrity import IntegrityError
    from .session import scratch_path
    from .sources.files import append
    orders = load(spark, sf, "orders")
    path = scratch_path(spark, "orders_wh")
    cut = F.to_date(F.col("o_orderdate")) < F.lit("1998-01-01").cast("date")
    append(orders.filter(cut), path, "orders", ["o_orderkey"])
    existing = spark.read.parquet(path)
    bad = orders.filter(cut & (F.month("o_orderdate") == 12))
    try:  # a batch that repeats loaded keys is rejected whole
        append(bad, path, "orders", ["o_orderkey"], existing)
        if not bad.isEmpty():
            raise AssertionError("duplicate keys were not rejected")
    except IntegrityError:
        pass
    append(orders.filter(~cut), path, "orders", ["o_orderkey"], existing)
    return (spark.read.parquet(path).groupBy("o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_orderkey").alias("key_sum")))


# ---------------------------------------------------------------------------
# S5 + C7: overwrite twice, read back
# ---------------------------------------------------------------------------

@query("overwrite_rebuild", """
SELECT user_id, count(*) AS n_events, max(event_id) AS last_event_id
FROM events GROUP BY user_id
""")
def overwrite_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import types as T
    from .session import scratch_path
    from .sources.files import overwrite
    ev = load(spark, sf, "events")
    schema = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("n_events", T.LongType()),
                           T.StructField("last_event_id", T.LongType())])
    path = scratch_path(spark, "user_summary")

    def summary(df):
        return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                         F.max("event_id").alias("last_event_id"))
    overwrite(summary(ev.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))), path, schema)
    overwrite(summary(ev), path, schema)
    return spark.read.parquet(path)
