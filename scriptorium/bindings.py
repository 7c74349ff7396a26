"""Every inventory operator bound to a query on the driver tables,
with the equivalent DuckDB SQL beside it.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables. Column names and types are the same on both sides (the oracle casts
counts and row numbers to BIGINT).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import analogue as an
from .plans.analogue import load
from .session import discard, materialize, materialize_parts, sparing_disk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and (unless it is not SQL-expressible) its oracle."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# PL1 keyword_dim: two loads — benchmark words into an empty dimension, then
# document words as a delta on top of it.
# ---------------------------------------------------------------------------

def _keyword_source(df: DataFrame) -> DataFrame:
    from .functions.text import words
    return df.select(F.explode(words(F.col("text"))).alias("keyword"))


@query("keyword_dim", r"""
WITH first_src AS (
  SELECT DISTINCT lower(w) AS keyword_string
  FROM (SELECT unnest(regexp_extract_all(text, '\p{L}+')) AS w FROM benchmark)),
first_load AS (
  SELECT CAST(row_number() OVER (ORDER BY keyword_string) AS BIGINT) AS keyword_pk, keyword_string
  FROM first_src
  UNION ALL SELECT CAST(0 AS BIGINT), 'MISSING'),
second_src AS (
  SELECT DISTINCT lower(w) AS keyword_string
  FROM (SELECT unnest(regexp_extract_all(text, '\p{L}+')) AS w FROM documents)),
delta AS (
  SELECT keyword_string FROM second_src
  WHERE keyword_string NOT IN (SELECT keyword_string FROM first_load)),
mx AS (SELECT max(keyword_pk) AS m FROM first_load)
SELECT keyword_pk, keyword_string FROM first_load
UNION ALL
SELECT CAST(m + row_number() OVER (ORDER BY keyword_string) AS BIGINT), keyword_string
FROM delta, mx
""")
def keyword_dim(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.keyword import keyword_delta
    first = keyword_delta(_keyword_source(load(spark, sf, "benchmark")), None)
    first = materialize(first, "keywords")  # the "warehouse" after load 1
    second = keyword_delta(_keyword_source(load(spark, sf, "documents")), first)
    return first.unionByName(second)


# ---------------------------------------------------------------------------
# SQL helpers: the summary rules written as DuckDB SQL from the same table
# ---------------------------------------------------------------------------

def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sql_rule_weight(rules, for_sentence: bool = False) -> str:
    """The CASE expression of ``functions.weights.rule_weight`` in SQL."""
    whens = []
    for r in rules:
        if r.kind == "plain":
            w = "entity_count" if for_sentence else "1"
        elif r.kind == "sentence_type":
            w = (f"CASE WHEN coalesce(sentence_type IN ({_sql_list(r.boosted_types)}), false) "
                 f"THEN 15 ELSE 10 END * entity_count")
        else:
            excl = ""
            if r.excluded:
                excl = (f"WHEN coalesce(entity_name IN ({_sql_list(r.excluded)}), false) "
                        f"THEN {'entity_count' if for_sentence else '1'} ")
            w = (f"CASE {excl}WHEN coalesce(regexp_matches(heading, '(?i)^(?:{r.pattern})'), false) "
                 f"THEN 15 * entity_count ELSE 10 * entity_count END")
        whens.append(f"WHEN '{r.label}' THEN {w}")
    return "CAST(CASE entity_label " + " ".join(whens) + " END AS BIGINT)"


SQL_INT_WORD = ("CASE WHEN regexp_full_match(tok, '[0-9]+([,.][0-9]{3})*') "
                "THEN TRY_CAST(regexp_replace(tok, '[,.]', '', 'g') AS BIGINT) END")
SQL_FLOAT_WORD = ("CASE WHEN regexp_full_match(tok, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
                  "AND isfinite(TRY_CAST(tok AS DOUBLE)) THEN TRY_CAST(tok AS DOUBLE) END")


def sql_summary(dets_ctes: str, papers_sql: str, paper_cols: list[str], rules,
                dummy: dict | None = None) -> str:
    """SQL of ``plans.paper_summary.summarise``. ``dets_ctes`` defines a CTE
    ``dets`` with the detection columns; ``papers_sql`` selects ``paper_pk`` and
    ``paper_cols``."""
    from .plans.paper_summary import NUMBER_COLUMNS
    cols = [r.column for r in rules]
    wide_cols = ", ".join(
        f"max(CASE WHEN entity_label = '{r.label}' THEN entity_name END) AS {r.column}" for r in rules)
    ctes = [dets_ctes,
            f"votes AS (SELECT *, {sql_rule_weight(rules)} AS _w, "
            f"{sql_rule_weight(rules, True)} AS _ws FROM dets)",
            "totals AS (SELECT paper_pk, entity_label, entity_name, sum(_w) AS w FROM votes "
            "WHERE entity_name IS NOT NULL GROUP BY ALL)",
            "winners AS (SELECT paper_pk, entity_label, entity_name FROM (SELECT *, row_number() "
            "OVER (PARTITION BY paper_pk, entity_label ORDER BY w DESC, entity_name) AS rn "
            "FROM totals WHERE w IS NOT NULL) WHERE rn = 1)",
            f"wide AS (SELECT paper_pk, {wide_cols} FROM winners GROUP BY paper_pk)",
            f"papers AS ({papers_sql})"]
    outs, joins = [], []
    for label, win_col, out_col, _, typ in NUMBER_COLUMNS:
        if win_col not in cols:
            continue
        parse = SQL_INT_WORD if typ == "bigint" else SQL_FLOAT_WORD
        sql_type = "BIGINT" if typ == "bigint" else "DOUBLE"
        ctes.append(
            f"nums_{out_col} AS (SELECT paper_pk, v, sum(_ws) AS w FROM ("
            f"SELECT paper_pk, _ws, {parse} AS v FROM ("
            f"SELECT v.paper_pk, v._ws, unnest(string_split_regex(regexp_replace(v.sentence_string, "
            f"'START_CITE .* END_CITE(?s:.*)', ''), '\\s+')) AS tok FROM votes v "
            f"JOIN winners w ON v.paper_pk = w.paper_pk AND v.entity_label = w.entity_label "
            f"AND v.entity_name = w.entity_name WHERE v.entity_label = '{label}')) "
            f"WHERE v IS NOT NULL AND v <> 0 GROUP BY ALL)")
        ctes.append(
            f"mode_{out_col} AS (SELECT paper_pk, v AS {out_col} FROM (SELECT *, row_number() "
            f"OVER (PARTITION BY paper_pk ORDER BY w DESC, v) AS rn FROM nums_{out_col}) WHERE rn = 1)")
        outs.append(f"CAST(coalesce({out_col}, 0) AS {sql_type}) AS {out_col}")
        joins.append(f"LEFT JOIN mode_{out_col} USING (paper_pk)")
    select = (["p.paper_pk"] + [f"p.{c}" for c in paper_cols]
              + [f"coalesce({c}, 'MISSING') AS {c}" for c in cols] + outs)
    sql = ("WITH " + ",\n".join(ctes) + "\nSELECT " + ", ".join(select)
           + "\nFROM papers p LEFT JOIN wide USING (paper_pk) " + " ".join(joins))
    if dummy is not None:
        sql += "\nUNION ALL SELECT " + ", ".join(dummy_values for dummy_values in dummy.values())
    return sql


# ---------------------------------------------------------------------------
# PL9 on documents: category_pivot (flagship), weighted modes, number modes
# ---------------------------------------------------------------------------

def _doc_dets(spark: SparkSession, sf: str) -> DataFrame:
    return (an.detections(load(spark, sf, "documents"))
            .select((F.col("doc_id") + 1).alias("paper_pk"), *an.SENTENCE_KEY, "heading",
                    "sentence_type", "entity_count", "entity_label", "entity_name"))


SQL_DOC_DETS = an.SQL_DETECTIONS + """,
dets AS (SELECT doc_id + 1 AS paper_pk, heading, sentence AS sentence_string, sentence_type,
                entity_count, entity_label, entity_name FROM detections)"""

_PAPER_COLS = ["citekey", "article_source_id"]


def _summary_dummy():
    from .functions.weights import CATEGORY_RULES
    d = {"paper_pk": "CAST(0 AS BIGINT)", "citekey": "'MISSING'",
         "article_source_id": "CAST(0 AS BIGINT)"}
    d.update({r.column: "'MISSING'" for r in CATEGORY_RULES})
    d.update({"no_of_participants": "CAST(0 AS BIGINT)", "metric_value": "CAST(0 AS DOUBLE)"})
    return d


def _category_pivot_sql():
    from .functions.weights import CATEGORY_RULES
    papers = ("SELECT doc_id + 1 AS paper_pk, source || '/' || CAST(doc_id AS VARCHAR) AS citekey, "
              "doc_id AS article_source_id FROM documents")
    return sql_summary(SQL_DOC_DETS, papers, _PAPER_COLS, CATEGORY_RULES, _summary_dummy())


@query("category_pivot", _category_pivot_sql())
def category_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """A10, J10, P6, P9, P15, PL9: the wide summary of every document."""
    from pyspark.sql import types as T
    from .operators.impute import replace_unknown_member
    from .plans.paper_summary import summarise
    docs = load(spark, sf, "documents")
    papers = docs.select((F.col("doc_id") + 1).alias("paper_pk"),
                         F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("citekey"),
                         F.col("doc_id").alias("article_source_id"))
    out = summarise(_doc_dets(spark, sf), papers, sentence_text=an.sentence_text(docs),
                    sentence_key=an.SENTENCE_KEY)
    schema = T.StructType([f for f in out.schema.fields])
    return replace_unknown_member(out, "paper_pk", schema)


@query("aggregation_paper", _category_pivot_sql())
def aggregation_paper(spark: SparkSession, sf: str) -> DataFrame:
    """PL9, J8, J9, C7 on warehouse tables: the documents' detections are stored as fact, entity,
    sentence and paragraph tables with surrogate keys first, and the summary is built from those. Each table is stored
    before the next is built, and detections are worked on in parts, so the disk holds the shuffle of one part of a step."""
    with sparing_disk(spark):
        return _aggregation_paper(spark, sf)


def _aggregation_paper(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.weights import CATEGORY_RULES
    from .operators.keys import dense_keys, number_rows
    from .operators import skew
    from .plans import paper_summary as ps
    from .schemas import TABLES
    docs = load(spark, sf, "documents")
    dets = an.detections(docs)
    repeated = an.repeated_ids(docs)
    para = number_rows(an.lines(docs).select("doc_id", "line_no", "heading"), ["doc_id", "line_no"], "paragraph_pk")
    numbered = number_rows(an.sentences(docs).select(*an.SENTENCE_KEY, "sentence_type",
                                                     F.col("sentence").alias("sentence_string")),
                           an.SENTENCE_KEY, "sentence_pk")
    # stored, else each reader of the texts would join their paragraphs again
    sent = materialize_parts((numbered.filter(part).join(para.drop("heading").filter(part), ["doc_id", "line_no"])
                              for part in skew.part_filters(numbered, "doc_id", skew.PART_ROWS // 8)), "sentences")
    discard(numbered)
    ent = dense_keys(dets, ["entity_label", "entity_name"], "entity_pk")
    again = materialize(an.merged_detections(an.entity_counts(an.sentences(an.by_repeated_id(docs, repeated)[1]).select(
        *an.SENTENCE_KEY, "sentence"))), "repeated_detections")

    def facts(rows: DataFrame) -> DataFrame:
        # a stored sentence holds its own detections, so they needn't be joined by its key, unless documents share an id
        own, shared = an.by_repeated_id(rows, repeated)
        found = an.entity_counts(own.select("sentence_pk", "sentence_string"), "sentence_string")
        found = found.unionByName(again.join(shared, an.SENTENCE_KEY).select(*found.columns))
        return found.withColumn("entity_label", an.label_of("entity_name")).join(ent, ["entity_label", "entity_name"]) \
            .select("entity_pk", "sentence_pk", "entity_count")
    fact = materialize_parts((facts(sent.filter(part)) for part in skew.part_filters(sent, "sentence_pk", skew.PART_ROWS // 8)), "facts")
    own = {"paper_pk": F.col("doc_id") + 1, "citekey": F.concat_ws("/", "source", F.col("doc_id").cast("string")),
           "article_source_id": F.col("doc_id")}
    papers = docs.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in TABLES["dim_paper"].fields])
    out = ps.aggregation_paper(fact, ent, sent, para.withColumns(
        {"paper_pk": F.col("doc_id") + 1, "paragraph_type": F.lit("BODY")}), papers, spent=[fact])
    return out.select("paper_pk", *_PAPER_COLS, *[r.column for r in CATEGORY_RULES],
                      *[c for _, _, c, _, _ in ps.NUMBER_COLUMNS])


# the remaining queries register themselves on import
from . import queries_load, queries_modes, queries_parsing, queries_warehouse  # noqa: E402,F401
