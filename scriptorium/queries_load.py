"""PL10 / I4 on the driver tables: the 8 source files derived from documents,
line items, parts, suppliers and nations, loaded in foreign-key order; one row
per warehouse table with its row count and constraint violations (I1, I3).

Too many stages for a readable SQL oracle: the pipeline test checks the same
plans against hand-computed values on a fixture, and the driver records a
rows-only check for this query."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bindings import query
from .functions import text as tx
from .plans.analogue import by_repeated_id, lines, load, repeated_ids, sentences
from .queries_parsing import ISSUES, NAME_NOISE, PAGE_RANGES, VOLUMES, _cell
from .session import materialize


def dealt(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table stored anew in as many pieces as there are tasks. A file of one row group is read by one task, and
    several sources are built from the rows."""
    df = load(spark, sf, name)
    return materialize(df.repartition(F.xxhash64(*df.columns)), name)


def derived_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The eight sources. Keywords, authors and references are stored, as several plans read them."""
    docs = dealt(spark, sf, "documents")
    part = dealt(spark, sf, "part")
    w1 = F.split_part("p_name", F.lit(" "), F.lit(1))
    w2 = F.split_part("p_name", F.lit(" "), F.lit(2))
    sents = sentences(docs)
    sid = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("line_no").cast("string"),
                      F.col("sent_no").cast("string"))
    pid = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("line_no").cast("string"))

    # a document's words are made distinct inside its row; only documents that share an id, or have none, meet for that
    named = lambda d: d.select(F.col("doc_id").alias("article_id"),
                               F.explode(F.array_distinct(tx.words(F.col("text")))).alias("keyword"))
    own, shared = by_repeated_id(docs, repeated_ids(docs))
    keywords = materialize(named(own).unionByName(named(shared).distinct()), "src_keywords")
    li = load(spark, sf, "lineitem")
    sup = load(spark, sf, "supplier").join(load(spark, sf, "nation"),
                                           F.col("s_nationkey") == F.col("n_nationkey"))
    authors = (li.withColumn("doc_id", F.col("l_orderkey"))
               .join(part, F.col("l_partkey") == F.col("p_partkey"))
               .join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left")
               .select(F.col("doc_id").alias("article_id"),
                       F.concat(w2, F.lit(", "), w1, _cell(NAME_NOISE, "l_partkey")).alias("fullname"),
                       F.concat(F.lower("p_type"), F.lit("@example.org")).alias("email"),
                       F.col("p_brand").alias("departments"),
                       F.concat(F.lit("Inst "), (F.col("s_nationkey") % 5).cast("string")).alias("institutions"),
                       F.col("n_name").alias("countries"),
                       F.col("l_linenumber").alias("author_position")))
    authors = materialize(authors, "src_authors")
    papers = docs.select(
        F.col("doc_id").alias("article_id"),
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("citekey"),
        F.concat_ws(" ", "source", F.lit("paper"), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("abstract"), (F.col("n_chars") % 40 + 1990).cast("string").alias("year"),
        (F.col("n_chars") / 2000).cast("int").cast("string").alias("number_of_pages"),
        F.concat(F.lit("Journal of "), F.col("lang")).alias("journal"),
        F.upper("lang").alias("journal_akronym"), F.col("source").alias("publisher"),
        F.when(F.col("lang") != "es", F.col("lang")).alias("place"),
        _cell(VOLUMES, "doc_id").alias("volume"), _cell(ISSUES, "doc_id").alias("issue"),
        F.lit(None).cast("string").alias("keywords"), F.lit(None).cast("string").alias("authors"))
    ref_authors = F.concat(w2, F.lit(", "), w1,
                           F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("; "), w1, F.lit(" "), w2))
                           .when(F.col("p_size") % 3 == 1, F.lit("")).otherwise(F.lit("; ab")))
    references = part.select(
        F.when(F.col("p_size") % 10 == 0, F.concat(F.lit("D"), F.col("p_partkey").cast("string")))
        .otherwise(F.concat(F.lit("P"), F.col("p_partkey").cast("string"))).alias("citekey"),
        F.col("p_name").alias("title"), ref_authors.alias("authors"),
        (F.col("p_size") + 1950).cast("string").alias("year"),
        _cell(PAGE_RANGES, "p_partkey").alias("pages"), F.col("p_brand").alias("journal"),
        F.col("p_type").alias("publisher"), F.lit(None).cast("string").alias("place"),
        _cell(VOLUMES, "p_partkey").alias("volume"), _cell(ISSUES, "p_partkey").alias("issue"),
        *[F.lit(None).cast("string").alias(c) for c in ("source_type", "editor", "monograph_title", "note")])
    references = materialize(references, "src_references")
    paragraphs = lines(docs).select(
        pid.alias("para_id"), F.col("doc_id").alias("article_id"),
        F.col("heading").alias("last_section_title"),
        F.lit(None).cast("string").alias("last_subsection_title"), F.lit("BODY").alias("paragraph_type"))
    sentences_src = sents.select(sid.alias("sentence_id"), pid.alias("para_id"), "sentence",
                                 "sentence_type")
    citations = sents.select(
        sid.alias("sentence_id"),
        F.concat(F.lit("P"), (F.col("doc_id") + F.col("line_no") + F.col("sent_no")).cast("string")).alias("reference_citekey"))
    from .functions.weights import LABELS
    labels = F.array(*[F.lit(x) for x in LABELS])
    ents = (sents.select(sid.alias("sentence_id"), F.explode(tx.words(F.col("sentence"))).alias("w"))
            .select("sentence_id", F.lower("w").alias("ent_id"))
            .withColumn("label", F.element_at(labels, (F.length("ent_id") % len(LABELS) + 1).cast("int"))))
    entities = ents.select("sentence_id", "label", "ent_id",
                           F.concat_ws("/", "label", F.substring("ent_id", 1, 1), "ent_id").alias("ent_path"))
    return {"keywords.csv": keywords, "authors.csv": authors, "papers_final.csv": papers,
            "unique_references.csv": references, "paragraphs.csv": paragraphs,
            "sentences.csv": sentences_src, "citations.csv": citations, "entities.csv": entities}


@query("full_load")
def full_load(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.integrity import fk_orphans, pk_violations
    from .plans import full_load as fl
    from .schemas import FOREIGN_KEYS, PRIMARY_KEYS
    tables = fl.run(derived_sources(spark, sf))
    metrics = ["rows_loaded", "pk_violations", "fk_orphans"]
    parts = []
    for name, df in tables.items():
        def measure(frame: DataFrame, metric: str) -> DataFrame:
            return frame.agg(F.count(F.lit(1)).alias("value")).select(
                F.lit(name).alias("table_name"), F.lit(metric).alias("metric"), "value")
        parts.append(measure(df, "rows_loaded"))
        parts.append(measure(pk_violations(df, PRIMARY_KEYS[name]), "pk_violations"))
        for child, cols, parent, pcols in FOREIGN_KEYS:
            if child == name and parent in tables:
                parts.append(measure(fk_orphans(df, cols, tables[parent], pcols), "fk_orphans"))
    # long (table, metric, value) rows summed per table: no join between aggregates
    long = reduce(DataFrame.unionByName, parts)
    wide = long.groupBy("table_name").pivot("metric", metrics).agg(F.sum("value"))
    return wide.na.fill(0, subset=metrics).select("table_name", *metrics)


# ---------------------------------------------------------------------------
# PL7 / PL10 / C8 / H4: two loads onto Parquet tables; the second brings new
# entities under known nodes, children for stored leaves, and known inner nodes
# as roots
# ---------------------------------------------------------------------------

def _part_sources(spark: SparkSession, sf: str, second: bool) -> dict[str, DataFrame]:
    from .schemas import SOURCES
    # a few small files, of which eight sources are built: dealt out, so that no task builds a whole source
    part = load(spark, sf, "part").repartition("p_partkey")
    sup = load(spark, sf, "supplier").repartition("s_suppkey")
    key = F.col("p_partkey").cast("string")
    word = F.split_part("p_name", F.lit(" "), F.lit(1))
    paths = [F.struct(F.col("p_type").alias("ent_id"), F.col("p_type").alias("ent_path")),
             F.struct(F.col("p_brand").alias("ent_id"), F.concat_ws("/", "p_type", "p_brand").alias("ent_path"))]
    if second:
        paths += [F.struct(word.alias("ent_id"), F.concat_ws("/", "p_type", "p_brand", word).alias("ent_path")),
                  F.struct(word.alias("ent_id"), F.when(F.col("p_size") % 5 == 0, F.concat_ws("/", F.col("p_brand"), word))
                           .otherwise(word).alias("ent_path"))]
    own = {
        "keywords.csv": part.select(F.col("p_partkey").alias("article_id"), F.col("p_type").alias("keyword")),
        "authors.csv": sup.select(F.col("s_suppkey").alias("article_id"), F.col("s_name").alias("fullname")),
        "papers_final.csv": part.select(F.col("p_partkey").alias("article_id"), key.alias("citekey"),
                                        F.col("p_name").alias("title"), F.col("p_brand").alias("journal")),
        "unique_references.csv": sup.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("citekey"),
                                            F.col("s_name").alias("title")),
        "paragraphs.csv": part.select(key.alias("para_id"), F.col("p_partkey").alias("article_id")),
        "sentences.csv": part.select(key.alias("sentence_id"), key.alias("para_id"), F.col("p_name").alias("sentence")),
        "citations.csv": part.select(key.alias("sentence_id"), key.alias("reference_citekey")),
        "entities.csv": part.select(key.alias("sentence_id"), F.lit("TOPIC").alias("label"), F.inline(F.array(*paths))),
    }
    return {name: df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                              for f in SOURCES[name].fields]) for name, df in own.items()}


@query("incremental_load", """
WITH paths AS (
  SELECT p_type AS path FROM part
  UNION SELECT p_type || '/' || p_brand FROM part
  UNION SELECT p_type || '/' || p_brand || '/' || split_part(p_name, ' ', 1) FROM part
  UNION SELECT CASE WHEN p_size % 5 = 0 THEN p_brand || '/' || split_part(p_name, ' ', 1)
                    ELSE split_part(p_name, ' ', 1) END FROM part),
nodes AS (SELECT string_split(path, '/') AS n FROM paths),
starts AS (SELECT n, unnest(range(1, len(n) + 1)) AS i FROM nodes),
pairs AS (SELECT n[i] AS a, n[j] AS b, j - i AS depth, i = 1 AS root
          FROM (SELECT n, i, unnest(range(i, len(n) + 1)) AS j FROM starts)),
merged AS (SELECT a, b, min(depth) AS depth, bool_or(root) AS root FROM pairs GROUP BY a, b),
names AS (SELECT p_type AS e FROM part UNION SELECT p_brand FROM part UNION SELECT split_part(p_name, ' ', 1) FROM part),
facts AS (SELECT p_partkey, p_type AS e FROM part UNION SELECT p_partkey, p_brand FROM part
          UNION SELECT p_partkey, split_part(p_name, ' ', 1) FROM part)
SELECT 'pair' AS kind, a, b, CAST(depth AS INTEGER) AS depth, root,
       b NOT IN (SELECT a FROM merged WHERE a <> b) AS leaf, CAST(NULL AS BIGINT) AS n FROM merged
UNION ALL SELECT 'rows', 'dim_entity', NULL, NULL, NULL, NULL, count(*) + 1 FROM names
UNION ALL SELECT 'rows', 'map_entity_hierarchy', NULL, NULL, NULL, NULL, count(*) FROM merged
UNION ALL SELECT 'rows', 'fact_entity_detection', NULL, NULL, NULL, NULL, count(*) FROM facts
UNION ALL SELECT 'rows', 'dim_sentence', NULL, NULL, NULL, NULL, count(*) + 1 FROM part
UNION ALL SELECT 'rows', 'dim_paper', NULL, NULL, NULL, NULL, (SELECT count(*) FROM part) + count(*) + 1 FROM supplier
UNION ALL SELECT 'rows', 'aggregation_paper', NULL, NULL, NULL, NULL, (SELECT count(*) FROM part) + count(*) + 1 FROM supplier
""")
def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.full_load import load_to_path, open_warehouse
    from .session import scratch_path
    root = scratch_path(spark, "incremental")
    for second in (False, True):
        load_to_path(spark, _part_sources(spark, sf, second), root, buckets=4)
    read = open_warehouse(spark, root).tables().__getitem__
    names = read("dim_entity").select("entity_pk", "entity_name")
    pairs = read("map_entity_hierarchy") \
        .join(names.withColumnsRenamed({"entity_pk": "parent_entity_pk", "entity_name": "a"}), "parent_entity_pk") \
        .join(names.withColumnsRenamed({"entity_pk": "child_entity_pk", "entity_name": "b"}), "child_entity_pk") \
        .select(F.lit("pair").alias("kind"), "a", "b", F.col("depth_from_parent").alias("depth"),
                F.col("highest_parent_flag").alias("root"), F.col("lowest_child_flag").alias("leaf"),
                F.lit(None).cast("bigint").alias("n"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    rows = [read(t).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("rows").alias("kind"), F.lit(t).alias("a"), none("string", "b"), none("int", "depth"),
        none("boolean", "root"), none("boolean", "leaf"), "n")
        for t in ("dim_entity", "map_entity_hierarchy", "fact_entity_detection", "dim_sentence", "dim_paper",
                  "aggregation_paper")]
    return reduce(DataFrame.unionByName, rows, pairs)


@query("summary_maintained", """
SELECT CAST(p_partkey AS VARCHAR) AS citekey, CASE WHEN p_partkey = 0 THEN 'MISSING' ELSE least(p_type, p_brand) END AS first_topic,
       CASE WHEN p_partkey = 0 THEN 'MISSING' ELSE 'A ' || split_part(p_name, ' ', 1) END AS topic FROM part
UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), 'MISSING', 'MISSING' FROM supplier
UNION ALL SELECT 'MISSING', 'MISSING', 'MISSING'
""")
def summary_maintained(spark: SparkSession, sf: str) -> DataFrame:
    """PL9 / C7 / A3: the second load brings each paper an entity with as many votes as its winner has
    and a smaller name, so every stored winner changes."""
    from .plans.full_load import load_to_path, open_warehouse
    from .session import scratch_path
    root = scratch_path(spark, "maintained")
    first = _part_sources(spark, sf, False)
    load_to_path(spark, first, root, buckets=4)
    name = F.concat(F.lit("A "), F.split_part("p_name", F.lit(" "), F.lit(1)))
    more = load(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("sentence_id"), F.lit("TOPIC").alias("label"),
                                          name.alias("ent_id"), name.alias("ent_path"))
    load_to_path(spark, {**first, "entities.csv": first["entities.csv"].unionByName(more)}, root)
    warehouse = open_warehouse(spark, root)
    first = warehouse.read("aggregation_paper", 1).select("paper_pk", F.col("topic").alias("first_topic"))
    return warehouse.read("aggregation_paper").join(first, "paper_pk").select("citekey", "first_topic", "topic")


# ---------------------------------------------------------------------------
# PL6 / W2: sentence ids that repeat or are missing never share a key
# ---------------------------------------------------------------------------

@query("sentence_repeated_ids", """
SELECT coalesce(CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END, '0') AS sentence_source_id,
       count(*) AS n_rows, count(*) AS n_keys
FROM orders GROUP BY 1
""")
def sentence_repeated_ids(spark: SparkSession, sf: str) -> DataFrame:
    from .plans.text_units import sentence_delta, sentence_rows
    o = load(spark, sf, "orders")
    sents = o.select(F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).alias("sentence_id"),
                     F.lit("p").alias("para_id"),
                     F.concat_ws(" ", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("sentence"),
                     F.lit("BODY").alias("sentence_type"))
    no_citations = o.select(F.col("o_orderstatus").alias("sentence_id"), F.col("o_orderstatus").alias("reference_citekey"))
    papers = o.select(F.col("o_orderpriority").alias("citekey"), F.col("o_orderkey").alias("paper_pk"))
    paras = o.select(F.col("o_orderstatus").alias("para_source_id"), F.col("o_orderkey").alias("paragraph_pk"))
    out = sentence_delta(sentence_rows(sents, no_citations, papers, paras), None)["dim_sentence"]
    return out.filter("sentence_pk > 0").groupBy("sentence_source_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("sentence_pk").alias("n_keys"))


# ---------------------------------------------------------------------------
# CSV bound by name, numbers written as decimals
# ---------------------------------------------------------------------------

@query("csv_by_name", """
SELECT o_orderkey AS article_id, CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE WHEN o_custkey % 9 <> 0 THEN o_orderpriority END AS keyword FROM orders
""")
def csv_by_name(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import types as T
    from .functions import numbers as nu
    from .session import scratch_path
    from .sources.files import read_csv
    path = scratch_path(spark, "csv")
    load(spark, sf, "orders").select(
        F.concat(F.year("o_orderdate").cast("string"), F.lit(".0")).alias("year"),
        F.lit("unused").alias("note"),
        F.when(F.col("o_custkey") % 9 != 0, F.col("o_orderpriority")).otherwise("NA").alias("keyword"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".00")).alias("article_id"),
    ).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("keyword", T.StringType()),
                           T.StructField("year", T.StringType())])
    return read_csv(spark, path, schema).select("article_id", nu.try_int("year").alias("year"), "keyword")


# ---------------------------------------------------------------------------
# Cells with line breaks and quotes, cut in parallel; rejected cells
# ---------------------------------------------------------------------------

def _sql_tokens() -> str:
    from .sources.files import MISSING_TOKENS
    return ", ".join(f"'{t}'" for t in MISSING_TOKENS)


@query("csv_quoted", f"""
SELECT doc_id, CASE WHEN text NOT IN ({_sql_tokens()}) THEN text END AS text,
       CASE WHEN source NOT IN ({_sql_tokens()}) THEN source || ' "' || lang || '"' || chr(10) || 'end' END AS note
FROM documents
""")
def csv_quoted(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import types as T
    from .session import scratch_path
    from .sources.files import read_csv
    path = scratch_path(spark, "csv_quoted")
    load(spark, sf, "documents").select(
        F.concat(F.col("source"), F.lit(' "'), F.col("lang"), F.lit('"\nend')).alias("note"), "text", "doc_id",
    ).write.option("header", True).option("quote", '"').option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("note", T.StringType())])
    return read_csv(spark, path, schema, multiline=True)


@query("csv_rejected", """
WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 1 AS record_no, o_totalprice,
                  CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority WHEN o_orderkey % 11 = 0 THEN 'NA'
                       ELSE CAST(o_custkey AS VARCHAR) || '.0' END AS year FROM orders)
SELECT record_no, 'year' AS column_name, year AS cell FROM o WHERE o_orderkey % 7 = 0 AND o_orderkey % 5 <> 0
UNION ALL SELECT record_no, NULL, CAST(o_orderkey AS VARCHAR) FROM o WHERE o_orderkey % 5 = 0
""")
def csv_rejected(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import types as T
    from .session import scratch_path
    from .sources.files import rejected_cells
    path = scratch_path(spark, "csv_rejected")
    year = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderpriority")).when(F.col("o_orderkey") % 11 == 0, F.lit("NA")) \
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
    key = F.coalesce(F.col("o_orderkey").cast("string"), F.lit(""))
    lines = load(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, key).otherwise(
        F.concat_ws(",", key, year, F.concat(F.lit('"clerk ""'), key, F.lit('""\n'), F.lit('second line"')))).alias("value"))
    # one file for each range of order keys, in their order, each with the header before its first record
    header = F.lit("article_id,year,note")
    head = spark.range(1).select(F.lit(None).cast("long").alias("o_orderkey"), header.alias("value"), F.lit(True).alias("head"))
    order = [F.desc("head"), F.asc_nulls_last("o_orderkey")]
    first = F.monotonically_increasing_id() == F.shiftleft(F.spark_partition_id().cast("long"), 33)
    lines.withColumn("head", F.lit(False)).unionByName(head).repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.when(first & ~F.col("head"), F.concat(header, F.lit("\n"), "value")).otherwise(F.col("value")).alias("value")) \
        .write.text(path)
    schema = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("year", T.IntegerType()),
                           T.StructField("note", T.StringType())])
    return rejected_cells(spark, path, schema, onward=True).select("record_no", "column_name", "cell")
