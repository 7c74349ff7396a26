"""The driver tables read as a literature corpus.

documents = papers, lines of a document = paragraphs, ``'. '`` pieces of a
line = sentences, words of a sentence = entity detections. Each derivation is
written once for Spark here and once as SQL text (``SQL_*``) that DuckDB and
Spark SQL both run, so oracle queries share it verbatim.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.weights import LABELS
from ..session import materialize

# fixed values: headings assigned to paragraphs by line number (line_no % 10)
HEADINGS = ("Abstract", "Introduction", "Data Collection", "Sample Design",
            "Methods", "Results", "Analysis", "Discussion", "Conclusion",
            "Theory")

# tables whose rows carry whole texts: per-row work on them is heavy
TEXT_TABLES = {"documents": "doc_id"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Text tables are spread over ``spark.scriptorium.textPartitions`` tasks by a hash
    of their key where that setting is given (files with few, large row groups); by default the
    scan's own splits are used."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get("spark.scriptorium.textPartitions", None)
    if parts and name in TEXT_TABLES:
        df = df.repartition(int(parts), TEXT_TABLES[name])
    return df


def _sql_array(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def heading_of(line_no) -> "F.Column":
    heads = F.array(*[F.lit(h) for h in HEADINGS])
    return F.element_at(heads, (F.col(line_no) % len(HEADINGS) + 1).cast("int"))


def sentence_type_of(line_no) -> "F.Column":
    return F.when(F.col(line_no) == 0, F.lit("ABSTRACT")).otherwise(F.lit("BODY"))


def lines(docs: DataFrame) -> DataFrame:
    """Paragraphs: (doc_id, line_no, line, heading)."""
    return (docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .withColumn("line_no", F.col("line_no").cast("bigint"))
            .withColumn("heading", heading_of("line_no")))


def sentences(docs: DataFrame) -> DataFrame:
    """Sentences: (doc_id, line_no, sent_no, heading, sentence_type, sentence)."""
    return (lines(docs)
            .select("doc_id", "line_no", "heading",
                    F.posexplode(F.split("line", r"\. ")).alias("sent_no", "sentence"))
            .withColumn("sent_no", F.col("sent_no").cast("bigint"))
            .withColumn("sentence_type", sentence_type_of("line_no")))


SENTENCE_KEY = ["doc_id", "line_no", "sent_no"]


def repeated_ids(docs: DataFrame) -> DataFrame:
    """The doc_ids of more than one document (few or none; stored)."""
    return materialize(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "repeated_ids")


def by_repeated_id(rows: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of documents with an id of their own, rows of those that share or lack one)."""
    return (rows.filter(F.col("doc_id").isNotNull()).join(repeated, "doc_id", "left_anti"),
            rows.filter(F.col("doc_id").isNull()).unionByName(rows.join(repeated, "doc_id", "left_semi")))


def entity_counts(sentence_rows: DataFrame, sentence: str = "sentence") -> DataFrame:
    """One row per (sentence row, entity) with its count; counted inside the row, so nothing moves."""
    found = tx.counted(F.transform(tx.words(F.col(sentence)), F.lower))
    return sentence_rows.select("*", F.inline(found).alias("entity_name", "entity_count")).drop(sentence)


def label_of(entity) -> "F.Column":
    labels = F.array(*[F.lit(x) for x in LABELS])
    return F.element_at(labels, (F.length(entity) % len(LABELS) + 1).cast("int"))


def merged_detections(counts: DataFrame) -> DataFrame:
    """The counts of sentences that share a key, added up."""
    return counts.groupBy(*SENTENCE_KEY, "entity_name").agg(F.sum("entity_count").alias("entity_count"))


def detections(docs: DataFrame) -> DataFrame:
    """Entity facts: one row per (sentence, entity) with its count (A1).

    Entities are the lower-cased letter runs; the label is chosen by word length from the 16 labels. Rows carry the sentence key,
    not its text: heading and type are functions of the line number, and the
    text is joined back only where it is read (``sentence_text``). A sentence is one row, so its entities are
    counted there; only documents that share an id, or have none, are grouped by key."""
    own, shared = (entity_counts(sentences(d).select(*SENTENCE_KEY, "sentence"))
                   for d in by_repeated_id(docs, repeated_ids(docs)))
    return own.unionByName(merged_detections(shared)).withColumns({
        "heading": heading_of("line_no"), "sentence_type": sentence_type_of("line_no"), "entity_label": label_of("entity_name")})


def sentence_text(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, sent_no, sentence_string)."""
    return sentences(docs).select(*SENTENCE_KEY, F.col("sentence").alias("sentence_string"))


# --- the same derivations as SQL (DuckDB dialect, run by the oracle) ---------

SQL_LINES = f"""
lines AS (
  SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line,
         {_sql_array(HEADINGS)}[CAST(line_no % {len(HEADINGS)} AS INTEGER) + 1] AS heading
  FROM (SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
)"""

SQL_SENTENCES = SQL_LINES + """,
sentences AS (
  SELECT doc_id, line_no, heading, CAST(sent_no AS BIGINT) AS sent_no, sentence,
         CASE WHEN line_no = 0 THEN 'ABSTRACT' ELSE 'BODY' END AS sentence_type
  FROM (SELECT doc_id, line_no, heading, unnest(range(len(parts))) AS sent_no,
               unnest(parts) AS sentence
        FROM (SELECT doc_id, line_no, heading, string_split(line, '. ') AS parts FROM lines))
)"""

SQL_DETECTIONS = SQL_SENTENCES + f""",
detections AS (
  SELECT doc_id, line_no, sent_no, heading, sentence_type, sentence, entity_name,
         COUNT(*) AS entity_count,
         {_sql_array(LABELS)}[CAST(length(entity_name) % {len(LABELS)} AS INTEGER) + 1] AS entity_label
  FROM (SELECT doc_id, line_no, sent_no, heading, sentence_type, sentence, lower(w) AS entity_name
        FROM (SELECT *, unnest(regexp_extract_all(sentence, '\\p{{L}}+')) AS w FROM sentences))
  GROUP BY ALL
)"""
