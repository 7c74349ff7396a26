"""The paper tables from keyword x author rows: a plain version that tests compare the plan with."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import numbers as nu
from scriptorium.functions import text as tx
from scriptorium.operators.delta import new_rows
from scriptorium.operators.groups import assign_group_keys, bridge, owners
from scriptorium.operators.impute import MISSING, fill
from scriptorium.operators.keys import max_key
from scriptorium.operators.lookup import full_merge, lookup_key
from scriptorium.plans.author import NAME, split_names
from scriptorium.plans.journal import journal_key
from scriptorium.plans.paper import PAPER_ATTRS, _tables
from scriptorium.session import materialize


def article_rows(papers: DataFrame, keywords: DataFrame, authors: DataFrame,
                 dim_keyword: DataFrame, dim_author: DataFrame,
                 dim_journal: DataFrame) -> DataFrame:
    """Articles with keyword_pk (J3 + J1 + X26), author_pk (J3 + J2) and
    journal_pk (J2); one row per article x keyword x author."""
    kw = keywords.select("article_id", tx.lower("keyword").alias("keyword"))
    # a null article id matches nothing (nor another null), and full_merge spreads such rows
    a = full_merge(papers.drop("keywords", "authors", "journal_akronym"), kw, ["article_id"], null_safe=False)
    a = lookup_key(a, dim_keyword, {"keyword": "keyword_string"}, "keyword_pk").drop("keyword")
    au = split_names(authors).select("article_id", "author_position", *NAME)
    a = full_merge(au, a, ["article_id"], null_safe=False)
    a = fill(a, {n: MISSING for n in NAME})
    a = lookup_key(a, dim_author, NAME, "author_pk", default=None).drop(*NAME)
    a = journal_key(a, dim_journal)
    return a.select("article_id", "author_position", "citekey", "abstract", "year", "title",
                    "author_pk", nu.try_int("number_of_pages").alias("number_of_pages"),
                    "journal_pk", "keyword_pk")


def paper_delta(source: DataFrame, existing: DataFrame | None,
                groups: DataFrame | None = None) -> dict[str, DataFrame]:
    """C4 + W1 + W3 + M1 + M2 + M4 + W2 + P14: the five tables to append.

    New papers are the merged rows whose paper attributes are not yet in the
    dimension (Q1); a group number per citekey gives both the keyword and the
    author group key, above those of ``groups`` (``dim_keywordgroup``)."""
    src = source.withColumnRenamed("article_id", "article_source_id").withColumns({
        "article_source_id": F.col("article_source_id").cast("bigint"),
        "author_position": F.col("author_position").cast("int"),
        "no_of_pages": F.col("no_of_pages").cast("int")})
    delta = new_rows(src, existing, PAPER_ATTRS, null_safe=True)
    start = max_key(groups if groups is not None else existing, "keywordgroup_pk")
    # five tables are cut from these rows: store them once
    g = materialize(assign_group_keys(delta, ["citekey"], ["keywordgroup_pk", "authorgroup_pk"],
                                      start), "paper_rows")
    own = owners(g, ["author_position", "author_pk", "keyword_pk"])
    return _tables(own, bridge(g, "keywordgroup_pk", "keyword_pk"),
                   bridge(g, "authorgroup_pk", "author_pk", first_of="author_position"), existing, start)
