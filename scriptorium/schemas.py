"""Fixed schemas: the 8 source CSV files and the 16 warehouse tables, with
primary and foreign keys. Keys are ``long``; every warehouse column is
non-null by contract (checked by ``operators.integrity``, not declared)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, R = (T.StringType(), T.LongType(), T.IntegerType(), T.DateType(),
                    T.BooleanType(), T.DoubleType())


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# fixed values: column names and types of the sources and of the warehouse
# --- sources (dirty columns are strings, parsed by functions.*) -------------
SOURCES: dict[str, T.StructType] = {
    "keywords.csv": _st(("article_id", L), ("keyword", S)),
    "authors.csv": _st(("article_id", L), ("fullname", S), ("email", S),
                       ("departments", S), ("institutions", S), ("countries", S),
                       ("author_position", I)),
    "papers_final.csv": _st(("article_id", L), ("citekey", S), ("title", S),
                            ("abstract", S), ("year", S), ("number_of_pages", S),
                            ("journal", S), ("journal_akronym", S), ("publisher", S),
                            ("place", S), ("volume", S), ("issue", S),
                            ("keywords", S), ("authors", S)),
    "unique_references.csv": _st(("citekey", S), ("title", S), ("authors", S),
                                 ("year", S), ("pages", S), ("journal", S),
                                 ("publisher", S), ("place", S), ("volume", S),
                                 ("issue", S), ("source_type", S), ("editor", S),
                                 ("monograph_title", S), ("note", S)),
    "paragraphs.csv": _st(("para_id", S), ("article_id", L), ("last_section_title", S),
                          ("last_subsection_title", S), ("paragraph_type", S)),
    "sentences.csv": _st(("sentence_id", S), ("para_id", S), ("sentence", S),
                         ("sentence_type", S)),
    "citations.csv": _st(("sentence_id", S), ("reference_citekey", S)),
    "entities.csv": _st(("sentence_id", S), ("label", S), ("ent_id", S), ("ent_path", S)),
}

# --- warehouse ---------------------------------------------------------------
TABLES: dict[str, T.StructType] = {
    "dim_citationgroup": _st(("citationgroup_pk", L)),
    "dim_authorgroup": _st(("authorgroup_pk", L)),
    "dim_keywordgroup": _st(("keywordgroup_pk", L)),
    "dim_journal": _st(("journal_pk", L), ("title", S), ("volume", I), ("issue", I),
                       ("publisher", S), ("place", S)),
    "dim_keyword": _st(("keyword_pk", L), ("keyword_string", S)),
    "bridge_paper_keyword": _st(("keyword_pk", L), ("keywordgroup_pk", L)),
    "dim_author": _st(("author_pk", L), ("surname", S), ("firstname", S),
                      ("middlename", S), ("email", S), ("department", S),
                      ("institution", S), ("country", S)),
    "bridge_paper_author": _st(("author_pk", L), ("authorgroup_pk", L),
                               ("author_position", I)),
    "dim_paper": _st(("paper_pk", L), ("keywordgroup_pk", L), ("authorgroup_pk", L),
                     ("journal_pk", L), ("year", D), ("title", S), ("citekey", S),
                     ("abstract", S), ("no_of_pages", I), ("article_source_id", L)),
    "bridge_sentence_citation": _st(("citationgroup_pk", L), ("paper_pk", L)),
    "dim_paragraph": _st(("paragraph_pk", L), ("paper_pk", L), ("subheading", S),
                         ("heading", S), ("paragraph_type", S), ("para_source_id", S)),
    "dim_entity": _st(("entity_pk", L), ("entity_label", S), ("entity_name", S)),
    "map_entity_hierarchy": _st(("child_entity_pk", L), ("parent_entity_pk", L),
                                ("depth_from_parent", I), ("highest_parent_flag", B),
                                ("lowest_child_flag", B)),
    "dim_sentence": _st(("sentence_pk", L), ("citationgroup_pk", L), ("paragraph_pk", L),
                        ("sentence_type", S), ("sentence_string", S),
                        ("sentence_source_id", S)),
    "fact_entity_detection": _st(("entity_pk", L), ("sentence_pk", L), ("entity_count", L)),
    "aggregation_paper": _st(
        ("paper_pk", L), ("keywordgroup_pk", L), ("authorgroup_pk", L), ("journal_pk", L),
        ("year", D), ("title", S), ("citekey", S), ("abstract", S), ("no_of_pages", I),
        ("article_source_id", L), ("model_element", S), ("level", S), ("participants", S),
        ("no_of_participants", L), ("collection_method", S), ("sampling", S),
        ("analysis_method", S), ("sector", S), ("region", S), ("metric", S),
        ("metric_value", R), ("conceptual_method", S), ("topic", S), ("technology", S),
        ("theory", S), ("paradigm", S), ("company_type", S), ("validity", S)),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "dim_citationgroup": ["citationgroup_pk"],
    "dim_authorgroup": ["authorgroup_pk"],
    "dim_keywordgroup": ["keywordgroup_pk"],
    "dim_journal": ["journal_pk"],
    "dim_keyword": ["keyword_pk"],
    "bridge_paper_keyword": ["keyword_pk", "keywordgroup_pk"],
    "dim_author": ["author_pk"],
    "bridge_paper_author": ["author_pk", "authorgroup_pk"],
    "dim_paper": ["paper_pk"],
    "bridge_sentence_citation": ["citationgroup_pk", "paper_pk"],
    "dim_paragraph": ["paragraph_pk"],
    "dim_entity": ["entity_pk"],
    "map_entity_hierarchy": ["child_entity_pk", "parent_entity_pk"],
    "dim_sentence": ["sentence_pk"],
    "fact_entity_detection": ["entity_pk", "sentence_pk"],
    "aggregation_paper": ["paper_pk"],
}

# what makes a row new (C1-C6); stored tables are bucketed by it
NATURAL_KEYS: dict[str, list[str]] = {
    "dim_keyword": ["keyword_string"],
    "dim_author": ["surname", "firstname", "middlename"],
    "dim_journal": ["title", "volume", "issue", "publisher", "place"],
    "dim_paper": ["article_source_id", "citekey", "abstract", "year", "title", "no_of_pages", "journal_pk"],
    "dim_paragraph": ["para_source_id", "heading", "subheading", "paragraph_type", "paper_pk"],
    "dim_sentence": ["sentence_source_id"],
    "dim_entity": ["entity_name", "entity_label"],
    "fact_entity_detection": ["entity_pk", "sentence_pk"],
    "entity_paths": ["ent_path"],
}

# kept beside the warehouse tables: facts whose count changed (Q9), cells that a source's schema refused, the
# hierarchy paths that were expanded, and the vote totals behind the summary
SIDE_TABLES: dict[str, T.StructType] = {
    "entity_paths": _st(("ent_path", S)),
    "paper_votes": _st(("paper_pk", L), ("entity_label", S), ("entity_name", S), ("votes", L)),
    "paper_numbers": _st(("paper_pk", L), ("entity_label", S), ("entity_name", S), ("whole", L), ("number", R), ("votes", L)),
    "changed_facts": _st(("entity_pk", L), ("sentence_pk", L), ("entity_count", L), ("previous_entity_count", L)),
    "rejected_cells": _st(("source", S), ("file", S), ("record_no", L), ("column_name", S), ("cell", S)),
}

# (child table, child columns, parent table, parent columns) — 19 foreign keys
FOREIGN_KEYS: list[tuple[str, list[str], str, list[str]]] = [
    ("dim_sentence", ["citationgroup_pk"], "dim_citationgroup", ["citationgroup_pk"]),
    ("bridge_sentence_citation", ["citationgroup_pk"], "dim_citationgroup", ["citationgroup_pk"]),
    ("dim_paper", ["authorgroup_pk"], "dim_authorgroup", ["authorgroup_pk"]),
    ("bridge_paper_author", ["authorgroup_pk"], "dim_authorgroup", ["authorgroup_pk"]),
    ("aggregation_paper", ["authorgroup_pk"], "dim_authorgroup", ["authorgroup_pk"]),
    ("dim_paper", ["keywordgroup_pk"], "dim_keywordgroup", ["keywordgroup_pk"]),
    ("bridge_paper_keyword", ["keywordgroup_pk"], "dim_keywordgroup", ["keywordgroup_pk"]),
    ("aggregation_paper", ["keywordgroup_pk"], "dim_keywordgroup", ["keywordgroup_pk"]),
    ("dim_paper", ["journal_pk"], "dim_journal", ["journal_pk"]),
    ("aggregation_paper", ["journal_pk"], "dim_journal", ["journal_pk"]),
    ("bridge_paper_keyword", ["keyword_pk"], "dim_keyword", ["keyword_pk"]),
    ("bridge_paper_author", ["author_pk"], "dim_author", ["author_pk"]),
    ("dim_paragraph", ["paper_pk"], "dim_paper", ["paper_pk"]),
    ("bridge_sentence_citation", ["paper_pk"], "dim_paper", ["paper_pk"]),
    ("dim_sentence", ["paragraph_pk"], "dim_paragraph", ["paragraph_pk"]),
    ("fact_entity_detection", ["entity_pk"], "dim_entity", ["entity_pk"]),
    ("map_entity_hierarchy", ["child_entity_pk"], "dim_entity", ["entity_pk"]),
    ("map_entity_hierarchy", ["parent_entity_pk"], "dim_entity", ["entity_pk"]),
    ("fact_entity_detection", ["sentence_pk"], "dim_sentence", ["sentence_pk"]),
]

# load order that respects the foreign keys (I4 / PL10)
LOAD_ORDER = [
    "dim_keyword", "dim_author", "dim_journal",
    "dim_keywordgroup", "bridge_paper_keyword", "dim_authorgroup",
    "bridge_paper_author", "dim_paper", "dim_paragraph",
    "dim_citationgroup", "bridge_sentence_citation", "dim_sentence",
    "dim_entity", "map_entity_hierarchy", "fact_entity_detection",
    "aggregation_paper",
]
