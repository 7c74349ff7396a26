"""A tiny source set in the 8 CSV schemas covering the cases of FIXTURES §5."""

import csv
import os

ROWS = {
    "keywords.csv": [
        ["article_id", "keyword"],
        [1, "Supply Chain"], [1, "supply chain"], [1, "Blockchain"],
        [2, "NA"], [2, "Logistics"], [3, "blockchain"],
    ],
    "authors.csv": [
        ["article_id", "fullname", "email", "departments", "institutions", "countries",
         "author_position"],
        [1, "Smith1, John A", "js@uni.org", "IS", "Uni A", "DE", 1],
        [1, "Brown, Kim", "kb@uni.org", "", "Uni B", "US", 2],
        [2, "Smith, John A", "js@uni.org", "IS", "Uni A", "DE", 1],
        [2, "Smith, John A", "john@uni.org", "OM", "Uni A", "DE", 1],
        [3, "Lee &amp; (PhD)", "", "", "", "", 1],
    ],
    "papers_final.csv": [
        ["article_id", "citekey", "title", "abstract", "year", "number_of_pages", "journal",
         "journal_akronym", "publisher", "place", "volume", "issue", "keywords", "authors"],
        [1, "smith2020", "Chains", "About chains", "2020", "12", "J Ops", "JO", "Pub",
         "Berlin", "XIV", "3-4", "", ""],
        [2, "smith2021", "More chains", "", "2021", "", "J Ops", "JO", "Pub", "Berlin",
         "12", "12-13", "", ""],
        [3, "lee2019", "Ledgers", "About ledgers", "1500", "7", "", "", "", "", "", "", "", ""],
    ],
    "unique_references.csv": [
        ["citekey", "title", "authors", "year", "pages", "journal", "publisher", "place",
         "volume", "issue", "source_type", "editor", "monograph_title", "note"],
        ["smith2020", "Chains", "Smith, John; Brown, Kim", "2020", "10-20", "J Ops", "Pub",
         "Berlin", "XIV", "3-4", "article", "", "", ""],
        ["berg2018", "Old work", "Berg, Van, Jan; Doe Jane", "2018", "iv-x", "J Hist", "",
         "", "xiv", "Suppl", "article", "", "", ""],
        ["anon2017", "Anonymous", "", "2017", "17", "", "", "", "", "", "", "", "", ""],
        ["ab2016", "Short", "ab", "2263", "1-2-3", "J Short", "", "", "10001", "", "", "",
         "", ""],
    ],
    "paragraphs.csv": [
        ["para_id", "article_id", "last_section_title", "last_subsection_title",
         "paragraph_type"],
        ["p1", 1, "Data Collection", "", "BODY"],
        ["p2", 1, "Introduction", "Motivation", "BODY"],
        ["p3", 2, "Results", "", "BODY"],
        ["p4", 9, "", "", ""],
    ],
    "sentences.csv": [
        ["sentence_id", "para_id", "sentence", "sentence_type"],
        ["s1", "p1", "We surveyed 120 firms START_CITE smith2020 END_CITE in 2020.", "ABSTRACT"],
        ["s2", "p1", "A total of 120 managers answered.", ""],
        ["s3", "p2", "Blockchain matters.", "BODY"],
        ["s4", "p3", "The accuracy was 0.95 overall.", "BODY"],
        ["s5", "p3", "   ", "BODY"],
        ["s6", "p3", "", "BODY"],
        ["s7", "p3", "Table 1", "TABLE"],
        ["s8", "p3", "x", "FIGURE"],
        ["s9", "p2", "Scholars' view.", "BODY"],
    ],
    "citations.csv": [
        ["sentence_id", "reference_citekey"],
        ["s1", "smith2020"], ["s1", "berg2018"], ["s3", "unknown1999"],
    ],
    "entities.csv": [
        ["sentence_id", "label", "ent_id", "ent_path"],
        ["s1", "PARTICIPANTS", "firms", "participant/firms"],
        ["s1", "PARTICIPANTS", "firms", "participant/firms"],
        ["s2", "PARTICIPANTS", "managers", "participant/managers"],
        ["s2", "PARTICIPANTS", "firms", "participant/firms"],
        ["s3", "TECHNOLOGY", "blockchain", "technology/ledger/blockchain"],
        ["s3", "TOPIC", "blockchain", "topic/blockchain"],
        ["s4", "METRIC", "accuracy", "metric/accuracy"],
        ["s9", "THEORY", "scholars'", "theory/scholars'"],
        ["s9", "THEORY", "theory", "theory"],
    ],
}


def write_sources(folder: str) -> dict[str, str]:
    paths = {}
    for name, rows in ROWS.items():
        path = os.path.join(folder, name)
        with open(path, "w", newline="") as fh:
            csv.writer(fh).writerows(rows)
        paths[name] = path
    return paths


def read_sources(spark, folder: str):
    from scriptorium.schemas import SOURCES
    from scriptorium.sources.files import read_csv
    paths = write_sources(folder)
    return {name: read_csv(spark, paths[name], SOURCES[name], multiline=True) for name in paths}
