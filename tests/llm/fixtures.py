"""Rows that every operator has to take: nulls in any column, empty and very long texts, ties,
repeated rows and extra columns with names that operators use inside."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, kind int, spans string, "
          "score double, ids string, fp long, bucket int")
EXTRA = (7, 1, "x", 0.5, "y", 3, 2)


def prose(n, seed, vocabulary=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeé") for _ in range(1 + v % 7)) + str(v)
                    for v in (r.randrange(vocabulary) for _ in range(n)))


def edge_rows():
    long_text = prose(6000, 5) + "\n" + "x" * 50_000 + " " + "same " * 3000
    rows = [(1, prose(40, 1), "en", "s"), (2, prose(40, 1), "en", "s"), (2, prose(40, 1), "en", "s"),
            (3, None, "en", "s"), (4, "", None, "s"), (5, " \n\t ", "fr", None), (6, long_text, "en", "s"),
            (None, prose(40, 1), None, None), (None, prose(30, 9), "de", "s"), (7, prose(60, 3), "fr", "s"),
            (8, prose(20, 4) + " " + prose(30, 1), "en", "s"), (9, "one", "en", "s"), (10, "日本語 テキスト 😀", "ja", "s"),
            (11, long_text, "en", "s"), (12, prose(13, 1), "en", "s"), (12, prose(25, 2), "en", "s"),
            (-4, "12345 678 !!", "en", "s"), (9_007_199_254_740_993, prose(50, 2), "en", "s")]
    return [(i, t, l, s, None if t is None else len(t), *EXTRA) for i, t, l, s in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
