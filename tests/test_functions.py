"""Golden scalar cases (FIXTURES §4): each function on one small DataFrame."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import numbers as nu
from scriptorium.functions import text as tx
from scriptorium.functions import weights as wt


def run(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_volume(spark):
    vals = ["12", " 7 ", "XIV", "xiv", "IIII", "MMMM", "10000", "10001", "-3", "12a", None]
    assert run(spark, vals, nu.volume_to_int) == [12, 7, 14, 0, 0, 4000, 10000, 0, -3, 0, 0]


def test_issue(spark):
    assert run(spark, ["3", "3-4", "12-13", "Suppl", "", None], nu.issue_to_int) == [3, 3, 1, 0, 0, 0]


def test_roman(spark):
    vals = ["XIV", "MCMXCIX", "CDXLIV", "XL", "DCCC", "IIII", "iv", "12", ""]
    got = run(spark, vals, lambda c: F.coalesce(nu.roman_to_int(c), F.lit(0)))
    assert got == [14, 1999, 444, 40, 800, 0, 0, 0, 0]


def test_roman_all_values(spark):
    """Every numeral 1..3999 written the standard way parses back."""
    def to_roman(n):
        out = ""
        for v, s in ((1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"),
                     (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
            while n >= v:
                out, n = out + s, n - v
        return out
    vals = [to_roman(n) for n in range(1, 4000)]
    assert run(spark, vals, nu.roman_to_int) == list(range(1, 4000))


def test_page(spark):
    assert run(spark, ["17", "xiv", "XIV", "e12", None], nu.page_to_int) == [17, 14, 14, 0, 0]
    vals = ["10-20", "iv-x", "17", "20-10", "1-2-3", None]
    assert run(spark, vals, nu.page_count) == [10, 6, 0, 0, 1, 0]


def test_year(spark):
    got = run(spark, [1999, 1676, 1677, 2262, 2263, None], nu.year_to_date, "int")
    d = dt.date
    assert got == [d(1999, 1, 1), d(1678, 1, 1), d(1677, 1, 1), d(2262, 1, 1), d(1678, 1, 1),
                   d(1678, 1, 1)]


def test_name_clean(spark):
    vals = ["Smith1, John@uni", "Smith, J. R.", "Lee &amp; (PhD)"]
    assert run(spark, vals, tx.clean_name) == ["Smith, John", "Smith, J R", "Lee  PhD"]


def test_name_split(spark):
    got = run(spark, ["Smith, John A", "Smith, John A B", "Smith"], tx.split_fullname)
    assert [tuple(r) for r in got] == [("Smith", "John", "A"), ("Smith", "John", "A"),
                                       ("Smith", None, None)]


@pytest.mark.parametrize("words,pairs", [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (5, 2)])
def test_pairs(spark, words, pairs):
    arr = " ".join(f"w{i}" for i in range(words))
    got = run(spark, [arr], lambda c: F.size(tx.pairs(F.when(c != "", F.array(c))
                                                   .otherwise(F.array().cast("array<string>")))))
    assert got == [pairs]


def test_author_string(spark):
    vals = ["Smith, John; Brown, Kim", "Berg, Van, Jan", "Smith John", "ab"]
    got = run(spark, vals, tx.parse_author_string)
    assert [[tuple(p) for p in r] for r in got] == [
        [("Smith", "John"), ("Brown", "Kim")], [("Berg", "Jan")], [("Smith", "John")], []]


def test_word_to_int(spark):
    vals = ["12", "1,234", "1.234", "1,234,567", "1234,567", "007", "12,34", "-5", "5."]
    assert run(spark, vals, nu.word_to_int) == [12, 1234, 1234, 1234567, 1234567, 7, None, None, None]


def test_word_to_float(spark):
    vals = ["0.35", "1e3", ".5", "5.", "-2", "5d", "nan", "inf"]
    assert run(spark, vals, nu.word_to_float) == [0.35, 1000.0, 0.5, 5.0, -2.0, None, None, None]


def test_drop_null_and_zero(spark):
    df = spark.createDataFrame([([None, 0, 3],)], "a array<int>")
    assert df.select(nu.drop_null_and_zero("a")).first()[0] == [3]


def test_before_citation(spark):
    vals = ["a START_CITE x END_CITE b START_CITE y END_CITE c", "no citation", "x START_CITE y"]
    assert run(spark, vals, tx.text_before_citation) == ["a ", "no citation", "x START_CITE y"]


def test_weights(spark):
    df = spark.createDataFrame(
        [("ABSTRACT", "Data Collection", "firms", 2), ("BODY", "Intro", "firms", 2),
         (None, "Intro", "sampling", 2)],
        "t string, h string, e string, n int")
    by_type = [r[0] for r in df.select(wt.weight_by_sentence_type("t", "n", ["ABSTRACT"])).collect()]
    assert by_type == [30, 20, 20]
    by_head = [r[0] for r in df.select(
        wt.weight_by_heading("h", "e", "n", ".*data.*", ["sampling"])).collect()]
    assert by_head == [30, 20, 1]
    sent = [r[0] for r in df.select(
        wt.weight_by_heading("h", "e", "n", ".*data.*", ["sampling"],
                             for_sentence=True)).collect()]
    assert sent == [30, 20, 2]


def test_heading_match_is_anchored_and_single_line(spark):
    pat = ".*method.*"
    vals = ["Research Methods", "intro\nmethods", "MÉTHOD", None]
    got = run(spark, vals, lambda c: tx.matches_heading(c, pat))
    assert got == [True, False, False, False]
