import base64
import random
import string
import zlib

import numpy as np

from scriptorium.llm import language_id, quality_fm
from scriptorium.llm.common import table
from tests.llm.fixtures import edge_docs, edge_rows, empty_docs

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = language_id.op6(spark, docs).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got) and np.mean([r["rejected"] for r in got]) < 0.002


def test_language_rejects_foreign_texts_and_keeps_short_ones(spark):
    model = language_id.fit(language_id.training_columns(table(spark, SF, "documents")))
    _, _, rejected = model.predict(["Re.", "the that with", "漢字仮名交文" * 30, "Щекъ жюри вдов ьыъ эфхц " * 20, "1234 !!", None])
    assert rejected.tolist() == [False, False, True, True, True, True]


POLISH = (
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i "
    "sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności "
    "zawarte w niniejszej deklaracji bez względu na różnice rasy, koloru, płci, języka, wyznania. ")
FINNISH = (
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
    "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokainen on oikeutettu kaikkiin tässä julistuksessa "
    "esitettyihin oikeuksiin ja vapauksiin ilman minkäänlaista rotuun, väriin, sukupuoleen perustuvaa erotusta. ")


def test_language_rejects_latin_gibberish_and_keeps_clean_texts(spark):
    docs = table(spark, SF, "documents")
    model = language_id.fit(language_id.training_columns(docs))
    r = random.Random(5)
    words = lambda n, letters: " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 10))) for _ in range(n))
    foreign = [words(n, letters) for n in (100, 400, 2000, 20_000)
               for letters in (string.ascii_lowercase, string.ascii_letters, "abcdefghijklmnopqrstuvwxyzéäöüßñç")]
    foreign += [base64.b64encode(r.randbytes(n)).decode() for n in (600, 3000, 15_000)] + [POLISH * 3, FINNISH * 3]
    assert model.predict(foreign)[2].all()
    held = [x["text"] for x in docs.where(language_id.held_out(docs["doc_id"])).collect()]
    assert len(held) > 100 and not model.predict(held)[2].any()
    assert not model.predict([" ".join(t.split()[:n]) for t in held for n in (5, 20, 60) if len(t.split()) >= n])[2].any()


def test_every_language_is_learned(spark):
    r, rows = random.Random(8), []
    for lang in range(230):
        words = ["".join(r.choice(string.ascii_lowercase) for _ in range(r.randint(2, 8))) for _ in range(40)]
        rows += [(12 * lang + k, " ".join(r.choice(words) for _ in range(80)), f"l{lang:03}") for k in range(12 - lang // 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(set(language_id.fit(docs).langs)) == 230
    got = {x["doc_id"]: x for x in language_id.op6(spark, docs).collect()}
    assert len(got) == len(rows)
    for wanted in (True, False):
        held = [(got[i], lang) for i, _, lang in rows if got[i]["held_out"] == wanted]
        assert np.mean([x["lang_pred"] == lang for x, lang in held]) > 0.98
        assert np.mean([x["rejected"] for x, _ in held]) < 0.01


def test_language_edge_rows(spark):
    got = language_id.op6(spark, edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        if r["doc_id"] in (3, 4, 5, -4):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in {"en", "fr", "de", "ja"}
    assert language_id.op6(spark, empty_docs(spark)).count() == 0
    kept = language_id.accepted(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns and kept.where("text IS NULL").count() == 0
    assert language_id.accepted(empty_docs(spark)).count() == 0


def test_no_labelled_row_is_unknown(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language_id.op6(spark, docs).collect()[0]["lang_pred"] == "und"


def test_quality_held_out(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = [r for r in quality_fm.op8(spark, docs, labels).collect() if r["held_out"] and r["doc_id"] in truth]
    y = np.array([truth[r["doc_id"]] for r in got])
    s = np.array([r["score"] for r in got])
    auc = (s[y == 1][:, None] > s[y == 0][None]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None]).mean()
    predicted = np.array([r["predicted"] for r in got])
    assert auc > 0.95 and (predicted == y).mean() > 0.93
    assert ((s >= 0.3) == (predicted == 1)).all()


def test_pairwise_term_equals_the_double_sum():
    r = np.random.default_rng(1)
    n = quality_fm.STATS + quality_fm.WORDS
    m = quality_fm.Machine(None, None, 0.5, r.normal(size=n), r.normal(size=(n, 4)))
    x = np.zeros(n)
    at = r.choice(n, 12, replace=False)
    x[at] = r.normal(size=12)
    direct = 0.5 + x @ m.linear + sum(m.factors[i] @ m.factors[j] * x[i] * x[j]
                                      for a, i in enumerate(at) for j in at[a + 1:])
    assert np.isclose(m.raw(x[None])[0], direct)


def test_quality_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, None), (6, None, 0), (None, 1, 1), (7, 0, 0),
                                    (8, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality_fm.op8(spark, edge_docs(spark), labels).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_fm.op8(spark, empty_docs(spark), labels).count() == 0
    none = quality_fm.op8(spark, edge_docs(spark), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
