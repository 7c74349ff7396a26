import hashlib
import re

import pytest

from scriptorium.llm import decontaminate as op
from tests.llm.fixtures import edge_docs, edge_rows, empty_docs, prose

ITEMS = [(1, prose(40, 1)), (2, prose(9, 3)), (3, prose(12, 1)), (4, None), (5, "!!"), (10, "same same SAME"),
         (2, prose(4, 4)), (None, prose(30, 2)), (7, prose(25, 2).upper()), (8, "one")]


def words(t):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(rows, items):
    windows = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            n = min(10, len(w))
            for k in range(len(w) - n + 1):
                windows.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in range(1, 11):
            for k in range(len(w) - n + 1):
                s = tuple(w[k:k + n])
                if s in windows:
                    hit.update(range(k, k + n))
                    found |= windows[s]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [op.BLOCK_WORDS, 45, 1])
def test_edge_rows(spark, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = op.report(edge_docs(spark), items, block_words=block)
    assert sorted(map(tuple, got.collect()), key=str) == brute([r[:2] for r in edge_rows()], ITEMS)


def test_small_alphabet_automaton():
    import random
    r = random.Random(3)
    for _ in range(150):
        items = {str(k): [[r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(1, 14))]] for k in range(6)}
        text = [r.choice([b"a", b"b", b"c", b"d"]) for _ in range(60)]
        size = r.randint(2, 5)
        spans, found = op.SuffixAutomaton(items, size).scan(text)
        hit, names = set(), set()
        for name, (w,) in items.items():
            n = min(size, len(w))
            for k in range(len(w) - n + 1):
                for p in range(len(text) - n + 1):
                    if text[p:p + n] == w[k:k + n]:
                        hit.update(range(p, p + n))
                        names.add(name)
        assert {p for a, b in spans for p in range(a, b)} == hit
        assert {sorted(items)[k] for k in found} == names
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_clean_cuts_spans_and_drops_covered_documents(spark):
    passage = prose(15, 50)
    rows = [(1, "Before it. " + re.sub("[a-z]", lambda m: m.group().upper(), passage) + " After, as it was. " + prose(30, 51), 1), (2, passage, 2),
            (3, "clean   text\n" + prose(30, 52), 3), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r["doc_id"]: r for r in op.clean(docs, items).collect()}
    assert set(got) == {1, 3, 4} and got[3]["text"] == rows[2][1] and got[3]["n_chars"] == 3
    assert got[1]["text"] == "Before it.  After, as it was. " + prose(30, 51)
    assert got[1]["n_chars"] == len(got[1]["text"]) and got[4]["text"] is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert op.report(empty_docs(spark), none).count() == 0
    assert op.report(edge_docs(spark), none).where("contaminated").count() == 0
    assert op.clean(edge_docs(spark), none).count() == len(edge_rows())


def test_columns_named_like_the_operators_own(spark):
    names = ["_hit_spans", "_hit_items", "_s", "_i", "row_key", "Spans", "items", "block"]
    rows = [(1, prose(40, 1), *[f"{n}!" for n in names]), (2, prose(30, 80), *[f"{n}?" for n in names])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, prose(40, 1)[:60]), (2, prose(90, 81))], "item_id long, text string")
    for block in (op.BLOCK_WORDS, 10):
        got = op.clean(docs, items, block_words=block, max_coverage=1.0)
        assert got.columns == docs.columns
        assert sorted(tuple(r)[2:] for r in got.collect()) == sorted(r[2:] for r in rows)


def test_blocks_have_a_bounded_number_of_words(spark):
    items = spark.createDataFrame([(k, prose(20 + 300 * (k % 3), k)) for k in range(40)] + [(99, prose(5000, 99))],
                                  "item_id long, text string").repartition(4)
    rows = op.blocks(items, block_words=1000, piece_words=200).collect()
    size = {}
    for r in rows:
        size[r["block"]] = size.get(r["block"], 0) + len(r["piece"])
    assert max(size.values()) <= 1200 and len(size) > 8
    docs = spark.createDataFrame([(1, "x " + prose(5000, 99)[7000:9000])], "doc_id long, text string")
    whole = op.report(docs, items).collect()
    assert op.report(docs, items, block_words=1000).collect() == whole and whole[0]["n_hit"] > 100
