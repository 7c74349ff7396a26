"""The pipeline against a brute-force run of its stages, and the registration guard."""

import re
import subprocess
import sys
from itertools import combinations

import corpus_pipeline
from scriptorium.llm import decontaminate, language_id, pii, sentencepiece_wfst
from scriptorium.llm.common import table
from tests.llm.fixtures import SCHEMA, edge_docs, edge_rows, empty_docs
from tests.llm.test_decontaminate import words
from tests.llm.test_simhash import brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_wfst.DEFAULT_MODEL)
    docs = [r.asDict() for r in table(spark, SF, "documents").collect()]
    model = language_id.fit(language_id.training_columns(table(spark, SF, "documents")))
    rejected = model.predict([d["text"] for d in docs])[2]
    docs = sorted((d for d, gone in zip(docs, rejected) if not gone), key=lambda d: d["doc_id"])
    fps = {d["doc_id"]: brute_fingerprint(d["text"]) for d in docs}
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    docs = [d for d in docs if find(d["doc_id"]) == d["doc_id"]]
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = words(r["text"])
        n = min(10, len(w))
        windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
    want = {}
    for d in docs:
        spans = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
            "[A-Z]", lambda m: m.group().lower(), d["text"]))]
        w = words(d["text"])
        hit = {p for n in range(1, 11) for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in windows
               for p in range(k, k + n)}
        if len(hit) > decontaminate.MAX_COVERAGE * len(w):
            continue
        text, done, runs = "", 0, sorted(hit)
        for p in runs:
            if p - 1 not in hit:
                text += d["text"][done:spans[p][0]]
            done = spans[p][1]
        text += d["text"][done:]
        want[d["doc_id"]] = (d["lang"], d["source"], pii.redact(text))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: (r["lang"], r["source"], r["text"]) for r in got} == want and len(got) == len(want)
    for r in got:
        assert r["n_chars"] == len(r["text"]) and r["ids"] == library.encode(r["text"]) and r["decoded_ok"]
    assert len(want) < len(fps)


def test_stages_take_edge_rows_and_empty_tables(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.schema.simpleString() == edge_docs(spark).schema.simpleString(), name
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_entry_works_without_the_subpackage(tmp_path):
    code = ("import sys; sys.modules['scriptorium.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert 'category_pivot' in q and 'pipeline' not in q\n"
            "assert not any(n.startswith('op') and n[2:3].isdigit() for n in q)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])
