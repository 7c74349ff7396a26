import random

import pytest
import sentencepiece

from scriptorium.llm import sentencepiece_wfst as op
from tests.llm.fixtures import edge_docs, edge_rows, empty_docs


@pytest.fixture(scope="module")
def machines():
    model = op.read_model()
    return op.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)


def test_shortest_path_equals_the_library(machines):
    fst, library = machines
    r = random.Random(1)
    letters, pieces = "etaoinshr      .,\n\t=-0123456789ABCÄéñ中文字本語😀▁\x00_/()", list(fst.id)
    for k in range(3000):
        s = "".join(r.choice(letters) for _ in range(r.randint(0, 60))) if k % 2 else \
            "".join(r.choice(pieces) for _ in range(r.randint(0, 12))).replace(op.MARK, " ")
        ids = fst.encode(s)
        assert ids.tolist() == library.encode(s), repr(s)
        assert fst.decode(ids) == library.decode(ids.tolist())


def test_runs_of_one_character(machines):
    fst, library = machines
    for ch in " a=.é😀0":
        for n in (1, 2, 15, 16, 17, 33, 500):
            assert fst.encode(ch * n).tolist() == library.encode(ch * n)


def test_cache_generations_keep_results(machines, monkeypatch):
    fst, library = machines
    monkeypatch.setattr(op.Transducer, "CACHE_BYTES", 4000)
    for _, text, *_ in edge_rows():
        assert fst.encode(text).tolist() == library.encode(text or "")


def test_unigram_path_is_the_lightest():
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(op.read_model())
    proto.trainer_spec.model_type = op.UNIGRAM
    for p in proto.pieces:
        if p.type == op.NORMAL and p.score < -1e6:
            p.score = -40000
    model = proto.SerializeToString()
    fst, library = op.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for s in ("the quick brown fox", "internationalization", "日本語 é😀"):
        cost = lambda ids: sum(-library.get_score(i) for i in ids)
        assert cost(fst.encode(s).tolist()) <= cost(library.encode(s))
        assert fst.decode(fst.encode(s)) == s


def test_edge_rows_and_empty_table(spark, machines):
    _, library = machines
    rows = op.encode_column(spark, edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        assert r["ids"] == library.encode(r["text"] or "") and r["n_tokens"] == len(r["ids"]) and r["decoded_ok"]
    back = op.decode_column(spark, op.encode_column(spark, edge_docs(spark)).withColumnRenamed("text", "was"))
    assert all(r["text"] == (r["was"] or "") for r in back.collect())
    assert op.op1(spark, empty_docs(spark)).count() == 0
