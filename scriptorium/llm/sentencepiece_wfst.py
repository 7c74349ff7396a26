"""SentencePiece encoding and decoding by weighted finite-state transducers (operator 1).

A model file is compiled into three machines over the tropical semiring
(weights add along a path, the smallest total wins):

* the normaliser rewrites spaces to the space mark and adds the leading mark;
* the lexicon is a trie over the pieces, one arc per character, whose final
  states output the piece id at the weight ``-score``; a character that is no
  piece leaves through an arc that outputs its UTF-8 byte pieces;
* the grammar is an acceptor over neighbouring pieces. For a unigram model it
  accepts all of them. For a BPE model it accepts (a, b) at weight 0 when the
  merge order keeps a and b apart, that is when merging the characters of a+b
  ends at exactly [a, b], and refuses it (infinite weight) otherwise. A
  segmentation is what the merges produce just when all its neighbours pass,
  so the shortest path is the model's own segmentation.

An input is composed with them lazily, position by position, and the shortest
path is read back. No piece crosses from a non-mark to a mark, so the composed
machine splits there into independent chunks; the paths of short chunks are
kept in a bounded cache.

Defined cases: null or empty text has no ids and decodes to the empty text; a
U+2581 in the text decodes as a space (as in the model's own library); lone
bytes that are no UTF-8 decode to U+FFFD. Rows are independent, so ties and
repeated rows don't matter; extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scriptorium.llm.common import kept, replaced, slices, texts

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_BYTES = 64 << 20  # the largest model that is broadcast
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, UNUSED, BYTE = 1, 2, 3, 5, 6
UNIGRAM, BPE = 1, 2
START = -1  # the grammar's start state, where no piece came before
_NONE: dict[int, bool] = {}


class Transducer:
    """The compiled machines of one model."""

    CACHE_BYTES, CACHED_CHARS, PAIRS = 24 << 20, 48, 400_000

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        if norm.precompiled_charsmap or trainer.treat_whitespace_as_suffix or not norm.escape_whitespaces:
            raise ValueError("only models whose normaliser rewrites spaces alone are supported")
        if trainer.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.bpe = trainer.model_type == BPE
        self.id: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes_of = [b""] * len(proto.pieces)
        byte_id = [0] * 256
        self.unknown = 0
        for i, p in enumerate(proto.pieces):
            if p.type == NORMAL:
                self.id[p.piece], self.score[p.piece] = i, p.score
                self.bytes_of[i] = p.piece.replace(MARK, " ").encode()
            elif p.type == BYTE:
                byte_id[int(p.piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == UNKNOWN:
                self.unknown, self.bytes_of[i] = i, b" \xe2\x81\x87 "
            elif p.type not in (CONTROL, UNUSED):
                raise ValueError(f"piece type {p.type} is not supported")
        self.byte_id = byte_id if trainer.byte_fallback else None
        self.fallback = 10.0 - min(self.score.values(), default=0.0)
        self.trie: dict = {}
        for piece in self.id:
            if self.bpe and self.merged(piece) != [piece]:
                continue  # no merges make it
            node = self.trie
            for ch in piece:
                node = node.setdefault(ch, {})
            node[""] = self.id[piece]
        crosses = any(MARK in piece.lstrip(MARK) for piece in self.id)
        self.chunk = re.compile("(?s).+" if crosses else f"{MARK}*[^{MARK}]+|{MARK}+")
        if self.bpe and any(ch not in self.id for piece in self.id for ch in piece):
            raise ValueError("every character of a BPE model's pieces must be a piece itself")
        self.piece = [p.piece for p in proto.pieces]
        self.apart: dict[int, dict[int, bool]] = {}
        self.pairs = 0
        self.paths = _Paths(self)

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix else text

    def merged(self, s: str) -> list[str]:
        """The pieces that the merge order makes of the characters of s (short s only)."""
        parts, score = list(s), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                v = score.get(parts[i] + parts[i + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def accepts(self, a: int, b: int) -> bool:
        """The grammar's arc from piece a to piece b has a finite weight."""
        if self.pairs > self.PAIRS:
            self.apart.clear()
            self.pairs = 0
        x, y = self.piece[a], self.piece[b]
        ok = self.apart.setdefault(a, {})[b] = self.merged(x + y) == [x, y]
        self.pairs += 1
        return ok

    def shortest_path(self, s: str) -> list[int]:
        """Outputs of the lightest path through normalised s; a character that only the fallback
        arc reads is given as -1 - its code point."""
        return self._merge_path(s) if self.bpe else self._score_path(s)

    def _merge_path(self, s: str) -> list[int]:
        """With the BPE grammar every prefix has one path of finite weight (the merges of
        that prefix), so one state for each position is kept: the piece that ends there."""
        n, trie, apart, piece_of = len(s), self.trie, self.apart, self.piece
        last: list[int | None] = [None] * (n + 1)
        last[0] = START
        for i in range(n):
            prev = last[i]
            if prev is None:
                continue
            row = apart.get(prev, _NONE)
            node = trie.get(s[i])
            if node is None:  # no piece starts here: the fallback arc, which merges with nothing
                last[i + 1] = -1 - ord(s[i])
                continue
            j = i
            while node is not None:
                j += 1
                piece = node.get("")
                if piece is not None and last[j] is None:
                    ok = True if prev < 0 else row.get(piece)
                    if ok is None:
                        ok = self.accepts(prev, piece)
                        row = apart[prev]
                    if ok:
                        last[j] = piece
                if j == n:
                    break
                node = node.get(s[j])
        out, j = [], n
        while j:
            k = last[j]
            if k is None:
                raise ValueError("no path: the model's merges and pieces disagree")
            out.append(k)
            j -= len(piece_of[k]) if k >= 0 else 1
        out.reverse()
        return out

    def _score_path(self, s: str) -> list[int]:
        n, trie = len(s), self.trie
        cost, back = [0.0] + [float("inf")] * n, [(0, 0)] * (n + 1)
        for i in range(n):
            node, j, single = trie, i, False
            while j < n and (node := node.get(s[j])) is not None:
                j += 1
                piece = node.get("")
                if piece is not None:
                    single |= j == i + 1
                    w = cost[i] - self.score[self.piece[piece]]
                    if w < cost[j]:
                        cost[j], back[j] = w, (i, piece)
            if not single and cost[i] + self.fallback < cost[i + 1]:
                cost[i + 1], back[i + 1] = cost[i] + self.fallback, (i, -1 - ord(s[i]))
        out, j = [], n
        while j:
            j, piece = back[j]
            out.append(piece)
        return out[::-1]

    def ids(self, s: str) -> list[int]:
        out = self.shortest_path(s)
        if min(out, default=0) >= 0:
            return out
        spread = (lambda k: [self.byte_id[b] for b in chr(-1 - k).encode("utf-8", "replace")]) if self.byte_id \
            else lambda k: [self.unknown]
        return [x for k in out for x in (spread(k) if k < 0 else (k,))]

    def encode(self, text: str | None) -> np.ndarray:
        """Piece ids of a text, as int32."""
        chunks = self.chunk.findall(self.normalise(text or ""))
        return np.frombuffer(b"".join(map(self.paths.__getitem__, chunks)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids: the inverse machines, without the leading mark."""
        out = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        if self.prefix and out.startswith(b" "):
            out = out[1:]
        return out.decode("utf-8", "replace")


class _Paths(dict):
    """Chunk -> packed ids of its shortest path, in two generations of CACHE_BYTES each;
    long chunks are not kept."""

    ENTRY = 180  # bytes of an entry besides its chunk and ids

    def __init__(self, fst: Transducer) -> None:
        super().__init__()
        self.fst, self.old, self.held = fst, {}, 0

    def __missing__(self, chunk: str) -> bytes:
        packed = self.old.get(chunk)
        if packed is None:
            packed = np.asarray(self.fst.ids(chunk), np.int32).tobytes()
        if len(chunk) <= Transducer.CACHED_CHARS:
            self.held += self.ENTRY + 2 * len(chunk) + len(packed)
            if self.held > Transducer.CACHE_BYTES:
                self.old, self.held = dict(self), 0
                self.clear()
            self[chunk] = packed
        return packed


def transducer(model: bytes) -> Transducer:
    """The compiled model, once for each worker process."""
    return kept(("transducer", hash(model)), lambda: Transducer(model))


def read_model(path: str = DEFAULT_MODEL) -> bytes:
    with open(path, "rb") as f:
        model = f.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"the model is larger than {MODEL_BYTES} bytes")
    return model


def encode_column(spark: SparkSession, df: DataFrame, text_col: str = "text",
                  model_path: str = DEFAULT_MODEL) -> DataFrame:
    """All columns of df, then ids array<int>, n_tokens long and decoded_ok boolean
    (decoding gives the text back, U+2581 read as a space). Columns of df with those
    names are replaced."""
    shared = spark.sparkContext.broadcast(read_model(model_path))
    df = df.drop("ids", "n_tokens", "decoded_ok")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(shared.value)
        for b in slices(batches, text_col):
            ids, ok = [], []
            for text in b.column(text_col).to_pylist():
                path = fst.encode(text)
                ids.append(path)
                want = (text or "").replace(MARK, " ")
                ok.append(fst.decode(path) == (re.sub(" +", " ", want.strip(" ")) if fst.squeeze else want))
            sizes = np.array([len(x) for x in ids], np.int64)
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum(sizes, out=offsets[1:])
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.empty(0, np.int32)])))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, lists, pa.array(sizes), pa.array(ok)],
                names=[*b.schema.names, "ids", "n_tokens", "decoded_ok"])

    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType()), T.StructField("decoded_ok", T.BooleanType())])
    return df.mapInArrow(run, schema)


def decode_column(spark: SparkSession, df: DataFrame, ids_col: str = "ids", text_col: str = "text",
                  model_path: str = DEFAULT_MODEL) -> DataFrame:
    """All columns of df with text_col set to the decoded ids (null ids: null)."""
    shared = spark.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(shared.value)
        for b in batches:
            yield replaced(b, {text_col: [None if x is None else fst.decode(np.asarray(x, np.int32))
                                          for x in b.column(ids_col).to_pylist()]})

    if text_col not in df.columns:
        from pyspark.sql import functions as F
        df = df.withColumn(text_col, F.lit(None).cast("string"))
    return df.mapInArrow(run, df.schema)


def op1(spark: SparkSession, docs: DataFrame, model_path: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id, ids, n_tokens, decoded_ok of every document."""
    return encode_column(spark, texts(docs), model_path=model_path).drop("text")
