"""SentencePiece encoding and decoding with an Aho-Corasick automaton and one Viterbi pass.

The automaton holds all pieces of a public .model file. It is run once over a
stretch of text; at each position its output links give every piece that ends
there, longest first, and each is relaxed against the best path to its start.

* Unigram models: the path with the greatest sum of piece scores.
* BPE models: summing their scores (which are merge ranks) does not give the
  segmentation that their merges give. Here a piece may follow another only if
  the merges keep that pair apart (the pair's own merge result is the pair). For
  each position exactly one piece passes against the path before it, so the
  same single pass yields the merge result exactly. Until a merge crosses their
  border, two pieces grow as each would alone; so a pair is judged by running
  the two pieces' own merges side by side and looking only at the border.
  Answers are remembered.

Text is cut where no piece can reach across (before a run of word marks, around
unknown characters); equal stretches are encoded once and remembered in a cache
of bounded size. Unknown characters become byte pieces where the model has them.
Long texts are encoded in parts cut before a run of spaces. A worker process
keeps the codec of the last model, its caches included, for its next tasks.

Decoding joins the pieces' bytes; word marks turn to spaces, and the space the
encoder put in front goes.

Defined cases: a null text has null ids, an empty one no ids; U+2581 in a text
decodes as a space, as with any such model (round_trip is then false); an
empty table gives an empty result; extra columns are ignored, repeated rows are
encoded row by row.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Where the public model files lie; a parameter of every entry point.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: What may become a word mark: no piece reaches from before one into it.
MARKS = " ▁"
#: Entries of either generation of the word cache, and of the pair memory.
CACHE, PAIRS = 120_000, 400_000
#: Characters of a text that are encoded at once.
PART = 1 << 18
#: Piece types and model types of the file format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) pairs of a protobuf message."""
    i = 0

    def varint() -> int:
        nonlocal i
        x = shift = 0
        while True:
            b = buf[i]
            i += 1
            x |= (b & 127) << shift
            if b < 128:
                return x
            shift += 7

    while i < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 5:
            yield tag >> 3, buf[i : i + 4]
            i += 4
        elif kind == 1:
            yield tag >> 3, buf[i : i + 8]
            i += 8
        else:
            n = varint()
            yield tag >> 3, buf[i : i + n]
            i += n


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    types: list[int]
    model_type: int
    dummy_prefix: bool = True
    squeeze: bool = True

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, raw: bytes) -> Vocabulary:
        v = cls([], [], [], UNIGRAM)
        for k, x in _fields(raw):
            if k == 1:
                p = dict(_fields(x))
                v.pieces.append(p[1].decode())
                v.scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                v.types.append(p.get(3, NORMAL))
            elif k == 2:
                v.model_type = dict(_fields(x)).get(3, UNIGRAM)
            elif k == 3:
                n = dict(_fields(x))
                if n.get(2):
                    raise ValueError("models with a character map are not supported")
                v.dummy_prefix, v.squeeze = bool(n.get(3, 1)), bool(n.get(4, 1))
        if v.model_type not in (UNIGRAM, BPE):
            raise ValueError(f"model type {v.model_type} is not supported")
        return v


@dataclass
class Codec:
    vocab: Vocabulary
    young: dict = field(default_factory=dict)
    old: dict = field(default_factory=dict)
    pairs: dict = field(default_factory=dict)
    table: tuple | None = None

    def __post_init__(self):
        v = self.vocab
        self.ids = {p: k for k, (p, t) in enumerate(zip(v.pieces, v.types, strict=True)) if t in (NORMAL, USER)}
        self.bytes = {int(p[3:5], 16): k for k, (p, t) in enumerate(zip(v.pieces, v.types, strict=True)) if t == BYTE}
        self.unk = next((k for k, t in enumerate(v.types) if t == UNKNOWN), 0)
        self.known = {p for p in self.ids if len(p) == 1}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a word mark inside")
        self.auto = ahocorasick.Automaton()
        self.grown: dict[int, list] = {}
        self.length, self.wide = [len(p) for p in v.pieces], len(v.pieces) + 1
        for p, k in self.ids.items():
            if self.known.issuperset(p) and (v.model_type == UNIGRAM or self.merge(p) == [k]):
                self.auto.add_word(p, (k, len(p)))
        self.auto.make_automaton()
        stop = "" if "\n" in self.known else "\n"
        self.cut = re.compile(f"{MARK}*[^{MARK}{stop}]+|{MARK}+" + (f"|{stop}" if stop else ""))
        # what each id decodes to
        self.out = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else p.replace(MARK, " ").encode() for p, t in zip(v.pieces, v.types, strict=True)]

    # ---- the merge rule itself, for short strings

    def merge(self, text: str) -> list[int]:
        """BPE by definition: merge the neighbours whose piece has the best score, the first of equals, until none is left."""
        s = list(text)
        while len(s) > 1:
            best, at = None, 0
            for i in range(len(s) - 1):
                k = self.ids.get(s[i] + s[i + 1])
                if k is not None and (best is None or self.vocab.scores[k] > best):
                    best, at = self.vocab.scores[k], i
            if best is None:
                break
            s[at : at + 2] = [s[at] + s[at + 1]]
        return [self.ids.get(x, self.unk) for x in s]

    def _growth(self, k: int) -> list[tuple[float, str, str]]:
        """How piece k comes about by its own merges: before each merge its score, and the first and the last symbol; then those of the whole."""
        got = self.grown.get(k)
        if got is None:
            ids, scores, got = self.ids, self.vocab.scores, []
            s = list(self.vocab.pieces[k])
            while len(s) > 1:
                best, at = -np.inf, -1
                for i in range(len(s) - 1):
                    j = ids.get(s[i] + s[i + 1])
                    if j is not None and (at < 0 or scores[j] > best):
                        best, at = scores[j], i
                got.append((best, s[0], s[-1]))
                s[at : at + 2] = [s[at] + s[at + 1]]
            got.append((-np.inf, s[0], s[0]))
            self.grown[k] = got
        return got

    def apart(self, a: int, b: int) -> bool:
        """Whether the merges leave pieces a and b next to each other as they are; a = len(pieces) stands for the start."""
        key = a * self.wide + b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = a == self.wide - 1 or self._stay_apart(self._growth(a), self._growth(b))
        return got

    def _stay_apart(self, left: list, right: list) -> bool:
        ids, scores, i, j, m, n = self.ids, self.vocab.scores, 0, 0, len(left) - 1, len(right) - 1
        while True:
            across = ids.get(left[i][2] + right[j][1])
            if across is not None:
                s = scores[across]
                # the best merge is next, of equals the one further left
                if s > left[i][0] or i == m:
                    if s >= right[j][0] or j == n:
                        return False
            if i == m and j == n:
                return True
            if j == n or i < m and left[i][0] >= right[j][0]:
                i += 1
            else:
                j += 1

    # ---- one pass over a stretch of known characters

    def viterbi(self, s: str) -> array:
        """Ids of a stretch of known characters."""
        n = len(s)
        # last[j]: the piece that ends with character j on the best path; behind the last character, the start (as last[-1])
        last = [-1] * n if n < 1 << 12 else array("i", [-1]) * n  # of a long stretch, four bytes a number
        last.append(self.wide - 1)
        if self.vocab.model_type == BPE:
            known, apart, wide = self.pairs.get, self.apart, self.wide
            for j, (k, m) in self.auto.iter(s):
                if last[j] < 0:
                    p = last[j - m]
                    if p >= 0:
                        ok = known(p * wide + k)
                        if apart(p, k) if ok is None else ok:
                            last[j] = k
        else:
            scores, best = self.vocab.scores, [-np.inf] * n + [0.0]
            for j, (k, m) in self.auto.iter(s):
                x = best[j - m] + scores[k]
                if x > best[j]:
                    best[j], last[j] = x, k
        out, size = array("i"), self.length
        j = n - 1
        while j >= 0:
            out.append(last[j])
            j -= size[last[j]]
        out.reverse()
        return out

    def _stretch(self, s: str) -> bytes:
        """Ids of a stretch, packed as int32."""
        known = self.known
        if known.issuperset(s):
            return self.viterbi(s).tobytes()
        out, i = array("i"), 0
        while i < len(s):
            j = i
            while j < len(s) and s[j] in known:
                j += 1
            if j > i:
                out += self.viterbi(s[i:j])
            while j < len(s) and s[j] not in known:
                raw = s[j].encode("utf-8", "replace")
                out.extend([self.bytes.get(b, self.unk) for b in raw] if self.bytes else [self.unk])
                j += 1
            i = j
        return out.tobytes()

    def encode_packed(self, text: str) -> bytes:
        """Ids of a text, packed as little-endian int32."""
        if self.vocab.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return b""
        if self.vocab.dummy_prefix:
            text = " " + text
        if len(text) <= 2 * PART:
            return self._encode(text.replace(" ", MARK))
        out, at = [], 0
        while at < len(text):
            to = min(at + PART, len(text))
            while to < len(text) and (text[to] not in MARKS or text[to - 1] in MARKS):
                to += 1
            out.append(self._encode(text[at:to].replace(" ", MARK)))
            at = to
        return b"".join(out)

    def _encode(self, text: str) -> bytes:
        words = self.cut.findall(text)
        young = self.young
        got = list(map(young.get, words))
        if None in got:
            for i, x in enumerate(got):
                if x is None:
                    w = words[i]
                    x = young.get(w)
                    if x is None:
                        x = self.old.get(w) or self._stretch(w)
                        if len(w) <= 64:
                            young[w] = x
                    got[i] = x
            if len(young) > CACHE:
                self.old, self.young = young, {}
        return b"".join(got)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), np.int32).tolist()

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that ids decode to, all joined, and how many bytes each gives."""
        if self.table is None:
            size = np.array([len(x) for x in self.out], np.int64)
            self.table = np.frombuffer(b"".join(self.out), np.uint8), np.concatenate([[0], np.cumsum(size)]), size
        flat, at, size = self.table
        n = size[ids]
        ends = np.cumsum(n)
        return flat[np.repeat(at[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], n

    def same_bytes(self, ids: np.ndarray, at: np.ndarray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Per row whether its ids (ids[at[k] : at[k + 1]]) decode to its text's bytes."""
        out = np.zeros(len(off) - 1, bool)
        k = 0
        while k < len(out):  # some rows at a time; a long row alone
            j = max(k + 1, int(np.searchsorted(at, at[k] + PART, "right")) - 1)
            raw, n = self.decoded(ids[at[k] : at[j]])
            ends = np.concatenate([[0], np.cumsum(n)])[at[k : j + 1] - at[k]]
            for r in range(k, j):
                s, e = ends[r - k], ends[r - k + 1]
                s += bool(self.vocab.dummy_prefix and e > s and raw[s] == 32)
                out[r] = e - s == off[r + 1] - off[r] and np.array_equal(raw[s:e], data[off[r] : off[r + 1]])
            k = j
        return out

    def decode(self, ids) -> str:
        raw = b"".join(map(self.out.__getitem__, ids))
        if self.vocab.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_KEPT: dict[bytes, Codec] = {}


def codec_of(raw: bytes) -> Codec:
    """The codec of a model file's bytes; a process keeps the last one."""
    name = hashlib.sha256(raw).digest()
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = Codec(Vocabulary.parse(raw))
    return _KEPT[name]


def _read(model: str) -> bytes:
    with open(model, "rb") as f:
        raw = f.read()
    Vocabulary.parse(raw)  # a model that is not supported fails here, on the driver
    return raw


def encode_documents(docs: DataFrame, model: str = MODEL, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """(key, n_tokens, n_bytes, ids_crc32, round_trip[, token_ids]) for every row. The model file is read by the driver and travels with the tasks."""
    raw = _read(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(raw)
        for b in batches:
            for i, j, data, off in C.text_blocks(b, "_t", 4 * C.BLOCK_BYTES):
                part = b.slice(i, j - i)
                null = np.asarray(part.column(1).is_null())
                packed = [None if t is None else codec.encode_packed(t) for t in part.column(1).to_pylist()]
                size = np.array([len(p) // 4 if p else 0 for p in packed], np.int64)
                flat = np.frombuffer(b"".join(p for p in packed if p), np.int32)
                at = np.concatenate([[0], np.cumsum(size)])
                same = codec.same_bytes(flat, at, data, off)
                cols = [part.column(0), pa.array(size, mask=null), pa.array(np.diff(off), mask=null), pa.array([None if p is None else zlib.crc32(p) for p in packed], pa.int64()), pa.array(same, mask=null)]
                names = ["_k", "n_tokens", "n_bytes", "ids_crc32", "round_trip"]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat), mask=pa.array(null)))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"_k {kind}, n_tokens long, n_bytes long, ids_crc32 long, round_trip boolean" + (", token_ids array<int>" if ids else "")
    return C.arrow(docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")), run, schema).withColumnRenamed("_k", key)


def decode_documents(tokens: DataFrame, model: str = MODEL, key: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """(key, text) for every row of token ids; null ids give a null text."""
    raw = _read(model)
    kind = tokens.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(raw)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else codec.decode(x) for x in b.column(1).to_pylist()], pa.string())], ["_k", "text"])

    return C.arrow(tokens.select(F.col(key).alias("_k"), F.col(ids).alias("_i")), run, f"_k {kind}, text string").withColumnRenamed("_k", key)
