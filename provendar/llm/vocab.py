"""Token ids of whole texts with the public tokenizers, encoded once per distinct stretch.

A text is cut before spaces that follow a visible character. No rule of a
byte-level pre-tokenizer and no piece of a SentencePiece BPE model reaches
across such a border (the latter is checked when the model is read), so the ids
of a text are those of its stretches, one after another. Arrow's dictionary
encoding finds the distinct stretches of a block; a worker remembers the ids of
the last CACHE of them, and only new ones go to the tokenizer's library. Tests
hold the result against the library's ids of whole texts.

A row of any length is read in parts of about PART bytes, cut at such borders.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from . import common as C

#: Where the public files lie; a parameter of every entry point.
FOLDER = "/opt/tokenizers"
BYTE_LEVEL = f"{FOLDER}/byte_bpe_50k.json"
PIECES = f"{FOLDER}/piece_bpe_32k.model"
#: Distinct stretches that a worker remembers; the half not used for the longest time goes when it is full.
CACHE = 1_800_000
#: Bytes of a long text handled at once.
PART = 8 << 20
#: Words of a call to the tokenizer's library.
CALL = 500


def read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def seen_end(w: bytes) -> bool:
    """Whether a stretch ends in a character after which a space begins a new one: visible ASCII, or two bytes from U+00C0 on."""
    return 32 < w[-1] < 127 or (w[-1] > 127 and len(w) > 1 and 0xC3 <= w[-2] < 0xE0)


def borders(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of all stretches: rows, and spaces after a visible character. A space that ends its row stays with what is before it."""
    w = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        ink = (data[:-1] > 32) & (data[:-1] < 127)
        two = (data[1:-1] > 127) & (data[:-2] >= 0xC3) & (data[:-2] < 0xE0)
        ink[1:] |= two
        w[1:-1] = (data[1:] == 32) & ink
        last = off[1:][np.diff(off) > 0] - 1
        w[last] = False
    w[off] = True
    w[len(data)] = False
    return np.flatnonzero(w)


class ByteLevel:
    """A byte-level BPE of the tokenizers library. specials: whether special tokens inside texts are plain text."""

    def __init__(self, raw: bytes, plain_specials: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(raw.decode())
        self.tok.encode_special_tokens = plain_specials
        spec = json.loads(raw)
        if spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("a byte-level model without normalizer and prefix space is needed")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take spaces are not supported")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(shown)]
        back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(other)}
        table = {i: bytes(back[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        table |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.bytes = [table.get(i, b"") for i in range(max(table) + 1)]
        self.size = np.array([len(x) for x in self.bytes], np.int64)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(the words' places in the order of coding, the ids of all words in that order, how many each has). Words that begin and end at a border share calls."""
        size = self.size
        order: list[int] = []
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        joint = [k for k, w in enumerate(words) if w[0] == 32 and seen_end(w)]
        alone = sorted(set(range(len(words))) - set(joint)) if len(joint) < len(words) else []
        for i in range(0, len(joint), CALL):
            some = joint[i : i + CALL]
            texts = [words[k] for k in some]
            got = np.array(self.tok.encode_batch_fast([b"".join(texts).decode("utf-8", "replace")], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
            done = np.cumsum(size[got])
            cut = np.searchsorted(done, ends) + 1
            if not len(got) or done[-1] != ends[-1] or not np.array_equal(done[cut - 1], ends):
                alone += some  # bytes that are no UTF-8
                continue
            order += some
            ids.append(got)
            counts.append(np.diff(cut, prepend=0))
        for i in range(0, len(alone), CALL):
            some = alone[i : i + CALL]
            got = [e.ids for e in self.tok.encode_batch_fast([words[k].decode("utf-8", "replace") for k in some], add_special_tokens=False)]
            order += some
            ids += [np.array(x, np.uint32) for x in got]
            counts.append(np.fromiter(map(len, got), np.int64, len(got)))
        return np.array(order, np.int64), np.concatenate(ids or [np.zeros(0, np.uint32)]), np.concatenate(counts or [np.zeros(0, np.int64)])


class Pieces:
    """A SentencePiece BPE model that puts a space in front; a word begins with that space."""

    def __init__(self, raw: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in names):
            raise ValueError("a model with pieces across word marks is not supported")
        if self.sp.encode("a") != self.sp.encode(" a")[1:] and self.sp.id_to_piece(self.sp.encode("a")[0])[0] != "▁":
            raise ValueError("a model that puts a space in front is needed")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else b"" if self.sp.is_control(i) else p.encode().replace("▁".encode(), b" ") for i, p in enumerate(names)]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids: list[int] = []
        counts = np.zeros(len(words), np.int64)
        for i in range(0, len(words), CALL):
            got = self.sp.encode([w[1:].decode("utf-8", "replace") for w in words[i : i + CALL]], num_threads=1)
            counts[i : i + len(got)] = [len(x) for x in got]
            for x in got:
                ids += x
        return np.arange(len(words)), np.array(ids, np.uint32), counts


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (n[0] of them), first[1], ..."""
    ends = np.cumsum(n)
    out = np.repeat(first - ends + n, n)
    out += np.arange(len(out))
    return out


class Memory:
    """The ids of whole texts, through a bounded memory of their stretches' ids.

    A stretch is found by its hash among sorted hashes, and its bytes are compared.
    """

    def __init__(self, codec, limit: int = CACHE):
        self.codec, self.limit = codec, limit
        self.size = np.array([len(x) for x in codec.bytes], np.int64)
        self.wide = np.uint16 if len(codec.bytes) <= 1 << 16 else np.uint32
        self.table = np.frombuffer(b"".join(codec.bytes), np.uint8)
        self.first = np.cumsum(self.size) - self.size
        self.hash, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted hashes and where their stretch is kept
        self.ids, self.text = np.zeros(0, self.wide), np.zeros(0, np.uint8)
        self.n = self.long = self.last = np.zeros(0, np.int32)
        self.at = self.from_ = np.zeros(0, np.int64)
        self.good = np.zeros(0, bool)
        self.clock = 0

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, joined."""
        return self.table[spread(self.first[ids], self.size[ids])]

    def _forget(self) -> None:
        keep = np.sort(np.argsort(self.last, kind="stable")[len(self.last) - self.limit // 2 :])
        new = np.full(len(self.last), -1, np.int32)
        new[keep] = np.arange(len(keep), dtype=np.int32)
        to = new[self.slot]
        self.hash, self.slot = self.hash[to >= 0], to[to >= 0]
        self.ids, self.text = self.ids[spread(self.at[keep], self.n[keep])], self.text[spread(self.from_[keep], self.long[keep])]
        self.n, self.long, self.last, self.good = self.n[keep], self.long[keep], self.last[keep], self.good[keep]
        self.at, self.from_ = np.cumsum(self.n, dtype=np.int64) - self.n, np.cumsum(self.long, dtype=np.int64) - self.long

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Keeps new stretches; returns their slots."""
        order, ids, n = self.codec.encode(words)
        words = [words[k] for k in order]
        text = np.frombuffer(b"".join(words), np.uint8)
        long = np.fromiter(map(len, words), np.int64, len(words))
        told = np.diff(np.concatenate([[0], np.cumsum(self.size[ids])])[np.cumsum(n)], prepend=0)
        good = told == long
        back = self.joined(ids)
        start, there = np.cumsum(long) - long, np.cumsum(told) - told
        at = np.flatnonzero(good)
        off = text[spread(start[at], long[at])] != back[spread(there[at], long[at])]
        if off.any():
            good[at[np.searchsorted(np.cumsum(long[at]), np.flatnonzero(off), "right")]] = False
        base = len(self.n)
        slots = np.empty(len(words), np.int32)
        slots[order] = base + np.arange(len(words), dtype=np.int32)
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(n) - n])
        self.from_ = np.concatenate([self.from_, len(self.text) + start])
        self.ids, self.text = np.concatenate([self.ids, ids.astype(self.wide)]), np.concatenate([self.text, text])
        self.n, self.long = np.concatenate([self.n, n.astype(np.int32)]), np.concatenate([self.long, long.astype(np.int32)])
        self.good = np.concatenate([self.good, good])
        self.last = np.concatenate([self.last, np.full(len(words), self.clock, np.int32)])
        by = np.argsort(hashes, kind="stable")
        by = by[np.append(True, np.diff(hashes[by]) > 0)]
        place = np.searchsorted(self.hash, hashes[by])
        free = place == len(self.hash)
        free[~free] = self.hash[place[~free]] != hashes[by][~free]
        self.hash = np.insert(self.hash, place[free], hashes[by][free])
        self.slot = np.insert(self.slot, place[free], slots[by][free])
        return slots

    def _slots(self, words: pa.Array) -> np.ndarray:
        """Where each of different stretches is kept."""
        n = len(words)
        off = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        hashes = [C.span_hash(C.prefix_hash(data[off[i] : off[j]]), off[i:j] - off[i], off[i + 1 : j + 1] - off[i]) for i, j in C.blocks(off)]
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        slots = np.zeros(n, np.int32)
        known = np.zeros(n, bool)
        if len(self.hash):
            place = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
            slots = self.slot[place]
            size = np.diff(off)
            known = (self.hash[place] == hashes) & (self.long[slots] == size)
            at = np.flatnonzero(known)
            other = data[spread(off[at], size[at])] != self.text[spread(self.from_[slots[at]], size[at])]
            if other.any():
                known[at[np.searchsorted(np.cumsum(size[at]), np.flatnonzero(other), "right")]] = False
        new = np.flatnonzero(~known)
        if len(new):
            slots[new] = self._learn(hashes[new], words.take(pa.array(new)).to_pylist())
        self.last[slots] = self.clock
        return slots

    def _part(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        start = borders(data, off)
        ends = np.append(start, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        self.clock += 1
        if len(self.n) > self.limit:
            self._forget()
        slot = self._slots(words.dictionary)[np.asarray(words.indices)]
        n = self.n[slot]
        ids = self.ids[spread(self.at[slot], n)]
        row = np.searchsorted(start, off)
        at = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[row]
        bad = np.concatenate([[0], np.cumsum(~self.good[slot])])[row]
        return ids, at, np.diff(bad) == 0

    def parts(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, bool]]:
        """(first row, last row, ids, each row's place in them, whether a row's ids give its bytes back, whether more of the last row follows)."""
        for i, j in C.blocks(off, PART):
            at, end = int(off[i]), int(off[j])
            if end - at <= 2 * PART:
                yield i, j, *self._part(data[at:end], off[i : j + 1] - at), False
                continue
            while at < end:  # one row alone, in parts
                to, more = end, PART
                while at + more < end:
                    cut = borders(data[at : at + more], np.array([0, more]))
                    if len(cut) > 1:
                        to = at + int(cut[-1])
                        break
                    more *= 2
                yield i, j, *self._part(data[at:to], np.array([0, to - at])), to < end
                at = to


_KEPT: dict[tuple, Memory] = {}


def memory(raw: bytes, make: Callable, *args) -> Memory:
    """The memory of a model's bytes; a worker process keeps up to two."""
    name = (hashlib.sha256(raw).digest(), make.__name__, args)
    if name not in _KEPT:
        while len(_KEPT) > 1:
            _KEPT.pop(next(iter(_KEPT)))
        _KEPT[name] = Memory(make(raw, *args))
    return _KEPT[name]


def led_by_space(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a space in front of each that is not empty."""
    has = np.diff(off) > 0
    to = off + np.concatenate([[0], np.cumsum(has)])
    out = np.empty(int(to[-1]), np.uint8)
    text = np.ones(len(out), bool)
    text[to[:-1][has]] = False
    out[~text] = 32
    out[text] = data
    return out, to
