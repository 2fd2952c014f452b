"""Byte-level BPE ids of Arrow text columns.

Texts are cut into pre-tokens with array operations on code points (the
pattern of the public byte-level vocabularies), every distinct pre-token of
a stretch of text is encoded once by ``tokenizers``, and ids are gathered.
Pre-tokens never merge with each other, so the ids are those of the text.
Encoded pre-tokens are remembered by the worker process, up to a bound.

The strings of a vocabulary's added tokens are tokens of their own, as an
untouched ``Tokenizer`` has it, or ordinary text with ``plain``. A ``.model``
file is read by ``sentencepiece``: its pieces have white space only in front,
so texts may be cut before a blank that follows something else.
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa

from meteora.llm.shingles import _BACK, _BASE, CHUNK, _powers, mix

#: Pre-tokens remembered by a worker, and the longest that is remembered.
REMEMBERED = 900_000
#: The contractions of the pattern, its \s outside of ASCII.
SHORT = "stmd"
LONG = ("re", "ve", "ll")
SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


def _holder():
    """What this process keeps: functions are sent by value, so it is in a
    module of its own."""
    holder = sys.modules.setdefault("_meteora_bpe", types.ModuleType("_meteora_bpe"))
    if "classes" not in holder.__dict__:
        kinds = np.array([{"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(i))[0], OTHER)
                          for i in range(sys.maxunicode + 1)], np.uint8)
        kinds[[*range(9, 14), 32, *SPACES]] = SPACE
        holder.table = mix(np.arange(1, sys.maxunicode + 2, dtype=np.uint64)) | np.uint64(1)
        holder.classes = kinds
    return holder


def _worker_state(path: str, plain: bool = True):
    """Class table, code point table, encoder and memory of this process."""
    holder, key = _holder(), f"{path} {plain}"
    if key not in holder.__dict__:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encoder = ModelEncoder(path) if path.endswith(".model") else PieceEncoder(path, plain)
        holder.__dict__[key] = (encoder, Memory())
    return holder.classes, holder.table, *holder.__dict__[key]


def char_classes() -> np.ndarray:
    return _holder().classes


class Memory:
    def __init__(self):
        self.clear()

    def clear(self):
        self.at = {}
        self.pool = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.used = 0

    def add(self, keys: list[int], ids: list[list[int]]):
        flat = np.fromiter((i for x in ids for i in x), np.uint32)
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        n = len(self.at)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + len(lens) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.pool[self.used:self.used + len(flat)] = flat
        self.start[n:n + len(lens)] = self.used + np.cumsum(lens) - lens
        self.count[n:n + len(lens)] = lens
        self.used += len(flat)
        self.at.update(zip(keys, range(n, n + len(lens)), strict=True))


def pretoken_starts(points: np.ndarray, heads: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Start offsets of the pre-tokens in texts laid end to end; ``heads``
    are the texts' first offsets."""
    n = len(points)
    kind = classes[points]
    head = np.zeros(n + 1, bool)
    head[heads] = True
    head[n] = True
    space = kind == SPACE
    new = head[:-1].copy()
    new[1:] |= kind[1:] != kind[:-1]
    last = np.zeros(n, bool)  # white space before other text
    last[:-1] = space[:-1] & ~space[1:] & ~head[1:-1]
    joined = np.zeros(n, bool)  # after a blank, which is taken along
    joined[1:] = (points[:-1] == 32) & ~head[1:-1]
    start = np.where(space, new | last, new & ~joined)
    quote = np.flatnonzero((points == 39) & new & ~joined)
    quote = quote[quote + 1 < n]
    quote = quote[~head[quote + 1]]
    first = points[quote + 1]
    two = quote[np.isin(first, [ord(c) for c in SHORT])]
    three = quote[quote + 2 < n]
    three = three[~head[three + 2]]
    pair = points[three + 1].astype(np.int64) * 65536 + points[three + 2]
    three = three[np.isin(pair, [ord(a) * 65536 + ord(b) for a, b in LONG])]
    start[two + 1] = False
    start[three + 1] = False
    for end in (two + 2, three + 3):
        start[end[end < n]] = True
    return np.flatnonzero(start)


class PieceEncoder:
    """Ids of single pre-tokens by the vocabulary file of ``tokenizers``.

    In a byte-level BPE file whose merges stand in the order of the ids they
    make, a merge's rank is its id, and ``tiktoken`` gives the same ids from
    the same table several times faster; other files go through
    ``tokenizers``. Joined by line ends, pre-tokens are cut as they stand, so
    one call encodes all but white space."""

    def __init__(self, path: str, plain: bool = True):
        import json

        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"].get("merges", [])
        extra = {t["content"] for t in spec["added_tokens"]}
        self.added = {} if plain else {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")) and self.added:
            raise ValueError("added tokens that take their surroundings along are not supported")
        longest = sorted(self.added, key=len, reverse=True)
        self.literal = re.compile("|".join(map(re.escape, longest))) if longest else None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        ids = [vocab.get("".join(p), -1) for p in pairs]
        plain = {t: i for t, i in vocab.items() if t not in extra}
        self.ranks = None
        if (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel" and ids == sorted(ids) \
                and len(plain) == 256 + len(ids) and (not ids or ids[0] >= 256):
            import tiktoken
            letters = byte_letters()
            self.ranks = tiktoken.Encoding("table", pat_str=r"\n|[^\n]+", special_tokens={}, mergeable_ranks={
                bytes(letters[c] for c in t): i for t, i in plain.items()})

    def starts(self, text: str, points: np.ndarray, heads: np.ndarray, classes: np.ndarray) -> np.ndarray:
        spans = [m.span() for m in self.literal.finditer(text)] if self.literal else []
        if spans:  # a literal that runs over the end of a text is none
            ends = np.searchsorted(heads, [a for a, _ in spans], "right") < np.searchsorted(heads, [b for _, b in spans])
            if ends.any():
                spans, cuts = [], [*heads.tolist(), len(points)]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    spans += [m.span() for m in self.literal.finditer(text, a, b)]
        if not spans:
            return pretoken_starts(points, heads, classes)
        first, behind = (np.array(x) for x in zip(*spans, strict=True))
        found = pretoken_starts(points, np.unique(np.concatenate([heads, first, behind[behind < len(points)]])), classes)
        at = np.searchsorted(first, found, "right") - 1
        return found[(at < 0) | (found <= first[at]) | (found >= behind[at])]

    def __call__(self, pieces: list[str], classes: np.ndarray) -> list[list[int]]:
        if any(p in self.added for p in pieces):
            rest = iter(self._plain([p for p in pieces if p not in self.added], classes))
            return [[self.added[p]] if p in self.added else next(rest) for p in pieces]
        return self._plain(pieces, classes)

    def _plain(self, pieces: list[str], classes: np.ndarray) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        rest = range(len(pieces))
        if self.ranks:
            plain = [i for i in rest if classes[ord(pieces[i][-1])] != SPACE]
            ids = np.array(self.ranks.encode_ordinary("\n".join([*(pieces[i] for i in plain), ""])), np.int64)
            end = np.flatnonzero(ids == self.ranks.encode_single_token("\n"))
            ids, start = ids.tolist(), np.r_[0, end + 1][:len(end)].tolist()
            for i, a, b in zip(plain, start, end.tolist(), strict=True):
                out[i] = ids[a:b]
            rest = [i for i in rest if classes[ord(pieces[i][-1])] == SPACE]
        found = self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found, strict=True):
            out[i] = e.ids
        return out


#: Stands for a piece of text that its tokens don't spell.
BAD = (1 << 32) - 1


class ModelEncoder:
    """Ids of stretches of text that begin with a blank, by a model file of
    ``sentencepiece`` that puts a blank in front itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.pieces = model_bytes(self.model)
        if any(" " in p.lstrip(" ") for p in (self.model.id_to_piece(i).replace("\u2581", " ") for i in range(n))):
            raise ValueError("pieces with white space behind other text are not supported")

    def starts(self, text, points, heads, classes) -> np.ndarray:
        new = points == 32
        new[1:] &= points[:-1] != 32
        new[heads] = True
        return np.flatnonzero(new)

    def __call__(self, pieces: list[str], classes: np.ndarray) -> list[list[int]]:
        found = self.model.encode([p[1:] for p in pieces], num_threads=1)
        blank, spell = self.model.piece_to_id("\u2581"), self.pieces.__getitem__
        found = [[blank] if p == " " else ids for p, ids in zip(pieces, found, strict=True)]
        return [ids if b"".join(map(spell, ids)) == p.encode() else [BAD] for p, ids in zip(pieces, found, strict=True)]


def model_bytes(model) -> list[bytes]:
    """The bytes of every piece of a ``sentencepiece`` model."""
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("\u2581", " ").encode()
            for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as: printable
    ones as themselves, the others as the code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def encode(texts: pa.Array | list, path: str, plain: bool = True, remembered: int = REMEMBERED, counts: bool = False):
    """The ids of every text, in order; null is empty. With ``plain``, the
    strings of added tokens are ordinary text. With ``counts``, not the ids
    but for every pre-token how many characters and tokens it has."""
    classes, table, encoder, memory = _worker_state(path, plain)
    texts = texts if isinstance(texts, list) else texts.to_pylist()
    at = 0
    while at < len(texts):
        parts, size = [], 0
        while at + len(parts) < len(texts) and (not parts or size < CHUNK):
            parts.append(texts[at + len(parts)] or "")
            size += len(parts[-1])
        at += len(parts)
        yield from _encode_chunk(parts, classes, table, encoder, memory, remembered, counts)


def _encode_chunk(parts, classes, table, encoder, memory, remembered, counts=False):
    text = "".join(parts)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(p) for p in parts])
    if not len(points):
        none = np.zeros(0, np.uint32)
        yield from ((none, none) if counts else none for _ in parts)
        return
    heads = np.concatenate([[0], ends[:-1]])
    starts = encoder.starts(text, points, np.unique(heads[heads < len(points)]), classes)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(table[points] * _powers(_BASE, len(points)), out=sums[1:])
    stops = np.append(starts[1:], len(points))
    keys = mix((sums[stops] - sums[starts]) * _powers(_BACK, len(points))[starts])
    back, distinct = pd.factorize(keys)
    example = np.empty(len(distinct), np.int64)
    example[back[::-1]] = np.arange(len(keys) - 1, -1, -1)
    if len(memory.at) + len(distinct) > remembered:
        memory.clear()
    known = distinct.tolist()
    get = memory.at.get
    missing = [i for i, k in enumerate(known) if get(k) is None]
    if missing:
        a, b = starts[example[missing]].tolist(), stops[example[missing]].tolist()
        new = encoder([text[x:y] for x, y in zip(a, b, strict=True)], classes)
        memory.add([known[i] for i in missing], new)
    slot = np.fromiter(map(get, known), np.int64, len(known))[back]
    lens, at = memory.count[slot], memory.start[slot]
    first = np.searchsorted(starts, np.concatenate([[0], ends]))
    if counts:
        for a, b in zip(first[:-1], first[1:], strict=True):
            yield stops[a:b] - starts[a:b], lens[a:b]
        return
    total = np.cumsum(lens)
    ids = memory.pool[np.repeat(at - (total - lens), lens) + np.arange(total[-1])]
    upto = np.concatenate([[0], total])
    cut = upto[first]
    for d in range(len(parts)):
        yield ids[cut[d]:cut[d + 1]]
