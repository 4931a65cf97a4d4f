"""Token ids of whole texts with the ``tokenizers`` library, each distinct word once.

The byte-level pre-tokenizer never joins a character that is not white space to a space
after it, so a text may be cut before each such space: the ids of the pieces, in order,
are the ids of the text. A worker remembers the ids of the pieces it has seen, up to a
bounded amount, and encodes only new ones, many at a time.
"""

from __future__ import annotations

import itertools
import os
import zlib

import numpy as np
from tokenizers import Tokenizer

from wayfare.llm.shared import worker_cache

# Characters that the pre-tokenizer's pattern takes as white space.
WHITE = frozenset("\t\n\v\f\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))))
# Pieces that a worker remembers (and so many characters each, on average), and how many
# are encoded as one text. A worker whose tasks do little else may remember more.
CACHE_PIECES, MORE_PIECES, PIECE_CHARS, JOINED = 500_000, 900_000, 24, 500


class _Index(dict):
    """piece -> number. A piece stands for itself after a space; the first piece of a
    text, which no space precedes, is held as a 1-tuple."""

    def __missing__(self, piece) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


def _open_ended(piece) -> bool:
    """Whether a space after this piece may belong to a run of white space with it."""
    text = piece[0] if isinstance(piece, tuple) else piece
    return not text or text[-1] in WHITE


def _merge(pieces: list) -> list:
    """Pieces with no cut inside a run of white space."""
    out = []
    for piece in pieces:
        if out and _open_ended(out[-1]):
            last = out[-1]
            out[-1] = (f"{last[0]} {piece}",) if isinstance(last, tuple) else f"{last} {piece}"
        else:
            out.append(piece)
    return out


class TextEncoder:
    """Encodes texts to uint32 ids and appends ``end_id`` to each."""

    def __init__(self, tokenizer_json: str, end_id: int, cache_pieces: int = CACHE_PIECES):
        self.most = cache_pieces
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # In a byte-level vocabulary a token has a character for each of its bytes.
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(k) or "")
                                  for k in range(self.tokenizer.get_vocab_size())])
        self.end = np.array([end_id], dtype=np.uint32)
        self.clear()

    def clear(self) -> None:
        self.index, self.chars, self.used = _Index(), 0, 0
        self.index.new = []
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.open_ended = np.zeros(1024, bool)
        self.pool = np.zeros(1 << 16, np.uint32)

    def _raw(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(size.sum())), size

    def _store(self, numbers: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        if self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * (self.used + len(flat)))
        self.size[numbers] = size
        self.start[numbers] = self.used + np.cumsum(size) - size
        self.pool[self.used:self.used + len(flat)] = flat
        self.used += len(flat)

    def _learn(self) -> None:
        new, self.index.new = self.index.new, []
        if not new:
            return
        first = len(self.index) - len(new)
        while len(self.index) > len(self.size):
            self.start, self.size, self.open_ended = (
                np.resize(x, 2 * len(x)) for x in (self.start, self.size, self.open_ended))
        inner, other = [], []
        for number, piece in enumerate(new, first):
            ended = self.open_ended[number] = _open_ended(piece)
            (other if ended or isinstance(piece, tuple) else inner).append(number)
            self.chars += len(piece[0]) if isinstance(piece, tuple) else len(piece)
        if other:
            texts = [p[0] if isinstance(p := new[k - first], tuple) else f" {p}" for k in other]
            self._store(np.array(other), *self._raw(texts))
        if inner:
            # Each piece starts with a space and ends otherwise: encoded as one text, they
            # keep their ids, and byte lengths tell which ids are whose.
            texts = [f" {new[k - first]}" for k in inner]
            flat, _ = self._raw(["".join(texts[k:k + JOINED]) for k in range(0, len(texts), JOINED)])
            ends = np.cumsum(np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts)))
            token_ends = np.cumsum(self.bytes_of[flat])
            upto = np.searchsorted(token_ends, ends, side="right")
            if not np.array_equal(token_ends[upto - 1], ends):
                raise ValueError("the tokenizer joins pieces across a space")
            self._store(np.array(inner), flat, np.diff(upto, prepend=0))

    def _numbers(self, pieces: list) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.index) > self.most or self.chars > self.most * PIECE_CHARS:
            self.clear()
        split = [(text or "").split(" ") for text in texts]
        for pieces in split:
            pieces[0] = (pieces[0],)
        numbers = [self._numbers(pieces) for pieces in split]
        self._learn()
        for k, found in enumerate(numbers):
            if self.open_ended[found[:-1]].any():
                numbers[k] = self._numbers(_merge(split[k]))
        self._learn()
        out = []
        for found in numbers:
            size = self.size[found]
            ends = np.cumsum(size)
            at = np.repeat(self.start[found] - (ends - size), size) + np.arange(int(ends[-1]))
            out.append(np.concatenate([self.pool[at], self.end]))
        return out


def text_encoder(tokenizer_json: str, end_id: int, cache_pieces: int = CACHE_PIECES) -> TextEncoder:
    """The worker's encoder for this tokenizer, kept across tasks."""
    key = f"encoder_{zlib.crc32(tokenizer_json.encode())}_{end_id}"
    encoder = worker_cache(key, lambda: TextEncoder(tokenizer_json, end_id))
    encoder.most = cache_pieces
    return encoder


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
