"""Encoding and decoding with a word-level BPE vocabulary (``op11_bpe``).

A word's symbols are merged pair by pair, always the leftmost pair of the lowest rank. The
ranks of adjacent pairs are the leaves of a segment tree whose nodes hold the smallest
(rank, place) below them: the root is the next merge, and a merge changes three leaves, so
a word of n symbols takes O(n log n) steps, however long it is.

Normalising and cutting into words is the library's own work, done for one stretch between
white space at a time: neither step looks across white space, so a worker keeps the ids of
the stretches it has seen, up to a bounded number of characters.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfare.llm.shared import map_slices, worker_cache
from wayfare.llm.tokens import read_tokenizer

# White space that every step takes as such; other white space is left to the library.
BETWEEN = " \t\n\v\f\r"
# Characters of remembered stretches and words in a worker, and of one to be remembered.
CACHE_CHARS, CACHED_STRETCH = 16_000_000, 64
# The words of lower-case ASCII without control characters, as the file's pattern cuts it.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[!-/:-@\[-`{-~]+")
ODD_ASCII = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
NONE = 1 << 62
# A text is taken apart in windows of about so many characters.
WINDOW = 1 << 20
RESULT_COLUMNS = ("ids", "decoded")


def merge_word(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols left when no adjacent pair is in ``merges``, (a, b) -> (rank, merged).

    The tree's leaf k is the pair that starts at place k: rank * width + k, or ``NONE``."""
    n = len(symbols)
    if n < 2:
        return symbols
    find = merges.get
    width = 1 << (n - 1).bit_length()
    tree = [NONE] * (2 * width)
    node, left = width, symbols[0]
    for right in symbols[1:]:
        found = find((left, right))
        if found is not None:
            tree[node] = found[0] * width + node - width
        left = right
        node += 1
    for node in range(width - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    top = tree[1]
    while top != NONE:
        k = top & width - 1
        gone = after[k]
        merged = symbols[k] = merges[symbols[k], symbols[gone]][1]
        symbols[gone] = -1
        right, left = after[gone], before[k]
        after[k] = right
        # Three leaves change: the pair that was merged away, and the merged one's pairs.
        changed = [(width + gone, NONE)]
        if right < n:
            before[right] = k
            found = find((merged, symbols[right]))
            changed.append((width + k, NONE if found is None else found[0] * width + k))
        else:
            changed.append((width + k, NONE))
        if left >= 0:
            found = find((symbols[left], merged))
            changed.append((width + left, NONE if found is None else found[0] * width + left))
        for node, value in changed:
            if tree[node] == value:
                continue
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                if other < value:
                    value = other
                if tree[node] == value:
                    break
                tree[node] = value
        top = tree[1]
    return [s for s in symbols if s >= 0]


# The steps of the tokenizer file for which ASCII_WORDS holds.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class Words(dict):
    """word -> ids, filled as words are asked for."""

    def __init__(self, bpe: WordBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> tuple[int, ...]:
        bpe = self.bpe
        vocab = bpe.vocab
        symbols = [vocab.get(c) for c in word[:-1]] + [vocab.get(word[-1] + bpe.suffix)]
        if None in symbols:
            symbols = [s for s in symbols if s is not None]
        ids = tuple(merge_word(symbols, bpe.merges))
        if len(word) <= CACHED_STRETCH:
            self[word] = ids
            bpe.chars += len(word)
        return ids


class WordBpe(dict):
    """stretch -> ids, filled as stretches are asked for."""

    def __init__(self, tokenizer_json: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        parts = json.loads(tokenizer_json)
        model = parts["model"]
        for key in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges", "unk_token"):
            if model.get(key):
                raise ValueError(f"not supported: {key}")
        if parts["decoder"] is not None or any(t["normalized"] or t["single_word"] for t in parts["added_tokens"]):
            raise ValueError("not supported: a decoder, or added tokens matched after normalising or as words")
        # With the file's own steps, ASCII can be cut into words without the library.
        self.plain = parts["normalizer"] == NORMALIZER and parts["pre_tokenizer"] == PRE_TOKENIZER
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.merges = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.added = {t["content"]: t["id"] for t in parts["added_tokens"]}
        # Longer added tokens win where two start at one place.
        longest = sorted(self.added, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.stretches = re.compile(f"[^{BETWEEN}]+")
        self.window_end = re.compile(f"[{BETWEEN}]")
        size = max([*self.vocab.values(), *self.added.values()]) + 1
        self.tokens = [""] * size
        for token, k in (self.vocab | self.added).items():
            self.tokens[k] = token
        self.words = Words(self)
        self.chars = 0

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        ids, at = [], 0
        for special in self.specials.finditer(stretch) if self.specials else ():
            ids += self._words(stretch[at:special.start()])
            ids.append(self.added[special.group()])
            at = special.end()
        ids = tuple(ids + self._words(stretch[at:]))
        if len(stretch) <= CACHED_STRETCH:
            self.chars += len(stretch)
            self[stretch] = ids
        return ids

    def _words(self, text: str) -> list[int]:
        if not text:
            return []
        if self.plain and text.isascii() and text.isprintable():
            words = ASCII_WORDS.findall(text.lower())
        else:
            text = self.tokenizer.normalizer.normalize_str(text)
            words = [word for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return list(itertools.chain.from_iterable(map(self.words.__getitem__, words)))

    def _windows(self, text: str):
        at = 0
        while at < len(text):
            cut = self.window_end.search(text, at + WINDOW)
            end = cut.start() if cut else len(text)
            yield text[at:end]
            at = end

    def encode(self, text: str | None) -> np.ndarray:
        parts = []
        for window in self._windows(text or ""):
            if self.chars > CACHE_CHARS:
                self.clear()
                self.words.clear()
                self.chars = 0
            if self.plain and window.isascii() and not ODD_ASCII.search(window) and not (
                    self.specials and self.specials.search(window)):
                found = map(self.words.__getitem__, ASCII_WORDS.findall(window.lower()))
            else:
                found = map(self.__getitem__, self.stretches.findall(window))
            parts.append(np.fromiter(itertools.chain.from_iterable(found), np.int32))
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts])

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by spaces, as the library does for a file without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def encode_documents(docs: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",),
                     decode: bool = True) -> DataFrame:
    """A row for each row of ``docs``, in no order: the columns ``keep``, ``ids`` (array of
    int) of its whole ``text`` and, if asked for, ``decoded``, the text of those ids.

    No shuffle: each task encodes the rows it reads. A null text counts as empty; an empty
    one, or one of white space, has no ids and decodes to the empty string. Repeated rows
    give repeated results; other columns of ``docs`` are not read. ``keep`` may not hold a
    result column's name."""
    clash = [c for c in keep if c in RESULT_COLUMNS]
    if clash:
        raise ValueError(f"kept columns clash with result columns: {clash}")
    tokenizer_json = read_tokenizer(tokenizer_path)
    name = f"word_bpe_{zlib.crc32(tokenizer_json.encode())}"
    texts = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_text"))
    if "_text" in keep:
        raise ValueError("kept columns may not include _text")

    def make():
        bpe = worker_cache(name, lambda: WordBpe(tokenizer_json))

        def run(part: dict) -> dict:
            ids = [bpe.encode(text) for text in part.pop("_text")]
            return part | {"ids": ids} | ({"decoded": [bpe.decode(x) for x in ids]} if decode else {})
        return run
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1])
    schema = ", ".join([kept] * bool(keep) + ["ids array<int>"] + ["decoded string"] * decode)
    return map_slices(texts, make, schema)


def bpe_query(documents: DataFrame) -> DataFrame:
    """Query ``op11_bpe``: digests of the ids of every whole text and of their decoding."""
    import public_tokenizers

    out = encode_documents(documents, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
