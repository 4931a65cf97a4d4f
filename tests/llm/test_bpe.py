import hashlib
import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import ODD_TEXTS, frame, read
from wayfare.llm.bpe import WordBpe, bpe_query, encode_documents, merge_word
from wayfare.llm.tokens import read_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(read_tokenizer(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain_merge(symbols, merges):
    """The definition: look for the leftmost lowest pair again after every merge."""
    symbols = list(symbols)
    while True:
        pairs = [(merges[p][0], k) for k, p in enumerate(zip(symbols, symbols[1:])) if p in merges]
        if not pairs:
            return symbols
        k = min(pairs)[1]
        symbols[k:k + 2] = [merges[symbols[k], symbols[k + 1]][1]]


def test_tree_equals_the_definition():
    rnd = random.Random(5)
    for _ in range(400):
        ranks = list(range(40))
        rnd.shuffle(ranks)
        merges = {(rnd.randint(0, 9), rnd.randint(0, 9)): (r, rnd.randint(0, 9)) for r in ranks}
        word = [rnd.randint(0, 5) for _ in range(rnd.randint(0, 24))]
        assert merge_word(list(word), merges) == plain_merge(word, merges)


def test_texts_equal_the_library(bpe, library):
    rnd = random.Random(6)
    parts = ["a", "the", "'s", "'LL", "'", "ing", " ", "\n", "\v", "\x1c", "\x85", "\xa0", "　", "É", "é",
             "́", "ΑΣ", "İ", "ß", "中文", "🙂", "👩‍👧", "42", "½", "_", "...", "<|endoftext|>", "<|startoftext|>",
             "<|", "|>", "\x00", "​", "Å", "각"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        want = library.encode(text, add_special_tokens=False).ids
        got = bpe.encode(text)
        assert got.tolist() == want, text
        assert bpe.decode(got) == library.decode(want, skip_special_tokens=False)


def test_windows_and_a_cleared_cache_change_nothing(bpe, library, monkeypatch):
    texts = ["alpha beta\tgamma, delta\n" * 30, "x" * 500 + " y", " " * 50, "end"]
    monkeypatch.setattr("wayfare.llm.bpe.WINDOW", 7)
    monkeypatch.setattr("wayfare.llm.bpe.CACHE_CHARS", 10)
    for text in texts:
        assert bpe.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_runs_are_not_quadratic(bpe, library):
    for text in ("a" * 100_000, "=" * 100_000):
        start = time.time()
        assert bpe.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert time.time() - start < 20


def check(spark, docs, library):
    want = []
    for row in docs.select("doc_id", "text").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(s.encode()).hexdigest()
                   for s in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want.append((row.doc_id, len(ids), *digests))
    got = bpe_query(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    key = lambda r: (r[0] is not None, *map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_documents(spark, library):
    check(spark, read(spark, "documents"), library)


def test_odd_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (3, "again"), (3, "again")]
    docs = frame(spark, rows)
    check(spark, docs.withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded"), library)
    assert bpe_query(docs.limit(0)).count() == 0


def test_kept_columns(spark):
    docs = frame(spark, [(1, "two words")])
    row = encode_documents(docs, PATH, keep=("doc_id", "lang", "n_chars")).first()
    assert (row.doc_id, row.lang, row.n_chars, row.decoded) == (1, "en", 9, "two</w> words</w>")
    for name in ("ids", "decoded", "_text"):
        with pytest.raises(ValueError, match="clash|_text"):
            encode_documents(docs.withColumnRenamed("lang", name), PATH, keep=("doc_id", name))
