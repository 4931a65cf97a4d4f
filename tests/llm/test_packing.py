import pytest
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import ODD_TEXTS, frame, read
from wayfare.llm.packing import best_fit, local_search, pack_pieces, pack_documents, packing_query, token_pieces
from wayfare.llm.tokens import TextEncoder, read_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_encoder_equals_the_library():
    rnd = random.Random(1)
    bits = ["a", "Word", " ", "  ", "\n", "\t", "'s", "é", "\xa0", " ", "\x85", "1", "!", "...", "\x1c", "᠎",
            "​", "　", "<|endoftext|>", "\r\n", "中", "\x0b", "﻿"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(3000)] + ODD_TEXTS
    encoder, library = TextEncoder(read_tokenizer(PATH), 2), plain()
    want = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert [g.tolist() for g in encoder.encode(texts)] == want
    encoder.clear()
    assert [encoder.encode([t])[0].tolist() for t in texts[:200]] == want[:200]


def check(rows, packed, capacity=1024):
    """Every piece once, sequences without gaps, lengths and checksums as encoded."""
    library, want = plain(), []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r)[:5] for r in packed), key=key) == sorted(want, key=key)
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r[3] for r in want) // capacity)


def test_documents_pack_to_the_least_number(spark):
    docs = read(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    used, least = check(rows, packing_query(docs).collect())
    assert used <= least + 1


def test_many_shards_and_rounds(spark):
    docs = read(spark, "documents", "sf0.01")
    pieces = token_pieces(docs, PATH)
    packed = pack_pieces(pieces, shard_pieces=100).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    used, least = check(rows, packed)
    assert used <= least * 1.02 + 1


def test_odd_rows(spark):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "null id"), (None, None), (2**62 + 1, "big id"), (1, ""), (1, "")]
    df = frame(spark, rows).withColumnRenamed("source", "length").withColumnRenamed("lang", "_shard")
    check(rows, packing_query(df).collect())
    assert packing_query(frame(spark, [])).collect() == []
    with_ids = pack_documents(df, PATH, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in with_ids)


def test_pieces_above_half_never_share(spark):
    pieces = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(600).cast("long").alias("length"))
    packed = pack_pieces(pieces, shard_pieces=50)
    assert packed.select("sequence_id").distinct().count() == 500 == packed.count()


def test_local_search_empties_bins_that_best_fit_leaves():
    lengths = np.array([6, 6, 5, 5, 5, 4, 4, 4, 3, 3, 3], dtype=np.int64)  # 48 of 5 x 10
    start = [[0, 10], [1, 9], [2, 3], [4, 8], [5, 6], [7]]
    better = local_search([list(b) for b in start], lengths, 10)
    assert len(better) == 5 and sorted(k for b in better for k in b) == list(range(11))
    rnd = random.Random(5)
    for _ in range(50):
        sizes = np.array([rnd.randint(1, 99) for _ in range(60)], dtype=np.int64)
        bins = best_fit(sizes, 100)
        improved = local_search([list(b) for b in bins], sizes, 100)
        assert all(sizes[b].sum() <= 100 for b in improved) and len(improved) <= len(bins)
        assert sorted(k for b in improved for k in b) == list(range(60))


def test_local_search_leaves_no_gain_in_many_bins():
    lengths, capacity = np.random.default_rng(1).integers(200, 701, 10_000), 1024
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    assert sorted(k for b in bins for k in b) == list(range(10_000))
    fills = [int(lengths[b].sum()) for b in bins]
    assert max(fills) <= capacity and len(bins) > -(-sum(fills) // capacity)
    under = [at for at, f in enumerate(fills) if f < capacity]

    def sums(at, most):
        return {sum(int(lengths[k]) for k in c) for n in range(most + 1) for c in itertools.combinations(bins[at], n)}
    for s in under:
        for t in under:
            if s != t and fills[s] <= fills[t]:
                free = capacity - fills[t]
                assert not any(0 < offer - back <= free for offer in sums(s, 2) for back in sums(t, 2))


def test_carried_columns_and_clashes(spark):
    pieces = spark.createDataFrame([(k, 10 * k % 40 + 1, f"x{k}") for k in range(30)], "doc_id long, length long, note string")
    got = pack_pieces(pieces, 64).collect()
    assert {(r.doc_id, r.note) for r in got} == {(k, f"x{k}") for k in range(30)}
    for name in ("offset", "sequence_id", "_shard", "_full"):
        with pytest.raises(ValueError, match="clash"):
            pack_pieces(pieces.withColumnRenamed("note", name), 64)
