import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import ODD_TEXTS, frame, read
from wayfare.llm.shared import Scratch
from wayfare.llm.tokenfile import decode_ranks, encode_ranks, read_token_files, token_file_query, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=200))
def test_coding_round_trip(values):
    ranks = np.array(values, dtype=np.uint32)
    control, data = encode_ranks(ranks)
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(max(1, (v.bit_length() + 7) // 8) for v in values)
    assert decode_ranks(control, data, len(values)).tolist() == values


def expected(rows):
    library, at, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_documents_round_trip(spark):
    docs = read(spark, "documents").repartition(7)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, token_file_query(docs).collect())) == expected(rows)


def test_odd_rows(spark):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "no id"), (2**60, "big"), (3, "a"), (3, "b")]
    df = frame(spark, rows).withColumnRenamed("source", "ids").withColumnRenamed("lang", "part")
    got = sorted(map(tuple, token_file_query(df).collect()), key=lambda r: r[1])
    # Rows that repeat a doc_id may stand in either order: compare without their places.
    drop = lambda found: sorted(((r[0] is None, r[0] or 0, *r[2:]) for r in found))
    assert drop(got) == drop(expected(rows))
    ends = [0] + [r[1] + r[2] for r in got]
    assert [r[1] for r in got] == ends[:-1]
    assert token_file_query(frame(spark, [])).collect() == []


def test_frequent_ids_get_short_codes_and_damage_is_found(spark):
    rnd = random.Random(1)
    rows = [(k, " ".join(rnd.choice(["the", "of", "and"]) for _ in range(200))) for k in range(20)]
    folder = Scratch(spark, "test").root
    write_token_files(frame(spark, rows), PATH, folder)
    blocks = spark.read.parquet(f"{folder}/blocks").collect()
    ids = sum(sum(b["lengths"]) for b in blocks)
    assert sum(len(b["data"]) for b in blocks) == ids  # a byte each
    back = {r["doc_id"]: r["ids"] for r in read_token_files(spark, folder, with_ids=True).collect()}
    library = Tokenizer.from_file(PATH)
    assert back == {k: library.encode(t, add_special_tokens=False).ids + [2] for k, t in rows}
