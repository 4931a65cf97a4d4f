import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tests.llm.helpers import ODD_TEXTS, frame, read
from wayfare.llm.segment import MARK, Path, Segmenter, segment_documents, segment_query

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def segmenter():
    with open(PATH, "rb") as file:
        return Segmenter(file.read(), 4)


def every_path(lattice, link, n):
    found = []

    def back(at, ids, score):
        if at == 0:
            found.append((-score, tuple(ids)))
            return
        for start, own, s in lattice.edges(link, at):
            back(start, ids + list(own[::-1]), score + s)
    back(len(link), [], 0.0)
    return [(-s, ids[::-1]) for s, ids in sorted(found)[:n]]


def test_search_equals_all_paths(segmenter):
    rnd, lattice = random.Random(1), segmenter.lattice
    for _ in range(200):
        link = MARK * rnd.randint(0, 3) + "".join(rnd.choice("theinoraé中") for _ in range(rnd.randint(1, 9)))
        want = every_path(lattice, link, 6)
        assert lattice.n_best(link, 6) == want
        score, ids, cost = lattice.best_path(link)
        assert (score, ids) == want[0] and cost == (want[0][0] - want[1][0] if len(want) > 1 else float("inf"))
    for _ in range(100):
        text = " ".join("".join(rnd.choice("theinoraé.1") for _ in range(rnd.randint(1, 3)))
                        for _ in range(rnd.randint(1, 4)))
        got, want = segmenter.encode([text])[0], every_path(lattice, lattice.normalize(text), 4)
        assert [s for s, _ in got] == [s for s, _ in want]
        assert len({ids.tobytes() for _, ids in got}) == len(got)


def test_decoding_equals_the_library(segmenter):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rnd = random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "the", " ", "\n", "é", "中", "🙂", "\x07", ".", "7"]) for _ in range(rnd.randint(1, 20)))
        for _, ids in segmenter.encode([text])[0]:
            assert segmenter.decode(ids) == sp.decode([int(k) for k in ids]) == text


def test_documents(spark, segmenter):
    docs = read(spark, "documents")
    got = {}
    for r in segment_query(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for doc in docs.collect():
        want = segmenter.encode([doc["text"]])[0]
        rows = sorted(got[doc["doc_id"]], key=lambda r: r["rank"])
        assert [(r["rank"], r["score"], r["ids_crc32"]) for r in rows] == [
            (k, s, zlib.crc32(ids.astype("<u4").tobytes())) for k, (s, ids) in enumerate(want, 1)]
        assert all(r["round_trip"] for r in rows)


def test_odd_rows(spark):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "null id"), (1, "x"), (1, "x")]
    df = frame(spark, rows).withColumnRenamed("source", "rank").withColumnRenamed("lang", "score")
    got = segment_documents(df, PATH, with_pieces=True).collect()
    empty = [r for r in got if r["doc_id"] in (0, 1) and r["n_pieces"] == 0]
    assert len(empty) == 2 and all(r["score"] == 0 and r["rank"] == 1 for r in empty)
    assert all(r["round_trip"] and len(r["ids"]) == r["n_pieces"] == len(r["pieces"]) for r in got)
    assert segment_query(frame(spark, [])).collect() == []
    assert np.isfinite([r["score"] for r in got]).all()


def test_path_order_is_that_of_id_tuples():
    rnd = random.Random(8)
    paths = [Path()]
    for _ in range(400):
        paths.append(Path(rnd.choice(paths[-40:]), len(paths)))
    for _ in range(3000):
        a, b = rnd.choice(paths), rnd.choice(paths)
        assert (a < b) == (a.ids()[::-1] < b.ids()[::-1])


def test_long_runs_take_memory_in_proportion():
    """100 000 letters without a cut, and as many equal signs, in a fresh process."""
    code = f"""
import random, resource, sys
from wayfare.llm.segment import Segmenter
seg = Segmenter(open({PATH!r}, "rb").read(), 4)
rnd = random.Random(1)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for text in ("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)), "=" * 100_000):
    found = seg.encode([text])[0]
    assert len(found) == 4 and all(seg.decode(ids) == text for _, ids in found)
    assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                          cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 500_000
