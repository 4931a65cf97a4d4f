import random

import numpy as np

from tests.llm.helpers import ODD_TEXTS, frame, jaccard_components, read
from wayfare.llm.minhash import WordHashes, near_duplicate_query, near_duplicates, similarity_sketch, shingle_set
import wayfare.llm.minhash as minhash


def check(spark, rows, width):
    df = frame(spark, rows).repartition(5)
    got = {r["doc_id"]: r for r in near_duplicates(df, width=width).collect()}
    sets, comp = jaccard_components(rows, width)
    assert {i: got[i]["n_shingles"] for i in got} == {i: len(s) for i, s in sets.items()}
    assert {i: got[i]["component_id"] for i in got} == comp
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_matches_brute_force_on_the_documents(spark):
    docs = read(spark, "documents", "sf0.01")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicate_query(docs).collect()}
    sets, comp = jaccard_components(rows, 4)
    assert got == {i: (len(sets[i]), comp[i]) for i in sets}


def edited(words, rnd, edits):
    out = list(words)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"w{rnd.randrange(10**6)}"
    return " ".join(out)


def test_large_groups_chains_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    monkeypatch.setattr(minhash, "SMALL_BAND", 4)
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(100)]
    texts = [" ".join(base)] * 40 + [edited(base, rnd, 3) for _ in range(80)]
    chain = list(base)  # neighbours are alike, the ends are not
    for k in range(30):
        chain[3 * k % 100] = f"c{k}"
        texts.append(" ".join(chain))
    texts += [edited(base, rnd, 12) for _ in range(60)]  # alike, mostly below the threshold
    rnd.shuffle(texts)
    check(spark, list(enumerate(texts)), 5)


def test_odd_rows(spark):
    check(spark, list(enumerate(ODD_TEXTS)), 4)
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (3, "A B C D E F"), (9, "one two")]
    df = frame(spark, rows).withColumnRenamed("source", "component_id").withColumnRenamed("lang", "digest")
    got = sorted(((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in near_duplicates(df, 4).collect()))
    assert got == [(-1, None, True), (3, 3, True), (7, 3, False), (7, 3, False), (9, 9, True)]
    assert near_duplicates(frame(spark, []), 4).collect() == []


def test_sketch_agreement_follows_similarity():
    words = WordHashes()
    for n in (3, 40, 2000):
        a = shingle_set(" ".join(f"a{k}" for k in range(n)), 1, words)
        b = shingle_set(" ".join(f"a{k}" for k in range(n // 3, n + n // 3)), 1, words)
        both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = (similarity_sketch(a) == similarity_sketch(b)).mean()
        assert abs(got - both) < 0.2
        assert (similarity_sketch(a) != np.uint64(2**64 - 1)).all()


def test_rows_sent_grow_with_the_group_not_its_square(spark, monkeypatch):
    """Near copies of one text and a few strays between 0.66 and 0.8 alike: the rows that
    clusters send for 2N copies are at most 2.2 times those for N."""
    rnd = random.Random(9)
    base = [f"w{k}" for k in range(60)]

    def rows_of(n):
        rows = [(-1, " ".join(base))]
        for k in range(n):
            words = list(base)
            words[rnd.randrange(60)] = f"c{k}"
            rows.append((k, " ".join(words)))
        for k in range(4):  # strays: about a sixth of the shingles differ
            rows.append((n + k, " ".join(base[:52] + [f"s{k}x{j}" for j in range(8)])))
        return rows
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 32)
    monkeypatch.setattr(minhash, "SMALL_BAND", 8)
    sent, inner = [], minhash._link_clusters
    monkeypatch.setattr(minhash, "_link_clusters", lambda members, percent: (sent.append(members.count()), inner(members, percent))[1])
    for n in (150, 300):
        rows = rows_of(n)
        got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, rows), 4).collect()}
        assert got == jaccard_components(rows, 4)[1]
    assert sent[0] > 0 and sent[1] <= 2.2 * sent[0]
