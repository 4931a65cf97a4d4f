import pytest
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD_TEXTS, frame, read
from wayfare.llm.substring import (MAX_BYTES, RUN_BYTES, chunk_digests, chunk_ends, cut_repeats, repeated_runs,
                                   substring_query)


def brute_force(rows, run_bytes=RUN_BYTES):
    """Cut texts by the same chunks, with plain dictionaries."""
    chunks = [(i, t, chunk_ends(t.encode()) if t else []) for i, t in rows]
    holders = {}
    for i, t, ends in chunks:
        if i is not None and t:
            for d in chunk_digests(t.encode(), ends):
                holders.setdefault(d, set()).add(i)
    out = []
    for i, t, ends in chunks:
        if i is None or not t:
            out.append((i, t))
            continue
        data, at, kept = t.encode(), 0, b""
        digests = chunk_digests(data, ends)
        for s, e, _ in repeated_runs(ends, digests, {d for d in digests if min(holders[d]) != i}, run_bytes):
            kept, at = kept + data[at:s], e
        out.append((i, (kept + data[at:]).decode()))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")


def check(spark, rows):
    got = [(r["doc_id"], r["text"]) for r in cut_repeats(frame(spark, rows).repartition(3)).collect()]
    assert sorted(got, key=key) == sorted(brute_force(rows), key=key)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=3000))
def test_chunks_cover_the_text_on_character_boundaries(text):
    data = text.encode("utf-8", "surrogatepass") if text.isprintable() else text.encode("utf-8", "replace")
    ends = chunk_ends(data)
    assert ends == sorted(set(ends)) and (ends[-1] == len(data) if data else ends == [])
    at = 0
    for end in ends:
        assert 0 < end - at <= MAX_BYTES + 16
        data[at:end].decode("utf-8", "surrogatepass")
        at = end


def test_insertion_shifts_only_the_chunks_around_it():
    rnd = random.Random(1)
    text = " ".join(f"w{rnd.randrange(10**5)}" for _ in range(2000)).encode()
    other = text[:3000] + b"inserted words here " + text[3000:]
    a, b = (set(chunk_digests(t, chunk_ends(t))) for t in (text, other))
    assert len(a - b) <= 6 and len(b - a) <= 6


def test_unspaced_passages_are_found_at_any_offset():
    rnd = random.Random(3)
    scripts = [(range(0x4E00, 0x9FA5), 300, 0.95), (range(0x4E00, 0x9FA5), 100, 0.75), (range(0x0E01, 0x0E2F), 300, 0.95),
               (range(0x41, 0x5B), 600, 0.95)]
    for letters, size, least in scripts:
        found = 0
        for _ in range(60):
            draw = lambda n: "".join(chr(rnd.choice(letters)) for _ in range(n))
            passage = draw(size)
            a, b = ((draw(rnd.randint(0, 900)) + passage + draw(200)).encode() for _ in range(2))
            ends = chunk_ends(b)
            found += bool(repeated_runs(ends, chunk_digests(b, ends), set(chunk_digests(a, chunk_ends(a)))))
        assert found >= least * 60, (letters, size, found)


def test_shared_passages_are_cut_once_and_clean_documents_stay(spark):
    rnd = random.Random(2)
    prose = lambda n: " ".join(f"word{rnd.randrange(10**5)}" for _ in range(n))
    passage = prose(60)
    rows = [(i, f"{prose(80)} {passage} {prose(80)}") for i in range(30)] + [(100 + i, prose(200)) for i in range(30)]
    got = {r["doc_id"]: r for r in cut_repeats(frame(spark, rows)).collect()}
    assert got[0]["cut_chars"] == 0 and all(got[i]["cut_chars"] > 200 for i in range(1, 30))
    assert all(got[100 + i]["text"] == rows[30 + i][1] for i in range(30))
    for i in range(1, 30):
        text = rows[i][1]
        spans = [tuple(map(int, s.split(":"))) for s in got[i]["cut_spans"].split(",")]
        assert "".join(text[e:s] for (_, e), (s, _) in zip([(0, 0)] + spans, spans + [(len(text), 0)])) == got[i]["text"]


def test_matches_brute_force(spark):
    docs = read(spark, "documents")
    check(spark, [(r["doc_id"], r["text"]) for r in docs.collect()])
    check(spark, list(enumerate(ODD_TEXTS)) + [(None, "x" * 50_000), (1, "y " * 300), (1, "y " * 300), (50, "y " * 300)])
    assert substring_query(frame(spark, [])).collect() == []


def test_extra_columns_are_carried(spark):
    df = frame(spark, [(1, "a b"), (2, None)]).withColumnRenamed("source", "digest").withColumnRenamed("lang", "first")
    rows = cut_repeats(df).orderBy("doc_id").collect()
    assert rows[0]["digest"] == "s" and rows[0]["first"] == "en" and rows[1]["text"] is None


def test_clashing_columns_are_an_error(spark):
    for name in ("n_chunks", "cut_spans", "_doc", "_repeated"):
        with pytest.raises(ValueError, match="clash"):
            cut_repeats(frame(spark, [(1, "a")]).withColumnRenamed("lang", name))
