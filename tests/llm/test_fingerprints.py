import hashlib
import math
import struct

import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import ODD_TEXTS, frame, read
from wayfare.llm.fingerprints import SAMPLES, fingerprint_query, fingerprints

DIGITS = set("0123456789ABCDEF")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def edits(rows):
    """(doc_id, n_chars, sha256 of the edited text, edited text, next text) in order."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        following, q = rows[(k + 1) % len(rows)][1], len(t) // 4
        new = t[:len(t) - q] + following[:q]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), new, following))
    return out


def check(df):
    got = sorted(fingerprint_query(df).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["edited_sha256"]))
    want = sorted(edits(rows_of(df)), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    assert [tuple(r)[:3] for r in got] == [w[:3] for w in want]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert all(len(r["fingerprint"]) == 8 * SAMPLES == len(r["edited_fingerprint"]) for r in got)
    return got


def weights(text):
    out = {}
    for w in text.lower().split():
        out[w] = out.get(w, 0) + 1
    return out or {"": 1}


def jaccard(a, b):
    a, b = weights(a), weights(b)
    keys = a.keys() | b.keys()
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


def test_estimates_follow_generalised_jaccard(spark):
    docs = read(spark, "documents", "sf0.01")
    got = {r["doc_id"]: r for r in check(docs)}
    texts = dict(rows_of(docs))
    wrong = []
    for i, _, _, new, following in edits(list(texts.items())):
        wrong.append(got[i]["near_edited"] - jaccard(texts[i], new))
        wrong.append(got[i]["near_next"] - jaccard(texts[i], following))
    assert abs(sum(wrong) / len(wrong)) < 0.01  # no bias
    assert math.sqrt(sum(w * w for w in wrong) / len(wrong)) < 0.11
    same = {}
    for i, t in texts.items():
        same.setdefault(t, set()).add(got[i]["fingerprint"])
    assert all(len(f) == 1 for f in same.values())


def test_odd_rows_and_ranges(spark):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "no id"), (5, "repeated id"), (-(2**60), "first 🙂🙂🙂🙂"), (2**60, "last")]
    got = check(frame(spark, rows).withColumnRenamed("source", "_range").withColumnRenamed("lang", "term"))
    assert len(got) == len(rows)
    assert fingerprint_query(frame(spark, [])).collect() == []
    alone = fingerprint_query(frame(spark, [(1, "some words here")])).collect()
    assert alone[0]["near_next"] == 1.0
    check(frame(spark, [(7, "a b c d"), (7, "a b c d"), (7, None)]))


def brute_parts(terms):
    """The definition, sample by sample, with the xxhash library."""
    def hashed(data, seed=42):
        return xxhash.xxh64_intdigest(data, seed)

    def bits(h, shift, n):
        return (((h >> shift) & ((1 << n) - 1)) + 0.5) / (1 << n)
    out = []
    for k in range(SAMPLES):
        low = None
        for word, weight in terms.items():
            term = hashed(word.encode()).to_bytes(8, "little")
            a, b = (hashed((2 * k + x).to_bytes(4, "little"), hashed(term)) for x in (0, 1))
            r, beta = -math.log(bits(a, 0, 21) * bits(a, 21, 21)), bits(a, 42, 21)
            t = math.floor(math.log(weight) / r + beta)
            value = math.log(-math.log(bits(b, 0, 32) * bits(b, 32, 32))) - r * (t - beta + 1)
            low = value if low is None else min(low, value)
        out.append(low)
    return out


def test_values_match_the_definition(spark):
    from wayfare.llm.fingerprints import sample_values
    terms = {"the": 7, "of": 3, "word": 1, "ünï": 2}
    df = spark.createDataFrame([(w, float(n)) for w, n in terms.items()], "word string, n double").select(
        F.lit(1).alias("k"), F.xxhash64("word").alias("term"), F.log("n").alias("log_weight"))
    lows = sample_values(df, [F.lit(k) for k in range(SAMPLES)], ["k"]).groupBy("k").agg(
        *[F.min(f"v{k}") for k in range(SAMPLES)]).first()[1:]
    assert all(abs(a - b) < 1e-9 for a, b in zip(lows, brute_parts(terms)))
    parts = fingerprints(df, ["k"]).first()["parts"]
    whole = [xxhash.xxh64_intdigest(struct.pack("<d", v), 42) for v in lows]
    assert parts == [f"{h & 0xFFFFFFFF:08X}" for h in whole]
    assert len(parts) == SAMPLES and all(len(p) == 8 and set(p) <= DIGITS for p in parts)
