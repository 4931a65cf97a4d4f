import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tests.llm.helpers import read, sql_rows
from wayfare.llm.oracles import trie_sql
from wayfare.llm.prefix_trie import common_turns, trie_nodes, trie_query
from wayfare.llm.shared import Scratch

CONVS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_nodes(paths):
    """paths: {conv_id: [(turn key, characters), ...]} -> rows by definition."""
    members, chars = defaultdict(list), {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            node = tuple(k for k, _ in path[:d])
            members[node].append(c)
            chars[node] = path[d - 1][1] if d else 0
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * chars[node] + sum(saved[k] for k in children[node])
    rows = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(paths[c]) == len(node))
        rows.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]),
                     leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def rebuild(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [((r, t), len(t)) for _, _, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, x in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = turns.get(first, [])[:h] + x[h:]
    return out


def check(spark, rows):
    got = trie_query(spark.createDataFrame(rows, CONVS))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute_nodes(rebuild(rows))


def test_table(spark):
    rows = [tuple(r) for r in read(spark, "conversations", "sf0.01").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "nobody's"), (7, None, None, None), (7, 0, "user", ""), (7, 0, "user", ""), (205, 3, "", "é" * 3),
            (-3, 1, "user", "below zero"), (-100, 0, "user", "first"), (300, 0, "a", "bc"), (301, 0, "ab", "c"),
            (302, 0, "x", "long " * 20_000), (302, 1, "x", "🙂")]
    rows += [(c, k, "user", f"t{k}") for c in range(400, 430) for k in range(c % 8)]
    rows += [(500, k, "user", "same") for k in range(300)] + [(501, k, "user", "same") for k in range(301)]
    check(spark, rows)
    check(spark, [(12, 0, "user", "alone")])
    empty = spark.createDataFrame([], CONVS)
    assert trie_query(empty).collect() == []
    extra = spark.createDataFrame(rows, CONVS).selectExpr("*", "1 AS depth", "2 AS path", "3 AS _first", "4 AS digests")
    assert trie_query(extra).columns == COLUMNS and trie_query(extra).count() == trie_query(extra.select("conv_id", "turn", "role", "text")).count()


@pytest.mark.parametrize("seed", range(3))
def test_forests_merge_across_partitions(spark, seed):
    """Small random tries over many partitions and several rounds of merging; one path in
    three is a copy of the same."""
    rnd = random.Random(seed)
    paths = {}
    for c in rnd.sample(range(-50, 1000), 150):
        turns = [] if rnd.random() < 0.05 else [rnd.choice("ab") for _ in range(rnd.randint(0, 7))]
        if rnd.random() < 0.33:
            turns = list("abba")
        paths[c] = [(t, 3 * k + ord(t) % 5) for k, t in enumerate(turns)]
    digest = {t: hashlib.sha256(t.encode()).digest()[:16] for t in "ab"}
    rows = [(c, bytearray(b"".join(digest[t] for t, _ in p)), [n for _, n in p]) for c, p in paths.items()]
    df = spark.createDataFrame(rows, "conv_id long, path binary, chars array<long>")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = trie_nodes(df, Scratch(spark, "trie_test"), fan_in=3, piece_ids=4).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got), key=str) == brute_nodes(paths)


def test_common_turns():
    a, b, c = (bytes([k]) * 16 for k in (1, 2, 3))
    assert common_turns(a + b + c, a + b) == 2 and common_turns(a + b, a + c) == 1
    assert common_turns(b"", a) == 0 and common_turns(b, a) == 0 and common_turns(a + a, a + a) == 2


def test_sql_on_odd_rows():
    rows = [(None, 0, "user", "nobody's"), (7, None, None, None), (7, 0, "user", ""), (-3, 1, "user", "below zero"),
            (-100, 0, "user", "first"), (300, 0, "a", "bc"), (301, 0, "ab", "c"), (302, 1, "x", "🙂")]
    rows += [(c, k, "user", f"t{k}") for c in range(400, 430) for k in range(c % 8)]
    columns, found = sql_rows(trie_sql(), rows)
    assert columns == COLUMNS and sorted(found, key=str) == brute_nodes(rebuild(rows))
