"""Brute-force counterparts of the operators, and odd rows that each must take."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def read(spark, name, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


def frame(spark, rows):
    """documents rows from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


ODD_TEXTS = [None, "", "   \n\t ", "a", "ünïcödé 中文 🙂 text", "x" * 50_000, "word " * 20_000, "same text here twice",
             "same text here twice"]


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k:k + width]) for k in range(len(words) - width + 1))


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    both = {}
    for ids in holders.values():
        for x, a in enumerate(ids):
            for b in ids[x + 1:]:
                both[a, b] = both.get((a, b), 0) + 1
    edges = [(a, b) for (a, b), n in both.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    return sets, components(sets, edges)


def sql_rows(sql, rows):
    """(columns, rows) of DuckDB SQL over ``conversations`` rows (conv_id, turn, role, text)."""
    import duckdb
    import pandas as pd
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64", "role": "string", "text": "string"})
    con = duckdb.connect()
    con.register("conversations", conversations)
    found = con.sql(sql)
    return [d[0] for d in found.description], found.fetchall()
