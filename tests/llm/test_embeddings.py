import math

import numpy as np
import pytest

import wayfare.llm.embeddings as embeddings
from tests.llm.helpers import components, read
from wayfare.llm.embeddings import embedding_query, near_duplicate_vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_force(rows, threshold=0.98):
    units, links, edges = {}, {i: 0 for i, _, _ in rows}, []
    for i, v, label in rows:
        if v and label is not None and all(x is not None and math.isfinite(x) for x in v):
            a = np.array(v, dtype=np.float64)
            if np.abs(a).max() > 0:
                units[i] = (a / np.sqrt((a * a).sum()), label)
    for i, (a, la) in units.items():
        for j, (b, lb) in units.items():
            if i < j and la == lb and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    comp = components(links, edges)
    return {i: (links[i], comp[i], comp[i] == i) for i in links}


def check(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(df).collect()}
    assert got == brute_force(rows)


def test_matches_brute_force_on_the_embeddings(spark):
    table = read(spark, "embeddings", "sf0.01")
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in table.collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_query(table).collect()}
    assert got == brute_force(rows)


@pytest.mark.parametrize("cell_vectors, block_rows", [(20, 16), (1000, 1024)])
def test_many_cells_blocks_and_a_hot_group(spark, monkeypatch, cell_vectors, block_rows):
    monkeypatch.setattr(embeddings, "CELL_VECTORS", cell_vectors)
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block_rows)
    rng, rows = np.random.default_rng(3), []
    base = rng.normal(size=8)
    for k in range(600):
        kind = k % 3
        if kind == 0:  # a third of all rows near one vector, some equal
            v = base + (0 if k % 2 else 1) * rng.normal(size=8) * 0.25
        elif kind == 1:
            v = rng.normal(size=8)
        else:  # a chain on a circle
            v = np.array([math.cos(k / 40), math.sin(k / 40), 0.1, 0, 0, 0, 0, 0])
        rows.append((k, [float(np.float32(x)) for x in v], int(k % 5 == 0)))
    check(spark, rows)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
            (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [float("inf"), 1.0], 1), (10, [1.0, 0.0, 0.0], 1),
            (11, [1.0, 0.0], 2), (12, [1e-38, 0.0], 1), (13, [3e38, 1e37], 1), (14, [-0.0, 1.0], 1), (15, [0.0, 1.0], 1)]
    check(spark, rows)
    twice = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    got = sorted(((r["vec_id"], r["n_links"], r["kept"]) for r in near_duplicate_vectors(
        spark.createDataFrame(twice, VECTORS)).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (None, 0, True)]
    assert embedding_query(spark.createDataFrame([], VECTORS)).collect() == []


def test_extra_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, [1.0, 0.5], 1), (2, [1.0, 0.5], 1)], VECTORS).selectExpr(
        "*", "'x' as node", "'y' as digest", "7 as n")
    assert [tuple(r) for r in near_duplicate_vectors(df).orderBy("vec_id").collect()] == [
        (1, 1, 1, True), (2, 1, 1, False)]
