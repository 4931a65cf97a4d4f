"""Operator 9: near-duplicate embeddings by spherical k-means and blocked cosines.

Equal vectors of a label are one class with a count. Spherical k-means, fitted on a
bounded sample, assigns every class to the cell of its nearest centroid. Two unit vectors
with cosine t or more are at most d = sqrt(2 - 2t) apart, so of two such vectors in
different cells one lies within d/2 of the plane between their centroids: a vector visits
each cell whose plane it is that near, and no link across cells is lost. In a cell,
vectors of one label are compared by matrix products of blocks; large cells are spread
over tasks by pairs of blocks. A task returns no pairs but, for each vector, the number of
vectors it links to and the smallest member of its component in the block. Components of
those rows are the components of all links; one representative (the smallest vec_id) of
each is kept.

Defined results: null or empty vectors, vectors with null, NaN or infinite components, zero
vectors and rows with a null label or vec_id link with nothing (0 links, their own
component, kept). Vectors of different lengths never link. Rows that repeat a vec_id are
vectors of their own that count as linked. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.shared import Scratch, connected_components, map_slices, sorted_runs

THRESHOLD = 0.98
# k-means: vectors in the sample it is fitted on, wanted vectors a cell, most cells, rounds.
SAMPLE_VECTORS, CELL_VECTORS, MAX_CELLS, ROUNDS, SEED = 20_000, 1_000, 2_048, 8, 7
BLOCK_ROWS = 1_024


def unit_vector(vector) -> np.ndarray | None:
    """The vector in double precision at length 1, or None if it can link with nothing."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, dtype=np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v /= top  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum())


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, digest, unit) of each row; the last three null if it can't link."""
    def make():
        def run(part: dict) -> dict:
            units = [None if i is None or lab is None else unit_vector(v)
                     for i, lab, v in zip(part["vec_id"], part["label"], part["embedding"])]
            return {"vec_id": part["vec_id"], "label": part["label"],
                    "dim": [None if u is None else len(u) for u in units],
                    "digest": [None if u is None else xxhash.xxh3_128_digest(
                        (np.array(v, dtype=np.float64) + 0.0).tobytes())
                        for u, v in zip(units, part["embedding"])],
                    "unit": [None if u is None else u.tobytes() for u in units]}
        return run
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          "embedding")
    return map_slices(rows, make, "vec_id long, label string, dim int, digest binary, unit binary")


def spherical_kmeans(sample: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Unit centroids of the unit rows of ``sample``."""
    cells = min(cells, len(sample))
    centroids = sample[np.random.default_rng(seed).choice(len(sample), cells, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(sample[k:k + 4096] @ centroids.T).argmax(axis=1) for k in range(0, len(sample), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centroids)
    return centroids


def fit_cells(classes: DataFrame, dim: int, count: int) -> np.ndarray:
    """Centroids from a hash sample of about SAMPLE_VECTORS of the ``count`` classes."""
    part = F.pmod(F.xxhash64("digest"), F.lit(1 << 40)) < int(min(1.0, SAMPLE_VECTORS / count) * (1 << 40))
    sample = classes.filter((F.col("dim") == dim) & part).select("digest", "unit").orderBy("digest").limit(
        2 * SAMPLE_VECTORS).collect()
    if not sample:
        return np.zeros((0, dim))
    rows = np.stack([np.frombuffer(r["unit"]) for r in sample])
    return spherical_kmeans(rows, min(MAX_CELLS, -(-count // CELL_VECTORS)))


def _plane_distances(units: np.ndarray, centroids: np.ndarray, home: np.ndarray) -> np.ndarray:
    """Distance of each unit vector to the plane between its home centroid and each other."""
    score = units @ centroids.T
    gaps = centroids @ centroids.T
    apart = np.sqrt(np.maximum(2 - 2 * gaps, 0))[home]
    lead = score[np.arange(len(units)), home][:, None] - score
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(apart > 1e-12, lead / apart, 0.0)


def assign_cells(classes: DataFrame, centroids: np.ndarray, dim: int, reach: float) -> DataFrame:
    """A row for each class and cell it lives in or visits (cell -1: another length)."""
    columns = ["label", "dim", "node", "n", "unit"]

    def make():
        def run(part: dict) -> dict:
            out = {c: [] for c in columns} | {"home": [], "cell": []}
            fits = [k for k, d in enumerate(part["dim"]) if d == dim and len(centroids)]
            cells = {k: (-1, [-1]) for k in range(len(part["dim"]))}
            if fits:
                units = np.stack([np.frombuffer(part["unit"][k]) for k in fits])
                home = (units @ centroids.T).argmax(axis=1)
                near = _plane_distances(units, centroids, home) <= reach
                near[np.arange(len(fits)), home] = True
                cells |= {k: (int(home[x]), np.flatnonzero(near[x]).tolist()) for x, k in enumerate(fits)}
            for k, (own, all_cells) in cells.items():
                for cell in all_cells:
                    for c in columns:
                        out[c].append(part[c][k])
                    out["home"].append(own), out["cell"].append(cell)
            return out
        return run
    return map_slices(classes.select(*columns), make,
                      "label string, dim int, node long, n long, unit binary, home int, cell int")


def _components(linked: np.ndarray) -> np.ndarray:
    """The smallest row number each row reaches in a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked)))
        low = low[low]
        if np.array_equal(low, label):
            return label
        label = low


def compare_blocks(members: DataFrame, centroids: np.ndarray, threshold: float, reach: float) -> DataFrame:
    """(node, links, root) of each member of a block that links with another class."""
    def one(part: pd.DataFrame):
        part = part.sort_values("node", kind="stable")
        i, j, cell = (int(part[c].iloc[0]) for c in ("i", "j", "cell"))
        units = np.stack([np.frombuffer(u) for u in part["unit"]])
        home, block, n, node = (part[c].to_numpy() for c in ("home", "block", "n", "node"))
        linked = units @ units.T >= threshold
        np.fill_diagonal(linked, False)
        if i != j:
            linked &= block[:, None] != block[None, :]
        here = home == cell
        linked &= here[:, None] | here[None, :]
        if cell >= 0 and not here.all():
            # A resident that also visits the visitor's home meets it there too: the
            # smaller cell counts the pair.
            visits = _plane_distances(units, centroids, np.where(home < 0, 0, home)) <= reach
            twice = visits[:, home] & here[:, None] & ~here[None, :] & (home < cell)[None, :]
            linked &= ~(twice | twice.T)
        links = linked @ n
        some = np.flatnonzero(links)
        if len(some):
            root = _components(linked)
            return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]),
                                               pa.array(node[root[some]])], names=["node", "links", "root"])

    def run(batches):
        for run_of in sorted_runs(batches, ["key", "i", "j"]):
            for _, part in run_of.groupby(["label", "dim"], sort=False):
                got = one(part) if len(part) > 1 else None
                if got is not None:
                    yield got
    return members.mapInArrow(run, "node long, links long, root long")


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label)."""
    scratch = Scratch(vectors.sparkSession, "embeddings")
    rows = scratch.write(prepared(vectors), "vectors")
    valid = rows.filter("digest IS NOT NULL")
    classes = scratch.write(
        valid.groupBy("label", "digest").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n")), "classes")
    reps = scratch.write(valid.withColumnRenamed("vec_id", "node").join(classes, ["label", "digest", "node"])
                         .dropDuplicates(["label", "digest"]), "representatives")
    dims = reps.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim, count = (dims[0]["dim"], dims[0]["count"]) if dims else (1, 0)
    centroids = fit_cells(reps, dim, count) if count else np.zeros((0, 1))
    reach = float(np.sqrt(2 - 2 * threshold)) / 2 + 1e-9

    placed = scratch.write(assign_cells(reps, centroids, dim, reach)
                           .withColumn("key", F.xxhash64("label", "dim", "cell")), "cells")
    sizes = scratch.write(placed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
                          .select("key", F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("blocks")), "sizes")
    blocks = (placed.join(sizes, "key")
              .withColumn("block", F.pmod(F.xxhash64("node", "home"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "block", "label", "dim", "cell", "home", "node", "n", "unit")
              .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    found = scratch.write(compare_blocks(blocks, centroids, threshold, reach), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(scratch, found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    of_class = scratch.write(
        classes.join(links, "node", "left").join(components, "node", "left")
        .select("label", "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("component_id")), "result")
    scratch.keep_only(rows, of_class)
    return (rows.select("vec_id", "label", "digest").join(of_class, ["label", "digest"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def embedding_query(embeddings: DataFrame) -> DataFrame:
    """Query ``op9_embedding_dedup``."""
    return near_duplicate_vectors(embeddings)
