"""Operator 8: near-duplicate documents by fast similarity sketching.

A document's set holds the hashes of its distinct word shingles. The sketch has BINS
places. Round after round, every element falls into one hashed place with a hashed value
and a place keeps its first and smallest value; the rounds after the BINS-th serve one
place each, so every place is filled after at most 2 * BINS rounds, and long documents
finish in the first. Places agree with probability equal to the Jaccard similarity and
concentrate like independent samples. ROWS places make a band, and documents that share
a band are candidates: at similarity 0.8 a pair shares none of the 40 bands with odds of
1.3e-7. Every link is confirmed on the full sets.

How the work stays linear where groups are large:

- Equal sets are one class, represented by its smallest doc_id.
- Each class first proposes one link, to the smallest document it shares any band with.
  A large group of near copies so costs one check a member, and becomes one component.
- Only bands that still hold several components go on. Members of a band of at most
  SMALL_BAND are paired by sketch, and the pairs are confirmed on the full sets.
- Larger bands that overlap form clusters. Their members are compared with their sets at
  hand, in blocks spread over tasks by pairs of blocks; blocks of a cluster's largest
  component meet only those of its other members. A pair of one component, of too different sizes, or whose sketches agree too little (5 standard
  deviations below the threshold) is skipped. A task returns only links that join
  components, never more than its rows.

Defined results: null and wordless texts have an empty set, n_shingles 0 and no links.
A null doc_id links with nothing: its component_id is null and it is kept. Rows that
repeat a doc_id are rows of one document; each is returned. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.shared import Scratch, connected_components, map_slices, sorted_runs

BINS, ROWS = 200, 5
THRESHOLD_PERCENT = 80
SKETCH_CUTOFF = 0.66
SMALL_BAND = 32
BLOCK_ROWS, BLOCK_ITEMS = 1_024, 2_000_000
CHUNK_PAIRS = 64
WORD_CACHE = 200_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value
        return value


def shingle_set(text: str | None, width: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words (fewer words: the whole
    sequence is one shingle). Only A-Z are lower-cased; words end at ASCII white space."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(words.__getitem__, parts), dtype=np.uint64, count=len(parts))
    size = min(width, len(parts))
    out = np.full(len(parts) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        part = hashes[k:len(parts) - size + 1 + k]
        out = (out + mix(part + np.uint64(k))) * _ODD[k % 8] + np.uint64(k)
    return np.unique(mix(out))


def similarity_sketch(items: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes.

    A value is (round << 32 | hash bits), so rounds computed beyond the one that fills
    the last place never change a filled place."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    sketch = np.full(bins, empty, dtype=np.uint64)
    first, step = 0, max(1, int(1.5 * bins * np.log(bins) / len(items)))
    while first < bins:
        rounds = np.arange(first, min(bins, first + step), dtype=np.uint64)
        h = mix(items[None, :] ^ mix(rounds + np.uint64(1))[:, None])
        place = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        value = (rounds << np.uint64(32))[:, None] | (h & np.uint64(0xFFFFFFFF))
        np.minimum.at(sketch, place.ravel().astype(np.int64), value.ravel())
        if not (sketch == empty).any():
            return sketch
        first += len(rounds)
    for place in np.flatnonzero(sketch == empty):
        r = np.uint64(bins + int(place))
        h = mix(items ^ mix(np.array([r + np.uint64(1)], dtype=np.uint64)))
        sketch[place] = (r << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)).min()
    return sketch


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    parts = sketch[:len(sketch) // rows * rows].reshape(-1, rows)
    key = np.arange(len(parts), dtype=np.uint64)
    for k in range(rows):
        key = mix(key * _ODD[k % 8] + parts[:, k])
    return key.view(np.int64)


def document_sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, digest, keys, sketch) for each row, in one pass over the text."""
    def make():
        words = WordHashes()

        def run(part: dict) -> dict:
            out = {"doc_id": part["doc_id"], "n_shingles": [], "digest": [], "keys": [], "sketch": []}
            for text in part["text"]:
                items = shingle_set(text, width, words)
                out["n_shingles"].append(len(items))
                if not len(items):
                    out["digest"].append(None), out["keys"].append(None), out["sketch"].append(None)
                    continue
                sketch = similarity_sketch(items)
                out["digest"].append(xxhash.xxh3_128_digest(items.tobytes()))
                out["keys"].append(band_keys(sketch))
                out["sketch"].append(mix(sketch).astype(np.uint8).tobytes())
            return out
        return run
    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make,
                      "doc_id long, n_shingles long, digest binary, keys array<long>, sketch binary")


def _full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, items): the sorted 64-bit hashes of each document's set."""
    def make():
        words = WordHashes()
        return lambda part: {"node": part["doc_id"],
                             "items": [np.sort(shingle_set(t, width, words).view(np.int64)) for t in part["text"]]}
    return map_slices(docs, make, "node long, items array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("u"), F.col("items").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("items").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return (pairs.join(left, "u").join(right, "v")
            .withColumn("both", both)
            .filter(100 * F.col("both") >= percent * (F.size("a") + F.size("b") - F.col("both")))
            .select("u", "v"))


def _matrix(sketches) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(-1, BINS)


def _alike(a: int, others: np.ndarray, n: np.ndarray, label: np.ndarray, sketch: np.ndarray, percent: int):
    """Those of ``others`` that may link row ``a`` to another component, with agreement."""
    b = others[(label[others] != label[a])
               & (100 * np.minimum(n[others], n[a]) >= percent * np.maximum(n[others], n[a]))]
    agree = (sketch[b] == sketch[a]).mean(axis=1)
    return b[agree >= SKETCH_CUTOFF], agree[agree >= SKETCH_CUTOFF]


def _pair_small_bands(members: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (u, v) of different components from bands of few members."""
    def run(batches):
        for part in sorted_runs(batches, ["key"]):
            node, n, label = (part[c].to_numpy() for c in ("node", "n", "label"))
            sketch, us, vs = _matrix(part["sketch"]), [], []
            for a in range(len(part) - 1):
                b, _ = _alike(a, np.arange(a + 1, len(part)), n, label, sketch, percent)
                us.append(np.maximum(node[b], node[a])), vs.append(np.minimum(node[b], node[a]))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))],
                                                 names=["u", "v"])
    ordered = members.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "u long, v long").filter("u != v").distinct()


def _link_clusters(members: DataFrame, percent: int) -> DataFrame:
    """Links (u, v), confirmed on the full sets, that join components of a cluster."""
    def run(batches):
        for part in sorted_runs(batches, ["cluster", "i", "j"]):
            i, j = int(part["i"].iloc[0]), int(part["j"].iloc[0])
            block, node, items = part["block"].to_numpy(), part["node"].to_numpy(), list(part["items"])
            label, sketch = part["label"].to_numpy().copy(), _matrix(part["sketch"])
            n = np.array([len(x) for x in items])
            left = np.flatnonzero(block == i)
            right = left if i == j else np.flatnonzero(block == j)
            us, vs = [], []
            for a in left:
                b, agree = _alike(a, right, n, label, sketch, percent)
                b = b[np.argsort(-agree, kind="stable")]
                while len(b):
                    now, b = b[:CHUNK_PAIRS], b[CHUNK_PAIRS:]
                    flat = np.concatenate([items[k] for k in now])
                    at = np.searchsorted(items[a], flat)
                    same = items[a][np.minimum(at, n[a] - 1)] == flat
                    both = np.add.reduceat(same, np.cumsum(n[now]) - n[now], dtype=np.int64)
                    for k in now[100 * both >= percent * (n[now] + n[a] - both)]:
                        if label[k] != label[a]:
                            us.append(node[a]), vs.append(node[k])
                            label[label == label[k]] = label[a]
                    b = b[label[b] != label[a]]
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
    ordered = members.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return ordered.mapInArrow(run, "u long, v long")


def _cluster_blocks(clusters: DataFrame, labels: DataFrame, reps: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Each cluster's members, once for each pair of blocks (i, j) that they have to meet in.

    Members of one component need not meet, so those of a cluster's largest one are spread
    over blocks of their own that meet only the blocks of the rest: with few others a member
    is sent once, however many there are. Blocks hold about BLOCK_ROWS members and
    BLOCK_ITEMS shingles."""
    placed = scratch.write(
        clusters.join(labels.withColumnRenamed("component", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
        .join(reps.select("node", "n"), "node"), "placed")
    parts = placed.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("items"))
    whole = parts.groupBy("cluster").agg(F.max(F.struct("rows", "label", "items")).alias("big"), F.sum("rows").alias("rows"),
                                         F.sum("items").alias("items"))

    def blocks_of(rows, items):
        return F.ceil(F.greatest(rows / BLOCK_ROWS, items / BLOCK_ITEMS)).cast("int")
    sizes = scratch.write(whole.filter("rows > big.rows").select(
        "cluster", F.col("big.label").alias("big"), blocks_of(F.col("big.rows"), F.col("big.items")).alias("big_blocks"),
        blocks_of(F.col("rows") - F.col("big.rows"), F.col("items") - F.col("big.items")).alias("rest_blocks")), "sizes")
    is_big = F.col("label") == F.col("big")
    spread = F.xxhash64("node")
    block = F.when(is_big, F.col("rest_blocks") + F.pmod(spread, F.col("big_blocks"))).otherwise(F.pmod(spread, F.col("rest_blocks")))
    meets = F.when(is_big, F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("big_blocks"))
    return (placed.join(sizes, "cluster").withColumn("block", block.cast("int"))
            .join(reps.select("node", "sketch"), "node").join(sets, "node")
            .withColumn("other", F.explode(F.sequence(F.lit(0), meets - 1)))
            .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "node", "label", "sketch", "items"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = scratch.write(document_sketches(docs, width), "sketches")
    linked = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = scratch.write(linked.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    reps = scratch.write(linked.join(classes.withColumnRenamed("node", "doc_id"), ["digest", "doc_id"])
                         .select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "keys", "sketch"),
                         "representatives")
    exploded = reps.select("node", "n", F.explode("keys").alias("key"))
    buckets = scratch.write(exploded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                            .filter("low != high").select("key", "low"), "bands")
    members = scratch.write(exploded.join(buckets, "key"), "members")
    involved = members.select(F.col("node").alias("doc_id")).distinct()
    sets = scratch.write(_full_sets(docs.join(involved, "doc_id"), width), "sets")

    # First links: each class and the smallest document it shares a band with.
    first = members.filter("node != low").groupBy("node").agg(F.min("low").alias("v")).withColumnRenamed("node", "u")
    links = scratch.write(_confirm(first, sets, percent), "links")
    labels = connected_components(scratch, links)

    # Bands that still hold several components.
    labelled = scratch.write(
        members.select("key", "node", "n").join(labels.withColumnRenamed("component", "label"), "node", "left")
        .withColumn("label", F.coalesce("label", "node")), "labelled")
    mixed = scratch.write(labelled.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"),
                                                      F.min("node").alias("low"), F.count(F.lit(1)).alias("size"))
                          .filter("a != b").select("key", "low", "size"), "mixed")
    few = labelled.join(mixed.filter(F.col("size") <= SMALL_BAND).select("key"), "key")
    pairs = _pair_small_bands(few.join(reps.select("node", "sketch"), "node"), percent)
    found = scratch.write(_confirm(scratch.write(pairs, "candidates"), sets, percent), "more-links")

    many = labelled.join(mixed.filter(F.col("size") > SMALL_BAND).select("key", "low"), "key")
    clusters = scratch.write(connected_components(
        scratch, many.select(F.col("node").alias("u"), F.col("low").alias("v"))).withColumnRenamed(
            "component", "cluster"), "clusters")
    blocks = _cluster_blocks(clusters, labels, reps, sets, scratch)
    joining = scratch.write(_link_clusters(blocks, percent), "joining-links")
    components = connected_components(scratch, links.unionByName(found).unionByName(joining))

    of_class = scratch.write(classes.join(components, "node", "left")
                             .select("digest", F.coalesce("component", "node").alias("component_id")), "components")
    scratch.keep_only(rows, of_class)
    return (rows.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def near_duplicate_query(documents: DataFrame) -> DataFrame:
    """Query ``op8_minhash``: 4-word shingles at 0.8 over all documents."""
    return near_duplicates(documents, width=4, percent=THRESHOLD_PERCENT)
