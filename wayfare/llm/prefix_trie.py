"""The trie of conversation prefixes, with figures for every node (``op13_prefix_trie``).

A conversation is a path of turn digests. Paths are sorted over range partitions, and each
partition builds its forest alone: neighbours share a prefix of known depth, and union-find
takes these edges in descending depth, so that every merge of components makes, or widens, a
branching node at that depth. Nodes between branchings have the members of the next deeper
one and are written out as their component is raised.

What a partition cannot know is the tries' spine along its first and last path. A component
there is left unmerged, and all that it holds is contracted into one row. The contracted
rows of neighbouring partitions, at most two for each depth, are merged by the same forest,
some partitions at a time, until one is left. A node whose parent was still open names it by
the digest of its prefix and finds it by a join at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.shared import Scratch
from wayfare.operators.joins import broadcast_if_small

DIGEST = 16           # bytes of a turn's digest
HEAD_CHARS = 64       # of a text, to order rows of one turn and role
PIECE_IDS = 50_000    # decimal ids in one written piece of a node's ends
FAN_IN = 32           # partitions whose contracted forests are merged at a time
NO_ENDS = hashlib.sha256(b"").hexdigest()

# Rows that a partition returns: finished nodes (kind 0), contracted components (1), and
# pieces of end lists that may go on in the next partition (2).
NODE, OPEN, PIECE = 0, 1, 2
_SCHEMA = pa.schema([
    ("kind", pa.int32()), ("part", pa.int64()), ("idx", pa.int64()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("ends_open", pa.bool_()), ("own_key", pa.string()), ("parent_key", pa.string()),
    ("edge", pa.int64()), ("path", pa.binary()), ("chars", pa.list_(pa.int64())), ("named", pa.bool_()),
    ("ids", pa.string())])
_DDL = ("kind int, part long, idx long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, ends_open boolean, own_key string, parent_key string, "
        "edge long, path binary, chars array<long>, named boolean, ids string")


def prefix_key(path: bytes, depth: int) -> str:
    return hashlib.sha256(path[:depth * DIGEST]).hexdigest()


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share from their start."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle * DIGEST] == b[:middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


class Component:
    """Neighbouring paths with a common prefix of ``depth`` turns, seen as that node: its
    children (``n_children``) and the sum of what they save (``below``) are those known so
    far. ``edge`` is the depth shared with the component before it."""

    __slots__ = ("edge", "path", "chars", "depth", "owner", "n", "n_children", "n_leaves", "below", "ends", "ends_open",
                 "named", "waiting", "stop")

    def __init__(self, edge, path, chars, depth, owner, n, n_children, n_leaves, below, ends, ends_open, named):
        self.edge, self.path, self.chars, self.depth, self.owner, self.n = edge, path, chars, depth, owner, n
        self.n_children, self.n_leaves, self.below = n_children, n_leaves, below
        self.ends, self.ends_open, self.named = ends, ends_open, named
        self.waiting, self.stop = [], -1


class Forest:
    """Union-find over a list of neighbouring components.

    ``whole``: nothing lies to the left or right of the list. Otherwise its first and last
    component may go on outside, and neither they nor what hangs on them above is merged."""

    def __init__(self, components: list[Component], whole: bool):
        self.items, self.whole, self.rows = components, whole, []
        self.root = list(range(len(components)))

    def find(self, k: int) -> int:
        root = self.root
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    def lift(self, c: Component, depth: int) -> None:
        """Write out the nodes of ``c`` deeper than ``depth``, each complete by now, and
        see ``c`` as a node at ``depth`` with one child."""
        if c.depth <= depth:
            return
        for row in c.waiting:
            row["parent_conv_id"] = c.owner
        saved, children = c.below, c.n_children
        for d in range(c.depth, depth, -1):
            saved += (c.n - 1) * c.chars[d - 1] if d else 0
            row = {"kind": NODE, "conv_id": c.owner, "depth": d, "parent_conv_id": c.owner if d - 1 > depth else None,
                   "n_convs": c.n, "n_children": children, "n_leaves": c.n_leaves, "saved_tokens": saved,
                   "ends_sha256": NO_ENDS, "ends_open": False}
            if d == c.depth:
                row["ends_sha256"], row["ends_open"] = c.ends or NO_ENDS, c.ends_open
                if c.named or c.ends_open:
                    row["own_key"] = prefix_key(c.path, d)
            self.rows.append(row)
            children = 1
        c.below, c.n_children, c.depth, c.ends, c.ends_open, c.named, c.waiting = saved, 1, depth, None, False, False, [row]

    def join(self, a: int, b: int, depth: int) -> None:
        x, y = self.items[a], self.items[b]
        self.lift(x, depth)
        self.lift(y, depth)
        # A path that ends here is a leaf only if nothing goes on from here.
        x.n_leaves = sum(c.n_leaves for c in (x, y) if c.n_children) or 1
        x.n, x.n_children, x.below, x.owner = x.n + y.n, x.n_children + y.n_children, x.below + y.below, min(x.owner, y.owner)
        x.ends, x.ends_open, x.named = x.ends or y.ends, x.ends_open or y.ends_open, x.named or y.named
        if len(x.waiting) < len(y.waiting):
            x.waiting, y.waiting = y.waiting, x.waiting
        x.waiting += y.waiting
        x.stop = max(x.stop, y.stop)
        self.root[b] = a

    def merge(self) -> list[Component]:
        """The components left, in order; ``rows`` then holds the finished nodes."""
        items, last = self.items, len(self.items) - 1
        for k in sorted(range(1, len(items)), key=lambda k: -items[k].edge):
            depth, a, b = items[k].edge, self.find(k - 1), self.find(k)
            x, y = items[a], items[b]
            outside = not self.whole and (a == 0 or b == self.find(last))
            if outside or x.stop > depth or y.stop > depth:
                x.stop, y.stop = max(x.stop, depth), max(y.stop, depth)
            else:
                self.join(a, b, depth)
        left = [k for k in range(len(items)) if self.root[k] == k]
        out = [items[k] for k in left]
        for place, c in enumerate(out):
            if self.whole:
                self.lift(c, -1)
            elif 0 < place < len(out) - 1:
                self.lift(c, max(c.edge, out[place + 1].edge))
            for row in c.waiting if c.depth >= 0 else ():
                row["parent_key"] = prefix_key(c.path, c.depth)
                c.named = True
        return [] if self.whole else out


def _batches(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 20_000):
        yield pa.RecordBatch.from_pylist(rows[at:at + 20_000], schema=_SCHEMA)


def _contracted(part: int, components: Iterable[Component]) -> list[dict]:
    out = []
    for idx, c in enumerate(components):
        row = {"kind": OPEN, "part": part, "idx": idx, "edge": c.edge, "path": c.path, "chars": c.chars, "depth": c.depth,
               "conv_id": c.owner, "n_convs": c.n, "n_children": c.n_children, "n_leaves": c.n_leaves,
               "saved_tokens": c.below, "ends_sha256": c.ends, "ends_open": c.ends_open, "named": c.named}
        out.append(row)
    return out


def _partition_forest(piece_ids: int):
    """The forest of one partition of (path, conv_id, chars), sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, items = TaskContext.get().partitionId(), []
        # End lists of the first path and of the last so far: only they may go on elsewhere.
        first: list[str] = []
        last: list[str] = []
        ids: list[str] = []
        hashed = hashlib.sha256()

        def piece() -> None:
            nonlocal ids
            text = ",".join(ids)
            hashed.update(text.encode())
            (first if len(items) == 1 else last).append(text)
            ids = []
        for batch in batches:
            for path, conv_id, chars in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if not items or path != items[-1].path:
                    if items:
                        piece()
                        items[-1].ends = hashed.hexdigest()
                    edge = common_turns(items[-1].path, path) if items else -1
                    items.append(Component(edge, path, chars, len(path) // DIGEST, conv_id, 0, 0, 1, 0, None, False, False))
                    hashed, last = hashlib.sha256(), []
                elif len(ids) >= piece_ids:
                    piece()
                    hashed.update(b",")
                items[-1].n += 1
                ids.append(str(conv_id))
        if not items:
            return
        piece()
        items[-1].ends = hashed.hexdigest()
        items[0].ends_open = items[-1].ends_open = True
        written = [{"kind": PIECE, "part": part, "idx": k, "own_key": prefix_key(c.path, c.depth), "ids": text}
                   for c, texts in ((items[0], first), (items[-1], last)) for k, text in enumerate(texts)]
        forest = Forest(items, whole=False)
        left = forest.merge()
        yield from _batches(forest.rows + _contracted(part, left) + written)
    return run


def _merge_partitions(whole: bool, fan_in: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["idx"]))
        items = []
        for r in rows:
            edge = r["edge"] if r["idx"] else common_turns(items[-1].path, r["path"]) if items else -1
            items.append(Component(edge, r["path"], r["chars"], r["depth"], r["conv_id"], r["n_convs"], r["n_children"],
                                   r["n_leaves"], r["saved_tokens"], r["ends_sha256"], r["ends_open"], r["named"]))
        forest = Forest(items, whole)
        left = forest.merge()
        return pa.Table.from_pylist(forest.rows + _contracted(rows[0]["part"] // fan_in, left), schema=_SCHEMA)
    return run


def _whole_ends(pieces: DataFrame) -> DataFrame:
    """(own_key, whole_ends): the digest over a node's pieces in order, a piece at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hashed = None

        def done() -> Iterator[pa.RecordBatch]:
            if key is not None:
                yield pa.RecordBatch.from_pydict({"own_key": [key], "whole_ends": [hashed.hexdigest()]})
        for batch in batches:
            for own_key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own_key != key:
                    yield from done()
                    key, hashed = own_key, hashlib.sha256()
                else:
                    hashed.update(b",")
                hashed.update(ids.encode())
        yield from done()
    return (pieces.select("own_key", "ids", "part", "idx").repartition("own_key")
            .sortWithinPartitions("own_key", "part", "idx").select("own_key", "ids")
            .mapInArrow(run, "own_key string, whole_ends string"))


def trie_nodes(paths: DataFrame, scratch: Scratch, fan_in: int = FAN_IN, piece_ids: int = PIECE_IDS) -> DataFrame:
    """One row for each distinct prefix of ``paths`` (conv_id long, path binary of 16 bytes
    a turn, chars array<long>: characters of each turn), the empty one included.

    An id has one path; equal paths are copies. Columns: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. No rows for
    no paths."""
    ranged = (paths.select("path", "conv_id", "chars").repartitionByRange("path", "conv_id")
              .sortWithinPartitions("path", "conv_id"))
    table = scratch.write(ranged.mapInArrow(_partition_forest(piece_ids), _DDL), "forests")
    pieces, levels = table.filter(F.col("kind") == PIECE), [table]
    parts = table.filter(F.col("kind") == OPEN).agg(F.max("part")).first()[0]
    while parts is not None:
        whole = parts < fan_in
        merged = (levels[-1].filter(F.col("kind") == OPEN).groupBy(F.floor(F.col("part") / fan_in))
                  .applyInArrow(_merge_partitions(whole, fan_in), _DDL))
        levels.append(scratch.write(merged, "merged"))
        parts = None if whole else parts // fan_in
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    nodes = nodes.filter(F.col("kind") == NODE)
    named = nodes.filter("own_key IS NOT NULL").select(F.col("own_key").alias("_key"), F.col("conv_id").alias("_parent"))
    ends = scratch.write(_whole_ends(pieces), "ends")
    ends = ends.select(F.col("own_key").alias("_own"), "whole_ends")
    return (nodes.join(broadcast_if_small(named), nodes["parent_key"] == F.col("_key"), "left")
            .join(broadcast_if_small(ends), F.col("ends_open") & (F.col("own_key") == F.col("_own")), "left")
            .select("conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), "n_convs",
                    "n_children", "n_leaves", "saved_tokens",
                    F.when(F.col("ends_open"), F.col("whole_ends")).otherwise(F.col("ends_sha256")).alias("ends_sha256")))


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, digests, chars): each conversation's turns in order, as arrays.

    Rows go by turn, null first; rows of one turn by role, the text's first characters and
    its digest. A null role or text counts as empty; rows without conv_id belong to no
    conversation and are left out. Only digests and lengths are shuffled, not texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), F.substring(text, 1, HEAD_CHARS).alias("head"),
                    F.substring(F.sha2(both, 256), 1, 2 * DIGEST).alias("digest"),
                    F.char_length(text).cast("long").alias("chars"))
    return (conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
            .select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars")))


def rebuilt_paths(own: DataFrame, block: int = 100, most: int = 5) -> DataFrame:
    """(conv_id, path, chars): the first h turns of the conversation that opens the block
    of ``block`` ids, then the own turns after the first h, h = crc32(id) % (most + 1)."""
    first = (F.col("conv_id") - F.col("conv_id") % block).alias("_first")
    heads = own.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("_first"), F.slice("digests", 1, most).alias("_digests"), F.slice("chars", 1, most).alias("_chars"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    joined = own.select("*", first, h.alias("_h")).join(heads, "_first", "left")

    def spliced(name: str):
        kept = F.slice(name, F.col("_h") + 1, F.greatest(F.size(name) - F.col("_h"), F.lit(0)))
        return F.concat(F.coalesce(F.slice(f"_{name}", F.lit(1), F.col("_h")), F.slice(name, 1, 0)), kept)
    return joined.select("conv_id", F.unhex(F.array_join(spliced("digests"), "")).alias("path"),
                         spliced("chars").alias("chars"))


def trie_query(conversations: DataFrame) -> DataFrame:
    """Query ``op13_prefix_trie``: every node of the trie of the rebuilt conversations."""
    scratch = Scratch(conversations.sparkSession, "prefix_trie")
    own = scratch.write(conversation_turns(conversations), "turns")
    return trie_nodes(rebuilt_paths(own), scratch)
