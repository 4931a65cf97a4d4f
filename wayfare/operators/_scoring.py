"""Task-side scoring for ALS top-N (runs inside ``mapInArrow``).

Only numpy and pyarrow are used here, and the module is registered to be pickled by value,
so executors run it without the ``wayfare`` package installed.

A scored item is one unsigned 64-bit number: the float score's bits, mapped so that they
order as the score does, above the inverted item id. A larger number is a better item, ties
going to the smaller id, and 0 stands for no item.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Users scored together, and scores in memory at a time (a few arrays of 8 B each).
USERS_AT_A_TIME = 2_048
CELLS_AT_A_TIME = 500_000
# Items of a leaf: those whose factors lie close together.
LEAF_ITEMS = 256
# Leaves that are scored for each user first, the most promising ones, to find a good n-th score.
FIRST_LEAVES = 4
_SIGN, _LOW = np.uint32(0x80000000), np.uint64(0xFFFFFFFF)
SCORED = pa.schema([("id", pa.int32()), ("features", pa.list_(pa.float32())), ("norm", pa.float64()),
                    ("items", pa.list_(pa.int32())), ("scores", pa.list_(pa.float32())), ("nth", pa.float64())])


@dataclass
class ItemBlock:
    """Items in the order of their leaves. Leaf k holds places ``starts[k]:starts[k + 1]``,
    all within ``radii[k]`` of ``centers[k]`` and none longer than ``lengths[k]``."""

    ids: np.ndarray
    slots: np.ndarray
    factors: np.ndarray
    starts: np.ndarray
    centers: np.ndarray
    radii: np.ndarray
    lengths: np.ndarray


def list_values(column, kind) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind)


def _leaves(factors: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of the leaves: halved along the direction of the largest spread until small."""
    todo, done = [np.arange(len(factors))], []
    while todo:
        own = todo.pop()
        if len(own) <= size:
            done.append(own)
            continue
        away = factors[own] - factors[own].mean(axis=0)
        along = away @ np.linalg.eigh(away.T @ away)[1][:, -1]
        order = np.argsort(along, kind="stable")
        todo += [own[order[len(own) // 2:]], own[order[:len(own) // 2]]]
    return done


def item_block(table, leaf_items: int = LEAF_ITEMS) -> ItemBlock:
    """The block of an Arrow table (id, slot, features)."""
    ids, slots = (table.column(c).to_numpy().astype(np.int64) for c in ("id", "slot"))
    factors = list_values(table.column("features"), np.float64).reshape(len(ids), -1)
    if not np.isfinite(factors).all():
        raise ValueError("factors must be finite")
    order = np.argsort(slots)
    ids, slots, factors = ids[order], slots[order], factors[order]
    leaves = _leaves(factors, leaf_items)
    order = np.concatenate(leaves) if leaves else np.empty(0, np.int64)
    starts = np.cumsum([0, *(len(x) for x in leaves)])
    centers = np.array([factors[x].mean(axis=0) for x in leaves]).reshape(len(leaves), factors.shape[1])
    radii = np.array([np.linalg.norm(factors[x] - c, axis=1).max() for x, c in zip(leaves, centers)])
    lengths = np.array([np.linalg.norm(factors[x], axis=1).max() for x in leaves])
    return ItemBlock(ids[order], slots[order], factors[order], starts, centers, radii, lengths)


def pack(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Numbers that order float32 ``scores`` (rows x items) descending, then ``ids`` ascending."""
    bits = (scores + np.float32(0)).view(np.uint32)  # adding 0 makes -0.0 equal 0.0
    ordered = np.where(bits & _SIGN, ~bits, bits | _SIGN)
    return (ordered.astype(np.uint64) << np.uint64(32)) | (_LOW - ids.astype(np.uint64))


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of packed numbers."""
    ordered = (packed >> np.uint64(32)).astype(np.uint32)
    bits = np.where(ordered & _SIGN, ordered ^ _SIGN, ~ordered)
    return bits.view(np.float32), (_LOW - (packed & _LOW)).astype(np.int64)


def merge_top(feats: np.ndarray, ids: np.ndarray, matrix: np.ndarray, n: int, best: np.ndarray | None = None,
              hidden: np.ndarray | None = None) -> np.ndarray:
    """The n best packed items per row of ``feats``, best first, 0 where there are fewer.

    ``best`` holds packed items found before; ``hidden`` (rows x items) marks those to leave
    out. Products are summed in double precision and rounded, so that the way a matrix
    product is cut up does not decide ties."""
    if not (np.isfinite(feats).all() and np.isfinite(matrix).all()):
        raise ValueError("factors must be finite")
    packed = pack((feats.astype(np.float64) @ matrix.T).astype(np.float32), ids)
    if hidden is not None:
        packed[hidden] = 0
    if best is not None:
        packed = np.concatenate([packed, best], axis=1)
    k = min(n, packed.shape[1])
    top = np.partition(packed, packed.shape[1] - k, axis=1)[:, packed.shape[1] - k:]
    return np.sort(top, axis=1)[:, ::-1]


def nth_scores(best: np.ndarray) -> np.ndarray:
    """The score that a further item must reach, for each row of packed items."""
    return np.where(best[:, -1] == 0, -np.inf, unpack(best[:, -1])[0].astype(np.float64))


class _Masks:
    """Bitmaps of seen slots, lowest bit first; slots beyond a bitmap's end are unseen."""

    def __init__(self, column: pa.Array):
        self.known = np.asarray(column.is_valid())
        parts = [x.as_buffer() if x.is_valid else b"" for x in column]
        self.sizes = np.array([len(x) for x in parts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def hidden(self, rows: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Whether row and slot (broadcast against each other) are marked."""
        byte = slots >> 3
        inside = byte < self.sizes[rows]
        if not len(self.bytes):
            return inside
        held = self.bytes[np.where(inside, self.starts[rows] + byte, 0)]
        return inside & ((held >> (slots & 7).astype(np.uint8)) & 1).astype(bool)


def best_of_block(feats: np.ndarray, block: ItemBlock, n: int, best: np.ndarray, masks: _Masks | None = None) -> np.ndarray:
    """``best`` (rows x n packed items) merged with the block's items.

    An item of a leaf scores at most the user's product with the center plus the user's
    length times the radius. Leaves that cannot reach a user's n-th score are passed over;
    of the others, single-precision products, with a margin for their rounding, leave the
    few items whose exact products are taken."""
    if not np.isfinite(feats).all():
        raise ValueError("factors must be finite")
    best = best.copy()
    rank = feats.shape[1]
    x = feats.astype(np.float64)
    norms = np.linalg.norm(x, axis=1)

    def whole(rows, lo, hi):
        step = max(1, CELLS_AT_A_TIME // (hi - lo))
        for at in range(0, len(rows), step):
            r = rows[at:at + step]
            hidden = None if masks is None else masks.hidden(r[:, None], block.slots[None, lo:hi])
            best[r] = merge_top(feats[r], block.ids[lo:hi], block.factors[lo:hi], n, best[r], hidden)

    def few(rows, leaf, lo, hi):
        near = block.factors[lo:hi].astype(np.float32)
        step = max(1, CELLS_AT_A_TIME // (hi - lo))
        for at in range(0, len(rows), step):
            r = rows[at:at + step]
            floor = nth[r] - (norms[r] * block.lengths[leaf] * (rank + 8) * 2.4e-7 + np.abs(nth[r]) * 1e-6 + 1e-30)
            i, j = np.divmod(np.flatnonzero(feats[r] @ near.T >= floor.astype(np.float32)[:, None]), hi - lo)
            if 8 * len(i) > len(r) * (hi - lo):  # ties in plenty
                whole(r, lo, hi)
                nth[r] = nth_scores(best[r])
                continue
            i, j = r[i], j + lo
            packed = pack(np.einsum("ij,ij->i", x[i], block.factors[j]).astype(np.float32), block.ids[j])
            keep = packed > best[i, -1]
            if masks is not None:
                keep &= ~masks.hidden(i, block.slots[j])
            i, packed = i[keep], packed[keep]
            if not len(i):
                continue
            order = np.lexsort((~packed, i))
            i, packed = i[order], packed[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            first = place < n
            own, row = np.unique(i, return_inverse=True)
            new = np.zeros((len(own), n), dtype=np.uint64)
            new[row[first], place[first]] = packed[first]
            best[own] = np.sort(np.concatenate([best[own], new], axis=1), axis=1)[:, ::-1][:, :n]
            nth[own] = nth_scores(best[own])

    everyone = np.arange(len(feats))
    leaves = len(block.radii)
    reach = norms.max(initial=0) * block.lengths.max(initial=0)
    # Few items, or lengths near the ends of single precision: every product is taken.
    if leaves < 2 * FIRST_LEAVES or not 1e-25 < reach < 1e35:
        for leaf in range(leaves):
            whole(everyone, block.starts[leaf], block.starts[leaf + 1])
        return best
    bound = x @ block.centers.T + norms[:, None] * (block.radii + 1e-6 * block.lengths)
    bound = np.minimum(bound, norms[:, None] * (block.lengths * (1 + 1e-6))) + 1e-30
    first = np.argpartition(bound, leaves - FIRST_LEAVES, axis=1)[:, leaves - FIRST_LEAVES:]
    first = np.take_along_axis(first, np.argsort(-np.take_along_axis(bound, first, axis=1), axis=1), axis=1)
    nth = nth_scores(best)
    for turn in range(FIRST_LEAVES):
        by_leaf = np.argsort(first[:, turn], kind="stable")
        cuts = np.flatnonzero(np.diff(first[by_leaf, turn])) + 1
        for rows in np.split(by_leaf, cuts):
            if not len(rows):
                continue
            leaf = first[rows[0], turn]
            lo, hi = block.starts[leaf], block.starts[leaf + 1]
            short, full = rows[nth[rows] == -np.inf], rows[nth[rows] > -np.inf]
            whole(short, lo, hi)
            nth[short] = nth_scores(best[short])
            few(full[bound[full, leaf] >= nth[full]], leaf, lo, hi)
    np.put_along_axis(bound, first, -np.inf, axis=1)
    for leaf in np.argsort(-bound.max(axis=0), kind="stable"):
        open_ = np.flatnonzero((bound[:, leaf] >= nth) & (bound[:, leaf] > -np.inf))
        if len(open_):
            lo, hi = block.starts[leaf], block.starts[leaf + 1]
            short = open_[nth[open_] == -np.inf]
            whole(short, lo, hi)
            nth[short] = nth_scores(best[short])
            few(open_[~np.isin(open_, short)], leaf, lo, hi)
    return best


def _packed_lists(items: pa.Array, scores: pa.Array, n: int) -> np.ndarray:
    """(rows x n) packed items from columns of lists or nulls, best first."""
    best = np.zeros((len(items), n), dtype=np.uint64)
    rows = np.repeat(np.arange(len(items)), pc.list_value_length(items).fill_null(0).to_numpy(zero_copy_only=False))
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    best[rows, place] = pack(list_values(scores, np.float32), list_values(items, np.int64))
    return best


def _lists(values: np.ndarray, sizes: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, type=kind))


def score_batches(batches, block: ItemBlock, n: int):
    """Merge one block of items into each Arrow batch of (id, features, norm, items, scores,
    mask); ``nth`` is the score that a further item must reach."""
    step = max(1, min(USERS_AT_A_TIME, CELLS_AT_A_TIME // max(1, len(block.radii))))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            ids, features, norm, items, scores, mask = part.columns
            feats = list_values(features, np.float32).reshape(len(part), -1)
            masks = None if mask.null_count == len(mask) else _Masks(mask)
            best = best_of_block(feats, block, n, _packed_lists(items, scores, n), masks)
            sizes = (best != 0).sum(axis=1)
            found, places = unpack(best[best != 0])
            yield pa.RecordBatch.from_arrays(
                [ids, _lists(feats.ravel(), np.full(len(feats), feats.shape[1]), pa.float32()), norm,
                 _lists(places.astype(np.int32), sizes, pa.int32()), _lists(found, sizes, pa.float32()),
                 pa.array(nth_scores(best))], schema=SCORED)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
