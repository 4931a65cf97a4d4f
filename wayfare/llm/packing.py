"""Operator 2: best-fit packing with swap-based local search.

Documents become pieces of at most ``capacity`` tokens: only a longer document is cut,
its first piece taking the remainder. A piece that fills a sequence is one. The others
are dealt evenly to shards. A shard places its pieces best-fit in decreasing length, then
local search moves load from emptier to fuller underfull sequences: one or two pieces for
none, one or two, whenever the fuller one gains without overflowing. Partners are looked
up by the space they would fill, so all pairs are covered and the search runs until no
exchange gains or the number of sequences is the least possible. Each step raises the sum
of squared fills; sequences that run empty vanish.
Full sequences are final; what is in underfull ones is dealt to fewer shards and packed
again, until one shard is left or a round no longer halves what is underfull.

Defined results: a null or empty text is one piece holding just the end id; null and
repeated doc_ids are pieces like others; ties go to the order of dealing. An empty table
gives no rows. Extra columns of the pieces are carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.shared import Scratch, map_slices, refuse_clash
from wayfare.llm.tokens import CACHE_PIECES, MORE_PIECES, ids_crc32, read_tokenizer, text_encoder

CAPACITY, END_ID = 1024, 2
SHARD_PIECES = 100_000


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
                 with_ids: bool = False, cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; map-only."""
    model = read_tokenizer(tokenizer_path)

    def make():
        encoder = text_encoder(model, end_id, cache_pieces)

        def run(part: dict) -> dict:
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, ids in zip(part["doc_id"], encoder.encode(part["text"])):
                first = (len(ids) - 1) % capacity + 1
                ends = range(first, len(ids) + 1, capacity)
                for piece, end in enumerate(ends):
                    start = max(0, end - (first if piece == 0 else capacity))
                    out["doc_id"].append(doc_id), out["piece"].append(piece), out["start"].append(start)
                    out["length"].append(end - start), out["ids_crc32"].append(ids_crc32(ids[start:end]))
                    out["ids"].append(ids[start:end].astype(np.int32) if with_ids else None)
            return out
        return run
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: best-fit in decreasing length. A bit mask over the free
    spaces finds the tightest open bin at once."""
    bins: list[list[int]] = []
    open_bins: dict[int, list[int]] = {}
    mask = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        fits = mask >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            at = open_bins[free].pop()
            if not open_bins[free]:
                mask &= ~(1 << free)
            bins[at].append(k)
        else:
            free, at = capacity, len(bins)
            bins.append([k])
        left = free - need
        if left:
            open_bins.setdefault(left, []).append(at)
            mask |= 1 << left
    return bins


class _Underfull:
    """Bins below ``capacity``, found by what would fill them.

    A bin with free space f that gives up at most two pieces of ``back`` tokens together
    has a slot of back + f: an offer of more than ``back`` and up to the slot gains. Bins
    are held by (slot, free); a bit mask of the free spaces of each slot answers a lookup."""

    def __init__(self, bins: list[list[int]], sizes: list[int], capacity: int):
        self.bins, self.sizes, self.capacity = bins, sizes, capacity
        self.fill = [sum(sizes[k] for k in b) for b in bins]
        self.sums: dict[int, tuple[int, list[int]]] = {}
        self.held: dict[tuple[int, int], dict[int, None]] = {}
        self.masks = [0] * (capacity + 1)
        self.slots = 0  # bit mask of the slots with any bin
        for at in range(len(bins)):
            self.add(at)

    def add(self, at: int) -> None:
        free = self.capacity - self.fill[at]
        if not 0 < free < self.capacity:
            return
        lengths = sorted(self.sizes[k] for k in self.bins[at])
        sums = {0, *lengths}
        single = sorted(set(lengths))
        sums.update(a + b for x, a in enumerate(single) for b in single[x + 1:])
        sums.update(2 * a for a, b in zip(lengths, lengths[1:]) if a == b)
        self.sums[at] = free, list(sums)
        for back in sums:
            self.held.setdefault((back + free, free), {})[at] = None
            self.masks[back + free] |= 1 << free
            self.slots |= 1 << (back + free)

    def remove(self, at: int) -> None:
        free, sums = self.sums.pop(at)
        for back in sums:
            bucket = self.held[back + free, free]
            del bucket[at]
            if not bucket:
                del self.held[back + free, free]
                self.masks[back + free] &= ~(1 << free)
                if not self.masks[back + free]:
                    self.slots &= ~(1 << (back + free))

    def best(self, offers: list[int], most_free: int):
        """(offer, target, back) that leaves least free, in the fullest such bin; None if
        nothing gains in a bin with at most ``most_free``."""
        upto = (1 << (most_free + 1)) - 1
        lefts = 0
        for offer in offers:
            lefts |= self.slots >> offer
        lefts &= upto >> 1
        while lefts:
            left = (lefts & -lefts).bit_length() - 1
            lefts &= lefts - 1
            found = None
            for offer in offers:
                frees = (self.masks[offer + left] & upto) >> (left + 1) if offer + left <= self.capacity else 0
                free = left + (frees & -frees).bit_length()
                if frees and (found is None or free < found[0]):
                    found = free, offer
            if found:
                free, offer = found
                return offer, next(reversed(self.held[offer + left, free])), offer + left - free
        return None

    def pieces(self, at: int, total: int) -> list[int]:
        """At most two pieces of a bin with ``total`` tokens together."""
        if not total:
            return []
        seen: dict[int, int] = {}
        for k in self.bins[at]:
            if self.sizes[k] == total:
                return [k]
        for k in self.bins[at]:
            if total - self.sizes[k] in seen:
                return [seen[total - self.sizes[k]], k]
            seen[self.sizes[k]] = k
        raise ValueError(f"no pieces of {total} tokens")

    def exchange(self, source: int) -> bool:
        """The best exchange out of ``source`` into a bin at least as full, if any gains."""
        free, sums = self.sums[source]
        self.remove(source)
        step = self.best([n for n in sums if n], free)
        if step is not None:
            offer, target, back = step
            out, into = self.pieces(source, offer), self.pieces(target, back)
            self.remove(target)
            self.bins[source] = [k for k in self.bins[source] if k not in out] + into
            self.bins[target] = [k for k in self.bins[target] if k not in into] + out
            self.fill[source] -= offer - back
            self.fill[target] += offer - back
            self.add(target)
        self.add(source)
        return step is not None


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int):
    """Improve ``bins`` by exchanges between underfull ones until none gains or the
    number of bins is the least possible."""
    bins = [list(b) for b in bins if b]
    search = _Underfull(bins, lengths.tolist(), capacity)
    least = -(-sum(search.fill) // capacity)
    count, changed = len(bins), True
    while changed and count > least:
        changed = False
        for source in sorted(search.sums, key=lambda at: (search.fill[at], at)):
            while count > least and source in search.sums and search.exchange(source):
                changed = True
                count -= not bins[source]
    return [b for b in bins if b]


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (with ``length``, 1 to capacity) plus sequence_id and offset. Other columns
    are carried; none may be called ``sequence_id``, ``offset``, ``_shard`` or ``_full``."""
    refuse_clash(pieces.columns, ("sequence_id", "offset", "_shard", "_full"))
    scratch = Scratch(pieces.sparkSession, "packing")
    pieces = scratch.write(pieces, "pieces")
    columns = pieces.columns
    whole = pieces.filter(F.col("length") == capacity).select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, rest, last = [whole], pieces.filter(F.col("length") != capacity), None
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    for round_no in range(64):
        n = rest.count()
        final = n <= shard_pieces or (last is not None and 2 * n > last)
        shards = max(1, -(-n // shard_pieces))
        base = round_no << 56

        def pack(part: pa.Table) -> pa.Table:
            lengths = part["length"].to_numpy()
            bins = local_search(best_fit(lengths, capacity), lengths, capacity)
            order = np.fromiter((k for b in bins for k in b), np.int64, part.num_rows)
            local = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
            ends = np.cumsum(lengths[order])
            starts = ends - lengths[order]
            firsts = np.flatnonzero(np.diff(local, prepend=-1))
            fills = np.add.reduceat(lengths[order], firsts)
            shard = part["_shard"][0].as_py()
            return (part.take(order).drop_columns("_shard")
                    .append_column("sequence_id", pa.array(base + (shard << 32) + local))
                    .append_column("offset", pa.array(starts - starts[firsts][local]))
                    .append_column("_full", pa.array(fills[local] == capacity)))

        dealt = rest.withColumn("_shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)))
        packed = scratch.write(dealt.groupBy("_shard").applyInArrow(
            pack, f"{schema}, sequence_id long, offset long, _full boolean"), "packed")
        done.append((packed if final else packed.filter("_full")).drop("_full"))
        if final:
            break
        rest, last = packed.filter("NOT _full").select(*columns), n
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False,
                   cache_pieces: int = CACHE_PIECES) -> DataFrame:
    return pack_pieces(token_pieces(docs, tokenizer_path, capacity=capacity, with_ids=with_ids, cache_pieces=cache_pieces), capacity)


def packing_query(documents: DataFrame) -> DataFrame:
    """Query ``op2_best_fit_packing``."""
    import public_tokenizers

    return pack_documents(documents, public_tokenizers.path("byte_bpe_50k.json"), cache_pieces=MORE_PIECES)
