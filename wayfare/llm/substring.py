"""Operator 1: substring dedup by content-defined chunking.

A gear hash rolls over the last 16 bytes of the text. A chunk ends where the hash's top
bits are zero, so the same passage is cut alike wherever it stands and an insertion shifts
only the chunks around it. That is 1 in 4 after white space, 1 in 8 after a character
beyond ASCII and 1 in 32 after LONG_RUN bytes without white space, but 1 in 512 inside a
word; text without spaces (Chinese, Thai, encoded) is so cut well below MAX_BYTES. Chunks
have MIN_BYTES to MAX_BYTES bytes, end on character boundaries and are compared by a
64-bit digest. A digest found in several documents is repeated; its copy in the smallest
doc_id stays. Where consecutive repeated chunks cover RUN_BYTES or more, that run is cut
from every other document. A false digest match alone is far too short for a run.

Repeats inside one document alone are left, and so are short repeats such as licence
lines. Defined results: a null text stays null with no chunks; an empty text is
unchanged; rows with a null doc_id are returned unchanged; rows that repeat a doc_id count
as one document. Extra columns are carried. Very long texts are only longer chunk lists.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.minhash import mix
from wayfare.llm.shared import Scratch, map_slices, refuse_clash

MIN_BYTES, MAX_BYTES, RUN_BYTES = 16, 512, 128
SPACE_BITS, WIDE_BITS, RUN_BITS, OTHER_BITS = 2, 3, 5, 9
LONG_RUN = 32
WINDOW_STEPS = (1, 2, 4, 8)
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
# A chunk may end after byte b when the hash is below this bound.
_BOUND = np.full(256, 1 << (32 - OTHER_BITS), dtype=np.uint32)
_BOUND[:0x21], _BOUND[0x80:] = 1 << (32 - SPACE_BITS), 1 << (32 - WIDE_BITS)


def chunk_ends(data: bytes) -> list[int]:
    """End offsets of the chunks of ``data`` (UTF-8), the last one being its length."""
    n = len(data)
    if not n:
        return []
    b = np.frombuffer(data, dtype=np.uint8)
    h = _GEAR[b]
    for step in WINDOW_STEPS:
        wider = h.copy()
        wider[step:] += h[:-step] << np.uint32(step)
        h = wider
    inside = np.zeros(n, dtype=bool)  # the next byte continues a character
    inside[:-1] = (b[1:] & 0xC0) == 0x80
    bound = _BOUND[b]
    spaces = np.concatenate(([-1], np.flatnonzero(b <= 0x20), [n]))
    for k in np.flatnonzero(np.diff(spaces) > LONG_RUN).tolist():
        long = bound[spaces[k] + LONG_RUN:spaces[k + 1]]
        np.maximum(long, np.uint32(1 << (32 - RUN_BITS)), out=long)
    ends, last = [], 0
    for end in (np.flatnonzero((h < bound) & ~inside) + 1).tolist() + [n]:
        while end - last > MAX_BYTES:
            last += MAX_BYTES
            while inside[last - 1]:
                last -= 1
            ends.append(last)
        if end - last >= MIN_BYTES or end == n and end > last:
            ends.append(end)
            last = end
    return ends


def chunk_digests(data: bytes, ends: list[int]) -> list[int]:
    out, at = [], 0
    for end in ends:
        out.append(xxhash.xxh3_64_intdigest(data[at:end]) - (1 << 63))
        at = end
    return out


def repeated_runs(ends: list[int], digests: list[int], repeated: set[int],
                  run_bytes: int = RUN_BYTES) -> list[tuple[int, int, int]]:
    """(start, end, chunks) byte runs of consecutive repeated chunks that are long enough."""
    runs, at, start, count = [], 0, 0, 0
    for end, digest in zip(ends + [0], digests + [None]):
        if digest in repeated:
            start, count = (start, count + 1) if count else (at, 1)
        else:
            if count and at - start >= run_bytes:
                runs.append((start, at, count))
            count = 0
        at = end
    return runs


def document_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every chunk, one row each."""
    def make():
        def run(part: dict) -> dict:
            ids, digests = [], []
            for doc_id, text in zip(part["doc_id"], part["text"]):
                data = text.encode("utf-8", "surrogatepass")
                got = chunk_digests(data, chunk_ends(data))
                ids.append(np.full(len(got), doc_id, dtype=np.int64))
                digests.extend(got)
            return {"doc_id": np.concatenate(ids) if ids else [], "digest": digests}
        return run
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_slices(rows.filter("doc_id IS NOT NULL AND text IS NOT NULL"), make, "doc_id long, digest long")


def repeated_digests(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, repeated): the digests of each document whose kept copy is elsewhere."""
    chunks = scratch.write(document_chunks(docs), "chunks")
    shared = scratch.write(chunks.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                           .filter("first != last").select("digest", "first"), "shared")
    marked = scratch.write(chunks.join(shared, "digest").filter("doc_id != first")
                           .groupBy("doc_id").agg(F.collect_set("digest").alias("repeated")), "marked")
    scratch.drop(chunks, shared)
    return marked


def cut_repeats(docs: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Every row and column of ``docs`` with repeated passages cut from ``text``, and the
    columns n_chunks, n_cut (chunks), cut_chars and cut_spans (start:end in code points of
    the old text, comma-joined). ``docs`` may not have those columns, ``_doc`` or
    ``_repeated``."""
    refuse_clash(docs.columns, ("n_chunks", "n_cut", "cut_chars", "cut_spans", "_doc", "_repeated"))
    marked = repeated_digests(docs, Scratch(docs.sparkSession, "substring"))
    other = [c for c in docs.columns if c != "text"]

    def make():
        def one(text, repeated):
            if text is None:
                return None, 0, 0, 0, ""
            data = text.encode("utf-8", "surrogatepass")
            ends = chunk_ends(data)
            if not repeated:
                return text, len(ends), 0, 0, ""
            kept, spans, at, chars, cut = [], [], 0, 0, 0
            runs = repeated_runs(ends, chunk_digests(data, ends), set(repeated), run_bytes)
            for start, end, _ in runs:
                before = data[at:start].decode("utf-8", "surrogatepass")
                gone = len(data[start:end].decode("utf-8", "surrogatepass"))
                kept.append(before)
                chars += len(before)
                spans.append(f"{chars}:{chars + gone}")
                chars, cut, at = chars + gone, cut + gone, end
            kept.append(data[at:].decode("utf-8", "surrogatepass"))
            return "".join(kept), len(ends), sum(r[2] for r in runs), cut, ",".join(spans)

        def run(part: dict) -> dict:
            got = [one(t, r) for t, r in zip(part["text"], part["_repeated"])]
            names = ("text", "n_chunks", "n_cut", "cut_chars", "cut_spans")
            return {c: part[c] for c in other} | {n: [g[k] for g in got] for k, n in enumerate(names)}
        return run

    marked = marked.select(F.col("doc_id").alias("_doc"), F.col("repeated").alias("_repeated"))
    rows = docs.join(marked, docs["doc_id"] == marked["_doc"], "left").drop("_doc")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*other).schema)
    return map_slices(rows, make, f"{schema}, text string, n_chunks long, n_cut long, cut_chars long, "
                                  "cut_spans string")


def substring_query(documents: DataFrame) -> DataFrame:
    """Query ``op1_substring_dedup``: every document with its cleaned text and what was cut."""
    return cut_repeats(documents.select("doc_id", "text"))
