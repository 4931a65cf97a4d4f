"""Operator 5: SentencePiece encoding and decoding with N-best segmentations.

The lattice of a text has an edge for every piece of the vocabulary that matches, scored
as the model scores it; a character that no piece covers is an edge of its byte pieces,
below every score. A forward Viterbi pass gives the best score up to each position. Those
scores are exact, so a backward A-star search from the end, ordered by the score of the
path behind plus the best score before it, yields segmentations best first.

A text's lattice is a chain of smaller ones wherever no piece can cross: before a word
mark that follows other characters and, if the vocabulary mixes them in no piece, between
Latin letters and other characters. Each link of the chain is searched once and remembered
(up to a bounded number of links and characters): its best path, and the cost of its next
best one. The N best of the text change only the N - 1 links whose alternatives are cheapest;
A-star gives those links' N best, and a heap their best sums. Paths under search share their
steps, so memory grows with a link's length, not its square.

Decoding joins the pieces, turns runs of byte pieces into text, marks into spaces, and
takes off the mark that encoding put in front.

Defined results: a null or empty text has the one empty segmentation. Equal scores are
ordered by the ids of the pieces from the end, smaller first. Repeated rows and null ids
are rows like others; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.shared import map_slices, worker_cache

MARK = "▁"
N_BEST = 4
# Links and characters that a worker remembers.
LINK_CACHE, CACHE_CHARS = 1_200_000, 24_000_000
UNKNOWN_PENALTY = 10.0
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u1e00-\u1eff"
LINKS = re.compile(f"{MARK}*[{_LATIN}]+|{MARK}*[^{_LATIN}{MARK}]+|{MARK}+")
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
WHOLE = re.compile(".+", re.DOTALL)


class Lattice:
    """Pieces and scores of a SentencePiece model."""

    def __init__(self, model_bytes: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
        size = sp.vocab_size()
        self.text = [sp.id_to_piece(k) for k in range(size)]
        usable = [not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k)) for k in range(size)]
        self.pieces = {p: (k, sp.get_score(k)) for k, p in enumerate(self.text) if usable[k]}
        self.byte_ids = {int(p[3:5], 16): k for k, p in enumerate(self.text) if sp.is_byte(k)}
        self.byte_of = {k: b for b, k in self.byte_ids.items()}
        # A byte piece below 0x80 is a character by itself; runs of others are decoded.
        self.plain = [chr(b) if (b := self.byte_of.get(k)) is not None and b < 0x80 else p
                      for k, p in enumerate(self.text)]
        self.high_byte = np.array([self.byte_of.get(k, 0) >= 0x80 for k in range(size)])
        self.longest = max(map(len, self.pieces), default=1)
        # Every prefix of a piece, with the piece's ids and score or None.
        self.prefixes = {p[:k]: None for p in self.pieces for k in range(1, len(p))}
        self.prefixes |= {p: ((k,), score) for p, (k, score) in self.pieces.items()}
        self.unknown = min((s for _, s in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.links = next(r for r in (LINKS, WORDS, WHOLE) if all(len(r.findall(p)) == 1 for p in self.pieces))
        self.add_mark = sp.encode("a", out_type=str)[0].startswith(MARK)
        self.unknown_id = sp.unk_id()
        self.normalize = sp.normalize

    def unknown_ids(self, char: str) -> tuple[int, ...]:
        data = char.encode("utf-8", "surrogatepass")
        return tuple(self.byte_ids[b] for b in data) if self.byte_ids else (self.unknown_id,)

    def edges(self, link: str, end: int):
        """(start, ids, score) of the edges that end at ``end``."""
        for start in range(max(0, end - self.longest), end):
            got = self.pieces.get(link[start:end])
            if got is not None:
                yield start, (got[0],), got[1]
            elif start == end - 1:
                yield start, self.unknown_ids(link[start]), self.unknown

    def forward(self, link: str) -> list[float]:
        """The best score up to each position."""
        best = [0.0]
        for end in range(1, len(link) + 1):
            best.append(max([best[start] + score for start, _, score in self.edges(link, end)]))
        return best

    def best_path(self, link: str) -> tuple[float, tuple[int, ...], float]:
        """(score, ids, cost of the next best path or infinity): a forward pass that keeps
        the two best scores up to each position."""
        n, low, get = len(link), float("-inf"), self.prefixes.get
        best, second, back = [0.0] + [low] * n, [low] * (n + 1), [None] * (n + 1)
        for start in range(n):
            top, next_top = best[start], second[start]
            for end in range(start + 1, n + 1):
                got = get(link[start:end], 0)
                if not got:
                    if end == start + 1:
                        ids, score = self.unknown_ids(link[start]), self.unknown
                    elif got == 0:
                        break
                    else:
                        continue
                else:
                    ids, score = got
                total, held = top + score, best[end]
                if total > held:
                    second[end] = max(held, next_top + score)
                    best[end], back[end] = total, (start, ids)
                else:
                    if total == held and ids[-1] < back[end][1][-1]:
                        back[end] = (start, ids)
                    if total > second[end]:
                        second[end] = total
                if got == 0:
                    break
        parts, at = [], n
        while at:
            at, own = back[at]
            parts.append(own)
        return best[n], tuple(itertools.chain.from_iterable(reversed(parts))), best[n] - second[n]

    def n_best(self, link: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Up to ``n`` best (score, ids), best first, by backward A-star. Equal scores go by
        the ids from the end."""
        best = self.forward(link)
        # Entries: minus the full score, the path from the end, position, score behind.
        heap, out = [(-best[-1], Path(), len(link), 0.0)], []
        while heap and len(out) < n:
            total, path, at, behind = heapq.heappop(heap)
            if at == 0:
                out.append((-total, path.ids()))
                continue
            for start, got, score in self.edges(link, at):
                longer = path
                for piece in reversed(got):
                    longer = Path(longer, piece)
                heapq.heappush(heap, (-(best[start] + (score + behind)), longer, start, score + behind))
        return out


class Path:
    """Ids from the end of a link on: one step, its parent, and a jump further back, so
    that entries share what they have in common and compare in logarithmic time."""

    __slots__ = ("parent", "jump", "size", "piece")

    def __init__(self, parent: Path | None = None, piece: int = -1):
        self.piece, self.parent = piece, self if parent is None else parent
        if parent is None:
            self.jump, self.size = self, 0
            return
        self.size, far = parent.size + 1, parent.jump
        self.jump = far.jump if parent.size - far.size == far.size - far.jump.size else parent

    def upto(self, size: int) -> Path:
        path = self
        while path.size > size:
            path = path.jump if path.jump.size >= size else path.parent
        return path

    def __lt__(self, other: Path) -> bool:
        size = min(self.size, other.size)
        a, b = self.upto(size), other.upto(size)
        if a is b:
            return self.size < other.size
        while a.parent is not b.parent:
            a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.parent, b.parent)
        return a.piece < b.piece

    def ids(self) -> tuple[int, ...]:
        """From the start of the link."""
        out, path = [], self
        while path.size:
            out.append(path.piece)
            path = path.parent
        return tuple(out)


class _Index(dict):
    def __missing__(self, link: str) -> int:
        number = self[link] = len(self)
        self.new.append(link)
        self.chars += len(link)
        return number


class Segmenter:
    """N-best segmentations of texts; remembers the links it has searched."""

    def __init__(self, model_bytes: bytes, n: int):
        self.lattice, self.n = Lattice(model_bytes), n
        self.clear()

    def clear(self) -> None:
        self.index, self.others = _Index(), {}
        self.index.new, self.index.chars = [], 0
        self.arrays = None
        self.score, self.cost, self.start, self.size, self.pool = map(array, "ddqqI")

    def _learn(self) -> None:
        new, self.index.new = self.index.new, []
        self.arrays = None  # the arrays below cannot grow while numpy looks at them
        for link in new:
            score, ids, cost = self.lattice.best_path(link)
            self.score.append(score), self.cost.append(cost)
            self.start.append(len(self.pool)), self.size.append(len(ids))
            self.pool.extend(ids)
        self.arrays = tuple(np.array([]) if not x else np.frombuffer(x, dtype=x.typecode)
                            for x in (self.score, self.cost, self.start, self.size, self.pool))

    def encode(self, texts: list[str | None]) -> list[list[tuple[float, np.ndarray]]]:
        """For each whole text up to n best (score, ids), best first."""
        found = self.encode_normalized([self.lattice.normalize(t) if t else "" for t in texts])
        return [[(score, ids) for score, ids, _ in ways] for ways in found]

    def encode_normalized(self, texts: list[str]) -> list[list[tuple[float, np.ndarray, bool]]]:
        """(score, ids, whether the links that differ from the first way's decode to their
        text), up to n for each text."""
        if len(self.index) > LINK_CACHE or self.index.chars > CACHE_CHARS:
            self.clear()
        links = [self.lattice.links.findall(t) for t in texts]
        numbers = [np.fromiter(map(self.index.__getitem__, x), np.int64, len(x)) for x in links]
        self._learn()
        return [self._text(x, k) if x else [(0.0, np.zeros(0, np.uint32), True)] for x, k in zip(links, numbers)]

    def _text(self, links: list[str], numbers: np.ndarray) -> list[tuple[float, np.ndarray, bool]]:
        score, cost, start, size, pool = self.arrays
        size = size[numbers]
        ends = np.cumsum(size)
        ids = pool[np.repeat(start[numbers] - (ends - size), size) + np.arange(int(ends[-1]))]
        base, costs = float(score[numbers].sum()), cost[numbers]
        # The n - 1 cheapest single changes suffice: a change elsewhere costs at least as
        # much as each of those alone.
        few = min(self.n - 1, len(costs))
        bound = np.partition(costs, few - 1)[few - 1] if few else -1.0
        cheap = np.flatnonzero(costs <= bound)
        cheap = cheap[np.argsort(costs[cheap], kind="stable")][:few]
        choices = {int(k): self._others(links[k]) for k in cheap if np.isfinite(costs[k])}
        out, seen, heap = [], {()}, [(0.0, ())]  # (cost, ((link, alternative), ...))
        while heap and len(out) < self.n:
            spent, change = heapq.heappop(heap)
            parts, at, same = [], 0, True
            for k, alternative in change:
                parts += [ids[at:ends[k] - size[k]], choices[k][alternative][1]]
                same = same and choices[k][alternative][2]
                at = ends[k]
            out.append((base - spent, np.concatenate([*parts, ids[at:]]) if change else ids, same))
            chosen = dict(change)
            for k, found in choices.items():
                alternative = chosen.get(k, -1) + 1
                if alternative < len(found):
                    key = tuple(sorted((chosen | {k: alternative}).items()))
                    if key not in seen:
                        seen.add(key)
                        heapq.heappush(heap, (sum(choices[w][a][0] for w, a in key), key))
        return out

    def _others(self, link: str) -> list[tuple[float, np.ndarray, bool]]:
        """(cost, ids, whether they decode to the link) of a link's paths after its best."""
        if link not in self.others:
            got = self.lattice.n_best(link, self.n)
            ways = [(got[0][0] - s, np.array(ids, np.uint32)) for s, ids in got[1:]]
            self.index.chars += len(link) * len(got)
            self.others[link] = [(cost, ids, self._pieces(ids) == link) for cost, ids in ways]
        return self.others[link]

    def decode(self, ids) -> str:
        """The normalised text of ``ids``, marks as spaces and without the first mark."""
        text = self._pieces(ids)
        if self.lattice.add_mark and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")

    def _pieces(self, ids) -> str:
        """The pieces of ``ids`` joined, runs of byte pieces as the text of their bytes."""
        ids = np.asarray(ids, dtype=np.int64)
        if not self.lattice.high_byte[ids].any():
            return "".join(map(self.lattice.plain.__getitem__, ids.tolist()))
        out, run = [], bytearray()
        for k in ids:
            byte = self.lattice.byte_of.get(int(k))
            if byte is not None:
                run.append(byte)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.lattice.text[int(k)])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)


def segment_documents(docs: DataFrame, model_path: str, n: int = N_BEST, with_pieces: bool = False) -> DataFrame:
    """A row for each document and rank (from 1): score, n_pieces, ids_crc32, round_trip
    (decoding gives the normalised text back) and, if asked for, ids and pieces."""
    with open(model_path, "rb") as file:
        model = file.read()

    def make():
        # A worker keeps its segmenter; the model is part of the name.
        segmenter = worker_cache(f"segmenter_{zlib.crc32(model)}_{n}", lambda: Segmenter(model, n))
        lattice = segmenter.lattice

        def run(part: dict) -> dict:
            out = {c: [] for c in ("doc_id", "rank", "score", "n_pieces", "ids_crc32", "round_trip", "ids", "pieces")}
            marked = [lattice.normalize(t) if t else "" for t in part["text"]]
            for doc_id, text, found in zip(part["doc_id"], marked, segmenter.encode_normalized(marked)):
                plain = text.replace(MARK, " ")
                if lattice.add_mark and plain.startswith(" "):
                    plain = plain[1:]
                first = segmenter.decode(found[0][1]) == plain
                for rank, (score, ids, same) in enumerate(found, 1):
                    out["doc_id"].append(doc_id), out["rank"].append(rank), out["score"].append(score)
                    out["n_pieces"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    # Beyond the links that differ, the ids are the first way's, just decoded.
                    out["round_trip"].append((first and same) if first or rank == 1 else segmenter.decode(ids) == plain)
                    if with_pieces:
                        out["ids"].append(ids.astype(np.int32))
                        out["pieces"].append([lattice.text[k] for k in ids])
            return out
        return run
    schema = "doc_id long, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean"
    schema += ", ids array<int>, pieces array<string>" if with_pieces else ""
    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)


def segment_query(documents: DataFrame) -> DataFrame:
    """Query ``op5_sentencepiece``: the N best segmentations of every whole text."""
    import public_tokenizers

    return segment_documents(documents, public_tokenizers.path("piece_bpe_32k.model"))
