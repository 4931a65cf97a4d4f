"""Cheapest repair of damaged conversations (``op12_repair``).

A conversation is edited row by row (keep, change the role, delete, insert before) until the
initials of its roles read ``(s?(ua)+)?``. The cheapest edits, ties to the least string of
their initials, are found by iterative-deepening A*: a depth-first search that tries edits
in ASCII order under a cost bound that grows by one, with a table of the budgets known to
fail at each (row, state). The lower bound on what remains counts the rows that must go, the
rows without an end mark, and two for every two neighbouring pairs in a run that do not fit (an
odd one counts as two): no edit mends more of these than it costs.

A conversation of any length is cut into segments of a bounded number of rows, solved for
every state before and after it. As no insert ends a segment, no string of edits of a segment
is the start of another, so a segment's strings can be replaced by their ranks, and segments
are joined by sums of costs and pairs of ranks, many at a time, up to one row for each
conversation; the way chosen there is followed back down to the segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.shared import Scratch

SEGMENT_BITS = 8      # rows of a segment: 256
JOIN_BITS = 10        # segments joined at a time: 1024
SPACE = " \t\n\v\f\r"
HEAD_CHARS = 64

# States: nothing yet, after s, after u, after a.
STATES = (0, 1, 2, 3)
FOLLOW = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}     # the one role that may be put in
PUT = {0: 2, 1: 2, 2: 3, 3: 2}                                # the state after it
CLOSING = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}
GOOD_PAIRS = {("s", "u"), ("u", "a"), ("a", "u")}
NEVER = 1 << 40


class Segment:
    """Rows as lists: ``must`` (has to be deleted), ``cut`` (no end mark) and initials."""

    def __init__(self, must: list[bool], cut: list[bool], initials: list[str]):
        self.must, self.cut, self.initials, self.n = must, cut, initials, len(must)
        stay = [k for k in range(self.n) if not must[k]]
        self.before = [0] * (self.n + 1)                       # surviving rows before row k
        self.due = [0] * (self.n + 1)                          # certain cost from row k on
        for k in range(self.n):
            self.before[k + 1] = self.before[k] + (not must[k])
        for k in range(self.n - 1, -1, -1):
            self.due[k] = self.due[k + 1] + (3 if must[k] else int(cut[k]))
        self.letters = [initials[k] for k in stay]
        self.tails = {end: self._runs(end) for end in (False, True)}
        self.last_s = max((k for k in stay if initials[k] == "s"), default=-1)

    def _runs(self, end: bool) -> tuple[list[int], list[int]]:
        """For each surviving row: how many pairs in a row from it on do not fit (the end
        of the conversation is a neighbour if ``end``), and the cost of those after."""
        m = len(self.letters)
        run, rest = [0] * (m + 1), [0] * (m + 1)
        for j in range(m - 1, -1, -1):
            bad = (self.letters[j], self.letters[j + 1]) not in GOOD_PAIRS if j + 1 < m else end and self.letters[j] != "a"
            if bad:
                run[j], rest[j] = run[j + 1] + 1, rest[j + 1]
            else:
                run[j], rest[j] = 0, rest[j + 1] + 2 * ((run[j + 1] + 1) // 2)
        return run, rest

    def least(self, k: int, state: int, goal: int | None) -> int:
        """No way on from row ``k`` in ``state`` costs less; ``goal`` None is the end."""
        left = self.n - k
        if goal in (0, 1):
            if state == goal:
                return 3 * left
            return 3 * (left - 1) if (state, goal) == (0, 1) and self.last_s >= k else NEVER
        j = self.before[k]
        if j == len(self.letters):
            if goal is None:
                return self.due[k] + CLOSING[state][0]
            return self.due[k] if state == goal or left else NEVER
        run, rest = self.tails[goal is None]
        bad = run[j] + ((state, self.letters[j]) not in FOLLOW)
        return self.due[k] + 2 * ((bad + 1) // 2) + rest[j]

    def edits(self, k: int, state: int, goal: int | None) -> list[tuple[str, int, int, int]]:
        """(initial, next row, next state, cost) in ASCII order."""
        out = []
        if k < self.n:
            out.append(("D", k + 1, state, 3))
        if k < self.n or goal is None:
            out.append(("I", k, PUT[state], 2))
        if k < self.n and not self.must[k]:
            kept = FOLLOW.get((state, self.initials[k]))
            if kept is not None:
                out.append(("K", k + 1, kept, int(self.cut[k])))
            out.append(("R", k + 1, PUT[state], 2 + self.cut[k]))
        return out

    def search(self, start: int, goal: int | None = None) -> tuple[int, str] | None:
        """(cost, initials) of the cheapest edits from ``start`` to state ``goal`` without
        an insert after the last row, or (None) to a finished conversation."""
        goals = (0, 3) if goal is None else (goal,)
        bound = self.least(0, start, goal)
        if bound >= NEVER:
            return None
        if not self.n and start in goals:
            return 0, ""
        failed: dict[tuple[int, int], int] = {}
        while True:
            stack, initials = [(0, start, 0, iter(self.edits(0, start, goal)))], []
            while stack:
                k, state, spent, options = stack[-1]
                for initial, next_k, next_state, cost in options:
                    total = spent + cost
                    if total + self.least(next_k, next_state, goal) > bound:
                        continue
                    if next_k == self.n and next_state in goals:
                        return total, "".join(initials) + initial
                    if failed.get((next_k, next_state), -1) >= bound - total:
                        continue
                    initials.append(initial)
                    stack.append((next_k, next_state, total, iter(self.edits(next_k, next_state, goal))))
                    break
                else:
                    failed[k, state] = max(failed.get((k, state), -1), bound - spent)
                    stack.pop()
                    if initials:
                        initials.pop()
            bound += 1


def repaired(start: int, audit: str, roles: list[str], texts: list[str]) -> list[str]:
    """``role:text`` of the rows that the edits leave, in order."""
    out, k, state = [], 0, start
    for edit in audit:
        if edit == "I":
            out.append(f"{ROLE[state]}:")
            state = PUT[state]
            continue
        if edit == "K":
            out.append(f"{roles[k]}:{texts[k]}")
            state = FOLLOW[state, roles[k][:1]]
        elif edit == "R":
            out.append(f"{ROLE[state]}:{texts[k]}")
            state = PUT[state]
        k += 1
    return out


def ranked(keys: list) -> list[int]:
    """The place of each key among the distinct ones; None has none."""
    order = {key: place for place, key in enumerate(sorted({k for k in keys if k is not None}))}
    return [-1 if key is None else order[key] for key in keys]


def joined(tables: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int], list[list[int]]]:
    """Costs and ranks of neighbouring segments as one (16 values each, 4 x state before +
    state after; a cost of -1: no way), and for each joint the state chosen there."""
    costs, ranks = tables[0]
    choices = []
    for more_costs, more_ranks in tables[1:]:
        best = []
        for before in STATES:
            for after in STATES:
                ways = [(costs[4 * before + mid] + more_costs[4 * mid + after],
                         (ranks[4 * before + mid], more_ranks[4 * mid + after]), mid) for mid in STATES
                        if costs[4 * before + mid] >= 0 and more_costs[4 * mid + after] >= 0]
                best.append(min(ways) if ways else (-1, None, -1))
        costs, ranks = [b[0] for b in best], ranked([b[1] for b in best])
        choices.append([b[2] for b in best])
    return costs, ranks, choices


def states_along(choices: list[list[int]], before: int, after: int) -> list[int]:
    """The states before each segment and after the last one."""
    out = [after]
    for choice in reversed(choices):
        out.append(choice[4 * before + out[-1]])
    return [before, *reversed(out)]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_SOLVED = pa.schema([
    ("whole", pa.bool_()), ("conv_id", pa.int64()), ("block", pa.int64()), *[(c, pa.int64()) for c in _COUNTS],
    ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
    ("repaired_sha256", pa.string()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())),
    ("audits", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
_SOLVED_DDL = ("whole boolean, conv_id long, block long, blank long, duplicate long, truncated long, illegal long, "
               "first string, last string, cost long, audit string, repaired_sha256 string, costs array<long>, "
               "ranks array<long>, audits array<string>, roles array<string>, texts array<string>")
_JOINED = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), *[(c, pa.int64()) for c in _COUNTS],
                     ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64())),
                     ("ranks", pa.list_(pa.int64()))])
_JOINED_DDL = ("conv_id long, block long, blank long, duplicate long, truncated long, illegal long, first string, "
               "last string, costs array<long>, ranks array<long>")


def damaged_rows(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that crc32 of ``conv_id:turn`` deals: one in twenty each is
    dropped, emptied, robbed of its end marks, repeated, or given to the user. A null value
    reads as one space, in the key, the role and the text."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn"))) % 20).alias("_kind")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                as_text("role").alias("role"), as_text("text").alias("text"), kind).filter("_kind <> 0")
    text = (F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (rows.select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), "_kind").withColumn("_copy", copies).drop("_kind", "_copy"))


def numbered_rows(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with ``seq``, which orders conversations and, in each, rows by turn (nulls
    first); rows of one turn go by the start of their role and text, then by digest.

    The last key spreads equal rows over range partitions, so no run of them is one task's."""
    keys = ["conv_id", "turn", "_role", "_head", "digest", "_any"]
    both = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    keyed = rows.select("*", F.substring("role", 1, HEAD_CHARS).alias("_role"), F.substring("text", 1, HEAD_CHARS).alias("_head"),
                        F.sha2(both, 256).alias("digest"), F.monotonically_increasing_id().alias("_any"))
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    return scratch.write(ordered.select("conv_id", "turn", "role", "text", "digest", (trimmed == "").alias("is_blank"),
                                        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("is_cut"),
                                        F.monotonically_increasing_id().alias("seq")), "rows")


def _marked(rows: DataFrame, segment_bits: int) -> DataFrame:
    """The rows with their block of neighbours, and after a duplicate a mark of its seq."""
    seen = (rows.filter("NOT is_blank").groupBy("conv_id", "digest")
            .agg(F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    again = (rows.filter("NOT is_blank").select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "seq")
             .join(seen, F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("_digest") == F.col("digest")))
             .filter("seq > _first").select("seq", F.lit(1).alias("mark")))
    block = F.shiftright("seq", segment_bits).alias("block")
    return (rows.select(block, "seq", F.lit(0).alias("mark"), "conv_id", "role", "text", "is_blank", "is_cut")
            .unionByName(again.select(block, "seq", "mark"), allowMissingColumns=True))


def _illegal(initials: list[str]) -> int:
    return sum(pair not in GOOD_PAIRS for pair in zip(initials, initials[1:]))


def _solve(block: int, rows: list[list], whole: bool) -> dict:
    """The result of a conversation's neighbouring rows: [conv_id, role, text, is_blank,
    is_cut, is_duplicate]."""
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    blank, twice = [r[3] for r in rows], [r[5] and not r[3] for r in rows]
    must = [a or b for a, b in zip(blank, twice)]
    cut = [r[4] and not m for r, m in zip(rows, must)]
    initials = [r[:1] for r in roles]
    out = {"whole": whole, "conv_id": rows[0][0], "block": block, "blank": sum(blank), "duplicate": sum(twice),
           "truncated": sum(cut), "illegal": _illegal(initials)}
    segment = Segment(must, cut, initials)
    if whole:
        out["cost"], out["audit"] = segment.search(0)
        out["repaired_sha256"] = hashlib.sha256("\n".join(repaired(0, out["audit"], roles, texts)).encode()).hexdigest()
        return out
    ways = [segment.search(before, after) for before in STATES for after in STATES]
    out |= {"first": initials[0], "last": initials[-1], "costs": [-1 if w is None else w[0] for w in ways],
            "ranks": ranked([None if w is None else w[1] for w in ways]),
            "audits": [None if w is None else w[1] for w in ways], "roles": roles, "texts": texts}
    return out


def _solve_block(block: int, rows: list[list]) -> Iterator[dict]:
    """Conversations that lie inside the block are whole; its first and last may go on."""
    at = 0
    while at < len(rows):
        end = at + 1
        while end < len(rows) and rows[end][0] == rows[at][0]:
            end += 1
        yield _solve(block, rows[at:end], at > 0 and end < len(rows))
        at = end


def _solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, rows = None, []
    for batch in batches:
        out = []
        for block, mark, *row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns))):
            if block != now:
                out += _solve_block(now, rows)
                now, rows = block, []
            if mark:
                rows[-1][5] = True
            else:
                rows.append([*row, False])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SOLVED)
    yield pa.RecordBatch.from_pylist(list(_solve_block(now, rows)), schema=_SOLVED)


def _sorted_group(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: r["block"])


def _join_groups(join_bits: int):
    def run(table: pa.Table) -> pa.Table:
        rows = _sorted_group(table)
        costs, ranks, _ = joined([(r["costs"], r["ranks"]) for r in rows])
        seams = sum((a["last"], b["first"]) not in GOOD_PAIRS for a, b in zip(rows, rows[1:]))
        out = {c: sum(r[c] for r in rows) for c in _COUNTS}
        out |= {"conv_id": rows[0]["conv_id"], "block": rows[0]["block"] >> join_bits, "first": rows[0]["first"],
                "last": rows[-1]["last"], "costs": costs, "ranks": ranks, "illegal": out["illegal"] + seams}
        return pa.Table.from_pylist([out], schema=_JOINED)
    return run


def _split_group(table: pa.Table) -> pa.Table:
    rows = _sorted_group(table)
    choices = joined([(r["costs"], r["ranks"]) for r in rows])[2]
    states = states_along(choices, rows[0]["before"], rows[0]["after"])
    return pa.Table.from_pylist([{"conv_id": r["conv_id"], "block": r["block"], "before": a, "after": b}
                                 for r, a, b in zip(rows, states, states[1:])],
                                schema=pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("before", pa.int32()),
                                                  ("after", pa.int32())]))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation from its segments in order, a segment at a time; only
    the edits' initials, which are part of the result, are held."""
    schema = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    started, conv, audit, state, hashed, empty = False, None, [], 0, None, True

    def add(items: list[str]) -> None:
        nonlocal empty
        if items:
            hashed.update((("" if empty else "\n") + "\n".join(items)).encode())
            empty = False

    def done() -> Iterator[pa.RecordBatch]:
        if started:
            audit.append(CLOSING[state][1])
            add(repaired(state, audit[-1], [], []))
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "audit": "".join(audit),
                                               "repaired_sha256": hashed.hexdigest()}], schema=schema)
    for batch in batches:
        for conv_id, before, after, audits, roles, texts in zip(*(batch.column(k).to_pylist() for k in range(6))):
            if not started or conv_id != conv:
                yield from done()
                started, conv, audit, hashed, empty = True, conv_id, [], hashlib.sha256(), True
            audit.append(audits[4 * before + after])
            add(repaired(before, audit[-1], roles, texts))
            state = after
    yield from done()


def _cut_conversations(solved: DataFrame, scratch: Scratch, join_bits: int) -> DataFrame:
    """(conv_id, counts, cost, audit, repaired_sha256) of conversations in several blocks."""
    parts = solved.filter("NOT whole")
    levels = [parts.select(*_JOINED.names)]
    while True:
        if levels[-1].groupBy("conv_id").count().filter("count > 1").isEmpty():
            break
        group = F.shiftright("block", join_bits)
        levels.append(scratch.write(levels[-1].groupBy("conv_id", group).applyInArrow(_join_groups(join_bits), _JOINED_DDL),
                                    "joined"))
    end = F.array_min(F.array(*[F.when(F.element_at("costs", s + 1) >= 0, F.struct(
        (F.element_at("costs", s + 1) + CLOSING[s][0]).alias("cost"), F.element_at("ranks", s + 1).alias("rank"),
        F.lit(s).alias("after"))) for s in STATES]))
    top = scratch.write(levels[-1].withColumn("_end", end).select(
        "conv_id", "block", *_COUNTS, F.col("_end.cost").alias("cost"), F.lit(0).alias("before"),
        F.col("_end.after").alias("after")), "tops")
    chosen = top.select("conv_id", "block", "before", "after")
    for level in reversed(levels[:-1]):
        above = chosen.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_above"), "before", "after")
        known = level.select("conv_id", "block", "costs", "ranks", F.shiftright("block", join_bits).alias("_group")).join(
            above, F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("_above") == F.col("_group")))
        chosen = scratch.write(known.groupBy("_conv", "_group").applyInArrow(
            _split_group, "conv_id long, block long, before int, after int"), "split")
    way = chosen.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "before", "after")
    told = (parts.join(way, F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("_block") == F.col("block")))
            .select("conv_id", "block", "before", "after", "audits", "roles", "texts")
            .repartition("conv_id").sortWithinPartitions("conv_id", "block")
            .select("conv_id", "before", "after", "audits", "roles", "texts")
            .mapInArrow(_assemble, "conv_id long, audit string, repaired_sha256 string"))
    told = told.withColumnRenamed("conv_id", "_conv")
    return top.join(told, F.col("_conv").eqNullSafe(F.col("conv_id"))).select(
        "conv_id", *_COUNTS, "cost", "audit", "repaired_sha256")


def repair_conversations(rows: DataFrame, scratch: Scratch, segment_bits: int = SEGMENT_BITS,
                         join_bits: int = JOIN_BITS) -> DataFrame:
    """One row for each conv_id (null is one too) of ``rows`` (conv_id, turn, role, text):
    blank, duplicate, truncated, illegal, cost (long), audit, repaired_sha256 and gaps.

    A role that is empty or begins with none of s, u, a fits nowhere. Null roles or texts
    are not expected (``damaged_rows`` leaves none). No rows give no rows."""
    rows = numbered_rows(rows, scratch)
    marked = _marked(rows, segment_bits)
    solved = scratch.write(marked.repartition("block").sortWithinPartitions("block", "seq", "mark")
                           .select("block", "mark", "conv_id", "role", "text", "is_blank", "is_cut")
                           .mapInArrow(_solve_blocks, _SOLVED_DDL), "solved")
    columns = ["conv_id", *_COUNTS, "cost", "audit", "repaired_sha256"]
    found = solved.filter("whole").select(*columns).unionByName(_cut_conversations(solved, scratch, join_bits))
    wide = lambda c: c.cast("decimal(20,0)")
    spans = rows.groupBy(F.col("conv_id").alias("_conv")).agg(
        (wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")).try_cast("long").alias("gaps"))
    return found.join(spans, F.col("_conv").eqNullSafe(F.col("conv_id"))).select(
        "conv_id", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), *columns[1:])


def repair_query(conversations: DataFrame) -> DataFrame:
    """Query ``op12_repair``: every conversation's faults and cheapest repair after damage."""
    scratch = Scratch(conversations.sparkSession, "repair")
    found = repair_conversations(damaged_rows(conversations), scratch).withColumnRenamed("conv_id", "_found")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("_found")), "left").select(
        "conv_id", zero("gaps"), *[zero(c) for c in _COUNTS], zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
