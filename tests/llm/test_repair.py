import hashlib
import heapq
import random
import re
import time
import zlib
from collections import defaultdict

from tests.llm.helpers import read, sql_rows
from wayfare.llm.oracles import repair_sql
from wayfare.llm.repair import CLOSING, FOLLOW, STATES, Segment, damaged_rows, joined, ranked, repair_conversations, repair_query
from wayfare.llm.repair import states_along
from wayfare.llm.shared import Scratch

CONVS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NOT_SPACE = re.compile("[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, repaired) by uniform-cost search over whole edit strings.

    rows: (role, text, must, cut)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, k, roles, out = heapq.heappop(heap)
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, list(out)
        # Only what may still be completed matters, and the least string reaches it first.
        state = (k, roles[:1] == "s" and len(roles) == 1, roles[-1:])
        if (state, cost) in done and any(s == state for s, _ in done):
            continue
        done.add((state, cost))
        options = [("I", k, "u", "user:", 2), ("I", k, "a", "assistant:", 2)]
        if k < len(rows):
            role, text, must, cut = rows[k]
            options.append(("D", k + 1, "", None, 3))
            if not must:
                options += [("K", k + 1, role[:1], f"{role}:{text}", cut), ("R", k + 1, "u", f"user:{text}", 2 + cut),
                            ("R", k + 1, "a", f"assistant:{text}", 2 + cut)]
        for edit, next_k, letter, item, more in options:
            grown = roles + letter
            if re.fullmatch("s?(ua)*u?", grown) and (letter or edit == "D"):
                heapq.heappush(heap, (cost + more, audit + edit, next_k, grown, out if item is None else (*out, item)))


def brute(rows):
    by_id = defaultdict(list)
    ids = {r[0] for r in rows}
    space = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by_id[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv in ids:
        own = sorted(by_id[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in own:
            found = NOT_SPACE.findall(text)
            faults.append("blank" if not found else "duplicate" if (role, text) in seen else
                          "truncated" if found[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in own]
        illegal = sum((a, b) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(initials, initials[1:]))
        cost, audit, items = cheapest([(role, text, f in ("blank", "duplicate"), int(f == "truncated"))
                                       for (_, role, text), f in zip(own, faults)])
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                    hashlib.sha256("\n".join(items).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    got = repair_query(spark.createDataFrame(rows, CONVS))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def random_segment(rnd, most):
    n = rnd.randint(1, most)
    must = [rnd.random() < 0.25 for _ in range(n)]
    return Segment(must, [not m and rnd.random() < 0.3 for m in must], [rnd.choice(["u", "a", "u", "a", "s", "x", ""]) for _ in must])


def by_rows(segment):
    """(cost, string) of every way from state to state, row by row (dynamic programming)."""
    table = {(a, b): None for a in STATES for b in STATES}
    for a in STATES:
        now = {a: (0, "")}
        for k in range(segment.n):
            for _ in range(3):
                for state, (cost, audit) in list(now.items()):
                    put = 3 if state == 2 else 2
                    if (cost + 2, audit + "I") < now.get(put, (1 << 60, "")):
                        now[put] = (cost + 2, audit + "I")
            after = {}
            for state, (cost, audit) in now.items():
                ways = [(state, 3, "D")]
                if not segment.must[k]:
                    ways.append((3 if state == 2 else 2, 2 + segment.cut[k], "R"))
                    if (state, segment.initials[k]) in FOLLOW:
                        ways.append((FOLLOW[state, segment.initials[k]], int(segment.cut[k]), "K"))
                for b, more, edit in ways:
                    after[b] = min(after.get(b, (1 << 60, "")), (cost + more, audit + edit))
            now = after
        for b, way in now.items():
            table[a, b] = way
    return table


def test_search_equals_dynamic_programming():
    rnd = random.Random(1)
    for _ in range(400):
        segment = random_segment(rnd, 9)
        table = by_rows(segment)
        for a in STATES:
            for b in STATES:
                assert segment.search(a, b) == table[a, b], (segment.must, segment.cut, segment.initials, a, b)
        ends = [(w[0] + CLOSING[b][0], w[1] + CLOSING[b][1]) for b in STATES if (w := table[0, b])]
        assert segment.search(0) == min(ends)


def test_joined_segments_equal_one():
    rnd = random.Random(2)
    for _ in range(150):
        parts = [random_segment(rnd, 5) for _ in range(rnd.randint(2, 5))]
        one = Segment(*[sum((getattr(p, f) for p in parts), []) for f in ("must", "cut", "initials")])
        ways = [[p.search(a, b) for a in STATES for b in STATES] for p in parts]
        costs, ranks, choices = joined([([-1 if w is None else w[0] for w in row], ranked([w and w[1] for w in row])) for row in ways])
        whole = [one.search(a, b) for a in STATES for b in STATES]
        assert costs == [-1 if w is None else w[0] for w in whole]
        assert ranks == ranked([w and w[1] for w in whole])
        for k, way in enumerate(whole):
            if way:
                along = states_along(choices, k // 4, k % 4)
                assert "".join(row[4 * a + b][1] for row, a, b in zip(ways, along, along[1:])) == way[1]


def test_bound_never_exceeds_the_cost():
    rnd = random.Random(3)
    for _ in range(300):
        segment = random_segment(rnd, 8)
        for k in range(segment.n):
            rest = Segment(segment.must[k:], segment.cut[k:], segment.initials[k:])
            for state in STATES:
                assert segment.least(k, state, None) <= rest.search(state)[0]


def test_table(spark):
    check(spark, [tuple(r) for r in read(spark, "conversations", "sf0.01").select("conv_id", "turn", "role", "text").collect()])


def odd_rows():
    rows = [(None, None, None, None), (None, 1, "user", "Hello."), (None, 2, "assistant", "Yes!"), (5, None, "user", "a."),
            (5, 0, None, "b"), (5, 0, "", "c."), (5, 3, "tool", "d. "), (5, 3, "user", "d. "), (5, 3, "user", "d. "),
            (6, 0, "system", "\t\v\f\r\n "), (6, 10, "assistant", "é。"), (6, 11, "user", "🙂?"), (6, -4, "user", "x " * 30_000),
            (7, 1 << 40, "user", "u."), (7, -(1 << 40), "assistant", "a.")]
    rnd = random.Random(4)
    for conv in range(100, 160):
        rows += [(conv, k, rnd.choice(["user", "assistant", "system", "assistant", "user"]),
                  rnd.choice(["One.", "Two", "Three!", " ", "Four? "])) for k in range(rnd.randint(1, 7))]
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    check(spark, rows)
    assert repair_query(spark.createDataFrame([], CONVS)).collect() == []
    extra = spark.createDataFrame(rows, CONVS).selectExpr("*", "1 AS block", "2 AS seq", "3 AS audit", "4 AS _kind")
    assert sorted(map(tuple, repair_query(extra).collect()), key=str) == brute(rows)
    gone = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    check(spark, gone)


def test_cut_conversations(spark):
    """Small segments and several rounds of joining; one conversation holds half of all rows
    and equal rows are spread over partitions."""
    rnd = random.Random(5)
    rows = odd_rows() + [(900, k % 150, rnd.choice(["user", "assistant"]), rnd.choice(["Same.", f"t{k}.", f"t{k}", ""]))
                         for k in range(300)]
    got = repair_conversations(damaged_rows(spark.createDataFrame(rows, CONVS)), Scratch(spark, "repair_test"),
                               segment_bits=2, join_bits=1)
    # A conversation that the damage leaves no rows of is put back by the query.
    want = {r[0]: r for r in brute(rows)}
    found = got.select(*COLUMNS).collect()
    assert len(found) > 50
    for row in found:
        assert tuple(row) == want[row.conv_id]


def test_a_long_damaged_segment_is_quick():
    rnd = random.Random(6)
    must = [rnd.random() < 0.2 for _ in range(256)]
    for letters in ("ua", "u", "uas"):
        segment = Segment(must, [not m and rnd.random() < 0.3 for m in must], [rnd.choice(letters) for _ in must])
        start = time.time()
        for a in STATES:
            for b in STATES:
                segment.search(a, b)
        assert time.time() - start < 20


def test_sql_on_odd_rows():
    rows = [r for r in odd_rows() if not (r[3] and len(r[3]) > 1000)]
    columns, found = sql_rows(repair_sql(), rows)
    assert columns == COLUMNS and sorted(found, key=str) == brute(rows)
