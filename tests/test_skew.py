"""A passenger holding a third of all events: results equal a brute force over the
same rows, and the plans keep the hot key out of any single-task bottleneck."""

import datetime as dt
import hashlib
from collections import defaultdict

from wayfare.operators.evaluate import evaluation_report, holdout_split
from wayfare.operators.indexing import index_interactions
from wayfare.operators.interactions import interaction_strength
from wayfare.plans.inspect import physical_plan

WEIGHT = {"On Time": 10, "Delayed": 6, "Cancelled": 0}
STATUSES = ["On Time", "Delayed", "Cancelled", "Boarding"]


def _events(n=3000):
    rows = []
    for e in range(n):
        user = "hot" if e % 3 == 0 else f"u{(e * 7) % 97}"
        item = str((e * 13) % 41)
        rows.append((user, item, STATUSES[(e * 5) % 4], dt.datetime(2024, 1, 20) + dt.timedelta(minutes=e)))
    return rows


def _brute(rows):
    strength = defaultdict(int)
    for u, i, s, _ in rows:
        strength[(u, i)] += WEIGHT.get(s, 3)
    inter = {k: v / 10 for k, v in strength.items() if v > 0}
    def index(pos):
        freq = defaultdict(int)
        for k in inter:
            freq[k[pos]] += 1
        return {lab: n for n, lab in enumerate(sorted(freq, key=lambda x: (-freq[x], x)))}
    return inter, index(0), index(1)


def test_hot_passenger_matches_brute_force(spark):
    rows = _events()
    df = spark.createDataFrame(rows, "passengerId string, arrivalAirport string, flightStatus string, "
                                     "timestamp timestamp_ntz")
    inter_df = interaction_strength(df, "2024-02-01 00:00:00", 30)
    assert "partial_sum" in physical_plan(inter_df)
    inter, uidx, iidx = _brute(rows)
    got = {(r.passengerId, r.arrivalAirport): r.strength for r in inter_df.collect()}
    assert got == inter
    idx = index_interactions(inter_df)
    assert {r.passengerId: r.user_index for r in idx.user_index.table.collect()} == uidx
    assert {r.arrivalAirport: r.item_index for r in idx.item_index.table.collect()} == iidx
    assert uidx["hot"] == 0

    # Hold-out: largest md5('42|user|item') per user, ties to the smaller item.
    by_user = defaultdict(list)
    for (u, i) in inter:
        by_user[uidx[u]].append(iidx[i])
    pick = {u: max(items, key=lambda i: (hashlib.md5(f"42|{u}|{i}".encode()).hexdigest(), -i))
            for u, items in by_user.items()}
    expected_test = {(u, t) for u, t in pick.items() if len(by_user[u]) >= 2}
    split = holdout_split(idx.indexed)
    assert {(r.user_index, r.true_item) for r in split.test.collect()} == expected_test
    assert "SortAggregate" in physical_plan(split.test) or "HashAggregate" in physical_plan(split.test)

    # Baseline metrics by brute force: global top-5 popularity over train, seen kept.
    import numpy as np
    rating = {(uidx[u], iidx[i]): float(np.float32(v)) for (u, i), v in inter.items()}
    train = {k: v for k, v in rating.items() if (k[0], k[1]) not in {(u, t) for u, t in pick.items()}}
    pop = defaultdict(float)
    for (u, i), v in train.items():
        pop[i] += v
    top = sorted(pop, key=lambda i: (-pop[i], i))[:5]
    ranks = [top.index(t) + 1 if t in top else None for _, t in expected_test]
    hit = sum(r is not None for r in ranks) / len(ranks)
    mrr = sum(1 / r for r in ranks if r) / len(ranks)
    rep = evaluation_report(idx.indexed).first()
    assert rep.users_evaluated == len(expected_test)
    assert abs(rep.baseline_hit_rate - hit) < 1e-12
    assert abs(rep.baseline_mrr - mrr) < 1e-12
