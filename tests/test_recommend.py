import numpy as np
import pyarrow as pa
import pytest

from wayfare.operators import _scoring, recommend
from wayfare.operators._scoring import merge_top, unpack
from wayfare.operators.recommend import _item_blocks, fit_als, make_als, recommend_top_n, score_top_n, seen_bitmaps
from wayfare.plans.inspect import physical_plan


def _brute(ids, mat, feats, n, seen=()):
    out = []
    for row, f in enumerate(feats):
        s = mat @ f
        order = [j for j in sorted(range(len(ids)), key=lambda j: (-s[j], ids[j])) if (row, ids[j]) not in seen][:n]
        out.append([(float(s[j]), int(ids[j])) for j in order])
    return out


def test_top_n_exact_with_ties_seen_items_and_blocks():
    rng = np.random.default_rng(0)
    for n_items in (3, 12, 500):
        ids = np.arange(n_items, dtype=np.int64) * 3
        mat = rng.integers(-1, 2, size=(n_items, 4)).astype(np.float64)  # many exact ties
        feats = rng.integers(-1, 2, size=(30, 4)).astype(np.float32)
        pairs = [(int(r), int(i)) for r, i in zip(rng.integers(0, 30, 200), rng.choice(ids, 200))]
        hidden = np.zeros((30, n_items), dtype=bool)
        for r, i in pairs:
            hidden[r, i // 3] = True
        want = _brute(ids, mat, feats, 5, set(pairs))
        for block in (n_items, 7, 1):  # one block or many: the same answer
            best = np.zeros((30, 5), dtype=np.uint64)
            for at in range(0, n_items, block):
                best = merge_top(feats, ids[at:at + block], mat[at:at + block], 5, best, hidden[:, at:at + block])
            got = [[(float(s), int(i)) for s, i in zip(*unpack(row[row != 0]))] for row in best]
            assert got == want
    with pytest.raises(ValueError):
        merge_top(np.array([[np.inf]], dtype=np.float32), np.array([1]), np.array([[1.0]]), 1)


def test_blocks_are_a_parameter_of_the_fit_alone(spark):
    assert make_als().getNumUserBlocks() == make_als().getNumItemBlocks() == 10
    assert make_als(num_blocks=3).getNumUserBlocks() == 3


def _items(recs):
    out = {}
    for r in recs.collect():
        out.setdefault(r.user_index, {})[r["rank"]] = r.item_index
    return out


def test_partitioning_and_block_size_do_not_change_the_items(spark):
    rows = [(u, i, float(1 + (u * i) % 4)) for u in range(40) for i in range(25) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user_index int, item_index int, rating float")
    one = _items(recommend_top_n(fit_als(df.repartition(1), max_iter=5, rank=6), 5))
    many = _items(recommend_top_n(fit_als(df.repartition(9), max_iter=5, rank=6), 5, block_bytes=4 * 6 * 4))
    assert one == many and len(one) == 40 and all(len(v) == 5 for v in one.values())


def test_tied_items_give_the_lower_id_at_any_block_size(spark):
    rows = [(u, i + 12 * copy, float(1 + (u * i) % 3)) for u in range(30) for i in range(12) if (u + i) % 2
            for copy in range(2)]
    model = fit_als(spark.createDataFrame(rows, "user_index int, item_index int, rating float"), max_iter=3, rank=4)

    class Twins:  # every item's factors twice, so that all scores tie in pairs
        userFactors = model.userFactors
        itemFactors = model.itemFactors.filter("id < 12").unionByName(
            model.itemFactors.filter("id < 12").selectExpr("id + 12 as id", "features"))
    rows = recommend_top_n(Twins, 6).orderBy("user_index", "rank").collect()
    assert _items(recommend_top_n(Twins, 6, block_bytes=64)) == _items(recommend_top_n(Twins, 6))
    pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a.user_index == b.user_index]
    assert all((-a.score, a.item_index) < (-b.score, b.item_index) for a, b in pairs)
    assert sum(a.score == b.score for a, b in pairs) >= 3 * 30


def test_scoring_matches_mllib(spark):
    rows = [(u, i, float(1 + (u * i) % 4)) for u in range(40) for i in range(25) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user_index int, item_index int, rating float")
    model = fit_als(df, max_iter=5, rank=6)
    ours = {}
    for r in recommend_top_n(model, 5).orderBy("user_index", "rank").collect():
        ours.setdefault(r.user_index, []).append(r.score)
    theirs = {r.user_index: [x.rating for x in r.recommendations] for r in model.recommendForAllUsers(5).collect()}
    assert set(ours) == set(theirs) and len(ours) == 40
    for u in ours:
        assert np.allclose(ours[u], theirs[u], rtol=1e-5, atol=1e-5)


def test_full_job_publishes_and_evaluates(spark, tmp_path):
    import datetime as dt

    import __spark_entry__ as ent
    from wayfare.plans.job import run_recommendation_job
    from wayfare.sources.readers import scan_recommendations

    from conftest import SF_SMALL
    target = str(tmp_path / "recs")
    run = run_recommendation_job(ent._events(spark, SF_SMALL), ent._lookup(spark, SF_SMALL),
                                 as_of="2024-01-31 00:00:00", lookback_days=30, evaluate=True,
                                 target=target, max_iter=5)
    back = scan_recommendations(spark, target)
    rows = back.collect()
    assert len(rows) == 5 * run.index.user_index.size
    now_tehran = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=3, minutes=30)
    assert {abs((r.generated_at - now_tehran).total_seconds()) < 300 for r in rows} == {True}
    rep = run.evaluation.collect()
    assert len(rep) == 1 and 0.0 <= rep[0].model_mrr <= rep[0].model_hit_rate <= 1.0
    run.release()


def test_default_as_of_is_now(spark):
    import __spark_entry__ as ent
    from wayfare.functions.scalar import utc_now
    from wayfare.operators.interactions import interaction_strength

    from conftest import SF_SMALL
    # The test data is from January 2024: a 90-day window ending now holds none of it.
    assert interaction_strength(ent._events(spark, SF_SMALL), utc_now()).count() == 0


def test_exclude_seen_is_exact(spark):
    rows = [(u, i, float(1 + (u * i) % 4)) for u in range(30) for i in range(12) if (u + 2 * i) % 3]
    df = spark.createDataFrame(rows, "user_index int, item_index int, rating float")
    model, seen = fit_als(df, max_iter=5, rank=6), df.select("user_index", "item_index")
    pairs = {(r.user_index, r.item_index) for r in seen.collect()}
    whole = _items(recommend_top_n(model, 5, seen=seen))
    assert whole == _items(recommend_top_n(model, 5, seen=seen, block_bytes=4 * 6 * 5))
    for u, items in whole.items():
        assert not any((u, i) in pairs for i in items.values())
        assert len(items) == min(5, 12 - sum(1 for v, _ in pairs if v == u))


def test_scoring_runs_where_the_package_is_not_installed(tmp_path):
    """Executors need no copy of the package: the task-side code is pickled by value."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "probe.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from wayfare.operators.recommend import fit_als, recommend_top_n
df = spark.createDataFrame([(u, i, 1.0) for u in range(6) for i in range(5) if (u + i) % 2],
                           "user_index int, item_index int, rating float")
rows = recommend_top_n(fit_als(df, max_iter=2, rank=3), 2).collect()
print("ROWS", len(rows))
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=300)
    assert "ROWS 12" in out.stdout, out.stderr[-2000:]


def _factors(spark, vectors):
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in vectors.items()], "id int, features array<float>")


def _check_top_n(users, items, got, n, seen=()):
    ids = sorted(items)
    mat = np.array([items[i] for i in ids], dtype=np.float32).astype(np.float64)
    for u, f in users.items():
        scores = (mat @ np.array(f, dtype=np.float32).astype(np.float64)).astype(np.float32)
        want = [ids[j] for j in sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j])) if (u, ids[j]) not in seen][:n]
        assert [got.get(u, {}).get(r) for r in range(1, len(want) + 1)] == want and len(got.get(u, {})) == len(want)


def test_users_stop_at_the_block_that_cannot_matter(spark):
    """Few long items and many short ones: after the first blocks nobody goes on, and the
    items are those of one pass, ties included."""
    rng = np.random.default_rng(4)
    items = {int(k) * 7: rng.integers(-2, 3, 4) * (40 if k < 30 else 1) for k in range(400)}
    users = {u: rng.integers(-2, 3, 4) for u in range(60)}
    users[60] = np.zeros(4)  # scores nothing: every item ties, so every block may matter
    uf, itf = _factors(spark, users), _factors(spark, items)
    scored = []
    got = _items(score_top_n(uf, itf, 5, block_bytes=4 * 4 * 20, scored=scored))
    _check_top_n(users, items, got, 5)
    assert scored[0] == 61 and scored[2] < 61 and scored[-1] >= 1 and len(scored) == 20
    scored = []
    few = _items(score_top_n(uf.filter("id < 60"), itf, 5, block_bytes=4 * 4 * 20, scored=scored))
    assert few == {u: v for u, v in got.items() if u < 60}
    assert sum(scored) < 0.5 * 60 * 20, scored  # of the user passes that all blocks would take
    assert _items(score_top_n(uf, itf, 5)) == got


def test_seen_bitmaps_over_blocks(spark):
    rng = np.random.default_rng(5)
    items = {int(k): rng.normal(size=3) * (1 + k % 5) for k in range(90)}
    users = {u: rng.normal(size=3) for u in range(25)}
    seen = {(int(u), int(i)) for u, i in zip(rng.integers(0, 25, 900), rng.integers(0, 95, 900))}
    seen |= {(3, i) for i in range(88)} | {(4, i) for i in range(90)}  # two and no items left
    uf, itf = _factors(spark, users), _factors(spark, items)
    history = spark.createDataFrame(sorted(seen) + sorted(seen)[:50], "user_index int, item_index int")
    for block_bytes in (4 * 3 * 9, 4 * 3 * 90, 1 << 20):  # ten blocks, one, and one with room
        got = _items(score_top_n(uf, itf, 5, history, block_bytes=block_bytes))
        _check_top_n(users, items, got, 5, seen)
        assert len(got[3]) == 2 and 4 not in got
    items_of, blocks, last_id = _item_blocks(itf, 9)
    sizes = {r.n for r in seen_bitmaps(history, items_of, blocks, last_id).selectExpr("length(mask) n").collect()}
    assert sizes == {1, 2}  # nine items: two bytes at most, of the 4096 of a whole bitmap
    plan = physical_plan(seen_bitmaps(history, items_of, blocks, last_id))
    assert blocks == 10 and last_id is None and "bitmap" not in plan  # written once: passes read their own block
    assert "block" in plan


def test_no_items_and_no_users(spark):
    none, one = spark.createDataFrame([], "id int, features array<float>"), _factors(spark, {0: [1.0]})
    assert score_top_n(one, none, 3).collect() == [] and score_top_n(none, one, 3).collect() == []
    assert len(score_top_n(one, one, 3).collect()) == 1


def _block(spark, items):
    return _scoring.item_block(_factors(spark, items).selectExpr("id", "id as slot", "features").toArrow(), 16)


def test_leaves_that_cannot_matter_are_passed_over(spark, monkeypatch):
    """Close items: few exact products a user, and the items of a full comparison; items
    without any order, ties, short and zero users give those too."""
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(40, 6)) * 5
    close = {k: centers[k % 40] + rng.normal(size=6) * 0.01 for k in range(2000)}
    apart = {k: rng.normal(size=6) * (1 + k % 3) for k in range(700)}
    tied = {k: rng.integers(-2, 3, 6) for k in range(900)}
    users = np.concatenate([rng.normal(size=(50, 6)), rng.integers(-2, 3, (20, 6)), np.zeros((1, 6)), rng.normal(size=(3, 6)) * 1e-30,
                            rng.normal(size=(3, 6)) * 1e30]).astype(np.float32)
    whole = _scoring.merge_top
    for items in (close, apart, tied):
        block = _block(spark, items)
        assert sorted(block.ids) == sorted(items) and np.diff(block.starts).max() <= 16
        cells = []
        monkeypatch.setattr(_scoring, "merge_top", lambda f, i, *rest: cells.append(len(f) * len(i)) or whole(f, i, *rest))
        for part in (users, users[:50]):
            cells.clear()
            got = _scoring.best_of_block(part, block, 5, np.zeros((len(part), 5), np.uint64))
            assert (got == whole(part, block.ids, block.factors, 5)).all()
        if items is close:
            assert sum(cells) < 0.1 * 50 * 2000
        masks = [rng.integers(0, 256, int(rng.integers(0, 90)), dtype=np.uint8).tobytes() if u % 3 else None for u in range(50)]
        hidden = np.array([[m is not None and s // 8 < len(m) and bool(m[s // 8] >> (s % 8) & 1) for s in block.slots] for m in masks])
        got = _scoring.best_of_block(users[:50], block, 5, np.zeros((50, 5), np.uint64), _scoring._Masks(pa.array(masks, pa.binary())))
        assert (got == whole(users[:50], block.ids, block.factors, 5, None, hidden)).all()


def test_users_are_dealt_to_tasks_of_bounded_work(spark, monkeypatch):
    rng = np.random.default_rng(7)
    items = {k: rng.normal(size=3) for k in range(50)}
    users = {u: rng.normal(size=3) for u in range(200)}
    uf, itf = _factors(spark, users).coalesce(1), _factors(spark, items)
    assert "Exchange" not in physical_plan(score_top_n(uf, itf, 5))
    monkeypatch.setattr(recommend, "PAIRS_A_TASK", 50 * 200 // 8)
    recs = score_top_n(uf, itf, 5)
    assert recs.rdd.getNumPartitions() == 8
    _check_top_n(users, items, _items(recs), 5)
