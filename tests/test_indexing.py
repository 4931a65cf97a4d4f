from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StringIndexer

from wayfare.operators.indexing import build_label_index


def _expected(labels):
    counts = Counter(x for x in labels if x is not None)
    order = sorted(counts, key=lambda x: (-counts[x], x))
    return {lab: i for i, lab in enumerate(order)}


def test_ties_break_by_label_ascending(spark):
    labels = ["b", "a", "c", "c", "10", "2", "2", "10"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    idx = build_label_index(df, "label", "index", num_partitions=3)
    got = {r.label: r["index"] for r in idx.table.collect()}
    assert got == {"10": 0, "2": 1, "c": 2, "a": 3, "b": 4}
    assert idx.size == 5


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from([f"u{i}" for i in range(40)])), min_size=1, max_size=200),
       st.integers(min_value=1, max_value=7))
def test_index_is_a_bijection_in_frequency_order(spark, labels, parts):
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    idx = build_label_index(df, "label", "index", num_partitions=parts)
    got = {r.label: r["index"] for r in idx.table.collect()}
    exp = _expected(labels)
    assert got == exp
    assert sorted(got.values()) == list(range(len(exp)))
    assert idx.size == len(exp)


def test_matches_string_indexer(spark):
    labels = [f"p{(i * 7919) % 97}" for i in range(600)] + [f"p{i}" for i in range(30)]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    model = StringIndexer(inputCol="label", outputCol="ix", handleInvalid="skip").fit(df)
    ref = {lab: i for i, lab in enumerate(model.labels)}
    got = {r.label: r["index"] for r in build_label_index(df, "label", "index", num_partitions=5).table.collect()}
    assert got == ref
