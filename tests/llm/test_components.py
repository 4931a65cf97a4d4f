import random

from tests.llm.helpers import components
from wayfare.llm.shared import Scratch, connected_components


def test_graphs_of_many_shapes(spark):
    rnd = random.Random(4)
    order = list(range(1000, 1200))
    rnd.shuffle(order)
    edges = list(zip(order, order[1:]))                                    # a long path in random order
    edges += [(2000, 2000 + k) for k in range(1, 300)]                     # a star
    edges += [(3000 + rnd.randrange(200), 3000 + rnd.randrange(200)) for _ in range(150)]
    edges += [(5, 5), (9, 7), (7, 9), (9, 7)]                              # loops and repeats
    rnd.shuffle(edges)
    df = spark.createDataFrame([(b, a) if k % 2 else (a, b) for k, (a, b) in enumerate(edges)], "u long, v long")
    got = connected_components(Scratch(spark, "test"), df.repartition(5)).collect()
    real = [(a, b) for a, b in edges if a != b]
    want = components({n for edge in real for n in edge}, real)
    assert sorted(map(tuple, got)) == sorted(want.items())
    assert connected_components(Scratch(spark, "test"), df.limit(0)).collect() == []
