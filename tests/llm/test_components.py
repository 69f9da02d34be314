import random

import plain
from fieldledger.llm.common import components


def test_components_in_one_partition_and_in_many(spark):
    rng = random.Random(32)
    pairs = [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000), (7, 7)]  # a long chain
    pairs += [(2000, i) for i in range(2001, 2300)]  # a hot star
    pairs += [tuple(rng.sample(range(400), 2)) for _ in range(260)]
    rng.shuffle(pairs)
    edges = spark.createDataFrame([*pairs, (1, None), (None, 2)] * 2, "a long, b long").repartition(5)
    want = plain.components(pairs, {x for p in pairs for x in p})
    for few in (10**6, 0):
        found = components(edges, few)
        assert {r.node: r.root for r in found.collect()} == want
        assert found.count() == len(want)
    assert components(edges.limit(0)).count() == 0
