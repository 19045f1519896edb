import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellweave.llm import frequent, linking


def test_shrink_keeps_the_guarantee():
    rng = random.Random(1)
    items, n = pa.array([], pa.string()), np.zeros(0, np.int64)
    truth, error = Counter(), 0
    for _ in range(40):
        block = Counter(rng.choice("abc") if rng.random() < 0.5 else f"x{rng.randint(0, 500)}" for _ in range(200))
        truth += block
        table = pa.table({"item": pa.array([*items.to_pylist(), *block], pa.string()), "n": pa.array([*n.tolist(), *block.values()], pa.int64())})
        items, n, cut = frequent._add(table, 10)
        error += cut
    kept = dict(zip(items.to_pylist(), n.tolist()))
    total = sum(truth.values())
    assert len(kept) <= 10 and error <= total / 11
    assert all(truth[x] - error <= kept.get(x, 0) <= truth[x] for x in truth)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_frequent_items(spark, partitions):
    rng = random.Random(2)
    values = ["hot"] * 900 + ["warm"] * 300 + [f"v{rng.randint(0, 3000)}" for _ in range(2000)] + [None] * 50 + ["", "x" * 100_000]
    rng.shuffle(values)
    df = spark.createDataFrame([(v, 1, "z") for v in values], "v string, n int, item string").repartition(partitions)
    truth = Counter(v for v in values if v is not None)
    out = frequent.frequent_items(df, "v", counters=20).collect()
    assert {"hot", "warm"} <= {r.item for r in out} and len(out) <= 20
    assert all(r.n_rows == sum(truth.values()) and r.approx_count <= truth[r.item] <= r.approx_count + r.max_error and r.max_error <= r.n_rows / 21 for r in out)
    exact = {r.item: r.n_items for r in frequent.heavy_items(df, "v", 0.09, counters=20).collect()}
    assert exact == {"hot": 900, "warm": 300}


def test_frequent_items_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "v string")
    assert frequent.frequent_items(df, "v").count() == 0 and frequent.frequent_items(df.limit(0), "v").count() == 0
    assert frequent.heavy_items(df, "v", 0.5).count() == 0
    with pytest.raises(ValueError):
        frequent.heavy_items(df, "v", 0.01, counters=50)


def _groups(edges):
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    return {x: root(x) for x in parent}


def test_link_groups(spark):
    rng = random.Random(3)
    chain = [f"c{i:03d}" for i in range(40)]
    shuffled = rng.sample([f"s{i:02d}" for i in range(30)], 30)
    edges = [(a, b) for a, b in zip(chain, chain[1:])] + list(zip(shuffled, shuffled[1:]))
    edges += [("hub", f"leaf{i}") for i in range(80)] + [("own", "own"), ("", "blank"), ("d1", "d0"), ("d0", "d1"), ("d1", "d0")]
    df = spark.createDataFrame([*edges, (None, "lost"), ("lost2", None)], "a string, b string").withColumns({"u": F.lit(1), "label": F.lit("k"), "node": F.lit(0)})
    got = {r.node: r.group_id for r in linking.link_groups(df, "a", "b").collect()}
    assert got == _groups(edges)


def test_link_groups_of_nothing_and_too_few_rounds(spark):
    df = spark.createDataFrame([(None, "x")], "a string, b string")
    assert linking.link_groups(df, "a", "b").count() == 0
    chain = spark.createDataFrame([(f"n{i:04d}", f"n{i + 1:04d}") for i in range(300)], "a string, b string")
    with pytest.raises(RuntimeError):
        linking.link_groups(chain, "a", "b", max_rounds=1)
