import math
import random

import pytest
from pyspark.sql import functions as F

from cellweave.operators.prefix import running_sum
from cellweave.operators.selection import heavy_keys, key_profile, select_quantiles


def _disc(values, p):
    values = sorted(values)
    return values[max(math.ceil(p * len(values)), 1) - 1]


@pytest.mark.parametrize("kind", ["int", "float", "wide"])
def test_quantiles_agree_with_sorting(spark, kind):
    rng = random.Random(3)
    make = {"int": lambda: float(rng.randint(-5, 40)), "float": rng.random, "wide": lambda: rng.choice([0, -1, 1]) * 10 ** rng.uniform(-300, 300)}[kind]
    rows = [(rng.choice("aaaaaab"), make()) for _ in range(700)] + [("c", 7.0), (None, 1.0), (None, 3.0)]
    out = select_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0], bins=16).collect()
    got = {(r.g, r.prob): r.value for r in out}
    groups = {g for g, _ in rows}
    assert got == {(g, p): _disc([v for k, v in rows if k == g], p) for g in groups for p in (0.0, 0.25, 0.5, 0.9, 1.0)}


def test_quantiles_between_ranks(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), float(rng.randint(0, 300)), rng.randint(1, 4)) for _ in range(300)] + [(None, 5.0, 1)]
    out = select_quantiles(spark.createDataFrame(rows, "g string, v double, w int"), ["g"], "v", [0.0, 0.3, 0.5, 1.0], weight="w", bins=8, interpolate=True).collect()
    for r in out:
        values = sorted(v for g, v, w in rows if g == r.g for _ in range(w))
        at = r.prob * (len(values) - 1)
        a, b = values[math.floor(at)], values[math.ceil(at)]
        assert abs(r.value - (a + (b - a) * (at - math.floor(at)))) < 1e-9 and (r.n, r.total) == (len(values), sum(values))
    assert len(out) == 12


def test_heavy_keys_hold_at_least_their_share(spark):
    rng = random.Random(5)
    counts = {f"k{i}": rng.randint(1, 40) for i in range(300)} | {"hot": 4000, "warm": 700, "just": 0}
    rest = sum(counts.values())
    counts["just"] = -(-rest // 99)  # a hundredth of all rows, or a little more
    rows = [("f", k, n, n / sum(counts.values())) for k, n in counts.items()] + [("g", "only", 3, 1.0)]
    out = heavy_keys(spark.createDataFrame(rows, "field string, item string, n_rows long, share double"), 0.01).collect()
    assert {(r.field, r.item) for r in out} == {("f", "hot"), ("f", "warm"), ("f", "just"), ("g", "only")}
    assert heavy_keys(spark.createDataFrame([], "field string, item string, n_rows long, share double"), 0.5).count() == 0


def test_quantiles_leave_out_what_has_no_rank(spark):
    rows = [("a", 1.0, 2), ("a", None, 5), ("a", float("nan"), 5), ("a", float("inf"), 5), ("a", 9.0, 0), ("a", 4.0, 1), ("b", None, 1), ("a", 5.0, None)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    out = select_quantiles(df, ["g"], "v", [0.5, 1.0], weight="w").collect()
    assert {(r.g, r.prob, r.value) for r in out} == {("a", 0.5, 1.0), ("a", 1.0, 4.0)}
    assert select_quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_quantiles_of_cold_keys(spark, monkeypatch):
    monkeypatch.setattr("cellweave.operators.selection.HOT_KEYS", 2)
    rows = [(i % 50, float(i * i % 97)) for i in range(1000)] + [(99, float(i)) for i in range(2000)]
    out = select_quantiles(spark.createDataFrame(rows, "g int, v double"), ["g"], "v", [0.5])
    got = {r.g: r.value for r in out.collect()}
    assert got == {g: _disc([v for k, v in rows if k == g], 0.5) for g in {g for g, _ in rows}}


def test_key_profile(spark):
    rows = [("A", "g1", "u1"), (" a", "g1", "u1"), ("A", "g2", "u2"), ("A", "g2", "NA"), ("b", None, "u1"), ("none", "g1", "u9"), (None, "G1", ""), ("", "g1 ", None)]
    df = spark.createDataFrame(rows, "barcode string, gene string, umi string").withColumns({"n_rows": F.lit(1), "item": F.lit("x"), "field": F.lit(0)})
    got = {(r.field, r.item): (r.n_rows, r.n_units, round(r.share, 6), r.units_p50, r.units_p90) for r in key_profile(df, ["barcode", "gene"], "umi").collect()}
    assert got == {
        ("barcode", "A"): (4, 2, 0.8, 1.0, 2.0),
        ("barcode", "B"): (1, 1, 0.2, 1.0, 1.0),
        ("gene", "G1"): (5, 2, round(5 / 7, 6), 1.0, 2.0),
        ("gene", "G2"): (2, 1, round(2 / 7, 6), 1.0, 1.0),
    }


def test_key_profile_without_units_or_rows(spark):
    df = spark.createDataFrame([("a", None)], "k string, u string")
    (row,) = key_profile(df, ["k"], "u").collect()
    assert (row.n_rows, row.n_units, row.units_p50) == (1, 0, None)
    assert key_profile(df.limit(0), ["k"], "u").count() == 0


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_running_sum(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.choice(["x", "y", None]), i, rng.choice([None, 1, 5])) for i in range(300)]
    rng.shuffle(rows)
    out, _ = running_sum(spark.createDataFrame(rows, "g string, o int, v int"), ["g"], ["o"], {"s": "v", "t": "o"}, partitions)
    for r in out.collect():
        before = [x for x in rows if x[0] == r.g and x[1] <= r.o]
        assert (r.s, r.t) == (sum(x[2] or 0 for x in before), sum(x[1] for x in before))
    assert running_sum(spark.createDataFrame([], "g string, o int, v int"), [], ["o"], {"s": "v"})[0].count() == 0
