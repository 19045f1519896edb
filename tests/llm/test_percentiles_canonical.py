import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import edits
from cellweave.llm import canonical, percentiles


def test_percentiles_agree_with_numpy(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([rng.random(), float(rng.randint(0, 5))]), 1) for _ in range(500)]
    rows += [("a", None, 1), ("a", float("nan"), 1), ("one", 7.0, 1), ("none", None, 1)]
    counts = percentiles.value_counts(spark.createDataFrame(rows, "g string, v double, n int"), ["g"], "v")
    probs = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {(r.g, r.prob): r.value for r in percentiles.percentiles(counts, ["g"], probs).collect()}
    values = {g: [v for k, v, _ in rows if k == g and v is not None and v == v] for g in {"a", "b", None, "one"}}
    assert set(got) == {(g, p) for g in values for p in probs}
    assert all(abs(x - np.quantile(values[g], p)) < 1e-9 for (g, p), x in got.items())


def test_days_combine_and_resolution_bounds_the_error(spark):
    rows = [(f"d{i % 3}", float(i * 7 % 101)) for i in range(400)]
    df = spark.createDataFrame(rows, "day string, v double")
    by_day = percentiles.value_counts(df, ["day"], "v")
    parts = percentiles.value_counts(df.filter("day = 'd0'"), ["day"], "v").unionByName(percentiles.value_counts(df.filter("day <> 'd0'"), ["day"], "v"))
    for counts in (by_day, parts):
        (row,) = percentiles.percentiles(percentiles.merge_counts(counts, []), [], [0.5]).collect()
        assert row.value == np.quantile([v for _, v in rows], 0.5)
    rough = percentiles.value_counts(df, [], "v", resolution=5.0)
    (row,) = percentiles.percentiles(rough, [], [0.9]).collect()
    assert 0 <= np.quantile([v for _, v in rows], 0.9) - row.value < 5.0


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert percentiles.percentiles(percentiles.value_counts(df, ["g"], "v"), ["g"], [0.5]).count() == 0


def _mutate(rng, text, alphabet):
    out = list(text)
    for _ in range(rng.randint(0, 3)):
        at = rng.randint(0, len(out))
        kind = rng.random()
        if kind < 0.33 or not out:
            out.insert(at, rng.choice(alphabet))
        elif kind < 0.66:
            out.pop(min(at, len(out) - 1))
        else:
            out[min(at, len(out) - 1)] = rng.choice(alphabet)
    return "".join(out)


@pytest.mark.parametrize("alphabet, lengths, k", [("ACGT", (8, 9, 12), 2), ("AB", (0, 1, 2, 3, 4, 6), 2), ("abcé€😀", (4, 7, 7, 7, 70), 3), ("AC", (5, 6), 1), ("AC", (3,), 0)])
def test_forest_finds_every_entry(alphabet, lengths, k):
    rng = random.Random(5)
    entries = list({"".join(rng.choice(alphabet) for _ in range(rng.choice(lengths))) for _ in range(100)})
    texts = list({_mutate(rng, rng.choice(entries), alphabet) for _ in range(100)} | {"", "x" * 500})
    forest = canonical.Forest(entries, k)
    found = {(texts[a], forest.strings.texts[b], int(c)) for a, b, c in zip(*forest.search(texts))}
    near = lambda t, e: abs(len(t) - len(e)) <= k and edits.distance(t, e) <= k
    assert found == {(t, e, edits.distance(t, e)) for t in texts for e in entries if near(t, e)}
    nearest = {r.value: (r.distance, r.n_best) for r in forest.nearest(texts).itertuples()}
    for t in texts:
        d = [edits.distance(t, e) for e in entries]
        assert nearest.get(t) == ((min(d), d.count(min(d))) if min(d) <= k else None)


def test_trees_obey_the_triangle_rule():
    rng = random.Random(6)
    forest = canonical.Forest(["AAAA" + "".join(rng.choice("ACGT") for _ in range(6)) for _ in range(300)], 1)
    text = lambda node: forest.strings.texts[forest.entry[node]]
    for node in range(len(forest.entry)):
        for child in forest.children[forest.child_from[node] : forest.child_to[node]]:
            assert edits.distance(text(node), text(child)) == forest.edge[child]


def test_broadcast_and_shards_agree(spark):
    rng = random.Random(7)
    entries = ["".join(rng.choice("ACGT") for _ in range(10)) for _ in range(150)]
    values = [_mutate(rng, rng.choice(entries), "ACGT") for _ in range(200)] + ["", "y" * 3000, "y" * 1_000_000]
    v = spark.createDataFrame([(x, 1, "q") for x in [*values, *values[:9], None]], "v string, entry int, value string")
    e = spark.createDataFrame([(x,) for x in [*entries, *entries[:9], None]], "e string")
    whole = sorted(canonical.nearest_entries(v, "v", e, "e").collect())
    for room in (40, 7):  # shards of hot keys are split at 7
        assert whole == sorted(canonical.nearest_entries(v, "v", e, "e", max_entries=room).collect())
    want = {}
    for x in set(values):
        d = {c: edits.distance(x, c) for c in set(entries) if abs(len(c) - len(x)) <= 2}
        if d and min(d.values()) <= 2:
            best = [c for c in d if d[c] == min(d.values())]
            want[x] = (min(best), min(d.values()), len(best))
    assert {r.value: (r.entry, r.distance, r.n_best) for r in whole} == want
    assert canonical.nearest_entries(v, "v", e.limit(0), "e").count() == 0
    assert canonical.nearest_entries(v.limit(0), "v", e, "e").count() == 0


def test_barcode_query_by_brute_force(spark, tmp_path):
    from cellweave.llm.queries import p5_found

    entries = ["ACGTACGTAC", "ACGTACGTAA", "TTTTTGGGGG"]
    rows = [("r1", " acgtacgtac-2"), ("r2", "ACGTACGTAC"), ("r3", "ACGTACGTA"), ("r4", "TTTTTGGGG"), ("r5", "na"), ("r6", None), ("r7", "-1"), ("r8", "TTTTAGGGAG"), ("r8", "TTTTAGGGAG"), ("r9", "CCCCCCCCCC")]
    spark.createDataFrame(rows, "read_id string, putative_barcode string").withColumn("status", F.lit("x")).write.parquet(f"{tmp_path}/correction_map_3p.parquet")
    spark.createDataFrame([(e,) for e in [*entries, entries[0]]], "barcode string").write.parquet(f"{tmp_path}/whitelist_3p.parquet")
    got = sorted(map(tuple, p5_found(spark, str(tmp_path)).collect()))
    assert got == [("r1", "ACGTACGTAC"), ("r3", "UNMATCHED"), ("r4", "TTTTTGGGGG"), ("r7", "UNMATCHED"), ("r8", "TTTTTGGGGG"), ("r9", "UNMATCHED")]
