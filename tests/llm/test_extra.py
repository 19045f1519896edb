"""Cases at which the operators change their way of working."""

import random

import pytest
from pyspark.sql import functions as F

from cellweave.llm import encoding, frequent, leakage, linking, mixing


def test_longest_runs():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("xyz") for _ in range(rng.randint(0, 12))] for _ in range(2))
        gaps = list(range(-13, 14))
        runs = [(n, -i) for i in range(len(a)) for j in range(len(b)) for n in range(1, 13) if a[i : i + n] == b[j : j + n] and i + n <= len(a) and j + n <= len(b)]
        n, at = leakage.longest_runs(a, b, gaps)
        assert (n, -at) == max(runs, default=(0, 0))


def test_leaks_without_a_broadcast_and_with_repeats(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(200))
    other = "la " * 60
    docs = spark.createDataFrame([(1, "x " + item + " y " + item[:90]), (2, other * 5), (3, "la la")], "id long, t string")
    items = spark.createDataFrame([(7, item), (8, other)], "no long, t string")
    outs = []
    for bound in (1_000_000, 0):
        monkeypatch.setattr(leakage, "BROADCAST_FINGERPRINTS", bound)
        outs.append(sorted(map(tuple, leakage.leaks(docs, "id", "t", items, "no", "t").collect())))
    assert outs[0] == outs[1] == [(1, 7, 200, 1), (2, 8, 60, 0)]
    named = leakage.leaks(docs.selectExpr("concat('d', id) AS id", "t"), "id", "t", items, "no", "t")
    assert sorted((r.doc, r.item) for r in named.collect()) == [("d1", 7), ("d2", 8)]


def test_summaries_of_many_partitions_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(frequent, "FAN", 2)
    monkeypatch.setattr(frequent, "_BLOCK_BYTES", 100)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v")).repartition(9)
    out = {r.item: r for r in frequent.frequent_items(df, "v", counters=5).collect()}
    assert out["hot"].approx_count <= 1000 <= out["hot"].approx_count + out["hot"].max_error and out["hot"].n_rows == 3000


def test_one_component_of_nearly_all_nodes(spark):
    rng = random.Random(9)
    tree = [(f"n{i:04d}", f"n{rng.randint(max(0, i - 40), i - 1):04d}") for i in range(1, 500)]
    small = [(f"p{i:03d}", f"q{i:03d}") for i in range(25)]
    edges = tree + small
    rng.shuffle(edges)
    got = {r.node: r.group_id for r in linking.link_groups(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    assert got == {f"n{i:04d}": "n0000" for i in range(500)} | {x: p for p, q in small for x in (p, q)}


@pytest.mark.parametrize("budget", [1, 40, 333, 900, 5000])
def test_mixture_is_cut_where_sorting_all_passes_would_cut_it(spark, budget):
    rng = random.Random(budget)
    rows = [(i, rng.choice("aab"), rng.randint(1, 30)) for i in range(60)] + [(100 + i, "c", 3) for i in range(5)]
    shares = {"a": (0.5, 2), "b": (0.1, 5), "c": (0.4, 3)}
    df = spark.createDataFrame(rows, "id long, source string, size long")
    targets = spark.createDataFrame([(s, w, m) for s, (w, m) in shares.items()], "source string, target_share double, max_repeats int")
    queued, _ = mixing.fair_queue(df, "id", "source", targets)
    passes = []
    size = {s: sum(n for _, x, n in rows if x == s) for s in shares}
    for r in queued.collect():
        w, m = shares[r.source]
        passes += [((p * size[r.source] + r["_upto"]) / w, r.source, r.key, p, r["size"]) for p in range(m)]
    upto, want = 0, set()
    for finish, source, key, p, n in sorted(passes):
        upto += n
        if upto <= budget:
            want.add((source, key, p, upto))
    got = {(r.source, r.key, r.pass_no, r.upto) for r in mixing.mix_order(df, "id", "source", targets, budget=budget).collect()}
    assert got == want


def test_the_sample_is_what_sorting_all_units_would_give(spark):
    texts = spark.createDataFrame([(f"é{i % 700}. ü{i}",) for i in range(2000)], "t string")
    models = [encoding.train(texts.repartition(n), "t", rows=50) for n in (1, 6)]
    assert (models[0].weights == models[1].weights).all() and models[0].prior[0] == 0


def test_a_word_whose_chain_ranks_fourth_or_lower_is_restored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = encoding.train(docs, "text")
    word = encoding.garble("déjà", "utf8>cp850")
    scores = model.scores([word])[0]
    # Three other chains that can't be undone are put before the true one.
    others = [encoding.LABELS.index(x) for x in ("utf8>cp1251", "utf8>koi8_r", "utf8>latin1 twice")]
    true = encoding.LABELS.index("utf8>cp850")
    scores[:] = scores.min() - 1
    scores[0] = 0.0
    scores[true] = 30.0
    for i, label in enumerate(others):
        scores[label] = 40.0 + i
    assert (scores > scores[true]).sum() == 3
    assert encoding._restore(word, scores, model, 4.0)[0] == "déjà"
