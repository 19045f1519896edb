"""Transcripts of reads without summing all pairs of blocks and exons."""

import random

import pytest

from cellweave.operators import intervals as I

FIELDS = "chrom string, start long, end long, strand string"


def _tables(spark, seed):
    """Transcripts of one to four exons, some repeated or apart on two chromosomes; blocks that lie close or apart, repeat, or have nothing to meet."""
    rng = random.Random(seed)
    exons = []
    for t in range(50):
        at, chrom, strand = rng.randint(-200, 1500), rng.choice("ab"), rng.choice(["+", "-", ".", None])
        for _ in range(rng.choice([1, 2, 2, 4])):
            at += rng.randint(0, 150)
            exons.append((rng.choice([chrom, chrom, "a"]), at, at + rng.choice([0, 20, 60, 200]), strand, f"t{t}" if t else None, f"g{t // 2}"))
    exons += exons[:6] + [("a", None, 9, "+", "t1", "g0"), (None, 1, 9, "+", "t1", "g0")]
    blocks = []
    for r in range(120):
        at, chrom = rng.randint(-200, 1500), rng.choice("abc")
        for _ in range(rng.choice([1, 1, 2, 4])):
            at += rng.choice([0, 30, 300])
            blocks.append((r if r else None, rng.choice([chrom, chrom, "a", None]), at, at + rng.choice([0, 10, 80, 400]), rng.choice(["+", "-", ".", None]), rng.choice([10, 30, 40, None])))
    blocks += blocks[:20] + [(500, "a", None, 9, "+", 40)]
    return spark.createDataFrame(blocks, f"read_id long, {FIELDS}, score int"), spark.createDataFrame(exons, f"{FIELDS}, transcript_id string, label string")


@pytest.mark.parametrize("seed, related, width", [(1, 10**7, 50), (2, 10**7, 400), (3, 10, 50)])
def test_transcripts_agree_with_all_pairs(spark, monkeypatch, seed, related, width):
    monkeypatch.setattr(I, "_RELATED", related)
    blocks, exons = _tables(spark, seed)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    got = rows(I.assign_transcripts(blocks, exons, width=width))
    assert got == rows(I.assign_transcripts(blocks, exons, width=width, listed=0)) and len(got) > 100
    assert {r[1] for r in got} == {"Assigned", "Unassigned_ambiguous", "Unassigned_no_features", "Unassigned_mapq"}
    assert {r[1] for r in rows(I.assign_transcripts(blocks, exons.limit(0)))} == {"Unassigned_no_features", "Unassigned_mapq"}


def test_a_sum_wins_over_the_best_block(spark):
    """Also without pairing all: 3,000 exons over one block, and one transcript that sums two."""
    exons = spark.range(3000).selectExpr("'a' AS chrom", "id AS start", "id + 4000 AS end", "'.' AS strand", "concat('t', id) AS transcript_id", "'g' AS label")
    pair = spark.createDataFrame([("a", 0, 3000, ".", "sum", "G"), ("b", 0, 3000, ".", "sum", "G")], exons.schema)
    blocks = spark.createDataFrame([(1, "a", 0, 4000, "+", 40), (1, "b", 0, 4000, "+", 40), (2, "a", 0, 4000, "+", 40)], f"read_id long, {FIELDS}, score int")
    out = I.assign_transcripts(blocks, exons.unionByName(pair))
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [(1, "Assigned", 40, "G", "sum"), (2, "Assigned", 40, "g", "t0")]
