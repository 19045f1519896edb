"""Genes named without pairing them with reads."""

import random

import numpy as np
import pytest

from cellweave.operators import intervals as I


def _intervals(rng, n, span, longest):
    return [(a, a + rng.randint(1, longest)) for a in (rng.randint(-span // 4, span) for _ in range(n))]


def test_sweep_agrees_with_comparing_all():
    rng = random.Random(4)
    for k in range(150):
        span, longest = rng.choice([(10, 4), (60, 30), (500, 200)])
        reads, genes = np.array(_intervals(rng, rng.randint(1, 60), span, longest)), np.array(sorted(_intervals(rng, rng.randint(1, 40), span, longest)))
        one, other = I._compared(*reads.T, *genes.T), I._swept(*reads.T, *genes.T)
        assert (one[0] == other[0]).all() and (one[1] == other[1])[one[0] == 1].all()


@pytest.mark.parametrize("swept", [0, 2000])
def test_assign_genes_agrees_with_all_pairs(spark, monkeypatch, swept):
    """Lengths of all classes, negative starts, missing and unknown strands, repeated genes, empty intervals, low and missing scores."""
    monkeypatch.setattr(I, "SWEPT", swept)
    rng = random.Random(6)
    strands = ["+", "-", ".", "?", None]
    reads = [(i, rng.choice(["a", "b", None]), s, e, rng.choice(strands), rng.choice([10, 30, 40, None])) for i, (s, e) in enumerate(_intervals(rng, 150, 3000, 60) + _intervals(rng, 60, 3000, 5000))]
    reads += [(1000, "a", 5, 5, "+", 40), (1001, "a", None, 9, "+", 40), (1002, "c", 1, 9, "+", 40)]
    genes = [(rng.choice("ab"), s, e, rng.choice(strands), f"g{i}") for i, (s, e) in enumerate(_intervals(rng, 60, 3000, 100) + _intervals(rng, 10, 3000, 4000))]
    genes += genes[:9] + [("a", 7, 7, "+", "none"), ("a", None, 9, "+", "none")]
    fields = "chrom string, start long, end long, strand string"
    rs = spark.createDataFrame(reads, f"read_id long, {fields}, score int")
    got = {r.read_id: (r.status, r.score, r.gene) for r in I.assign_genes(rs, spark.createDataFrame(genes, f"{fields}, label string"), width=50).collect()}

    def differ(a, b):  # as SQL has it: unknown counts as differing unless the other one is open
        known = ("+", "-")
        if a is None or b is None:
            return not ((a is not None and a not in known) or (b is not None and b not in known))
        return a in known and b in known and a != b

    want = {}
    for i, c, s, e, strand, score in reads:
        met = [(min(e, ge) - max(s, gs), label) for gc, gs, ge, gstrand, label in genes if c == gc and None not in (s, e, gs, ge) and s < e and gs < ge and min(e, ge) > max(s, gs) and not differ(strand, gstrand)]
        best = [label for o, label in met if o == max(met)[0]]
        low, status = score is not None and score < 30, "Assigned" if len(best) == 1 else "Unassigned_ambiguous" if best else "Unassigned_no_features"
        if score is None:
            status = "Unassigned_no_features"
        want[i] = ("Unassigned_mapq", score, "NA") if low else (status, score, best[0] if status == "Assigned" else "NA")
    bad = [(r, got.get(r[0]), want[r[0]]) for r in reads if got.get(r[0]) != want[r[0]]]
    assert not bad


def test_reads_and_genes_arent_paired(spark):
    """Each read under each gene: 4 million pairs of 4,000 rows."""
    rs = spark.range(2000).selectExpr("id AS read_id", "'a' AS chrom", "id AS start", "id + 5000 AS end", "'.' AS strand", "40 AS score")
    gs = spark.range(2000).selectExpr("'a' AS chrom", "id AS start", "id + 3000 AS end", "'.' AS strand", "string(id) AS label")
    out = I.assign_genes(rs, gs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert {r.status for r in out.collect()} == {"Unassigned_ambiguous", "Assigned"}


def test_tags_are_joined_once(spark):
    """The tags go along with the records instead of being joined again by record."""
    rec = spark.createDataFrame([("a", 0, "c", 0, "9M", 60), ("a", 0, "c", 0, "9M", 60)], "read_id string, flag int, chrom string, start long, cigar string, mapq int")
    tags = spark.createDataFrame([("a", "x", "u")], "read_id string, barcode string, umi string")
    genes = spark.createDataFrame([("c", 0, 5, "+", "G")], "chrom string, start long, end long, strand string, label string")
    out = I.tag_and_assign(rec, tags, genes)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2  # records with high scores and others
    assert [tuple(r) for r in out.collect()] == [("a", "x", "u", "Assigned", 60, "G")]
