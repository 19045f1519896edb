import math
import random

import pytest
from pyspark.sql import functions as F

from cellweave.operators import barcodes as B
from cellweave.operators import features as X
from cellweave.operators import intervals as I
from cellweave.operators import molecules as M
from cellweave.operators import pairs as P
from cellweave.operators import readqc as R
from cellweave.operators.umi import collapse_umis, tile_edges, variant_edges


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_components_agree_with_search(spark):
    rng = random.Random(4)
    edges = [(f"n{rng.randint(0, 60):02d}", f"n{rng.randint(0, 60):02d}") for _ in range(40)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(70)]
    got = {r.node: r.component for r in P.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    assert got == {x: root(x) for x in parent}


def test_pair_rules(spark):
    support = spark.createDataFrame([("a", "a", 10, 5), ("a", "b", 8, 4), ("c", "c", 4, 2), ("d", "e", 100, 9), ("d", "f", 6, 1), ("d", "d", 1, 1)], "u string, v string, n_reads long, n_umis long")
    parts = P.components(support)
    kinds = {r.component: r.category for r in P.component_categories(support, parts).collect()}
    assert kinds == {"a": "pair_only", "c": "self_only", "d": "other"}
    kept = {(r.u, r.v): r.kept_by for r in P.prune_edges(support, parts).collect()}
    assert kept == {("a", "a"): "motif", ("a", "b"): "motif", ("c", "c"): "motif", ("d", "e"): "ends", ("d", "d"): "ends", ("d", "f"): "ends"}
    both = {(r.u, r.v) for r in P.prune_edges(support, parts, both_ends=True).collect()}
    assert ("d", "f") not in both
    tops = {r.node: (r.partner, round(r.dominance, 3)) for r in P.top_partner(support).collect()}
    assert tops["c"] == ("c", 0.5) and tops["a"] == ("a", round(10 / 28, 3))


def test_resolve_reads(spark):
    cells = spark.createDataFrame([("a", "cell_1"), ("b", "cell_2")], "node string, cell_id string")
    tops = spark.createDataFrame([("x", "a", 0.9), ("y", "b", 0.9), ("z", "a", 0.5)], "node string, partner string, dominance double")
    rows = [(1, "a", "b"), (2, None, "b"), (3, "x", None), (4, "x", "y"), (5, "x", "q"), (6, "z", None), (7, None, None)]
    out = P.resolve_reads(spark.createDataFrame(rows, "id int, s string, t string"), "s", "t", cells, tops)
    assert {r.id: r.cell_id for r in out.collect()} == {1: "cell_1", 2: "cell_2", 3: "cell_1", 4: None, 5: "cell_1", 6: None, 7: None}


def test_assign_reads_equals_each_read_resolved(spark):
    """One answer for each couple of barcodes is the answer of each read; cells with too few reads go."""
    cells = spark.createDataFrame([("a", "cell_1"), ("b", "cell_1"), ("c", "cell_2")], "node string, cell_id string")
    tops = spark.createDataFrame([("x", "a", 0.9), ("z", "c", 0.5)], "node string, partner string, dominance double")
    pairs = spark.createDataFrame([("a", "b"), ("a", "x"), ("c", "z")], "u string, v string")
    couples = [("a", "b"), ("b", "a"), ("a", "c"), ("a", None), (None, "b"), ("x", None), ("x", "a"), ("c", None), ("z", "c"), ("z", None), ("q", "q"), (None, None), ("a", "a")]
    rows = [(i, *couples[i % len(couples)], "old") for i in range(40)]
    reads = spark.createDataFrame([*rows, rows[0]], "id int, s string, t string, cell_id string")
    plain = P.resolve_reads(P.in_pairs(reads.drop("cell_id"), "s", "t", pairs), "s", "t", cells, tops)
    for least in (1, 8, 100):
        large = P.cell_reads(plain, least).select("cell_id")
        want = sorted((r.id, r.cell_id) for r in plain.join(large, "cell_id", "left_semi").collect())
        out = P.assign_reads(reads, "s", "t", pairs, cells, tops, least)
        assert sorted((r.id, r.cell_id) for r in out.collect()) == want and set(out.columns) == {"id", "s", "t", "cell_id"}
    assert P.assign_reads(reads.limit(0), "s", "t", pairs, cells, tops, 1).count() == 0
    assert P.assign_reads(reads, "s", "t", pairs.limit(0), cells.limit(0), tops.limit(0), 1).count() == 0


def test_reads_of_dropped_pairs_are_left_out(spark):
    schema = "id int, s string, t string, u5 string, u3 string"
    rows = [(1, "a", "b", "U", "V"), (2, "b", "a", "U", None), (3, "a", "c", "U", "V"), (4, "a", None, None, "V"), (5, None, "z", "U", "V"), (6, "a", "a", "U", "V"), (7, None, None, "U", "V"), (8, "a", "b", None, None)]
    reads = spark.createDataFrame([*rows, rows[0]], schema)
    pairs = spark.createDataFrame([("a", "b"), ("c", "c")], "u string, v string")
    valid = P.valid_reads(reads, "s", "t", "u5", "u3")
    assert sorted(r.id for r in valid.collect()) == [1, 1, 2, 3, 4, 5, 6]
    out = P.in_pairs(valid, "s", "t", pairs)
    assert sorted(r.id for r in out.collect()) == [1, 1, 2, 4, 5] and out.columns == reads.columns
    assert sorted(r.id for r in P.in_pairs(valid, "s", "t", pairs.limit(0)).collect()) == [4, 5]


def test_read_to_cell_drops_reads_of_pruned_pairs(spark, tmp_path):
    from cellweave.plans.reads import QUERIES

    # The pair a, b makes a cell; one read joins the hot barcode a to a stranger, below the least support of a pair.
    rows = [(f"r{i}", f"ACG{i}", f"CGT{i}", "A" * 3 + "C", "A" * 3 + "G") for i in range(8)]
    rows += [("odd", "ACG", "CGT", "AAAC", "TTTT"), ("single", "ACG", "CGT", "AAAC", None), ("blank", None, None, "AAAC", "AAAG")]
    df = spark.createDataFrame(rows, "read_id string, putative_umi_5p string, putative_umi string, bc5n string, bc3n string")
    df.write.parquet(f"{tmp_path}/readids_umi_bc_clean.parquet")
    out = QUERIES["read_to_cell"](spark, str(tmp_path)).collect()
    assert {r.read_id for r in out} == {*(f"r{i}" for i in range(8)), "single"} and {r.cell_id for r in out} == {"cell_000001"}


def test_knee_points(spark):
    rng = random.Random(5)
    rows = [(f"b{i:04}", rng.choice([1, 2, 3, rng.randint(4, 900)])) for i in range(700)]
    df = spark.createDataFrame(rows, "barcode string, n_reads long").repartition(5).withColumn("cell_rank", F.lit(0))
    listed = spark.createDataFrame([("b0003",), ("b0003",), (None,), ("b0600",), ("gone",)], "cell_rank string")
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    points = lambda called, n: sorted(tuple(r) for r in M.knee_points(df, "barcode", "n_reads", called, n).collect())
    want = [(i, b, n, b in ("b0003", "b0600")) for i, (b, n) in enumerate(order, 1)]
    assert points(listed, 20_000) == want and points(listed, 700) == want
    ranks = {max(1, min(700, round(math.exp(math.log(700) * i / 59)))) for i in range(60)} | {1, 700}
    assert points(listed, 60) == [x for x in want if x[0] in ranks] and len(ranks) > 40
    assert points(listed.limit(0), 2) == [(1, *order[0], True), (700, *order[-1], True)]
    assert M.knee_points(df.limit(0), "barcode", "n_reads", listed).count() == 0


def test_interval_join_agrees_with_all_pairs(spark):
    rng = random.Random(9)
    make = lambda n: [(i, rng.choice("xy"), s, s + rng.choice([0, 1, 30, 900]), rng.choice("+-.")) for i in range(n) for s in [rng.randint(0, 400)]]
    reads, features = make(80), make(80)
    schema = "id int, chrom string, start long, end long, strand string"
    out = I.interval_join(spark.createDataFrame(reads, schema), spark.createDataFrame(features, schema), width=50).collect()
    want = {
        (a[0], b[0], min(a[3], b[3]) - max(a[2], b[2])) for a in reads for b in features
        if a[1] == b[1] and min(a[3], b[3]) > max(a[2], b[2]) and {a[4], b[4]} != {"+", "-"}
    }
    assert len(out) == len(want) and {(r.id, r.f_id, r.overlap) for r in out} == want


def test_gene_statuses(spark):
    reads = spark.createDataFrame([(1, "c", 0, 100, "+", 60), (2, "c", 0, 100, "+", 5), (3, "c", 500, 600, "+", 60), (4, "c", 200, 300, ".", 60)], "read_id int, chrom string, start long, end long, strand string, score int")
    genes = spark.createDataFrame([("c", 50, 90, "+", "g1"), ("c", 0, 20, ".", "g2"), ("c", 0, 99, "-", "g3"), ("c", 200, 250, "+", "g4"), ("c", 250, 300, "-", "g5")], "chrom string, start long, end long, strand string, label string")
    got = {r.read_id: (r.status, r.gene) for r in I.assign_genes(reads, genes).collect()}
    assert got == {1: ("Assigned", "g1"), 2: ("Unassigned_mapq", "NA"), 3: ("Unassigned_no_features", "NA"), 4: ("Unassigned_ambiguous", "NA")}


def test_split_blocks(spark):
    df = spark.createDataFrame([("5S10M2D3M100N4M1I6M",), ("7M",), ("10S",), ("3M5N5N2M",)], "c string")
    got = [[tuple(b) for b in r.b] for r in df.select(I.split_blocks(F.lit(100), F.col("c")).alias("b")).collect()]
    assert got == [[(100, 115), (215, 225)], [(100, 107)], [], [(100, 103), (113, 115)]]


def test_region_name(spark):
    row = spark.range(1).select(*(I.region_name(F.lit("chr1"), F.lit(a), F.lit(b)).alias(n) for n, a, b in (("x", 1200, 1900), ("y", 1900, 2100), ("z", 0, 0)))).first()
    assert tuple(row) == ("chr1_1000_2000", "chr1_2000_2000", "chr1_0_0")


def _collapse(counts):
    """The rule as it is read: visit by strength, each taking all it reaches that nobody took."""
    order = sorted(counts, key=lambda u: (-counts[u], u))
    taken = {}
    for seed in order:
        if seed in taken:
            continue
        taken[seed], queue = seed, [seed]
        while queue:
            a = queue.pop()
            for b in counts:
                if b not in taken and _distance(a, b) <= 3 and counts[a] >= 2 * counts[b] - 1:
                    taken[b] = seed
                    queue.append(b)
    return taken


def _umi_groups():
    rng = random.Random(8)
    groups = {}
    for g in ("same", "mixed", None):
        base = ["".join(rng.choice("ACGT") for _ in range(12 if g == "same" else rng.choice([2, 11, 12]))) for _ in range(8)]
        near = ["".join(rng.choice("ACGT") if rng.random() < 0.15 else c for c in rng.choice(base)) for _ in range(60 if g else 5)]
        groups[g] = {u: rng.choice([1, 1, 1, 2, 3, 9, 30]) for u in base + near}
    groups["one"] = {"ACGT": 3}
    groups["long"] = {"A" * 200: 4, "A" * 199 + "C": 1, "": 2, "AC": 1}
    return groups


@pytest.mark.parametrize("whole, dense", [(2000, 10**6), (30, 10**6), (30, 31)])
def test_collapse_umis(spark, whole, dense):
    """Groups resolved whole, in tiles of blocks, and by variants agree with the rule as it is read."""
    groups = _umi_groups()
    if dense < 100:
        groups = {g: dict(list(c.items())[:45]) for g, c in groups.items()}
    rows = [(g, u, n) for g, c in groups.items() for u, n in c.items()] + [("same", None, 9)]
    df = spark.createDataFrame(rows, "g string, umi string, n long").withColumn("umi_corrected", F.lit("x"))
    out = collapse_umis(df, ["g"], whole=whole, dense=dense).collect()
    want = {(g, u): s for g, c in groups.items() for u, s in _collapse(c).items()}
    assert {(r.g, r.umi): r.umi_corrected for r in out} == want and len(out) == len(want)
    assert collapse_umis(df.limit(0), ["g"]).count() == 0


def test_tiles_and_variants_find_the_same_edges(spark):
    counts = {u: n for u, n in list(_umi_groups()["mixed"].items())[:50]}
    df = spark.createDataFrame([("g", u, n) for u, n in counts.items()], "g string, umi string, n long")
    want = {(a, b) for a in counts for b in counts if a != b and counts[a] >= 2 * counts[b] - 1 and _distance(a, b) <= 3}
    for edges in (tile_edges(df, ["g"], block=7), tile_edges(df, ["g"], block=100), variant_edges(df, ["g"])):
        got = [(r.a, r.b) for r in edges.collect()]
        assert len(got) == len(set(got)) and set(got) == want


def _semi(p, t):
    return min(_distance(p, t[a:b]) for a in range(len(t) + 1) for b in range(a, len(t) + 1))


def test_substring_distances():
    import pandas as pd

    rng = random.Random(7)
    pairs = [("".join(rng.choice("ACG") for _ in range(rng.randint(0, 6))), "".join(rng.choice("ACG") for _ in range(rng.randint(0, 9)))) for _ in range(150)]
    d, end = B.substring_distances(pd.Series([p for p, _ in pairs]), pd.Series([t for _, t in pairs]))
    for (p, t), x, e in zip(pairs, d, end):
        by_end = [min(_distance(p, t[a:b]) for a in range(b + 1)) for b in range(len(t) + 1)]
        assert x == min(by_end) and e == max(b for b, y in enumerate(by_end) if y == x), (p, t)
    assert len(B.substring_distances(pd.Series([], dtype=object), pd.Series([], dtype=object))[0]) == 0


def test_classify(spark):
    from cellweave.operators import classify as K

    p = K.Primers(tso="ACGTTGCAAC", rtp="GGATCCTTAG", tso_edits="1", rtp_edits="1", first=40, last=60, umi=0)
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    cdna = "CCGGTCAGTCCATGCCGTAC" * 3  # no primer within one edit of it; with two it would join molecules
    sense = p.tso + cdna + "A" * 12 + turn(p.rtp)
    cases = {
        "sense": sense, "anti": turn(sense), "wrong": sense.replace("ACGTTGCAAC", "ACGATGCAAC"), "low": p.tso + cdna + "A" * 12, "tso": p.tso + cdna, "none": cdna,
        "short": "ACGT", "empty": "", "lost": None,
    }
    df = spark.createDataFrame([(k, v, v and "I" * len(v)) for k, v in cases.items()], "read_id string, seq string, qual string")
    got = {r.read_id: (r["class"], r.seq) for r in K.classify(df, p, min_length=20).collect()}
    assert {k: v[0] for k, v in got.items()} == {"sense": 0, "anti": 1, "wrong": 0, "low": 2, "tso": 9, "none": 15, "short": 16, "empty": 16, "lost": 16}
    assert got["sense"][1].startswith(cdna) and got["sense"][1] == got["wrong"][1] and got["anti"][1] in (cdna, got["sense"][1])
    stats = {r["class"]: r.n for r in K.class_statistics(K.classify(df, p, min_length=20)).collect()}
    assert stats[16] == 3 and stats[0] == 2 and stats[7] == 0 and len(stats) == len(K.CLASSES) == 21


def test_fuzzy_join(spark):
    rng = random.Random(2)
    entries = ["".join(rng.choice("ACGT") for _ in range(9)) for _ in range(15)]
    values = set(entries[:3]) | {"", "ACG"}
    for e in entries:
        s = list(e)
        for _ in range(rng.randint(1, 3)):
            s[rng.randrange(len(s))] = rng.choice(["", "A", "CG"])
        values.add("".join(s) + rng.choice(["", "TT"]))
    got = {r.value: r.corrected for r in B.fuzzy_join(spark.createDataFrame([(v,) for v in values], "v string"), "v", spark.createDataFrame([(e,) for e in entries], "e string"), "e").collect()}
    for v in values - {""}:
        if v in entries:
            assert got[v] == v
            continue
        d = {e: _semi(e, v) for e in entries}
        near = [e for e in entries if d[e] == min(d.values()) <= 2]
        assert got[v] == (near[0] if len(near) == 1 else ""), v


def test_extract_and_trim(spark):
    bc5, umi5, cdna, umi3, bc3 = "AACCGGTTAA" + "CCTTCC" + "TTGGCCAATT", "CAGCAACGTACGTAC", "GATTACAGATTACAGGCC" * 4, "ACGTACGTAC" + "AGATC", "GGAATTCCGG" + "GCTACC" + "CCTTAAGGCC"
    seq = bc5 + umi5 + cdna + "A" * 14 + umi3 + bc3
    df = spark.createDataFrame([(seq, "I" * len(seq)), ("ACGT", "IIII"), ("", "")], "s string, q string")
    x = B.extract_5p(B.extract_3p(df, "s", "q", "a"), "s", "q", "b", anchor="CAGCA")
    x = x.withColumn("t", B.trim_bounds(F.col("a"), F.col("b"), F.length("s"), F.lit(True), F.lit(True)))
    whole, short, empty = x.collect()
    assert (whole.a.bc, whole.a.umi, whole.a.bc_loc, whole.a.read_type, whole.a.bc_min_q) == (bc3, umi3, -16, 1, 40)
    assert (whole.b.bc, whole.b.umi, whole.b.bc_loc) == (bc5, seq[26:41], 10)
    assert seq[whole.t.start : whole.t.end].startswith(cdna[:20]) and whole.t.end <= len(bc5 + umi5 + cdna) + 1
    assert (short.a.read_type, short.a.bc, empty.a.bc) == (11, "ACGT", "")


def test_feature_rules(spark):
    hits = [
        (1, "g", "t", 50, 0.9, 0.9, 20, 0), (2, "g", "t", 50, 0.9, 0.9, 0, 0), (3, "g", "t", 50, 0.9, 0.5, 0, 0), (3, "h", "u", 40, 0.9, 0.9, 0, 1),
        (4, "g", "t", 50, 0.3, 0.9, 9, 0), (4, "h", "u", 40, 0.3, 0.9, 9, 1), (5, "g", "t", 50, 0.9, 0.85, 9, 0), (5, "h", "u", 50, 0.9, 0.7, 9, 1),
        (6, "g", "t", 50, 0.9, 0.85, 9, 0), (6, "h", "u", 50, 0.9, 0.85, 9, 1), (8, "g", "t", 50, 0.9, 0.9, 20, 0),
    ]
    h = spark.createDataFrame(hits, "read_id int, gene string, transcript string, score int, query_cov double, transcript_cov double, mapq int, ord int")
    r = spark.createDataFrame([(i, 60 if i < 8 else 3) for i in range(1, 9)], "read_id int, genome_mapq int")
    got = {x.read_id: (x.gene, x.transcript) for x in X.select_features(h, r).collect()}
    assert got == {1: ("g", "t"), 2: ("-", "-"), 3: ("g", "t"), 4: ("g", "-"), 5: ("g", "t"), 6: ("g", "-"), 7: ("-", "-"), 8: ("-", "t")}


def test_saturation_is_nested_and_ends_whole(spark):
    rng = random.Random(6)
    rows = [(f"r{i}", f"G{rng.randint(0, 5)}", f"C{rng.randint(0, 3)}", f"U{rng.randint(0, 30)}") for i in range(400)]
    out = sorted(M.saturation(spark.createDataFrame(rows, "read_id string, gene string, barcode string, umi string"), (0.0, 0.1, 0.5, 1.0)).collect())
    assert [r.reads for r in out] == [0, 40, 200, 400] and out[0].saturation == 0
    assert abs(out[-1].saturation - (1 - len({x[1:] for x in rows}) / 400)) < 1e-12
    assert [r.umis_per_cell for r in out] == sorted(r.umis_per_cell for r in out)


def test_matrix_filters(spark):
    rows = [("a", "c1", 3), ("b", "c1", 1), ("MT-x", "c1", 1), ("a", "c2", 2), ("b", "c2", 2), ("a", "c3", 9), ("MT-x", "c2", 8)]
    out = M.filter_matrix(spark.createDataFrame(rows, "gene string, barcode string, n long"), min_features=2, min_cells=2, max_mito=40, norm=100).collect()
    assert {(r.gene, r.barcode) for r in out} == {("a", "c1"), ("b", "c1"), ("MT-x", "c1")}


def test_read_qc_of_one_and_of_no_read(spark):
    one = spark.createDataFrame([("s", 700)], "s string, l long")
    counts = R.length_counts(one, ["s"], "l")
    assert R.n50(counts, ["s"]).first().n50 == 700
    (point,) = R.yield_curve(counts, ["s"]).collect()
    assert (point.read_rank, point.x_kb) == (0, 0.7)
    assert R.n50(R.length_counts(one.limit(0), ["s"], "l"), ["s"]).count() == 0
