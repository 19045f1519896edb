"""Metrics, species tables, features of hits, and what their limits do."""

import decimal

import pytest
from pyspark.sql import functions as F

from cellweave import session
from cellweave.functions.text import parse_number, whole_number
from cellweave.operators import barcodes as B
from cellweave.operators import features as X
from cellweave.operators import intervals as I
from cellweave.operators import metrics
from cellweave.operators import molecules as M
from cellweave.operators import pairs as P
from cellweave.sources import fastq, tables


def test_numbers_in_texts(spark):
    cases = {
        "1,234.5": (1234.5, None), " 12 ": (12.0, 12), "12.0": (12.0, 12), "1.2e3": (1200.0, 1200), "1200e-2": (1200e-2, 12), "7%": (7.0, None), "-3": (-3.0, None), "": (None, None), "abc": (None, None),
        None: (None, None), "0": (0.0, 0), "000": (0.0, 0), "1.5": (1.5, None), "12345678901234567890123": (12345678901234567890123.0, 12345678901234567890123), "1e40": (1e40, None), ".": (None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    out = {r.t: (r.a, r.b) for r in df.select("t", parse_number("t").alias("a"), whole_number("t").alias("b")).collect()}
    assert out == {k: (a, None if b is None else decimal.Decimal(b)) for k, (a, b) in cases.items()}


def test_checked_totals(spark):
    df = lambda rows: spark.createDataFrame(rows, "gene string, n string")
    assert {(r.gene, int(r.total)) for r in M.checked_totals(df([("a", "3"), ("a", "4.0"), ("b", "0")]), "gene").collect()} == {("a", 7), ("b", 0)}
    for rows in ([("a", "1.5")], [("a", None)], [("a", "-1")], [("a", str(2**32))]):
        with pytest.raises(Exception, match="not a count"):
            M.checked_totals(df(rows), "gene").collect()
    with pytest.raises(Exception, match="too large"):
        M.checked_totals(df([("a", "5"), ("a", "6")]), "gene", max_total=10).collect()
    assert M.checked_totals(df([]), "gene").count() == 0


def test_cells_of_placeholders_alone_stay(spark):
    rows = [("r1", "G1", "c1", "u1"), ("r2", "G1", "c1", "u1"), ("r3", "CHR1_1000_2000", "c2", "u1")]
    df = spark.createDataFrame(rows, "read_id string, gene string, barcode string, umi string")
    assert {(r.barcode, r.n_features, r.n) for r in M.matrix_cells(df).collect()} == {("c1", 1, 1), ("c2", 0, 0)}
    layout = {r.barcode: (r.x, r.y, r.label, r.status) for r in M.fallback_layout(M.matrix_cells(df).select("barcode", "n")).collect()}
    assert layout == {"c1": (0.0, 0.0, "0", "fallback"), "c2": (0.0, -1.0, "unassigned", "unassigned")}
    empty = M.fallback_layout(spark.createDataFrame([("a", 0), ("b", 0)], "barcode string, n long")).collect()
    assert {(r.x, r.y, r.label) for r in empty} == {(-0.5, 0.0, "unassigned"), (0.5, 0.0, "unassigned")}
    assert M.needs_fallback(M.gene_matrix(df)).first().fallback


def test_species_tables(spark):
    cells = spark.createDataFrame([("a", "mixed", 30, 5, 40), ("b", "human_singlet", 50, 0, 50), ("c", "mixed", 3, 4, 90)], "cell_id string, assignment string, umi_human long, umi_mouse long, umi_total long")
    assert {r.cell_id for r in M.ambient_cells(cells, 20).collect()} == {"c"} and {r.cell_id for r in M.drop_ambient(cells, 20).collect()} == {"a", "b"}
    assert M.ambient_cells(cells, 0).count() == 0 and M.least_molecules(cells, 50).count() == 2
    assert tuple(M.filter_stats(cells, F.col("umi_total") >= 50).first()) == (3, 2, 1)
    assert [r.cell_id for r in M.by_assignment(cells).collect()] == ["b", "c", "a"]
    core = spark.createDataFrame([("a", "t", "x| |y|z"), ("b", None, ""), ("b", "u", "q")], "cell_id string, type string, barcodes string")
    joined = M.attach_metadata(cells.withColumn("core_type", F.lit("old")), core)
    assert {r.cell_id: (r.core_type, r.n_barcodes) for r in joined.collect()} == {"a": ("t", 3), "b": ("", 0), "c": (None, None)}
    assert {r.cell_id for r in M.with_barcode_count(joined, "3, 0x".replace("0x", "4")).collect()} == {"a"} and M.with_barcode_count(cells, None).count() == 3
    for bad in ("0", "x", "1,-2"):
        with pytest.raises(ValueError):
            M.whole_numbers(bad)
    with pytest.raises(ValueError):
        M.with_barcode_count(cells, "2")
    with pytest.raises(Exception, match="comes twice"):
        M.attach_metadata(cells.unionByName(cells), core).collect()
    numbers = M.attach_metadata(cells, spark.createDataFrame([("a", "7"), ("b", "?")], "cell_id string, n_barcodes string"))
    assert {r.cell_id: r.n_barcodes for r in numbers.collect()} == {"a": 7, "b": 0, "c": None}


def test_first_rows_of_a_key_without_sorting_it_whole(spark, monkeypatch):
    rows = [(k, i % 7, str(i)) for i in range(60) for k in ("hot", "cold" if i < 5 else "hot")] + [("hot", 0, "0")] * 3 + [(None, None, "x")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(5)
    outs = []
    for bound in (1000, 1):
        monkeypatch.setattr(M, "WINDOW_ROWS", bound)
        outs.append(sorted(map(str, M.first_per_key(df, ["k"], ["o", "v"], 9).collect())))
    assert outs[0] == outs[1] and len(outs[0]) == 9 + 5 + 1


def test_wide_quantiles_and_summaries(spark):
    df = spark.createDataFrame([(1, None), (2, 8.0), (9, 4.0), (4, None)], "a int, b double")
    assert tuple(metrics.wide_quantiles(df, {"x": ("a", 0.5), "y": ("b", 0.25)}).first()) == (3.0, 5.0)
    assert tuple(metrics.wide_quantiles(df.limit(0), {"x": ("a", 0.5)}).first()) == (None,)
    records = spark.createDataFrame([("a", 0), ("a", 2048), ("b", 4), ("c", 256), ("c", 16)], "read_id string, flag int")
    final = spark.createDataFrame([("a",), ("b",), ("a",)], "read_id string")
    assert tuple(metrics.alignment_summary(records, final).first()) == (5, 1, 2, 1, 2, 1)
    assert tuple(metrics.alignment_summary(records.limit(0), final).first()) == (0, 0, 0, 0, 0, 0)
    calls = spark.createDataFrame([("a", "Assigned", "t1"), ("a", "Assigned", "t2"), ("b", "Assigned", "NA"), ("b", "Unassigned_mapq", "t3"), ("z", "Assigned", "t4")], "read_id string, status string, transcript_id string")
    assert tuple(metrics.transcript_summary(calls, final).first()) == (1, 2)


def test_transcript_reference(spark):
    rows = [
        ("transcript", 'gene_id "g1"; transcript_id "t1"; gene_name "own";'), ("mRNA", 'gene_id "g2"; transcript_id "t2"; gene_name ".";'), ("Gene", 'gene_id "g2"; genename "of gene";'),
        ("transcript", 'gene_id "g3"; transcript_id "t3";'), ("EXON", 'gene_id "g3"; transcript_id "other"; gene_name "of exon";'), ("transcript", 'gene_id "g4"; transcript_id "t4"; gene_name "NA";'), ("exon", None),
    ]
    gtf = spark.createDataFrame(rows, "feature string, attributes string")
    assert {r.transcript_id: r.gene for r in X.transcript_reference(gtf).collect()} == {"t1": "own", "t2": "of gene", "t3": "of exon", "t4": "g4"}
    nameless = spark.createDataFrame([("transcript", 'gene_id "-"; transcript_id "t9";')], "feature string, attributes string")
    with pytest.raises(Exception, match="without a gene name or id: t9"):
        X.transcript_reference(nameless).collect()
    assert X.transcript_reference(gtf.limit(0)).count() == 0


def test_candidates_come_before_ranking(spark):
    tmap = spark.createDataFrame([("q1", "t1", "="), ("q2", "t2", "i"), ("q3", "novel", "u"), ("q4", None, "=")], "qry_id string, ref_id string, class_code string")
    reference = spark.createDataFrame([("t1", "G1"), ("t2", "G2")], "transcript_id string, gene string")
    known = X.candidates(tmap, reference)
    assert {tuple(r) for r in known.collect()} == {("q1", "G1", "t1"), ("q2", "G2", "-")}
    hits = [("r", "q3", 900, "100M", 60, 0), ("r", "q1", 50, "80M10I10S", 5, 1), ("s", "q1", 5, None, 5, 0), ("s", "q2", None, "50M", 5, 1)]
    a = spark.createDataFrame(hits, "read_id string, query_id string, score int, cigar string, mapq int, ord int")
    lengths = spark.createDataFrame([("q1", 160), ("q2", 100), ("q3", 100)], "query_id string, length int")
    found = {(r.read_id, r.ord): (r.gene, r.score, r.query_cov, r.transcript_cov) for r in X.hit_features(a, known, lengths).collect()}
    assert found == {("r", 1): ("G1", 50, 0.9, 0.5), ("s", 1): ("G2", 0, 1.0, 0.5)}
    reads = spark.createDataFrame([("r", 60), ("s", 60), ("none", 60), ("low", 3)], "read_id string, genome_mapq int")
    chosen = {r.read_id: (r.gene, r.transcript, r.reason) for r in X.select_features(X.hit_features(a, known, lengths), reads).collect()}
    assert chosen == {"r": ("G1", "t1", "candidate"), "s": ("G2", "-", "candidate"), "none": ("-", "-", "no_reference_candidate"), "low": ("-", "-", "no_reference_candidate")}
    features = spark.createDataFrame([("c", "a", "-", "-", "ambiguous_or_zero_transcript_mapq"), ("c", "b", "G", "-", "candidate")], "chrom string, read_id string, gene string, transcript string, reason string")
    records = spark.createDataFrame([("c", "a", 60), ("d", "a", 60), ("c", "b", 60), ("c", "a", 3)], "chrom string, read_id string, mapq int")
    out = [(r.mapq, r.gene_status, r.gene, r.transcript_status) for r in X.assignment_status(records, features).collect()]
    assert sorted(out) == [(3, "Unassigned_mapq", "NA", "Unassigned_ambiguous"), (60, "Assigned", "G", "Unassigned_ambiguous"), (60, "Unassigned_ambiguous", "NA", "Unassigned_ambiguous"), (60, "Unassigned_no_features", "NA", "Unassigned_no_features")]
    assert {r.counter: r.n for r in X.status_counts(X.assignment_status(records, features)).collect()}["gene:Assigned"] == 1


def test_records_and_tags(spark):
    rows = [("a", 64, "c", 10, "5M10N5M", 60), ("b", 4, "c", 10, "5M", 60), ("c", 16, None, 10, "5M", 60), ("d", 128 + 16, "c", 0, "20M", 10), ("e", 0, "c", -1, "5M", 1), ("u", 0, "c", 12, "5M", 60)]
    a = spark.createDataFrame(rows, "read_id string, flag int, chrom string, start long, cigar string, mapq int")
    assert {tuple(r) for r in I.bed_records(a).collect()} == {("c", 10, 30, "a/1", 60, "+"), ("c", 0, 20, "d/2", 10, "-"), ("c", 12, 17, "u", 60, "+")}
    tags = spark.createDataFrame([("a", "cell2", "v"), ("a", "cell1", "u"), ("d", "cell1", "w")], "read_id string, barcode string, umi string")
    genes = spark.createDataFrame([("c", 0, 15, "+", "G")], "chrom string, start long, end long, strand string, label string")
    assert {tuple(r) for r in I.tag_and_assign(a, tags, genes).collect()} == {("a", "cell1", "u", "Assigned", 60, "G"), ("d", "cell1", "w", "Unassigned_mapq", 10, "NA")}
    assert {r.read_id for r in I.tag_and_assign(a, tags, genes, keep_untagged=True).collect()} == {"a", "d", "u"}


def test_trimmed_reads_and_known_barcodes(spark):
    reads = spark.createDataFrame([("a", "ACGTAC", "IJKLMN", (1, 4)), ("b", "AC", "IJ", None)], "read_id string, seq string, qual string, b struct<start:int,end:int>")
    clean = spark.createDataFrame([("a",), ("b",)], "read_id string")
    assert {tuple(r) for r in B.trimmed_reads(clean, reads, "seq", "qual", "b").collect()} == {("a", "CGT", "JKL", False), ("b", "AC", "IJ", True)}
    with pytest.raises(Exception, match="no sequence: z"):
        B.trimmed_reads(spark.createDataFrame([("z",)], "read_id string"), reads, "seq", "qual", "b").collect()
    rows = spark.createDataFrame([("x", None), ("x", 1), ("y", 1), ("z", 9), (" ", 9), (None, 9)], "b string, q int")
    assert {r.barcode for r in B.known_barcodes(rows, "b", "q", 2).collect()} == {"x", "z"}


def test_clean_reads_and_stated_minimum(spark):
    rows = [(i, "a", "b", "U", "V") for i in range(3)] + [(3, "b", "a", None, None), (4, "a", "c", "U", None), (5, "a", None, "U", None), (6, None, None, "U", "V")]
    df = spark.createDataFrame(rows, "id int, s string, t string, u5 string, u3 string")
    assert sorted(r.id for r in P.clean_reads(df, "s", "t", "u5", "u3", floor=4).collect()) == [0, 1, 2, 5]
    support = spark.createDataFrame([("a", "b", 8)], "u string, v string, n_reads long")
    assert tuple(P.pair_minimum(support, stated=3).first()) == (3, "manual") and P.pair_minimum(support.limit(0)).first().mode == "auto_empty"


def test_prefixes_and_lists(spark, tmp_path):
    bed = spark.createDataFrame([("chr1", "g||t|x"), ("hs_chr1", "hs_g")], "chrom string, name string")
    assert {tuple(r) for r in tables.prefix_bed(bed, "hs").collect()} == {("hs_chr1", "hs_g||hs_t|x"), ("hs_chr1", "hs_g")}
    lines = spark.createDataFrame([(">chr1 a b",), ("ACGT",), (">hs_chr2",), (">",)], "value string")
    assert [r.value for r in tables.prefix_fasta(lines, "hs").collect()] == [">hs_chr1 a b", "ACGT", ">hs_chr2", ">"]
    sizes = spark.createDataFrame([("chr1", 5)], "chrom string, size int")
    assert {r.chrom for r in tables.mixed_reference({"hs": sizes, "mm": sizes}, tables.prefix_sizes).collect()} == {"hs_chr1", "mm_chr1"}
    for text in ("No,Barcode\n1,acgtacgtac\n2, TTTTTTTTTT\n", "acgtacgtac\nTTTTTTTTTT\n\n", "id\tseq\n1\tACGTACGTAC\n2\ttttttttttt\n"):
        (tmp_path / "t.txt").write_text(text)
        assert sorted(r.ten for r in tables.read_tens(spark, str(tmp_path / "t.txt")).collect()) == ["ACGTACGTAC", "TTTTTTTTTT"]
    (tmp_path / "m.tmap").write_text("ref_gene_id\tref_id\tclass_code\tqry_id\ng\tt1\t=\tq1\n")
    assert tuple(tables.read_tmap(spark, str(tmp_path / "m.tmap")).first()) == ("q1", "t1", "=")


def test_plain_fastq_is_read_in_parts(spark, tmp_path):
    path = tmp_path / "x.fastq"
    records = [(f"r{i}", "ACGT" * (i % 9), "@+I@" * (i % 9)) for i in range(300)]
    path.write_text("".join(f"@{n} more\n{s}\n+{'' if len(s) % 3 else n}\n{q}\n" for n, s, q in records))
    df = fastq.read_fastq(spark, str(path), split=997)
    rows = df.collect()
    assert sorted((r.read_id, r.seq, r.qual) for r in rows) == sorted(records) and len({r.ord for r in rows}) == 300
    assert [r.read_id for r in sorted(rows, key=lambda r: r.ord)] == [n for n, _, _ in records]
    assert fastq.read_fastq(spark, path.as_uri()).count() == 300 and fastq.read_fastq(spark, f"{tmp_path}/*.fastq").count() == 300


def test_written_tables_are_dropped(spark):
    stage = session.materialize(spark.range(5).withColumn("k", F.col("id") % 2), "x", by="k")
    assert stage.df.filter("k = 1").count() == 2 and stage.df.columns == ["id", "k"]
    assert session.release(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(stage.path)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_folder(Session())
