"""Products and matrices of few rows that must still be spread over tasks or resolved without tiles."""

from pyspark.sql import functions as F

from cellweave.operators import barcodes as B
from cellweave.operators import umi as U
from cellweave.plans import cells
from tests.test_operators import _collapse
from tests.test_umi_visits import _dense


def test_expand_whitelist_spreads_the_product(spark):
    tens = ["ACGT" * 2 + a + b for a in "ACGT" for b in "ACGT"]
    out = B.expand_whitelist(spark.createDataFrame([(t,) for t in tens], "t string"), "t", "CCTTCC")
    assert sorted(r.barcode for r in out.collect()) == sorted(a + "CCTTCC" + b for a in tens for b in tens)
    filled = out.groupBy(F.spark_partition_id()).count().count()
    assert filled > 4  # 16 entries in at least 16 partitions; adaptive execution put all into one


def test_corrected_matrix_of_a_large_group_needs_no_tiles(spark, tmp_path, monkeypatch):
    counts = _dense(300)
    rows = [(f"r{i}-{u}", "HS_A", "cell", u) for u, n in counts.items() for i in range(n)] + [("x", "HS_chr1_10_20", "cell", "ACGT")]
    spark.createDataFrame(rows, "read_id string, gene string, barcode string, umi string").write.parquet(f"{tmp_path}/cell_umi_gene.parquet")

    def refuse(*_, **__):
        raise AssertionError("compared in tiles")

    monkeypatch.setattr(U, "tile_edges", refuse)
    monkeypatch.setattr(cells, "collapse_umis", lambda c, g: U.collapse_umis(c, g, whole=30))
    got = [tuple(r) for r in cells.corrected_matrix(spark, str(tmp_path)).select("gene", "barcode", "n").collect()]
    assert got == [("HS_A", "CELL", len(set(_collapse(counts).values())))]


def test_corrected_matrix_resolves_no_placeholders(spark, tmp_path, monkeypatch):
    """Regions aren't in the matrix, so that their UMIs aren't resolved, and no UMI is moved again to be counted."""
    rows = [("a", "HS_A", "c", "ACGTACGT"), ("b", "HS_A", "c", "ACGTACGA"), ("d", "HS_A", "c", "TTTTTTTTTTTT"), ("e", "HS_chr1_10_20", "c", "ACGT")]
    spark.createDataFrame(rows, "read_id string, gene string, barcode string, umi string").write.parquet(f"{tmp_path}/cell_umi_gene.parquet")
    genes = []

    def seen(counts, group):
        genes.extend(r.gene for r in counts.select("gene").distinct().collect())
        return U.collapse_umis(counts, group)

    monkeypatch.setattr(cells, "collapse_umis", seen)
    assert [tuple(r) for r in cells.corrected_matrix(spark, str(tmp_path)).collect()] == [("HS_A", "C", 2)]
    assert genes == ["HS_A"]
