"""Molecule table (read_id, gene, barcode, umi): matrices, per-cell quality, saturation and species purity."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.text import clean_key, parse_number, whole_number
from cellweave.operators.metrics import wide_quantiles
from cellweave.operators.prefix import running_sum
from cellweave.session import materialize


def molecules(df: DataFrame) -> DataFrame:
    """The four columns trimmed and in upper case, rows with a missing gene, barcode or UMI left out."""
    rows = df.select(F.trim("read_id").alias("read_id"), *(clean_key(c).alias(c) for c in ("gene", "barcode", "umi")))
    return rows.filter("gene IS NOT NULL AND barcode IS NOT NULL AND umi IS NOT NULL")


def is_placeholder(gene: Column) -> Column:
    """A region in place of a gene, as the matrices see it: it ends in _digits_digits."""
    return gene.rlike(r"^.+_[0-9]+_[0-9]+$")


def is_known_gene(gene: Column) -> Column:
    """Not missing and no letters_digits_digits anywhere, as the quality metrics see it."""
    return ~F.trim(gene).isin("", "NA", "nan", "None", "NAN", "NONE") & ~gene.rlike(r"[A-Za-z0-9]+_[0-9]+_[0-9]+")


def is_mito(gene: Column, mixed: bool = True) -> Column:
    """Mitochondrial by its prefix, in mixed samples also after the species prefix."""
    return gene.rlike(r"^(?:[^_]*_)?(?:MT|mt|Mt)-" if mixed else r"^(?:MT|mt|Mt)-")


def count_matrix(rows: DataFrame, feature: str, cell: str = "barcode", umi: str = "umi") -> DataFrame:
    """feature, cell, n: distinct UMIs, in long form."""
    return rows.select(feature, cell, umi).distinct().groupBy(feature, cell).agg(F.count("*").alias("n"))


def gene_matrix(rows: DataFrame) -> DataFrame:
    return count_matrix(rows.filter(~is_placeholder(F.col("gene"))), "gene")


def matrix_cells(rows: DataFrame) -> DataFrame:
    """barcode, n_features, n: every cell of the input, those that hold placeholders alone with 0, as the columns of a matrix."""
    counted = gene_matrix(rows).groupBy("barcode").agg(F.count("*").alias("_f"), F.sum("n").alias("_n"))
    return rows.select("barcode").distinct().join(counted, "barcode", "left").select(
        "barcode", F.coalesce("_f", F.lit(0)).alias("n_features"), F.coalesce("_n", F.lit(0)).alias("n")
    )


#: Largest count of a cell and largest total, as the formats that hold them can take.
MAX_COUNT, MAX_TOTAL = 2**32 - 1, 2**64 - 1


def checked_totals(matrix: DataFrame, feature: str, n: str = "n", max_count: int = MAX_COUNT, max_total: int = MAX_TOTAL) -> DataFrame:
    """`feature`, total DECIMAL(38, 0) of counts given as text or number; a count that is no whole number or too large, or a total
    too large, raises an error. NULL is no count."""
    count = whole_number(F.col(n).cast("string"))
    wrong = F.raise_error(F.concat(F.lit("not a count: "), F.coalesce(F.col(n).cast("string"), F.lit("NULL"))))
    checked = F.when(count.isNull() | (count > F.lit(max_count).cast("decimal(38,0)")), wrong).otherwise(count)
    totals = matrix.select(feature, checked.alias("_n")).groupBy(feature).agg(F.sum("_n").cast("decimal(38,0)").alias("total"))
    over = F.raise_error(F.concat(F.lit("a total is too large: "), F.col("total").cast("string")))
    return totals.select(feature, F.when(F.col("total") > F.lit(str(max_total)).cast("decimal(38,0)"), over).otherwise(F.col("total")).alias("total"))


def needs_fallback(matrix: DataFrame, feature: str = "gene") -> DataFrame:
    """One row, `fallback`: whether the cells with counts are too few or too alike to be clustered."""
    counts = matrix.filter("n > 0")
    sizes = counts.agg(F.countDistinct("barcode").alias("_c"), F.countDistinct(feature).alias("_f"))
    return sizes.crossJoin(F.broadcast(identical_profiles(counts, feature))).select(  # one row
        ((F.col("_c") < 4) | (F.col("_f") < 2) | F.col("identical")).alias("fallback")
    )


def fallback_layout(cells: DataFrame) -> DataFrame:
    """barcode, x, y, label, status, n of cells (barcode, n) that aren't clustered: a centred line in the order of their names.

    Cells without counts stand in a line of their own one below, unassigned. Places come from running counts, so that no task
    holds all cells.
    """
    rows = cells.select("barcode", "n", (F.col("n") > 0).alias("_some"), F.lit(1).cast("long").alias("_one"))
    numbered, written = running_sum(rows, ["_some"], ["barcode"], {"_no": "_one"}, name="layout")
    sizes = written.df.groupBy(F.col("_some").alias("_kind")).agg(F.count("*").alias("_size"))  # two rows
    some = written.df.agg(F.coalesce(F.max("_some"), F.lit(False)).alias("_any"))  # one row
    x = F.col("_no") - 1 - (F.col("_size") - 1) / F.lit(2.0)
    y = F.when(F.col("_some") | ~F.col("_any"), 0.0).otherwise(-1.0)
    label = lambda a, b: F.when(F.col("_some"), a).otherwise(b)
    return numbered.join(F.broadcast(sizes), F.col("_some") == F.col("_kind")).crossJoin(F.broadcast(some)).select(
        "barcode", x.alias("x"), y.alias("y"), label("0", "unassigned").alias("label"), label("fallback", "unassigned").alias("status"), "n"
    )


def pivot_matrix(matrix: DataFrame, feature: str, cells: Sequence[str]) -> DataFrame:
    """One row per feature and one column per listed cell, absent counts 0. For export of a bounded list of cells."""
    return matrix.groupBy(feature).pivot("barcode", list(cells)).agg(F.sum("n")).na.fill(0).orderBy(feature)


def per_cell_qc(rows: DataFrame, mixed: bool = True) -> DataFrame:
    """barcode, n_reads, n_umis, n_genes, mito_percent; UMIs and genes of known genes only.

    Each distinct count goes over distinct pairs first, so that a hot cell is spread over tasks.
    """
    known = is_known_gene(F.col("gene"))
    pairs = rows.select("barcode", F.explode(F.array(
        F.struct(F.lit("r").alias("k"), F.col("read_id").alias("v")),
        F.struct(F.lit("u").alias("k"), F.when(known, F.col("umi")).alias("v")),
        F.struct(F.lit("g").alias("k"), F.when(known, F.col("gene")).alias("v")),
    )).alias("_p")).select("barcode", "_p.*").filter("v IS NOT NULL").distinct()
    counts = pairs.groupBy("barcode").agg(*(F.count_if(F.col("k") == k).alias(n) for k, n in (("r", "n_reads"), ("u", "n_umis"), ("g", "n_genes"))))
    mito = rows.groupBy("barcode").agg(F.count_if(is_mito(F.col("gene"), mixed)).alias("_mito"))
    return counts.join(mito, "barcode").select(
        "barcode", "n_reads", "n_umis", "n_genes",
        F.coalesce(F.try_divide(F.col("_mito"), F.col("n_reads")) * 100, F.lit(0.0)).alias("mito_percent"),
    )


def saturation(rows: DataFrame, fractions: Sequence[float], salt: int = 42) -> DataFrame:
    """fraction, reads, reads_per_cell, genes_per_cell, umis_per_cell, saturation for nested samples of the rows.

    Rows are ranked once in a fixed random order; an item belongs to every sample that its first rank
    is in, so all fractions come from one pass over the first ranks. A molecule is its joined text.
    """
    keyed = rows.select("*", F.concat_ws("_", "gene", "barcode", "umi").alias("_mol")).withColumn(
        "_o", F.md5(F.concat_ws("|", F.lit(str(salt)), "read_id", "gene", "barcode", "umi"))
    ).withColumn("_one", F.lit(1).cast("long"))
    ranked, _ = running_sum(keyed, [], ["_o", "read_id", "gene", "barcode", "umi"], {"_rank": "_one"}, name="ranks")
    total = rows.agg(F.count("*").alias("_all"))
    sizes = total.select(F.explode(F.array(*(F.lit(float(f)) for f in fractions))).alias("fraction"), "_all").select(
        "fraction", F.rint(F.col("fraction") * F.col("_all")).cast("long").alias("reads")
    )
    kinds = F.array(
        F.struct(F.lit("r").alias("k"), F.col("read_id").alias("v")),
        F.struct(F.lit("u").alias("k"), F.col("umi").alias("v")),
        F.struct(F.lit("g").alias("k"), F.when(is_known_gene(F.col("gene")), F.col("gene")).alias("v")),
        F.struct(F.lit("c").alias("k"), F.lit("").alias("v")),
    )
    firsts = ranked.select("barcode", "_rank", F.explode(kinds).alias("_k")).select("barcode", "_k.*", "_rank").filter("v IS NOT NULL")
    firsts = firsts.groupBy("barcode", "k", "v").agg(F.min("_rank").alias("_rank"))
    # One row for each listed fraction, so that the product stays in proportion to the items.
    per_cell = firsts.join(F.broadcast(sizes), F.col("_rank") <= F.col("reads")).groupBy("fraction", "reads", "barcode").agg(
        *(F.count_if(F.col("k") == k).alias(n) for k, n in (("r", "_r"), ("u", "_u"), ("g", "_g")))
    )
    medians = per_cell.groupBy("fraction").agg(
        F.median("_r").alias("reads_per_cell"), F.median("_g").alias("genes_per_cell"), F.median("_u").alias("umis_per_cell")
    )
    seen = ranked.groupBy("_mol").agg(F.min("_rank").alias("_rank")).join(F.broadcast(sizes), F.col("_rank") <= F.col("reads"))
    distinct = seen.groupBy("fraction").agg(F.count("*").alias("_mols"))
    return sizes.join(medians, "fraction", "left").join(distinct, "fraction", "left").select(
        "fraction",
        "reads",
        *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("reads_per_cell", "genes_per_cell", "umis_per_cell")),
        F.when(F.col("reads") > 0, 1 - F.coalesce("_mols", F.lit(0)) / F.col("reads")).otherwise(0.0).alias("saturation"),
    )


def filter_matrix(matrix: DataFrame, feature: str = "gene", min_features: int = 200, min_cells: int = 3, max_mito: float = 20.0, norm: float = 10000.0) -> DataFrame:
    """feature, barcode, n, value: cells and features with enough entries, few mitochondrial counts, log10(1 + normalised).

    Both minimums are taken on the whole matrix; the mitochondrial share on what is left of it.
    """
    features = matrix.groupBy(feature).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_cells).select(feature)
    cells = matrix.groupBy("barcode").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_features).select("barcode")
    left = matrix.join(features, feature, "left_semi").join(cells, "barcode", "left_semi")
    mito = F.col(feature).contains("MT-") | F.col(feature).contains("mt-")
    totals = left.groupBy("barcode").agg(F.sum("n").alias("_total"), F.coalesce(F.sum(F.when(mito, F.col("n"))), F.lit(0)).alias("_mito"))
    keep = totals.filter((F.col("_total") > 0) & (F.col("_mito") <= F.lit(max_mito / 100) * F.col("_total")))
    return left.join(keep, "barcode").select(
        feature, "barcode", "n", (F.log1p(F.col("n") * norm / F.col("_total")) / F.log(F.lit(10.0))).alias("value")
    )


def identical_profiles(matrix: DataFrame, feature: str = "gene") -> DataFrame:
    """One row, `identical`: whether all cells have the same counts, compared by a digest of the sorted counts."""
    digests = matrix.groupBy("barcode").agg(
        F.sum(F.xxhash64(feature, "n").cast("decimal(38,0)")).alias("_d"), F.count("*").alias("_n")
    )
    return digests.agg((F.countDistinct("_d", "_n") <= 1).alias("identical"))


SPECIES = {"human": "HS_", "mouse": "MM_"}


def species(gene: Column) -> Column:
    return F.when(gene.startswith(SPECIES["human"]), "human").when(gene.startswith(SPECIES["mouse"]), "mouse").otherwise("other")


def species_cells(rows: DataFrame, singlet: float = 0.9) -> DataFrame:
    """Per cell: reads, molecules and genes by species, fractions, and the assignment."""
    r = rows.withColumn("_s", species(F.col("gene")))
    kinds = F.array(
        F.struct(F.lit("read").alias("k"), F.col("read_id").alias("v"), F.lit("").alias("w")),
        F.struct(F.lit("umi").alias("k"), F.col("gene").alias("v"), F.col("umi").alias("w")),
        F.struct(F.lit("gene").alias("k"), F.col("gene").alias("v"), F.lit("").alias("w")),
    )
    once = r.select("barcode", "_s", F.explode(kinds).alias("_k")).select("barcode", "_s", "_k.*").distinct()
    names = [*SPECIES, "other"]
    counts = once.groupBy(F.col("barcode").alias("cell_id")).agg(
        *(F.count_if((F.col("k") == k) & (F.col("_s") == s)).alias(f"{k}_{s}") for k in ("read", "umi", "gene") for s in names)
    )
    for k in ("read", "umi", "gene"):
        counts = counts.withColumn(f"{k}_total", sum((F.col(f"{k}_{s}") for s in names), F.lit(0)).cast("long"))
    part = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    counts = counts.select(
        "*",
        *(part(f"{k}_{s}", f"{k}_total").alias(f"{s}_{k}_fraction") for k in ("read", "umi") for s in SPECIES),
    )
    h, m = F.col("human_umi_fraction"), F.col("mouse_umi_fraction")
    assignment = F.when(m >= singlet, "mouse_singlet").when(h >= singlet, "human_singlet").when((h > 0) & (m > 0), "mixed").otherwise("unclassified")
    return counts.select("*", F.least(h, m).alias("minority_umi_fraction"), assignment.alias("assignment"))


def drop_ambient(cells: DataFrame, least: int = 1000) -> DataFrame:
    """Cells with at least so many molecules of one species; all of them where the limit isn't positive."""
    return cells if least <= 0 else cells.filter(~_ambient(least))


def ambient_cells(cells: DataFrame, least: int = 1000) -> DataFrame:
    """The cells that `drop_ambient` removes."""
    return cells.filter(_ambient(least) if least > 0 else F.lit(False))


def _ambient(least: int) -> Column:
    return (F.col("umi_human") < least) & (F.col("umi_mouse") < least)


def filter_stats(cells: DataFrame, kept: Column) -> DataFrame:
    """One row: cells before and after a filter, and removed by it."""
    return cells.agg(F.count("*").alias("cells_before"), F.count_if(kept).alias("cells_after"), F.count_if(~kept).alias("cells_removed"))


def least_molecules(cells: DataFrame, least: int) -> DataFrame:
    """Cells with at least so many molecules over all species."""
    return cells.filter(F.col("umi_total") >= least)


def whole_numbers(listed: str | None) -> list[int] | None:
    """The different numbers of a comma list, sorted; None if it names none. Others than whole numbers from 1 on are errors."""
    parts = [p.strip() for p in (listed or "").split(",") if p.strip()]
    if any(not p.lstrip("+").isdigit() or int(p) < 1 for p in parts):
        raise ValueError(f"not a list of whole numbers from 1 on: {listed!r}")
    return sorted({int(p) for p in parts}) or None


def with_barcode_count(cells: DataFrame, listed: str | None) -> DataFrame:
    """Cells whose `n_barcodes` is one of a comma list; all of them without a list."""
    values = whole_numbers(listed)
    if values and "n_barcodes" not in cells.columns:
        raise ValueError("cells have no n_barcodes: attach their metadata first")
    return cells.filter(F.col("n_barcodes").isin(values)) if values else cells


def attach_metadata(cells: DataFrame, metadata: DataFrame) -> DataFrame:
    """Cells with core_type and n_barcodes of the metadata (cell_id, type, and n_barcodes or barcodes joined by |).

    A cell that comes twice in `cells` is an error; of several rows of a cell in the metadata the smallest counts. A number of barcodes that
    is none is 0; a cell without metadata has NULLs.
    """
    listed = F.filter(F.split(F.coalesce("barcodes", F.lit("")), r"\|"), lambda b: F.trim(b) != "") if "barcodes" in metadata.columns else None
    count = F.coalesce(parse_number(F.col("n_barcodes").cast("string")), F.lit(0.0)).cast("int") if "n_barcodes" in metadata.columns else F.lit(None).cast("int") if listed is None else F.size(listed)
    kind = F.coalesce(F.col("type").cast("string"), F.lit("")) if "type" in metadata.columns else F.lit(None).cast("string")
    one = metadata.groupBy("cell_id").agg(F.min(F.struct(kind.alias("core_type"), count.alias("n_barcodes"))).alias("_m")).select("cell_id", "_m.*")
    twice = cells.groupBy("cell_id").agg(F.count("*").alias("_times"))
    checked = F.when(F.col("_times") > 1, F.raise_error(F.concat(F.lit("a cell comes twice: "), F.col("cell_id")))).otherwise(F.col("cell_id"))
    rest = [c for c in cells.columns if c not in ("cell_id", "core_type", "n_barcodes")]
    return cells.drop("core_type", "n_barcodes").join(twice, "cell_id").join(one, "cell_id", "left").select(checked.alias("cell_id"), "core_type", "n_barcodes", *rest)


def by_assignment(cells: DataFrame) -> DataFrame:
    """Cells in the order of their assignment, those with most molecules first."""
    return cells.orderBy("assignment", F.desc("umi_total"), "cell_id")


def _long(one: DataFrame, names: Sequence[str]) -> DataFrame:
    """metric, value DOUBLE of a table of one row."""
    return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names))).alias("_m")).select("_m.*")


def species_summary(cells: DataFrame) -> DataFrame:
    """metric, value of the cells by assignment; NULL where there is nothing to divide or rank."""
    a = F.col("assignment")
    only = lambda kind, c: F.when(a == kind, F.col(c))
    n = lambda kind: F.count_if(a == kind)
    h = only("mixed", "human_umi_fraction")
    near = h.between(0.4, 0.6)
    far = h.between(0.05, 0.10) | h.between(0.90, 0.95)
    ranked = {f"{kind}:{c}": only(kind, c) for kind in ("human_singlet", "mouse_singlet", "mixed") for c in ("human_umi_fraction", "mouse_umi_fraction", "umi_total")}
    wanted = {
        "human_singlet_mouse_fraction_median": ("human_singlet:mouse_umi_fraction", 0.5),
        "human_singlet_mouse_fraction_p95": ("human_singlet:mouse_umi_fraction", 0.95),
        "mouse_singlet_human_fraction_median": ("mouse_singlet:human_umi_fraction", 0.5),
        "mouse_singlet_human_fraction_p95": ("mouse_singlet:human_umi_fraction", 0.95),
        "mixed_human_fraction_median": ("mixed:human_umi_fraction", 0.5),
        "mixed_mouse_fraction_median": ("mixed:mouse_umi_fraction", 0.5),
        **{f"{kind}_umi_total_median": (f"{kind}:umi_total", 0.5) for kind in ("human_singlet", "mouse_singlet", "mixed")},
    }
    cells = materialize(cells.select("assignment", "human_umi_fraction", "mouse_umi_fraction", "umi_total"), "cells").df
    quantiles = wide_quantiles(cells.select(*(v.alias(k) for k, v in ranked.items())), wanted)
    counts = {
        "total_cells": F.count("*"),
        "human_singlet_cells": n("human_singlet"),
        "mouse_singlet_cells": n("mouse_singlet"),
        "mixed_cells": n("mixed"),
        "unclassified_cells": n("unclassified"),
        "cross_species_doublet_rate_among_classified": F.try_divide(n("mixed"), n("human_singlet") + n("mouse_singlet") + n("mixed")),
        "mixed_near_50_50_cells": F.count_if(near),
        "mixed_near_50_50_fraction": F.try_divide(F.count_if(near), n("mixed")),
        "mixed_mostly_90_10_cells": F.count_if(far),
        "mixed_mostly_90_10_fraction": F.try_divide(F.count_if(far), n("mixed")),
    }
    one = cells.agg(*(c.alias(k) for k, c in counts.items())).crossJoin(quantiles)  # one row each
    return _long(one, [*counts, *wanted])


def purity(cells: DataFrame) -> DataFrame:
    """metric, value, text: own and all molecules of the singlets of each species, and overall; the names of the species have a text only."""
    a = F.col("assignment")
    total = lambda kind, c: F.coalesce(F.sum(F.when(a == kind, F.col(c))), F.lit(0))
    own0, all0 = total("human_singlet", "umi_human"), total("human_singlet", "umi_total")
    own1, all1 = total("mouse_singlet", "umi_mouse"), total("mouse_singlet", "umi_total")
    metrics = {
        "genome0_singlet_cells": F.count_if(a == "human_singlet"),
        "genome1_singlet_cells": F.count_if(a == "mouse_singlet"),
        "effective_singlet_cells_for_overall_purity": F.count_if(a.isin("human_singlet", "mouse_singlet")),
        "genome0_singlet_own_umis": own0,
        "genome0_singlet_total_umis": all0,
        "genome1_singlet_own_umis": own1,
        "genome1_singlet_total_umis": all1,
        "all_singlet_dominant_species_umis": own0 + own1,
        "all_singlet_total_umis": all0 + all1,
        "human_mean_purity": F.try_divide(own0, all0),
        "mouse_mean_purity": F.try_divide(own1, all1),
        "genome0_mean_purity": F.try_divide(own0, all0),
        "genome1_mean_purity": F.try_divide(own1, all1),
        "overall_purity": F.try_divide(own0 + own1, all0 + all1),
    }
    numbers = _long(cells.agg(*(c.alias(k) for k, c in metrics.items())), list(metrics)).withColumn("text", F.lit(None).cast("string"))
    names = [(f"genome{i}_name", None, name) for i, name in enumerate(SPECIES)]
    return cells.sparkSession.createDataFrame(names, numbers.schema).unionByName(numbers)


#: Rows of a key up to which a window keeps them without sorting the whole key.
WINDOW_ROWS = 1_000


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """The first `n` rows of each key in the given order; equal rows take places one after the other.

    Up to `WINDOW_ROWS` rows every task keeps its first rows of a key only. For more, ranks come from running counts over sorted ranges, so
    that no key is sorted in one task.
    """
    if n <= WINDOW_ROWS:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    told = rows.groupBy(*rows.columns).agg(F.count("*").alias("_times"))
    ranked, _ = running_sum(told, list(keys), [*order, *(c for c in rows.columns if c not in {*keys, *order})], {"_upto": "_times"}, name="firsts")
    kept = F.least(F.col("_times"), n - F.col("_upto") + F.col("_times"))
    return ranked.withColumn("_kept", kept.cast("int")).filter("_kept > 0").select(*rows.columns, F.explode(F.sequence(F.lit(1), F.col("_kept"))).alias("_i")).drop("_i")


def knee_points(counts: DataFrame, item: str, n: str, called: DataFrame, points: int = 20_000) -> DataFrame:
    """cell_rank, `item`, `n`, called: the points of a knee plot, by falling `n` and then `item`.

    Every rank is kept where there are at most `points`; beyond that as many ranks at equal steps of their
    logarithm, the first and the last among them. `called` tells whether the item is in the only column of
    `called`; if that has no values, all are.
    """
    if points < 2:
        raise ValueError("points must be 2 at least")
    spark = counts.sparkSession
    ordered = counts.select(item, n).withColumns({"_down": -F.col(n), "_one": F.lit(1).cast("long")})
    ranked, stage = running_sum(ordered, [], ["_down", item], {"cell_rank": "_one"}, name="knee")
    total = stage.df.count()
    if total > points:
        spaced = F.rint(F.exp(F.lit(math.log(total)) * F.col("id") / F.lit(points - 1))).cast("long")
        ends = spark.range(2).select((F.col("id") * (total - 1) + 1).alias("cell_rank"))
        ranks = spark.range(points).select(F.greatest(F.lit(1), F.least(F.lit(total), spaced)).alias("cell_rank"))
        ranked = ranked.join(ranks.unionByName(ends), "cell_rank", "left_semi")
    listed = called.select(F.col(called.columns[0]).alias("_called")).filter("_called IS NOT NULL").distinct()
    size = listed.agg(F.count("*").alias("_size"))  # one row
    flagged = ranked.join(listed, F.col(item) == F.col("_called"), "left").crossJoin(F.broadcast(size))
    return flagged.select("cell_rank", item, n, (F.col("_called").isNotNull() | (F.col("_size") == 0)).alias("called"))
