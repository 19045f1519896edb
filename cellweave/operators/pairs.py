"""Pairs of barcodes seen on one read: support, pruning by structure, components, cells and reads' cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cellweave.functions.seq import ratio_of
from cellweave.session import materialize

#: Categories of components small enough to be judged as a whole: nodes and edges between two nodes.
SMALL = {"pair_only": (2, 1), "triangle_only": (3, 3), "clique4_only": (4, 6), "clique5_only": (5, 10)}


def drop_a_rich(reads: DataFrame, umi: str, most: float = 0.5) -> DataFrame:
    """Reads whose UMI isn't mostly A; a missing UMI counts as having none."""
    return reads.filter(ratio_of(F.coalesce(F.col(umi), F.lit("")), "A") <= most)


def valid_reads(reads: DataFrame, bc5: str, bc3: str, umi5: str, umi3: str) -> DataFrame:
    """Reads with a barcode and a UMI at one end at least."""
    some = lambda *columns: F.coalesce(*(F.col(c) for c in columns)).isNotNull()
    return reads.filter(some(bc5, bc3) & some(umi5, umi3))


def in_pairs(reads: DataFrame, bc5: str, bc3: str, pairs: DataFrame) -> DataFrame:
    """Reads whose unordered pair of barcodes is one of `pairs` (u, v), and all reads with fewer than two barcodes.

    The latter don't go through the join, where they would all meet under one missing key.
    """
    two = F.col(bc5).isNotNull() & F.col(bc3).isNotNull()
    kept = pairs.select(F.least("u", "v").alias("_u"), F.greatest("u", "v").alias("_v"))
    on = (F.least(F.col(bc5), F.col(bc3)) == F.col("_u")) & (F.greatest(F.col(bc5), F.col(bc3)) == F.col("_v"))
    return reads.filter(~two).unionByName(reads.filter(two).join(kept, on, "left_semi"))


def edge_umi(bc5: Column, bc3: Column, umi5: Column, umi3: Column) -> Column:
    """The two UMIs of a read in the order of its barcodes; of a barcode with itself in their own order."""
    low, high = F.coalesce(umi5, F.lit("")), F.coalesce(umi3, F.lit(""))
    return F.when(bc5 == bc3, F.concat_ws("|", F.least(low, high), F.greatest(low, high))).when(
        bc5 < bc3, F.concat_ws("|", low, high)
    ).otherwise(F.concat_ws("|", high, low))


def pair_support(reads: DataFrame, bc5: str, bc3: str, umi5: str, umi3: str) -> DataFrame:
    """u, v, n_reads, n_umis for each unordered pair of barcodes; reads with one barcode are left out."""
    a, b = F.col(bc5), F.col(bc3)
    rows = reads.filter(a.isNotNull() & b.isNotNull()).select(
        F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), edge_umi(a, b, F.col(umi5), F.col(umi3)).alias("_umi")
    )
    # By pair and UMI first, so that a pair with many reads is spread over tasks.
    return rows.groupBy("u", "v", "_umi").agg(F.count("*").alias("_n")).groupBy("u", "v").agg(
        F.sum("_n").alias("n_reads"), F.count("*").alias("n_umis")
    )


def pair_minimum(support: DataFrame, floor: int = 10, quantile: float = 0.1, stated: int | None = None) -> DataFrame:
    """pair_min, mode: the larger of the floor and the whole part of the quantile of the support, or the stated number."""
    if stated is not None:
        return support.sparkSession.range(1).select(F.lit(stated).cast("long").alias("pair_min"), F.lit("manual").alias("mode"))
    return support.agg(
        F.greatest(F.lit(floor).cast("long"), F.coalesce(F.percentile("n_reads", F.lit(quantile)).cast("long"), F.lit(0))).alias("pair_min"),
        F.when(F.count("*") == 0, "auto_empty").otherwise("auto_quantile").alias("mode"),
    )


def clean_reads(reads: DataFrame, bc5: str, bc3: str, umi5: str, umi3: str, floor: int = 10, quantile: float = 0.1) -> DataFrame:
    """The reads that the table of clean reads takes over.

    These have a barcode and a UMI at one end at least, and if they have two barcodes, a pair with as many reads as the least
    support asks; the support is that of all `reads`, before any filter.
    """
    both = reads.filter(F.col(bc5).isNotNull() & F.col(bc3).isNotNull())
    counts = both.groupBy(F.least(bc5, bc3).alias("u"), F.greatest(bc5, bc3).alias("v")).agg(F.count("*").alias("n_reads"))
    return in_pairs(valid_reads(reads, bc5, bc3, umi5, umi3), bc5, bc3, keep_supported(materialize(counts, "pair-counts").df, floor, quantile))


def keep_supported(support: DataFrame, floor: int = 10, quantile: float = 0.1) -> DataFrame:
    least = pair_minimum(support, floor, quantile).select("pair_min")
    return support.crossJoin(F.broadcast(least)).filter("n_reads >= pair_min").drop("pair_min")  # one row


def _ends(support: DataFrame) -> DataFrame:
    """node, partner and the support; an edge of a node with itself comes twice."""
    both = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("partner")), F.struct(F.col("v").alias("node"), F.col("u").alias("partner")))
    return support.select(F.explode(both).alias("_e"), "n_reads", "n_umis").select("_e.*", "n_reads", "n_umis")


def top_partner(support: DataFrame) -> DataFrame:
    """node, partner, dominance: the partner with most reads (ties: the smaller name) and its share of all."""
    best = F.min(F.struct((-F.col("n_reads")).alias("_n"), "partner")).alias("_b")
    return _ends(support).groupBy("node").agg(best, F.sum("n_reads").alias("_all")).select(
        "node", F.col("_b.partner").alias("partner"), (-F.col("_b._n") / F.col("_all")).alias("dominance")
    )


def _stars(links: DataFrame) -> DataFrame:
    """One large and one small star over links a > b; distinct links come out."""
    sides = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))
    near = links.select(F.explode(sides).alias("_s")).select("_s.*")
    least = near.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
    large = near.join(least, "x").filter("y > x").select(F.col("y").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    root = large.groupBy("a").agg(F.min("b").alias("m"))
    linked = large.join(root, "a").select("b", "m").unionByName(root.select(F.col("a").alias("b"), "m"))
    return linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component: the smallest node that can be reached, by alternating stars.

    A large star links the larger neighbours of a node to its smallest, a small star its smaller
    ones; each pass shortens the trees, until every node hangs on the smallest of its component. The result is a written table.
    """
    pairs = edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
    given = materialize(pairs.distinct(), "links")
    links, stage, before = given.df.filter("a <> b"), None, None
    for _ in range(max_rounds):
        links = _stars(links)
        seen = Observation()
        size = (F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("sum"))
        after = materialize(links.observe(seen, *size), "stars")
        if stage:
            stage.drop()
        stage, links = after, after.df
        found = (seen.get["n"], seen.get["sum"])
        if found == before:
            break
        before = found
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    nodes = given.df.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stage.df.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    named = materialize(nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "components").df
    given.drop()
    stage.drop()
    return named


def label_edges(support: DataFrame, parts: DataFrame) -> DataFrame:
    """The edges with the component of their ends."""
    return support.join(parts.withColumnRenamed("node", "u"), "u")


def component_categories(support: DataFrame, parts: DataFrame) -> DataFrame:
    """component, n_nodes, n_edges, n_self, category by the numbers of nodes and edges."""
    return _categories(label_edges(support, parts), parts)


def _categories(labelled: DataFrame, parts: DataFrame) -> DataFrame:
    nodes = parts.groupBy("component").agg(F.count("*").alias("n_nodes"))
    edges = labelled.groupBy("component").agg(
        F.count("*").alias("n_edges"), F.count_if(F.col("u") == F.col("v")).alias("n_self")
    )
    n, m, own = F.col("n_nodes"), F.col("n_edges"), F.col("n_self")
    name = F.when((n == 1) & (m == 1) & (own == 1), "self_only")
    for label, (size, links) in SMALL.items():
        name = name.when((n == size) & (m - own == links), label)
    return nodes.join(edges, "component").withColumn("category", name.otherwise("other"))


def endpoint_passes(reads: Column, umis: Column, top_reads: Column, top_umis: Column, alpha_reads: float = 0.1, alpha_umis: float = 0.3) -> Column:
    """Whether an edge is strong enough beside the strongest edge of one of its ends."""
    r = F.coalesce(F.try_divide(reads, top_reads), F.lit(0.0))
    u = F.coalesce(F.try_divide(umis, top_umis), F.lit(0.0))
    return (
        (r >= alpha_reads)
        | ((u >= alpha_umis) & (r >= 0.5 * alpha_reads))
        | ((r >= 0.75 * alpha_reads) & (u >= 0.5 * alpha_umis))
    )


def _motif_verdicts(edges: DataFrame, categories: DataFrame) -> DataFrame:
    """component, motif_ok for the small components (at most 5 nodes and 15 edges each).

    Each test holds if it does in reads or in UMIs, whichever is more favourable.
    """
    small = edges.join(categories.filter("category <> 'other'").select("component", "category", "n_nodes"), "component")
    own = small.filter("u = v").select("component", F.col("u").alias("node"), F.col("n_reads").alias("own_reads"), F.col("n_umis").alias("own_umis"))
    ends = F.array("u", "v")
    incident = (
        small.filter("u <> v")
        .select("component", F.explode(ends).alias("node"), "n_reads", "n_umis")
        .groupBy("component", "node")
        .agg(*(F.sort_array(F.collect_list(f"n_{m}"), asc=False).alias(f"link_{m}") for m in ("reads", "umis")))
        .join(own, ["component", "node"], "left")
    )

    def node_tests(m: str) -> list[Column]:
        links, self_n = F.col(f"link_{m}"), F.coalesce(F.col(f"own_{m}"), F.lit(0))
        total = F.aggregate(links, F.lit(0).cast("long"), lambda s, x: s + x)
        beside = lambda k: F.coalesce(F.get(links, F.lit(k)) / F.greatest(self_n, F.lit(1)), F.lit(0.0))
        return [F.coalesce(F.try_divide(total, total + self_n), F.lit(0.0)), beside(1), beside(2)]

    tests = [F.min(F.greatest(a, b)).alias(f"node_{i}") for i, (a, b) in enumerate(zip(node_tests("reads"), node_tests("umis")))]
    nodes = incident.groupBy("component").agg(*tests)
    between = F.col("u") != F.col("v")
    whole = small.groupBy("component", "category").agg(
        *(
            x
            for m in ("reads", "umis")
            for x in (
                F.coalesce(F.try_divide(F.sum(F.when(between, F.col(f"n_{m}"))), F.sum(f"n_{m}")), F.lit(0.0)).alias(f"share_{m}"),
                F.coalesce(F.min(F.when(between, F.col(f"n_{m}"))) / F.median(F.when(between, F.col(f"n_{m}"))), F.lit(0.0)).alias(f"weak_{m}"),
            )
        ),
        F.max(F.when(between, F.col("n_umis"))).alias("link_umis"),
    )
    share, weak = F.greatest("share_reads", "share_umis"), F.greatest("weak_reads", "weak_umis")
    ok = (
        F.when(F.col("category") == "self_only", True)
        .when(F.col("category") == "pair_only", (F.col("node_0") >= 0.35) & (F.col("link_umis") >= 2))
        .when(F.col("category") == "triangle_only", (share >= 0.55) & (weak >= 0.25) & (F.col("node_0") >= 0.45))
        .when(F.col("category") == "clique4_only", (share >= 0.65) & (weak >= 0.18) & (F.col("node_1") >= 0.25))
        .otherwise((share >= 0.72) & (weak >= 0.15) & (F.col("node_2") >= 0.18))
    )
    return whole.join(nodes, "component", "left").select("component", ok.alias("motif_ok"))


def prune_edges(support: DataFrame, parts: DataFrame, both_ends: bool = False, alpha_reads: float = 0.1, alpha_umis: float = 0.3) -> DataFrame:
    """u, v, n_reads, n_umis, kept_by: the edges that stay, by the shape of their component or by their ends; a written table."""
    written = materialize(label_edges(support, parts), "labelled")  # three steps read it
    labelled = written.df
    categories, edges = _categories(labelled, parts), labelled
    tops = _ends(support).groupBy("node").agg(F.max("n_reads").alias("top_reads"), F.max("n_umis").alias("top_umis"))
    passes = {}
    for end in ("u", "v"):
        edges = edges.join(tops.select(F.col("node").alias(end), F.col("top_reads").alias(f"{end}_reads"), F.col("top_umis").alias(f"{end}_umis")), end)
        passes[end] = endpoint_passes(F.col("n_reads"), F.col("n_umis"), F.col(f"{end}_reads"), F.col(f"{end}_umis"), alpha_reads, alpha_umis)
    by_ends = (passes["u"] & passes["v"]) if both_ends else (passes["u"] | passes["v"])
    verdicts = _motif_verdicts(labelled, categories)
    kept = F.when(F.coalesce("motif_ok", F.lit(False)), "motif").when((F.col("u") == F.col("v")) | by_ends, "ends")
    pruned = edges.join(verdicts, "component", "left").withColumn("kept_by", kept).filter("kept_by IS NOT NULL")
    result = materialize(pruned.select("u", "v", "n_reads", "n_umis", "kept_by"), "pruned").df
    written.drop()
    return result


def number_cells(categories: DataFrame, parts: DataFrame, include_other: bool = False, max_other: int = 8) -> DataFrame:
    """node, cell_id: cells numbered from 1 in the order of their components' smallest barcodes.

    Components don't share barcodes, so that this is also the order of their sorted lists. The numbering
    goes over range partitions and needs no task that sees all components.
    """
    from cellweave.operators.prefix import running_sum

    chosen = F.col("category") != "other"
    if include_other:
        chosen = chosen | (F.col("n_nodes") <= max_other)
    cells = categories.filter(chosen).select("component", F.lit(1).cast("long").alias("_one"))
    numbered, _ = running_sum(cells, [], ["component"], {"_no": "_one"}, name="cells")
    return parts.join(numbered.select("component", F.format_string("cell_%06d", F.col("_no")).alias("cell_id")), "component").select("node", "cell_id")


def resolve_reads(reads: DataFrame, bc5: str, bc3: str, cells: DataFrame, partners: DataFrame, least: float = 0.8, absorb_pairs: bool = True) -> DataFrame:
    """The reads with `cell_id`, NULL where none is clear.

    A read takes the cell of its 5' barcode, else of its 3' one. Without either it is absorbed through
    the dominant partner of its barcodes: of the only one, or of both if they don't disagree.
    """
    absorbed = (
        partners.filter(F.col("dominance") >= least)
        .select(F.col("node").alias("_from"), "partner")
        .join(cells.select(F.col("node").alias("partner"), F.col("cell_id").alias("_via")), "partner")
        .select("_from", "_via")
    )
    # One table for both, so that the reads are joined once for each end.
    known = cells.select(F.col("node").alias("_from"), F.col("cell_id").alias("_cell")).join(absorbed, "_from", "full")
    out = reads
    for end in (bc5, bc3):
        out = out.join(known.select(F.col("_from").alias(end), F.col("_cell").alias(f"_cell_{end}"), F.col("_via").alias(f"_via_{end}")), end, "left")
    via5, via3 = F.col(f"_via_{bc5}"), F.col(f"_via_{bc3}")
    paired = F.col(bc5).isNotNull() & F.col(bc3).isNotNull()
    agreed = F.when(via5.isNull() | via3.isNull() | (via5 == via3), F.coalesce(via5, via3))
    absorbed_cell = F.when(paired, agreed if absorb_pairs else F.lit(None)).otherwise(F.coalesce(via5, via3))
    cell = F.coalesce(F.col(f"_cell_{bc5}"), F.col(f"_cell_{bc3}"), absorbed_cell)
    return out.select(*reads.columns, cell.alias("cell_id"))


def cell_reads(assigned: DataFrame, least: int = 20) -> DataFrame:
    """cell_id, n_reads of the cells with enough reads."""
    return assigned.filter("cell_id IS NOT NULL").groupBy("cell_id").agg(F.count("*").alias("n_reads")).filter(F.col("n_reads") >= least)


def assign_reads(reads: DataFrame, bc5: str, bc3: str, pairs: DataFrame, cells: DataFrame, partners: DataFrame, least: int = 20) -> DataFrame:
    """The reads of cells that have at least `least`, with `cell_id`; a read with two barcodes needs one of `pairs` (u, v).

    The cell of a read follows from its two barcodes. It is resolved once for each couple of barcodes that reads have, with
    their number, so that the reads go through one join only. Missing barcodes count as values of their own; reads
    without a cell are left out, repeated rows stay. A column `cell_id` that the reads have is replaced.
    """
    couples = reads.select(F.col(bc5).alias("_5"), F.col(bc3).alias("_3")).groupBy("_5", "_3").agg(F.count("*").alias("_n"))
    found = resolve_reads(in_pairs(couples, "_5", "_3", pairs), "_5", "_3", cells, partners).filter("cell_id IS NOT NULL")
    resolved = materialize(found, "couples").df  # counted and joined
    large = resolved.groupBy("cell_id").agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= least).select("cell_id")
    known = resolved.select("_5", "_3", "cell_id").join(large, "cell_id", "left_semi")
    rows = reads.drop("cell_id")
    same = rows[bc5].eqNullSafe(known["_5"]) & rows[bc3].eqNullSafe(known["_3"])
    return rows.join(known, same).drop("_5", "_3")
