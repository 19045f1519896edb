"""One group identifier for all records linked directly or through others.

Minimum labels spread along the edges and pointer jumping shortens the chains of labels; then every
edge is rewritten to the labels of its ends and the edges inside a group fall away. Each round is
written to the shared folder. The rounds end when no edge joins two labels, that is when no label
would change any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import Stage, materialize

#: Pointer jumps in a round; each doubles the length of the chains that one round resolves.
JUMPS = 2


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))
    return edges.select(F.explode(ends).alias("_e")).select("_e.*")


def _jump(labels: DataFrame) -> DataFrame:
    """Each node takes the label of its label."""
    over = labels.select(F.col("node").alias("_at"), F.col("label").alias("_next"))
    return labels.join(over, F.col("label") == F.col("_at"), "left").select(
        "node", F.coalesce("_next", "label").alias("label")
    )


def _relabel(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between different labels, each once."""
    for end in ("u", "v"):
        names = labels.select(F.col("node").alias(end), F.col("label").alias(f"_{end}"))
        edges = edges.join(names, end).drop(end).withColumnRenamed(f"_{end}", end)
    return edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u <> v").distinct()


def link_groups(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """node, group_id: every node of an edge and the smallest node linked to it, as text.

    Rows in which an end is NULL are left out; an edge from a node to itself makes the node a
    group of its own. Edge direction, repeats and ties don't matter. An empty table gives an empty
    result. Raises if edges between groups are left after `max_rounds` rounds, which takes chains
    of more than 4 ** max_rounds nodes.
    """
    pairs = (
        edges.select(F.col(left).cast("string").alias("u"), F.col(right).cast("string").alias("v"))
        .filter("u IS NOT NULL AND v IS NOT NULL")
        .distinct()
    )
    current = materialize(pairs, "edges")
    rounds: list[Stage] = []
    for _ in range(max_rounds):
        nearest = _both_ways(current.df).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least"))
        labels = materialize(nearest.select("node", F.least("node", "_least").alias("label")), "labels")
        jumped = labels.df
        for _ in range(JUMPS):
            jumped = _jump(jumped)
        rounds.append(materialize(jumped, "labels"))
        left_over = materialize(_relabel(current.df, rounds[-1].df), "edges")
        labels.drop()
        current.drop()
        current = left_over
        if current.df.isEmpty():
            break
    else:
        raise RuntimeError(f"labels still change after {max_rounds} rounds")
    # The last round names the groups; each earlier round leads to the one after it.
    result = rounds[-1].df
    for earlier in reversed(rounds[:-1]):
        after = result.select(F.col("node").alias("_at"), F.col("label").alias("_next"))
        result = earlier.df.join(after, F.col("label") == F.col("_at"), "left").select(
            "node", F.coalesce("_next", "label").alias("label")
        )
    return result.select("node", F.col("label").alias("group_id"))
