"""Map free-entered values to the nearest entry of a reference list.

The entries stand in BK-trees under the Levenshtein distance. In a tree, the children of a node are
kept by their distance from it, and by the triangle inequality a search within k has to follow only
the children whose distance is within k of that between the value and the node. Random strings of one
length lie at nearly the same distance from each other, where a single tree prunes little; so the
entries of one length are cut into k + 1 segments, and there is one tree for each segment text. An
entry within distance k leaves at least one of its segments unchanged, hence a value has to search
only the trees of the segments that it contains near their place. Every entry within k is found.

Searches of a batch go through all trees at once, level by level, with the distances worked out by
bit-parallel recurrences over arrays. The list is broadcast where its size was counted and is under
a bound, otherwise it is sharded by segments, values go to the shards of the segments they hold, and the winners are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.functions.edits import Texts, letters, pair_distances
from cellweave.session import materialize

#: Entries of a reference list (and of a shard) that one task holds; about 200 bytes each.
BROADCAST_ENTRIES = 200_000
#: Values that meet a shard in one task.
CHUNK_VALUES = 100_000
#: Entries of a length that its cuts are fitted on where the list is sharded.
CUT_SAMPLE = 2_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOUND = "value string, entry string, distance int, n_best int"


def _cuts(codes: np.ndarray, parts: int) -> list[int]:
    """Where to cut entries of one length, so that equal segments are as rare as can be."""
    sample, length = codes[:: max(1, len(codes) // 2000)], codes.shape[1]
    cost: dict[tuple[int, int], float] = {}
    for a in range(length):
        key = np.zeros(len(sample), np.uint64)
        for b in range(a + 1, length + 1):
            key = (key + sample[:, b - 1].astype(np.uint64) + np.uint64(1)) * _MIX
            cost[a, b] = float((np.unique(key, return_counts=True)[1].astype(float) ** 2).sum())
    best: dict[tuple[int, int], tuple[float, int]] = {(0, 0): (0.0, 0)}
    for p in range(1, parts + 1):
        for b in range(p, length - parts + p + 1):
            best[p, b] = min((best[p - 1, a][0] + cost[a, b], a) for a in range(p - 1, b) if (p - 1, a) in best)
    cuts = [length]
    for p in range(parts, 0, -1):
        cuts.append(best[p, cuts[-1]][1])
    return cuts[::-1]


def _segment_keys(codes: np.ndarray, start: int, end: int, length: int, part: int) -> np.ndarray:
    """A hash of a segment's text, its entry length and number. A clash only adds a tree's entries to another's."""
    key = np.full(len(codes), np.uint64(length * 1000 + part + 1), np.uint64)
    for j in range(start, end):
        key = (key ^ codes[:, j].astype(np.uint64)) * _MIX
        key ^= key >> np.uint64(29)
    return key


def _value_keys(values: Texts, cuts: dict[int, list[int]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of values and the keys of segments that an entry within k edits of them may have."""
    for size in np.unique(values.lengths):
        rows = np.flatnonzero(values.lengths == size)
        own = values.codes[rows, :size]
        for length, at in cuts.items():
            gap = int(size) - length
            if abs(gap) > k:
                continue
            for part, (a, b) in enumerate(zip(at, at[1:])):
                right = k - part
                low = max(0, a - part, a + gap - right)
                high = min(int(size) - (b - a), a + part, a + gap + right)
                if length <= k:
                    low = high = 0
                for start in range(low, high + 1):
                    yield rows, _segment_keys(own, start, start + b - a, length, part)


def _within_reach(texts: list[str], lengths: list[int], k: int) -> list[int]:
    """Numbers of the texts whose length is within k of one of the lengths. The others have no entry within k, and very long ones
    among them would widen the arrays of all."""
    near = {n + d for n in lengths for d in range(-k, k + 1)}
    return [i for i, t in enumerate(texts) if len(t) in near]


class Forest:
    """BK-trees over `entries`, one for each segment text, as arrays."""

    def __init__(self, entries: list[str], k: int, cuts: dict[int, list[int]] | None = None, bucket: tuple[int, int] | None = None) -> None:
        """`cuts` are those of other entries too, where this is a shard; of `bucket` (number, of how many) only the trees are planted."""
        self.k = k
        entries = sorted(set(entries))
        self.strings = Texts.of(entries)
        codes, lengths = self.strings.codes, self.strings.lengths
        self.alphabet = np.unique(codes[codes > 0])
        self.letters = letters(codes, self.alphabet)
        self.cuts: dict[int, list[int]] = {}
        keys, members = [], []
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            own = codes[rows, :length]
            # Entries too short to be cut stand in one tree, searched by every value near their length.
            at = cuts[int(length)] if cuts else _cuts(own, k + 1) if length > k else [0, 0]
            self.cuts[int(length)] = at
            for part, (a, b) in enumerate(zip(at, at[1:])):
                key = _segment_keys(own, a, b, int(length), part)
                here = key % np.uint64(bucket[1]) == np.uint64(bucket[0]) if bucket else np.ones(len(key), bool)
                keys.append(key[here])
                members.append(rows[here])
        self._plant(np.concatenate(keys) if keys else np.zeros(0, np.uint64), np.concatenate(members) if members else np.zeros(0, np.int64))

    def _plant(self, keys: np.ndarray, members: np.ndarray) -> None:
        """Build all trees together: the first of each set becomes its root, the rest splits by distance from it."""
        masks = self.strings.masks(self.alphabet)
        sets = np.unique(keys, return_inverse=True)
        self.roots, group = sets[0], sets[1]
        parents, edges, entry = [], [], []
        self.root_node = np.full(len(self.roots), -1, np.int64)
        parent_of, edge_of = np.full(len(self.roots), -1, np.int64), np.zeros(len(self.roots), np.int32)
        made, first_level = 0, True
        while len(members):
            order = np.argsort(group, kind="stable")
            group, members = group[order], members[order]
            head = np.r_[True, group[1:] != group[:-1]]
            nodes = made + np.arange(int(head.sum()))
            made += len(nodes)
            entry.append(members[head])
            parents.append(parent_of[group[head]])
            edges.append(edge_of[group[head]])
            if first_level:
                self.root_node[group[head]] = nodes
                first_level = False
            own_root = np.repeat(np.flatnonzero(head), np.diff(np.r_[np.flatnonzero(head), len(group)]))
            rest = ~head
            apart = pair_distances(self.strings, masks, members[own_root][rest], self.strings, self.letters, members[rest])
            node_at = np.cumsum(head) - 1
            label = nodes[node_at][rest] * np.int64(1 << 20) + apart
            members = members[rest]
            uniq, group = np.unique(label, return_inverse=True)
            parent_of, edge_of = uniq >> 20, (uniq & ((1 << 20) - 1)).astype(np.int32)
        self.entry = np.concatenate(entry) if entry else np.zeros(0, np.int64)
        parents_all = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        self.edge = np.concatenate(edges) if edges else np.zeros(0, np.int32)
        children = np.argsort(parents_all, kind="stable")
        children = children[parents_all[children] >= 0]
        self.children = children
        self.child_from = np.searchsorted(parents_all[children], np.arange(made))
        self.child_to = np.searchsorted(parents_all[children], np.arange(made), side="right")

    def _starts(self, values: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The pairs (value, root) that a search begins with."""
        who, roots = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for rows, keys in _value_keys(values, self.cuts, self.k) if len(self.roots) else ():
            at = np.searchsorted(self.roots, keys)
            at[at == len(self.roots)] = 0
            hit = self.roots[at] == keys
            who.append(rows[hit])
            roots.append(self.root_node[at[hit]])
        return np.concatenate(who), np.concatenate(roots)

    def search(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (value, entry, distance) within k, each pair once; values and entries by number."""
        reach = np.array(_within_reach(texts, list(self.cuts), self.k), np.int64)
        if not len(reach):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        values = Texts.of([texts[x] for x in reach])
        masks = values.masks(self.alphabet)
        q, node = self._starts(values)
        found = []
        while len(q):
            d = pair_distances(values, masks, q, self.strings, self.letters, self.entry[node])
            near = d <= self.k
            found.append((q[near], self.entry[node[near]], d[near]))
            spread = self.child_to[node] - self.child_from[node]
            back = np.repeat(np.arange(len(q)), spread)
            inner = np.arange(len(back)) - np.repeat(np.cumsum(spread) - spread, spread)
            child = self.children[self.child_from[node[back]] + inner]
            keep = np.abs(self.edge[child] - d[back]) <= self.k
            q, node = q[back[keep]], child[keep]
        who, entry, d = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        pair = np.unique(who * np.int64(max(1, len(self.strings.texts))) + entry, return_index=True)[1]
        return reach[who[pair]], entry[pair], d[pair].astype(np.int32)

    def nearest(self, texts: list[str]) -> pd.DataFrame:
        """value, entry, distance, n_best: one row for each text that has an entry within k."""
        who, entry, d = self.search(texts)
        if not len(who):
            return pd.DataFrame({"value": [], "entry": [], "distance": [], "n_best": []}).astype({"value": object, "entry": object, "distance": "int32", "n_best": "int32"})
        order = np.lexsort((entry, d, who))
        who, entry, d = who[order], entry[order], d[order]
        first = np.r_[True, who[1:] != who[:-1]]
        at = np.cumsum(first) - 1
        best = d[first][at] == d
        return pd.DataFrame(
            {
                "value": [texts[x] for x in who[first]],
                "entry": [self.strings.texts[x] for x in entry[first]],
                "distance": d[first],
                "n_best": np.bincount(at[best], minlength=int(first.sum())).astype(np.int32),
            }
        )


def _search_broadcast(spark: SparkSession, values: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """`entries` has at most BROADCAST_ENTRIES rows."""
    forest = spark.sparkContext.broadcast(Forest([r[0] for r in entries.collect()], k))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield forest.value.nearest(batch["value"].tolist())

    return values.mapInPandas(run, _FOUND)


def _global_cuts(entries: DataFrame, k: int) -> dict[int, list[int]]:
    """Cuts for each length of entries, fitted on the `CUT_SAMPLE` with the smallest hashes; any cuts find the same entries.

    One row per length comes to the driver, with its sample.
    """
    ranked = entries.select("entry", F.length("entry").alias("n"), F.xxhash64("entry").alias("h"))
    least = Window.partitionBy("n").orderBy("h", "entry")
    sample = ranked.withColumn("_rn", F.row_number().over(least)).filter(F.col("_rn") <= CUT_SAMPLE)
    out = {}
    for n, texts in sample.groupBy("n").agg(F.collect_list("entry")).collect():
        codes = Texts.of(texts).codes
        out[n] = _cuts(codes, k + 1) if n > k else [0, 0]
    return out


def _search_shards(values: DataFrame, entries: DataFrame, k: int, n: int, max_entries: int) -> DataFrame:
    """Entries stand in the shards of their segments' keys, and a value goes to the shards of the keys it holds alone.

    A shard with many entries is split by entry, one with many values by value, so that a hot key doesn't fill a task. An
    entry may be found in several shards; the winners are merged by their texts.
    """
    spark = values.sparkSession
    cuts = _global_cuts(entries, k)
    lengths = list(cuts)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * (k + 1) // max_entries))

    def keyed(side: str):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                texts = batch["text"].tolist()
                reach = _within_reach(texts, lengths, k if side == "value" else 0)
                own = Texts.of([texts[x] for x in reach])
                pairs = [np.zeros((0, 2), np.int64)]
                if side == "value":
                    found = _value_keys(own, cuts, k)
                else:
                    found = (
                        (rows, _segment_keys(own.codes[rows, :length], a, b, int(length), part))
                        for length in np.unique(own.lengths)
                        for rows in [np.flatnonzero(own.lengths == length)]
                        for part, (a, b) in enumerate(zip(cuts[int(length)], cuts[int(length)][1:]))
                    )
                for rows, keys in found:
                    pairs.append(np.stack([rows, (keys % np.uint64(buckets)).astype(np.int64)], axis=1))
                each = np.unique(np.concatenate(pairs), axis=0)
                yield pd.DataFrame({"text": pd.Series([texts[reach[x]] for x in each[:, 0]], dtype=object), "bucket": each[:, 1]})

        return run

    def placed(df: DataFrame, column: str, room: int) -> DataFrame:
        rows = materialize(df.select(F.col(column).alias("text")).mapInPandas(keyed(column), "text string, bucket long"), "shards").df
        sizes = rows.groupBy("bucket").agg(F.ceil(F.count("*") / room).cast("int").alias("splits"))  # one row for each bucket
        return rows.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("text"), F.col("splits")).cast("int"))

    left, right = placed(values, "value", CHUNK_VALUES), placed(entries, "entry", max_entries)
    counts = [x.groupBy("bucket").agg(F.max("splits").alias(c)) for x, c in ((left, "_chunks"), (right, "_shards"))]
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asked = left.join(counts[1], "bucket").select("bucket", F.col("own").alias("chunk"), every("_shards").alias("shard"), "text")
    known = right.join(counts[0], "bucket").select("bucket", every("_chunks").alias("chunk"), F.col("own").alias("shard"), "text")

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        forest = Forest(b["text"].tolist(), k, cuts, (int(key[0]), buckets))
        texts = a["text"].tolist()
        who, entry, d = forest.search(texts)
        columns = {"value": [texts[x] for x in who], "entry": [forest.strings.texts[x] for x in entry]}
        found = pd.DataFrame({c: pd.Series(x, dtype=object) for c, x in columns.items()} | {"distance": d.astype(np.int32)})
        return found[found["distance"] == found.groupby("value")["distance"].transform("min")]

    at = ["bucket", "chunk", "shard"]
    winners = asked.groupBy(*at).cogroup(known.groupBy(*at)).applyInPandas(run, "value string, entry string, distance int").distinct()
    by_distance = winners.groupBy("value", "distance").agg(F.min("entry").alias("entry"), F.count("*").cast("int").alias("n_best"))
    best = by_distance.groupBy("value").agg(F.min(F.struct("distance", "entry", "n_best")).alias("_b"))
    return best.select("value", "_b.entry", "_b.distance", "_b.n_best")


def nearest_entries(
    values: DataFrame,
    column: str,
    reference: DataFrame,
    entry: str,
    k: int = 2,
    max_entries: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """value, entry, distance INT, n_best INT: for each distinct value its nearest entry within k edits.

    `n_best` is the number of entries at that distance; of several the smallest text is named.
    Values without an entry within k don't appear. NULL values and entries are left out; an empty
    text is a value like others, at distance len(entry); repeated entries count once. Texts of any
    length are compared whole. Texts are taken as they are: trim or change case before. Either
    table may be empty. Above `max_entries` entries the list is sharded instead of broadcast.
    """
    spark = values.sparkSession
    asked = values.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    entries = reference.select(F.col(entry).cast("string").alias("entry")).filter("entry IS NOT NULL").distinct()
    n = entries.count()
    if n <= max_entries:
        return _search_broadcast(spark, asked, entries, k)
    return _search_shards(asked, entries, k, n, max_entries)
