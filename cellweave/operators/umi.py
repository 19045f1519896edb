"""Directional UMI collapsing within cells and genes.

Most groups are small and are resolved whole, many of them in one array batch, from `TILED` UMIs on as a matrix of their own. From
`VISITED` UMIs on a group is visited in the order of ranks instead, and a UMI that was reached isn't compared again: where UMIs lie close, each meets a neighbour
after some hundred comparisons. A group above `WHOLE` UMIs whose visit takes more than `COMPARED` comparisons never comes
together: its UMIs are compared in tiles of two blocks, and above `DENSE` UMIs they meet on variants instead, a
bounded number for each UMI; the edges found are then followed in rounds of joins.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.functions.edits import Texts, code_points, letters, pair_distances
from cellweave.operators.pairs import components
from cellweave.operators.prefix import run_starts
from cellweave.session import materialize

#: UMIs of a group that one task resolves whole: at most 32 million comparisons, some ten seconds.
WHOLE = 8_000
#: UMIs of a group from which on it is compared as a matrix of its own rather than in a list of pairs with others.
TILED = 64
#: UMIs of a group from which on it is visited rather than compared all with all.
VISITED = 1_000
#: Comparisons of a visit to a group above `WHOLE`, about a minute, after which it is left to the tiles.
COMPARED = 1_500_000_000
#: UMIs of a block; two blocks are compared in one task.
BLOCK = 1_000
#: UMIs of a group from which on comparing all blocks costs more than the variants of each UMI.
DENSE = 500_000
#: Pairs listed at a time, and those compared at a time so that their bits stay in the processor's cache.
_PAIRS, _CELLS = 1 << 18, 1 << 15
#: Rows of a matrix at least.
_ROWS = 16


def umi_counts(rows: DataFrame, group: Sequence[str], umi: str) -> DataFrame:
    """`group`, umi, n."""
    return rows.groupBy(*group, F.col(umi).alias("umi")).agg(F.count("*").alias("n"))


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points, padded with 0 to the longest text, and lengths."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    width = int(lengths[0]) if len(lengths) else 0
    if width and texts.type == pa.string() and (lengths == width).all():  # texts of one length stand side by side
        flat = np.frombuffer(texts.buffers()[2], np.uint8, len(texts) * width, int(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset]))
        if int(flat.max()) < 128:
            return flat.reshape(len(texts), width).astype(np.uint32), lengths.astype(np.int32)
    return code_points(texts.to_pylist())


def _word(longest: int) -> type:
    return np.uint16 if longest <= 16 else np.uint32 if longest <= 32 else np.uint64


def _masks(at: np.ndarray, lengths: np.ndarray, letter_count: int) -> np.ndarray:
    """For each text and letter the places that hold it, as bits; `at` has the letters by place. Texts have at most 64 letters."""
    longest = int(lengths.max()) if len(lengths) else 0
    kind = _word(longest)
    masks = np.zeros((len(lengths), letter_count + 1), kind)
    for place in range(longest):
        rows = np.flatnonzero(lengths > place)
        masks[rows, at[place, rows]] |= kind(1) << kind(place)
    return masks


def _distances(eq_of, m: np.ndarray, n: np.ndarray, kind: type, shape: tuple[int, ...]) -> np.ndarray:
    """Distances of texts of `m` letters to texts of `n` letters, where eq_of(step) has the places of the first that hold a letter of the second.

    The vertical differences of the last column of the usual table, as bits, give the distance.
    """
    one = kind(1)
    pv, mv = np.full(shape, ~kind(0)), np.zeros(shape, kind)
    even = bool((n == n.flat[0]).all())
    for step in range(int(n.max())):
        eq = eq_of(step)
        xh = eq & pv
        xh += pv
        xh ^= pv
        xh |= eq
        eq |= mv
        ph = xh | pv
        np.invert(ph, out=ph)
        ph |= mv
        xh &= pv
        ph <<= one
        ph |= one
        xh <<= one
        after = eq | ph
        np.invert(after, out=after)
        after |= xh
        ph &= eq
        if even:
            pv, mv = after, ph
        else:
            on = n > step
            pv, mv = np.where(on, after, pv), np.where(on, ph, mv)
    every = np.array([(1 << x) - 1 for x in range(int(m.max()) + 1)], kind)
    used = every[m]
    return n + np.bitwise_count(pv & used).astype(np.int32) - np.bitwise_count(mv & used).astype(np.int32)


def _near(masks: np.ndarray, at: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray, k: int) -> np.ndarray:
    """Whether the texts of the pairs (i, j) lie within k edits."""
    out, flat, wide = np.empty(len(i), bool), masks.ravel(), masks.shape[1]
    for x in range(0, len(i), _CELLS):
        own, other = i[x : x + _CELLS], j[x : x + _CELLS]
        base = own * wide
        eq_of = lambda step: flat.take(base + at[step].take(other))  # noqa: B023, E731
        out[x : x + _CELLS] = _distances(eq_of, lengths[own], lengths[other], masks.dtype.type, own.shape) <= k
    return out


def _close(umis: pa.Array, n: np.ndarray, first: np.ndarray, end: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from a UMI to one within k edits that it has at least 2 n - 1 times the reads of.

    Each row is compared with the rows `first` to `end` (exclusive) behind it.
    """
    sources, targets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    spread = np.maximum(end - first, 0)
    if not spread.any():
        return sources[0], targets[0]
    codes, lengths = _codes(umis)
    alphabet = np.unique(codes[codes > 0])
    at = letters(codes, alphabet)
    if codes.shape[1] > 64:
        texts = Texts(umis.to_pylist(), codes, lengths)
        masks = texts.masks(alphabet)
        near_ones = lambda i, j: pair_distances(texts, masks, i, texts, at, j) <= k
    else:
        by_place = np.ascontiguousarray(at.T)
        masks = _masks(by_place, lengths, len(alphabet))
        near_ones = lambda i, j: _near(masks, by_place, lengths, i, j, k)
    upto = np.cumsum(spread)
    row = 0
    while row < len(umis):
        stop = max(int(np.searchsorted(upto, (upto[row - 1] if row else 0) + _PAIRS, side="right")), row + 1)
        own = spread[row:stop]
        i = np.repeat(np.arange(row, stop), own)
        j = first[i] + np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own)
        able = (np.maximum(n[i], n[j]) >= 2 * np.minimum(n[i], n[j]) - 1) & (np.abs(lengths[i] - lengths[j]) <= k)
        i, j = i[able], j[able]
        near = near_ones(i, j)
        i, j = i[near], j[near]
        down, up = n[i] >= 2 * n[j] - 1, n[j] >= 2 * n[i] - 1
        sources += [i[down], j[up]]
        targets += [j[down], i[up]]
        row = stop
    return np.concatenate(sources), np.concatenate(targets)


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches again, each with whole runs of equal keys, and where the runs start."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        starts = np.flatnonzero(run_starts(held, keys))
        if len(starts) and starts[-1]:
            yield held.slice(0, int(starts[-1])), np.r_[0, starts[:-1]] if starts[0] else starts[:-1]
            held = held.slice(int(starts[-1]))
    if held is not None and held.num_rows:
        starts = np.flatnonzero(run_starts(held, keys))
        yield held, np.r_[0, starts] if not len(starts) or starts[0] else starts


def _windows(masks: np.ndarray, places: int) -> np.ndarray:
    """For each place of a second text, letter and text the bits of the 8 diagonals about the middle one."""
    at = np.arange(places, dtype=np.uint64)[:, None, None]
    return ((masks.T.astype(np.uint64) << np.uint64(3) >> at) & np.uint64(255)).astype(np.uint8)


def _band(windows: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """`_within` for texts of one length, at most 31: the bits are those of the diagonals about the middle one, whatever the length.

    A way of at most 7 edits between texts of one length leaves the middle diagonal by 3 at most; the steps along it that cost nothing are counted.
    """
    middle, one, shape = np.uint8(8), np.uint8(1), (at.shape[1], windows.shape[2])
    vp, vn = np.full(shape, 0xF8, np.uint8), np.full(shape, 7, np.uint8)
    free, kept = np.zeros(shape, np.uint8), np.empty(shape, np.uint8)
    d0, hp = np.empty(shape, np.uint8), np.empty(shape, np.uint8)
    for place in range(len(at)):
        eq = windows[place].take(at[place], axis=0)
        np.bitwise_and(eq, vp, out=d0)
        d0 += vp
        d0 ^= vp
        d0 |= eq
        d0 |= vn
        np.bitwise_and(d0, middle, out=kept)
        free += kept
        np.bitwise_or(d0, vp, out=hp)
        np.invert(hp, out=hp)
        hp |= vn
        vp &= d0
        d0 >>= one
        np.bitwise_and(d0, hp, out=vn)
        d0 |= hp
        np.invert(d0, out=d0)
        vp |= d0
    return free >= 8 * (len(at) - k)


def _within(own: np.ndarray, m: np.ndarray, at: np.ndarray, n: np.ndarray, letter_count: int, k: int) -> np.ndarray:
    """Whether the texts `own`, of `m` letters, and `at`, of `n`, lie within k edits, a row for each of `at`; both hold letters by place, at most 64.

    Letters that all begin with don't change distances, so that they are left out for the texts that share most of them with all of `own`.
    """
    alike, some, most, chosen = 0, np.ones(len(n), bool), 2 * len(n), None
    for place in range(int(m.min())):
        if not (own[place] == own[place, 0]).all():
            break
        some = some & (at[place] == own[place, 0])
        saved = (place + 1) * int(np.count_nonzero(some))
        if saved >= most:
            alike, most, chosen = place + 1, saved, some
        elif chosen is not None or not saved:
            break
    parts = [(0, None)] if chosen is None else [(alike, np.flatnonzero(chosen)), (0, np.flatnonzero(~chosen))]
    even = m[0] <= 31 and k <= 7 and bool((m == m[0]).all() and (n == m[0]).all())
    step = max(1, _CELLS // len(m))
    out = np.empty((len(n), len(m)), bool)
    for skipped, columns in parts:
        size = len(n) if columns is None else len(columns)
        if not size:
            continue
        masks = _masks(own[skipped:], m - skipped, letter_count)
        windows = _windows(masks, len(own) - skipped) if even else None
        for x in range(0, size, step):
            those = slice(x, x + step) if columns is None else columns[x : x + step]
            seen = at[skipped:, those]
            if even:
                out[those] = _band(windows, seen, k)
                continue
            eq_of = lambda place: masks.T.take(seen[place], axis=0)  # noqa: B023, E731
            length = n[those] - skipped
            out[those] = _distances(eq_of, (m - skipped)[None, :], length[:, None], masks.dtype.type, (len(length), len(m))) <= k
    return out


def _ranked(umis: pa.Array, n: np.ndarray, run: np.ndarray | None = None) -> np.ndarray:
    """Places of the UMIs by reads, then by name, within runs."""
    keys = {} if run is None else {"run": pa.array(run)}
    kinds = [("run", "ascending")] if keys else []
    return pc.sort_indices(pa.table(keys | {"n": pa.array(n), "umi": umis}), sort_keys=[*kinds, ("n", "descending"), ("umi", "ascending")]).to_numpy()


def _matrix(umis: pa.Array, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The edges of `_close` among the UMIs of a group in the order of ranks; None if a text is too long."""
    codes, lengths = _codes(umis)
    if codes.shape[1] > 64:
        return None
    alphabet = np.unique(codes[codes > 0])
    at = np.ascontiguousarray(letters(codes, alphabet).T)
    sources, targets, a = [], [], 0
    while a < len(n):
        z = min(len(n), a + max(_ROWS, _CELLS // (len(n) - a)))
        j, i = np.nonzero(_within(at[:, a:z], lengths[a:z], at[:, a:], lengths[a:], len(alphabet), k))
        i, j = a + i[i < j], a + j[i < j]
        able = n[i] >= 2 * n[j] - 1
        i, j = i[able], j[able]
        back = n[j] >= 2 * n[i] - 1
        sources += [i, j[back]]
        targets += [j, i[back]]
        a = z
    return np.concatenate(sources), np.concatenate(targets)


def _visit(umis: Sequence[str] | pa.Array, n: np.ndarray, k: int, most: float) -> np.ndarray | None:
    """For each UMI of a group the number of the strongest that reaches it; None if that took more than `most` comparisons.

    UMIs are visited by rank, each with all that it reaches. What was reached is compared no more, which leaves the result
    as it is: it belongs to the first that reached it.
    """
    names = umis if isinstance(umis, pa.Array) else pa.array(umis, pa.string())
    codes, lengths = _codes(names)
    if codes.shape[1] > 64:
        return None
    order = _ranked(names, n)
    n, lengths = n[order], lengths[order]
    alphabet = np.unique(codes[codes > 0])
    at = np.ascontiguousarray(letters(codes[order], alphabet).T)
    limit = (n + 1) // 2  # what a UMI may reach has no more reads
    owner = np.full(len(n), -1, np.int64)
    left = np.arange(len(n))  # in the order of ranks, so that reads fall
    left_at, left_n, left_lengths, gone = at, n, lengths, 0
    met: dict[int, np.ndarray] = {}
    done = 0

    def room_for(most_reads: int) -> int:
        behind = max(1, len(left) - int(np.searchsorted(-left_n, -most_reads)))
        return max(_ROWS, min(2 * _CELLS // behind, 1_024))

    def compare(batch: np.ndarray) -> None:  # of one limit
        nonlocal done
        start = int(np.searchsorted(-left_n, -int(limit[batch[0]])))
        for x in batch.tolist():
            met[x] = left[:0]
        if start == len(left):
            return
        near = _within(at[:, batch], lengths[batch], left_at[:, start:], left_lengths[start:], len(alphabet), k)
        columns, rows = np.nonzero(near)
        by_row = np.argsort(rows, kind="stable")
        found = left[start + columns[by_row]]
        ends = np.searchsorted(rows[by_row], np.arange(len(batch) + 1)).tolist()
        for x, y, z in zip(batch.tolist(), ends, ends[1:]):
            if z > y:
                met[x] = found[y:z]
        done += near.size

    pick = random.Random(0)  # any order will do, but neighbours of one UMI reach much the same
    for root in range(len(n)):
        if owner[root] >= 0:
            continue
        owner[root] = root
        gone += 1
        open_ = [root]
        while open_:
            if gone * 16 > len(left):
                keep = owner[left] < 0
                left, left_at, left_n, left_lengths, gone = left[keep], np.ascontiguousarray(left_at[:, keep]), left_n[keep], left_lengths[keep], 0
                if not len(left):
                    break
            room, chosen = room_for(int(limit[open_[-1]])), []
            while open_ and len(chosen) < room:
                at_random = pick.randrange(len(open_))
                open_[at_random], open_[-1] = open_[-1], open_[at_random]
                chosen.append(open_.pop())
            batches: dict[int, list[int]] = {}
            for x in chosen:
                if x not in met:
                    batches.setdefault(int(limit[x]), []).append(x)
            for most_reads, batch in batches.items():
                if not open_ and len(batch) < room:  # the next roots, as far as nothing reaches them before
                    ahead = np.flatnonzero(owner[root + 1 : root + 1 + 4 * room] < 0)[: room - len(batch)] + root + 1
                    batch += [y for y in ahead[limit[ahead] == most_reads].tolist() if y not in met]
                size = room_for(most_reads)
                for y in range(0, len(batch), size):
                    compare(np.array(batch[y : y + size]))
                    if done > most:
                        return None
            for x in chosen:
                fresh = met.pop(x)
                if len(fresh):
                    fresh = fresh[owner[fresh] < 0]
                    owner[fresh] = root
                    gone += len(fresh)
                    open_ += fresh.tolist()
    best = np.empty(len(n), np.int64)
    best[order] = order[owner]
    return best


def _resolve(group: list[str], k: int, most: float = np.inf):
    """Rows sorted by group with `umi_corrected`: the strongest UMI that reaches each; NULL in groups that took more than `most` comparisons."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in _whole_runs(batches, group):
            ends = np.r_[starts[1:], len(rows)]
            order = _ranked(rows["umi"].combine_chunks(), rows["n"].to_numpy(), np.repeat(np.arange(len(starts)), ends - starts))
            rows = rows.take(pa.array(order)).combine_chunks()
            umis, n = rows["umi"].combine_chunks(), rows["n"].to_numpy()
            end = np.repeat(ends, ends - starts)
            sources, targets, visited = [], [], []
            large = np.flatnonzero(ends - starts >= min(TILED, VISITED))
            for a, z in zip(starts[large].tolist(), ends[large].tolist()):
                edges = found = None
                if z - a >= VISITED:
                    found = _visit(umis.slice(a, z - a), n[a:z], k, most)
                elif (z - a) ** 2 / 2 <= most:
                    edges = _matrix(umis.slice(a, z - a), n[a:z], k)
                if edges is not None:
                    sources.append(a + edges[0])
                    targets.append(a + edges[1])
                elif found is not None or most < np.inf:
                    visited.append((a, z, found))
                else:
                    continue
                end[a:z] = 0  # compared with nothing more
            few = _close(umis, n, np.arange(len(rows)) + 1, end, k)
            source, target = np.concatenate([few[0], *sources]), np.concatenate([few[1], *targets])
            best = np.arange(len(rows))
            while True:
                after = best.copy()
                np.minimum.at(after, target, best[source])
                if (after == best).all():
                    break
                best = after
            given_up = np.zeros(len(rows), bool)
            for a, z, found in visited:
                best[a:z] = a if found is None else a + found
                given_up[a:z] = found is None
            yield from rows.append_column("umi_corrected", umis.take(pa.array(best, mask=given_up)).cast(pa.string())).combine_chunks().to_batches()

    return run


def _thin(source: np.ndarray, target: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges without those between UMIs of one read, and one edge from each such UMI to the first it is joined with instead."""
    mutual = (n[source] == 1) & (n[target] == 1)
    a, b = source[mutual], target[mutual]
    label = np.arange(len(n))
    while True:
        after = label.copy()
        np.minimum.at(after, b, label[a])
        after = after[after]
        if (after == label).all():
            break
        label = after
    joined = np.flatnonzero(label != np.arange(len(n)))
    return np.concatenate([source[~mutual], label[joined]]), np.concatenate([target[~mutual], joined])


def _compare_tiles(keys: list[str], group: list[str], k: int, thin: bool):
    """Edges (a, na, b, nb) of the tiles; a tile of two blocks compares the rows of one with those of the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in _whole_runs(batches, keys):
            umis, n, side = rows["umi"].combine_chunks(), rows["n"].to_numpy(), rows["_side"].to_numpy()
            ends = np.r_[starts[1:], len(umis)]
            end = np.repeat(ends, ends - starts)
            # Sides are 0 and 1; in a tile of one block all rows have side 0 and meet the rows behind them.
            lefts = np.add.reduceat((side == 0).astype(np.int64), starts)
            one_block = rows["_same"].to_numpy(zero_copy_only=False)
            turn = np.repeat(starts + lefts, ends - starts)
            first = np.where(one_block, np.arange(len(umis)) + 1, np.where(side == 0, turn, end))
            source, target = _close(umis, n, first, end, k)
            if thin:
                source, target = _thin(source, target, n)
            made = rows.select(group).take(pa.array(source))
            for name, values in (("a", source), ("b", target)):
                made = made.append_column(name, rows["umi"].take(pa.array(values))).append_column(f"n{name}", rows["n"].take(pa.array(values)))
            yield from made.combine_chunks().to_batches()

    return run


def tile_edges(counts: DataFrame, group: Sequence[str], k: int = 3, block: int = BLOCK, thin: bool = False) -> DataFrame:
    """`group`, a, na, b, nb: UMIs within k edits of each other where na >= 2 nb - 1, by comparing blocks with blocks.

    With `thin` the UMIs of one read that a tile joins come as one edge each instead of all pairs: they reach each other all the same.
    The blocks of a group are spread over all tasks; a UMI is sent to as many tiles as its group has blocks.
    """
    g = list(group)
    sizes = counts.groupBy(*g).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    names = [f"_r{i}" for i in range(len(g))]
    right = sizes.select(*(F.col(c).alias(a) for c, a in zip(g, names)), "_blocks")
    on = [F.col(c).eqNullSafe(F.col(a)) for c, a in zip(g, names)]
    placed = counts.join(right, on).withColumn("_own", F.pmod(F.xxhash64("umi"), F.col("_blocks")).cast("int"))
    tiles = placed.select(*g, "umi", "n", "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")).select(
        *g, "umi", "n",
        F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"),
        (F.col("_own") > F.col("_other")).cast("int").alias("_side"), (F.col("_own") == F.col("_other")).alias("_same"),
    )
    keys = [*g, "_low", "_high"]
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = T.StructType(
        [*(counts.schema[c] for c in g), T.StructField("a", T.StringType()), T.StructField("na", T.LongType()), T.StructField("b", T.StringType()), T.StructField("nb", T.LongType())]
    )
    return tiles.repartition(tasks, *keys).sortWithinPartitions(*keys, "_side").mapInArrow(_compare_tiles(keys, g, k, thin), kinds)


def _variants(text: Column, alphabet: list[str], edits: int) -> Column:
    """ARRAY of the texts within so many edits of a text."""
    found = F.array(text)
    for _ in range(edits):

        def once(t: Column) -> Column:
            def put(letter: str, skip: int):
                return lambda i: F.concat(F.substring(t, F.lit(1), i), F.lit(letter), F.substring(t, i + 1 + skip, F.length(t)))

            inner = F.when(F.length(t) > 0, F.sequence(F.lit(0), F.length(t) - 1)).otherwise(F.array().cast("array<int>"))
            changes = [F.transform(inner, put(letter, 1)) for letter in ("", *alphabet)]
            changes += [F.transform(F.sequence(F.lit(0), F.length(t)), put(letter, 0)) for letter in alphabet]
            return F.concat(F.array(t), *changes)

        found = F.array_distinct(F.flatten(F.transform(found, once)))
    return found


def variant_edges(counts: DataFrame, group: Sequence[str], k: int = 3) -> DataFrame:
    """The edges of `tile_edges`, found by meeting in the middle.

    Of k edits between two UMIs one half leads from the first to a text to which the other half leads from the second. So
    UMIs meet on texts within k / 2 edits of one and the rest of the other, a bounded number for each UMI: the work grows in
    proportion to the UMIs and the pairs that are found.
    """
    g = list(group)
    alphabet = sorted(r[0] for r in counts.select(F.explode(F.split("umi", "")).alias("c")).filter("c <> ''").distinct().collect())  # the letters in use
    near, far = k // 2, k - k // 2
    left = counts.select(*g, F.col("umi").alias("a"), F.col("n").alias("na"), F.explode_outer(_variants(F.col("umi"), alphabet, near)).alias("_v"))
    names = [f"_r{i}" for i in range(len(g))]
    right = counts.select(
        *(F.col(c).alias(r) for c, r in zip(g, names)), F.col("umi").alias("b"), F.col("n").alias("nb"), F.explode_outer(_variants(F.col("umi"), alphabet, far)).alias("_w")
    )
    on = [F.col(c).eqNullSafe(F.col(r)) for c, r in zip(g, names)] + [F.col("_v") == F.col("_w"), F.col("a") != F.col("b")]
    strong = (F.col("na") >= 2 * F.col("nb") - 1) | (F.col("nb") >= 2 * F.col("na") - 1)
    met = left.join(right, on).filter(strong).select(*g, "a", "na", "b", "nb").distinct()
    back = met.select(*g, F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb"))
    return met.unionByName(back).filter("na >= 2 * nb - 1").distinct()


def _follow(counts: DataFrame, g: list[str], edges: DataFrame, max_rounds: int) -> DataFrame:
    """The strongest UMI that reaches each, over written edges.

    UMIs of one read reach each other, so that their components are merged first; all other edges lead to fewer reads, at
    most half and one more, so that the best rank has spread after as many rounds as the largest count has bits.
    """
    nodes = materialize(counts.select(*g, "umi", "n", F.to_json(F.struct(*g, "umi")).alias("id")), "umis").df
    ids = [F.to_json(F.struct(*g, F.col(x).alias("umi"))).alias(e) for x, e in (("a", "u"), ("b", "v"))]
    written = materialize(edges.select(*ids, ((F.col("na") == 1) & (F.col("nb") == 1)).alias("mutual")), "umi-edges")
    merged = components(written.df.filter("mutual").select("u", "v")).select(F.col("node").alias("id"), "component")
    placed = materialize(
        nodes.join(merged, "id", "left").select(*g, "umi", "n", "id", F.coalesce("component", "id").alias("part")), "umi-parts"
    ).df
    part_of = placed.select("id", "part")
    down = materialize(
        written.df.filter("NOT mutual")
        .join(part_of.select(F.col("id").alias("u"), F.col("part").alias("source")), "u")
        .join(part_of.select(F.col("id").alias("v"), F.col("part").alias("target")), "v")
        .select("source", "target")
        .distinct(),
        "umi-down",
    )
    written.drop()
    rank = F.struct((-F.col("n")).alias("r"), F.col("umi").alias("u"))
    state = materialize(placed.groupBy("part").agg(F.min(rank).alias("best"), F.lit(True).alias("new")), "umi-best")
    for _ in range(max_rounds):
        sent = down.df.join(state.df.filter("new").select(F.col("part").alias("source"), "best"), "source")
        offers = sent.groupBy(F.col("target").alias("part")).agg(F.min("best").alias("offer"))
        taken = F.least("best", F.coalesce("offer", "best"))
        after = materialize(
            state.df.join(offers, "part", "left").select("part", taken.alias("best"), (taken != F.col("best")).alias("new")), "umi-best"
        )
        state.drop()
        state = after
        if state.df.filter("new").isEmpty():
            down.drop()
            return placed.join(state.df, "part").select(*g, "umi", "n", F.col("best.u").alias("umi_corrected"))
    raise RuntimeError(f"UMIs still change after {max_rounds} rounds")


def collapse_umis(
    counts: DataFrame, group: Sequence[str], k: int = 3, max_rounds: int = 60, whole: int = WHOLE, dense: int = DENSE, compared: float = COMPARED
) -> DataFrame:
    """`group`, umi, n, umi_corrected: every UMI with the strongest UMI that reaches it.

    A UMI reaches those within k edits that it has at least 2 n - 1 times the reads of, and what they
    reach. UMIs rank by reads, then by name; visiting them in this order, each taking what it reaches
    and nobody took, gives every UMI the highest-ranked that reaches it. Each group and UMI comes once in `counts`, and rows
    without a UMI are left out. Groups of at most `whole` UMIs are resolved in one task each, and those of at most `dense` too if that takes
    at most `compared` comparisons; the others are spread over all tasks, with the same result.
    """
    g = list(group)
    rows = materialize(counts.select(*g, "umi", F.col("n").cast("long").alias("n")).filter("umi IS NOT NULL"), "umis").df
    out = T.StructType([*(rows.schema[c] for c in g), rows.schema["umi"], rows.schema["n"], T.StructField("umi_corrected", T.StringType())])
    names = [f"_r{i}" for i in range(len(g))]

    def among(chosen: DataFrame, how: str) -> DataFrame:
        right = chosen.select(*(F.col(c).alias(r) for c, r in zip(g, names)))
        on = [F.col(c).eqNullSafe(F.col(r)) for c, r in zip(g, names)]
        return rows.join(right, on or F.lit(True), how)

    def resolve(part: DataFrame, most: float = np.inf, tasks: Sequence[int] = ()) -> DataFrame:
        spread = part.repartition(*tasks, *g) if g else part.coalesce(1)
        return spread.sortWithinPartitions(*g).mapInArrow(_resolve(g, k, most), out)

    large = materialize(rows.groupBy(*g).agg(F.count("*").alias("_size")).filter(F.col("_size") > whole), "umi-groups").df
    hot = large.count()
    resolved = resolve(among(large, "left_anti") if hot else rows)
    if not hot:
        return resolved
    if compared > 0:
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, so that few rows of much work aren't put together
        tried = materialize(resolve(among(large.filter(F.col("_size") <= dense), "left_semi"), compared, [tasks]), "umis-tried").df
        resolved = resolved.unionByName(tried.filter("umi_corrected IS NOT NULL"))
        undone = tried.filter("umi_corrected IS NULL").select(*g).distinct().withColumn("_size", F.lit(dense).cast("long"))
        large = materialize(undone.unionByName(large.filter(F.col("_size") > dense).select(*undone.columns)), "umi-groups").df
        if large.isEmpty():
            return resolved
    apart = materialize(among(large, "left_semi"), "umis-hot").df
    edges = None
    tiled = lambda part: tile_edges(part, g, k, thin=True)
    for part, find in ((large.filter(F.col("_size") <= dense), tiled), (large.filter(F.col("_size") > dense), lambda part: variant_edges(part, g, k))):
        if not part.isEmpty():
            found = find(among(part, "left_semi"))
            edges = found if edges is None else edges.unionByName(found)
    return resolved.unionByName(_follow(apart, g, edges, max_rounds))
