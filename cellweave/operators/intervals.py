"""Overlap joins of aligned reads with genes and exons, and CIGAR strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cellweave.operators.umi import _whole_runs as whole_runs

#: Reads of a bin from which on genes are swept over the ends of reads rather than compared with each read.
SWEPT = 2_000
#: Bins of a read's length class are so many times wider than those of the class below.
_LADDER = 64
#: Reads answered at a time, and cells of a comparison.
_READS, _CELLS = 100_000, 1 << 20
#: Exons that are broadcast at most, about 100 bytes each, and pairs of bins that are told apart.
LISTED, _RELATED = 2_000_000, 30_000_000
#: Strands as numbers, and for each strand of a read those of the genes it may meet: only two known strands can differ, and a
#: missing one is unlike any but a strand that is known to be open.
_PLUS, _MINUS, _OPEN, _MISSING = range(4)
_MEETS = {_PLUS: (_PLUS, _OPEN), _MINUS: (_MINUS, _OPEN), _OPEN: (_PLUS, _MINUS, _OPEN, _MISSING), _MISSING: (_OPEN,)}


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Bases two half-open intervals share."""
    return F.greatest(F.least(e1, e2) - F.greatest(s1, s2), F.lit(0))


def strands_differ(a: Column, b: Column) -> Column:
    """Only two known strands can differ."""
    return a.isin("+", "-") & b.isin("+", "-") & (a != b)


def interval_join(reads: DataFrame, features: DataFrame, width: int = 100_000) -> DataFrame:
    """All pairs of overlapping intervals: `reads` columns and the `features` columns prefixed with f_.

    Both have chrom, start, end and strand. An interval is put in every bin it touches and intervals meet in
    bins; a pair is kept only in the first bin the two share, so that it comes once. Long intervals are
    put in as many bins as they need. Empty intervals and unknown coordinates overlap nothing. A bin that many
    reads fall into is split by adaptive skew joins; its features, which it is joined with, are those of one place.
    """

    def binned(df: DataFrame, s: str, e: str) -> DataFrame:
        last = F.floor((F.col(e) - 1) / width).cast("long")
        return df.filter(F.col(s) < F.col(e)).withColumn(
            "_bin", F.explode(F.sequence(F.floor(F.col(s) / width).cast("long"), last))
        )

    right = binned(features.select(*(F.col(c).alias(f"f_{c}") for c in features.columns)), "f_start", "f_end")
    left = binned(reads, "start", "end")
    met = left.join(right.withColumnRenamed("_bin", "_fbin"), (F.col("chrom") == F.col("f_chrom")) & (F.col("_bin") == F.col("_fbin")))
    shared = overlap(F.col("start"), F.col("end"), F.col("f_start"), F.col("f_end"))
    first = F.floor(F.greatest("start", "f_start") / width)
    return (
        met.filter((shared > 0) & ~strands_differ(F.col("strand"), F.col("f_strand")) & (F.col("_bin") == first))
        .drop("_bin", "_fbin")
        .withColumn("overlap", shared)
    )


def _best(scored: DataFrame, by: str, carry: list[str]) -> DataFrame:
    """`by`, the fields of the largest overlap and how many share it: two partial aggregates over one join."""
    level = scored.groupBy(by, "overlap").agg(F.count("*").alias("_n"), F.max(F.struct(*carry)).alias("_of"))
    top = level.groupBy(by).agg(F.max(F.struct("overlap", "_n", "_of")).alias("_top"))
    return top.select(by, *(F.col(f"_top._of.{c}").alias(f"_b_{c}") for c in carry), F.col("_top._n").alias("_ties"))


def _status(mapq: int) -> Column:
    return (
        F.when(F.col("score") < mapq, "Unassigned_mapq")
        .when(F.col("_ties").isNull(), "Unassigned_no_features")
        .when(F.col("_ties") > 1, "Unassigned_ambiguous")
        .otherwise("Assigned")
    )


def _compared(s: np.ndarray, e: np.ndarray, gs: np.ndarray, ge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each read the number of genes that share most bases with it (at most 2 are told apart), one of them and the bases, by comparing all."""
    ties, who, bases = np.zeros(len(s), np.int32), np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
    step = max(1, _CELLS // len(gs))
    for x in range(0, len(s), step):
        shared = np.minimum(e[x : x + step, None], ge) - np.maximum(s[x : x + step, None], gs)
        who[x : x + step] = shared.argmax(1)
        most = shared.max(1)
        bases[x : x + step] = np.maximum(most, 0)
        ties[x : x + step] = np.where(most > 0, np.minimum((shared == most[:, None]).sum(1), 2), 0)
    return ties, who, bases


def _swept(s: np.ndarray, e: np.ndarray, gs: np.ndarray, ge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same as `_compared`, for genes sorted by start.

    Of the genes that start no later than a read the two that end last share most with it. Genes that start later are swept from the
    last to the first; after each the two largest overlaps for every end of a read are known.
    """
    before = np.r_[np.int64(np.iinfo(np.int64).min), np.maximum.accumulate(ge)[:-1]]
    last, second = np.maximum.accumulate(ge), np.maximum.accumulate(np.minimum(ge, before))
    holder = np.maximum.accumulate(np.where(ge > before, np.arange(len(ge)), 0))
    p = np.searchsorted(gs, s, side="right") - 1
    some = p >= 0
    v1 = np.where(some, np.minimum(last[p], e) - s, 0)
    v2 = np.where(some, np.minimum(np.maximum(second[p], s), e) - s, 0)
    v1, v2, v_who = np.maximum(v1, 0), np.maximum(v2, 0), holder[p]

    order = np.argsort(-s, kind="stable")
    ends, at = np.unique(e[order], return_inverse=True)
    t1, t2, lead = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
    u1, u2, u_who = (np.zeros(len(s), np.int64) for _ in range(3))
    answered = np.searchsorted(-s[order], -gs, side="right")  # reads that start no earlier than a gene
    behind = np.searchsorted(ends, gs, side="right")
    done = 0
    for g in range(len(gs) - 1, -2, -1):
        upto = int(answered[g]) if g >= 0 else len(s)
        if upto > done:
            places, reads = at[done:upto], order[done:upto]
            u1[reads], u2[reads], u_who[reads] = t1[places], t2[places], lead[places]
            done = upto
        if g < 0 or done == len(s):
            break
        j = int(behind[g])
        v = np.minimum(ends[j:], ge[g]) - gs[g]
        top = t1[j:]
        np.maximum(t2[j:], np.minimum(top, v), out=t2[j:])
        np.copyto(lead[j:], g, where=v > top)
        np.maximum(top, v, out=top)
    most = np.maximum(v1, u1)
    tied = np.maximum(np.minimum(v1, u1), np.maximum(v2, u2)) == most
    return np.where(most > 0, 1 + tied, 0).astype(np.int32), np.where(v1 >= u1, v_who, u_who), most


def _name_reads(carry: list[str], kinds: pa.Schema):
    """Rows of a bin, its genes first, to its reads with the number of best genes (NULL: none) and the name of one."""

    def answer(reads: pa.Table, genes: pa.Table | None) -> Iterator[pa.RecordBatch]:
        ties, names, bases = np.zeros(len(reads), np.int32), np.full(len(reads), -1, np.int64), np.zeros(len(reads), np.int64)
        if genes is not None:
            s, e, strand = (reads[c].to_numpy() for c in ("_s", "_e", "_strand"))
            gs, ge, g_strand = (genes[c].to_numpy() for c in ("_s", "_e", "_strand"))
            by_start = np.argsort(gs, kind="stable")
            for own in np.unique(strand):
                able = by_start[np.isin(g_strand[by_start], _MEETS[int(own)])]
                rows = np.flatnonzero(strand == own)
                if len(able):
                    find = _swept if len(rows) > SWEPT else _compared
                    ties[rows], who, bases[rows] = find(s[rows], e[rows], gs[able], ge[able])
                    names[rows] = able[who]
        found = ties > 0
        labels = pa.nulls(len(reads), kinds.field("_b_label").type) if genes is None else genes["_label"].take(pa.array(np.where(found, names, 0), mask=~found))
        out = reads.select([*carry, "score"]).append_column("_b_label", labels).append_column("_ties", pa.array(ties.astype(np.int64), mask=~found)).append_column("_bases", pa.array(bases, mask=~found))
        yield from out.cast(kinds).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, genes, reads, waiting = None, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if reads:
                if len(genes) > 1:
                    genes[:] = [pa.concat_tables(genes).combine_chunks()]
                yield from answer(pa.concat_tables(reads).combine_chunks(), genes[0] if genes else None)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if not len(rows):
                continue
            run_of = [rows[c].to_numpy(zero_copy_only=False) for c in ("_class", "_chrom", "_bin", "_read")]
            starts = np.r_[0, 1 + np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in run_of])), len(rows)]
            for x, z in zip(starts[:-1].tolist(), starts[1:].tolist()):
                key = tuple(c[x] for c in run_of[:3])
                if key != at:
                    yield from flush()
                    at, genes, reads, waiting = key, [], [], 0
                part = rows.slice(x, z - x)
                if not run_of[3][x]:
                    genes.append(part)
                    continue
                reads.append(part)
                waiting += z - x
                if waiting >= _READS:
                    yield from flush()
                    reads, waiting = [], 0
        yield from flush()

    return run


def _with_id(reads: DataFrame) -> DataFrame:
    """Reads without an id overlap nothing."""
    return reads.withColumn("start", F.when(F.col("read_id").isNotNull(), F.col("start")))


def _nearest(reads: DataFrame, carry: list[str], genes: DataFrame, mapq: int | None, width: int) -> DataFrame:
    """`carry`, score, the label of a gene that shares most bases with the row of `reads` (_b_label), how many do (_ties; from 2 on 2) and the bases (_bases).

    All three are NULL without one, and for rows whose score is below `mapq` if it is given.

    Reads and genes aren't paired. A read goes to one bin, that of its start, whose width follows from its length so that it ends in
    the next one at the latest; genes go to the bins from which reads reach them. Of genes of one start and strand only the two that end
    last count, since no other is alone in sharing most with any read.
    """
    code = lambda c: F.when(F.col(c) == "+", _PLUS).when(F.col(c) == "-", _MINUS).when(F.col(c).isNull(), _MISSING).otherwise(_OPEN)
    kind = genes.schema["label"].dataType
    wide = [width, width * _LADDER, 0]  # 0: all in one bin
    bin_of = lambda x, w: F.floor(x / w).cast("long") if w else F.lit(0).cast("long")
    able = (F.lit(True) if mapq is None else F.col("score") >= mapq) & (F.col("start") < F.col("end")) & F.col("chrom").isNotNull()
    length = F.col("end") - F.col("start")
    size = F.when(length <= wide[0], 0).when(length <= wide[1], 1).otherwise(2)
    tagged = reads.select(
        *carry, "score", size.alias("_class"), F.col("chrom").alias("_chrom"), F.lit(True).alias("_read"),
        F.col("start").cast("long").alias("_s"), F.col("end").cast("long").alias("_e"), code("strand").alias("_strand"), F.lit(None).cast(kind).alias("_label"), able.alias("_able"),
    )
    placed = tagged.filter("_able").withColumn(
        "_bin", F.when(F.col("_class") == 0, bin_of(F.col("_s"), wide[0])).when(F.col("_class") == 1, bin_of(F.col("_s"), wide[1])).otherwise(F.lit(0).cast("long"))
    ).drop("_able")
    known = genes.filter((F.col("start") < F.col("end")) & F.col("chrom").isNotNull()).select(
        F.col("chrom").alias("_chrom"), F.col("start").cast("long").alias("_s"), F.col("end").cast("long").alias("_e"), code("strand").alias("_strand"), F.col("label").alias("_label")
    )
    last = Window.partitionBy("_chrom", "_s", "_strand").orderBy(F.desc("_e"))
    kept = known.withColumn("_rn", F.row_number().over(last)).filter("_rn <= 2").drop("_rn")
    reach = lambda w: F.sequence(bin_of(F.col("_s"), w) - 1, bin_of(F.col("_e") - 1, w)) if w else F.array(F.lit(0).cast("long"))
    of_class = lambda c: lambda b: F.struct(F.lit(c).alias("_class"), b.alias("_bin"))
    bins = F.array(*(F.transform(reach(w), of_class(c)) for c, w in enumerate(wide)))
    spread = kept.withColumn("_at", F.explode(F.flatten(bins))).select("_chrom", "_s", "_e", "_strand", "_label", "_at.*", F.lit(False).alias("_read"))
    tasks = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["_class", "_chrom", "_bin"]
    kinds = T.StructType([*(tagged.schema[c] for c in [*carry, "score"]), T.StructField("_b_label", kind), T.StructField("_ties", T.LongType()), T.StructField("_bases", T.LongType())])
    named = (
        placed.unionByName(spread, allowMissingColumns=True)
        .repartition(tasks, *keys).sortWithinPartitions(*keys, "_read")
        .mapInArrow(_name_reads(carry, to_arrow_schema(kinds)), kinds)
    )
    rest = tagged.filter("_able IS NOT TRUE").select(*carry, "score", F.lit(None).cast(kind).alias("_b_label"), *(F.lit(None).cast("long").alias(c) for c in ("_ties", "_bases")))
    return named.unionByName(rest)


def _name_genes(reads: DataFrame, carry: list[str], genes: DataFrame, mapq: int, width: int) -> DataFrame:
    """`carry`, status, score, gene of each row of `reads`; see `assign_genes`."""
    status = _status(mapq)
    return _nearest(reads, carry, genes, mapq, width).select(*carry, status.alias("status"), "score", F.when(status == "Assigned", F.col("_b_label")).otherwise("NA").alias("gene"))


def assign_genes(reads: DataFrame, genes: DataFrame, mapq: int = 30, width: int = 100_000) -> DataFrame:
    """read_id, status, score, gene: the gene a read shares most bases with.

    `reads` has one row per read_id with chrom, start, end, strand and score; `genes` has chrom, start, end, strand and
    label. Low scores come before any overlap, and an overlap that two genes reach is ambiguous.
    """
    return _name_genes(_with_id(reads), ["read_id"], genes, mapq, width)


class _Exons:
    """Exons of all chromosomes along one line, and which bins of it a transcript touches together."""

    def __init__(self, exons: pa.Table, width: int) -> None:
        chrom = exons["chrom"].combine_chunks().dictionary_encode()
        self.chroms = chrom.dictionary
        gs, ge = exons["start"].to_numpy(), exons["end"].to_numpy()
        self.base, self.span = int(gs.min()), int(ge.max() - gs.min()) + 2
        c = chrom.indices.to_numpy().astype(np.int64)
        tx = exons["label"].combine_chunks().dictionary_encode()
        self.names, code = tx.dictionary, tx.indices.to_numpy().astype(np.int64)
        order = np.lexsort((gs, c))
        self.gs, self.ge = (c * self.span + gs - self.base)[order], (c * self.span + ge - self.base)[order]
        self.tx, self.strand = code[order], exons["strand"].to_numpy()[order]
        self.reach = np.maximum.accumulate(self.ge)
        self.width, self.bins = width, int(self.ge.max()) // width + 1
        # Pairs of bins that one transcript touches, and those that it touches with two exons.
        low, high = self.gs // width, (self.ge - 1) // width
        who = np.repeat(np.arange(len(order)), high - low + 1)
        bin_ = low[who] + _places(high - low + 1)
        by_tx = np.argsort(self.tx[who], kind="stable")
        who, bin_ = who[by_tx], bin_[by_tx]
        i, j = _pairs(self.tx[who], _RELATED)
        self.whole = i is None  # too many to be told: every block may meet a transcript twice
        self.any = self.two = np.zeros(0, np.int64)
        if not self.whole:
            pair = bin_[i] * self.bins + bin_[j]
            self.any, self.two = np.unique(pair), np.unique(pair[who[i] != who[j]])


def _places(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _pairs(runs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray] | tuple[None, None]:
    """All ordered pairs of places with equal values in a sorted array; None if they are more than `most`."""
    first = np.searchsorted(runs, runs)
    size = np.searchsorted(runs, runs, side="right") - first
    if int(size.sum()) > most:
        return None, None
    return np.repeat(np.arange(len(runs)), size), np.repeat(first, size) + _places(size)


def _holds(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(among, values), max(len(among) - 1, 0))
    return among[at] == values if len(among) else np.zeros(len(values), bool)


def _met_twice(shared, kinds: pa.Schema):
    """Rows sorted by read to the transcripts that a read's blocks and their exons meet at least twice: the best of each read and how many there are."""
    meets = np.array([[g in _MEETS[r] for g in range(4)] for r in range(4)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x: _Exons = shared.value
        for rows, starts in whole_runs(batches, ["read_id"]):
            read = np.zeros(len(rows), np.int64)
            read[starts[1:]] = 1
            read = np.cumsum(read)
            c = pc.index_in(rows["chrom"], value_set=x.chroms).to_numpy()
            s, e, strand = (rows[k].to_numpy() for k in ("_s", "_e", "_strand"))
            end = x.base + x.span - 1
            inside = np.flatnonzero(~np.isnan(c.astype(float)) & (s < end) & (e > x.base))
            line = c[inside].astype(np.int64) * x.span
            read, strand = read[inside], strand[inside]
            s, e = line + np.maximum(s[inside], x.base) - x.base, line + np.minimum(e[inside], end) - x.base
            # Blocks of which a transcript may be met twice, by the bins they touch.
            low, size = s // x.width, (e - 1) // x.width - s // x.width + 1
            flagged = np.full(len(s), x.whole)
            for a in range(0, 0 if x.whole else len(s) and int(read[-1]) + 1, 20_000):
                u, z = np.searchsorted(read, [a, a + 20_000])
                who = u + np.repeat(np.arange(z - u), size[u:z])
                bin_ = low[who] + _places(size[u:z])
                i, j = _pairs(read[who], _RELATED)
                if i is None:
                    flagged[u:z] = True
                    continue
                pair, same = bin_[i] * x.bins + bin_[j], who[i] == who[j]
                flagged[who[i[np.where(same, _holds(pair, x.two), _holds(pair, x.any))]]] = True
            at = np.flatnonzero(flagged)
            if not len(at):
                continue
            lows, highs = np.searchsorted(x.reach, s[at], side="right"), np.searchsorted(x.gs, e[at])
            n = np.maximum(highs - lows, 0)
            upto, ends = np.cumsum(n), np.flatnonzero(np.r_[read[at][1:] != read[at][:-1], True]) + 1  # where reads end
            a = 0
            while a < len(at):
                z = int(ends[min(np.searchsorted(upto[ends - 1], (upto[a - 1] if a else 0) + 4 * _CELLS), len(ends) - 1)])
                block, exon = np.repeat(at[a:z], n[a:z]), np.repeat(lows[a:z], n[a:z]) + _places(n[a:z])
                bases = np.minimum(e[block], x.ge[exon]) - np.maximum(s[block], x.gs[exon])
                keep = (bases > 0) & meets[strand[block], x.strand[exon]]
                key, bases = read[block[keep]] * len(x.names) + x.tx[exon[keep]], bases[keep]
                order = np.argsort(key, kind="stable")
                key, bases = key[order], bases[order]
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
                total, times = np.add.reduceat(bases, first) if len(first) else bases, np.diff(np.r_[first, len(key)])
                of, total = key[first][times > 1], total[times > 1]
                a = z
                if not len(of):
                    continue
                whose = of // len(x.names)
                begin = np.flatnonzero(np.r_[True, whose[1:] != whose[:-1]])
                best = np.repeat(np.maximum.reduceat(total, begin), np.diff(np.r_[begin, len(whose)]))
                ties = np.add.reduceat((total == best).astype(np.int64), begin)
                one = np.maximum.reduceat(np.where(total == best, np.arange(len(total)), -1), begin)
                out = [rows["read_id"].take(pa.array(starts[whose[one]])), pa.array(total[one]), pa.array(ties), x.names.take(pa.array(of[one] % len(x.names)))]
                yield from pa.table(out, names=kinds.names).cast(kinds).combine_chunks().to_batches()

    return run


def assign_transcripts(blocks: DataFrame, exons: DataFrame, mapq: int = 30, width: int = 100_000, listed: int = LISTED) -> DataFrame:
    """read_id, status, score, gene, transcript_id: the transcript whose exons share most bases with a read's blocks.

    A transcript that a read meets in one block and one exon only can win only as the best exon of that block, so that blocks
    aren't paired with exons; those met more than once are summed. Beyond `listed` exons, which are broadcast, all pairs are summed.
    """
    blocks = _with_id(blocks)
    known = exons.filter((F.col("start") < F.col("end")) & F.col("chrom").isNotNull())
    if known.limit(listed + 1).count() > listed:
        return _pair_transcripts(blocks, exons, mapq, width)
    text = F.to_json(F.struct("transcript_id", "label"), {"ignoreNullFields": "false"})
    code = F.when(F.col("strand") == "+", _PLUS).when(F.col("strand") == "-", _MINUS).when(F.col("strand").isNull(), _MISSING).otherwise(_OPEN)
    named = known.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "strand", text.alias("label"))
    alone = _nearest(blocks, ["read_id"], named, None, width).select("read_id", "score", F.col("_bases").alias("overlap"), F.col("_ties").alias("_n"), F.col("_b_label").alias("_of"))
    table = named.withColumn("strand", code).toArrow()
    if table.num_rows:
        kinds = T.StructType([blocks.schema["read_id"], T.StructField("overlap", T.LongType()), T.StructField("_n", T.LongType()), T.StructField("_of", T.StringType())])
        placed = blocks.filter((F.col("start") < F.col("end")) & F.col("chrom").isNotNull()).select(
            "read_id", "chrom", F.col("start").cast("long").alias("_s"), F.col("end").cast("long").alias("_e"), code.alias("_strand")
        )
        shared = blocks.sparkSession.sparkContext.broadcast(_Exons(table, width))
        twice = placed.repartition("read_id").sortWithinPartitions("read_id").mapInArrow(_met_twice(shared, to_arrow_schema(kinds)), kinds)
        alone = alone.unionByName(twice, allowMissingColumns=True)
    level = alone.repartition("read_id").groupBy("read_id", "overlap").agg(F.sum("_n").alias("_n"), F.max("_of").alias("_of"), F.max("score").alias("score"))
    top = level.groupBy("read_id").agg(F.max(F.struct("overlap", "_n", "_of")).alias("_top"), F.max("score").alias("score")).select("read_id", "score", F.col("_top._n").alias("_ties"), F.col("_top._of").alias("_of"))
    names = T.StructType([T.StructField(c, exons.schema[c].dataType) for c in ("transcript_id", "label")])
    status = _status(mapq)
    shown = lambda c: F.when(F.col("status") == "Assigned", F.col(c)).otherwise("NA")
    return top.select("read_id", status.alias("status"), "score", F.from_json("_of", names).alias("_f")).select(
        "read_id", "status", "score", shown("_f.label").alias("gene"), shown("_f.transcript_id").alias("transcript_id")
    )


def _pair_transcripts(blocks: DataFrame, exons: DataFrame, mapq: int, width: int) -> DataFrame:
    scores = blocks.groupBy("read_id").agg(F.max("score").alias("score"))
    met = interval_join(blocks.select("read_id", "chrom", "start", "end", "strand"), exons, width)
    support = met.groupBy("read_id", F.col("f_transcript_id").alias("transcript_id"), F.col("f_label").alias("label")).agg(
        F.sum("overlap").alias("overlap")
    )
    best = _best(support, "read_id", ["transcript_id", "label"])
    status = _status(mapq)
    named = lambda c: F.when(status == "Assigned", F.col(c)).otherwise("NA")
    return scores.join(best, "read_id", "left").select(
        "read_id", status.alias("status"), "score", named("_b_label").alias("gene"), named("_b_transcript_id").alias("transcript_id")
    )


def cigar_parts(cigar: Column) -> Column:
    """ARRAY<STRUCT<op, n>> of a CIGAR string."""
    tokens = F.regexp_extract_all(cigar, F.lit(r"\d+[MIDNSHP=X]"), F.lit(0))
    return F.transform(tokens, lambda t: F.struct(F.right(t, F.lit(1)).alias("op"), F.regexp_extract(t, r"\d+", 0).cast("long").alias("n")))


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that the alignment spans."""
    return F.aggregate(
        F.filter(cigar_parts(cigar), lambda p: p["op"].isin("M", "D", "N", "=", "X")), F.lit(0).cast("long"), lambda s, p: s + p["n"]
    )


def query_length(cigar: Column, clipped: bool) -> Column:
    """Bases of the read in the alignment, or with the clipped ones too."""
    ops = ["M", "I", "=", "X", *(["S", "H"] if clipped else [])]
    return F.aggregate(F.filter(cigar_parts(cigar), lambda p: p["op"].isin(*ops)), F.lit(0).cast("long"), lambda s, p: s + p["n"])


def split_blocks(start: Column, cigar: Column) -> Column:
    """ARRAY<STRUCT<start, end>>: the aligned blocks, parted at skipped regions (N) only."""
    state = F.struct(start.cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("done"), start.cast("long").alias("open"))

    def step(s: Column, p: Column) -> Column:
        takes, skips = p["op"].isin("M", "D", "=", "X"), p["op"] == "N"
        at = F.when(takes | skips, s["at"] + p["n"]).otherwise(s["at"])
        block = F.array(F.struct(s["open"].alias("start"), s["at"].alias("end")))
        done = F.when(skips & (s["open"] < s["at"]), F.concat(s["done"], block)).otherwise(s["done"])
        return F.struct(at.alias("at"), done.alias("done"), F.when(skips, at).otherwise(s["open"]).alias("open"))

    def close(s: Column) -> Column:
        last = F.array(F.struct(s["open"].alias("start"), s["at"].alias("end")))
        return F.when(s["open"] < s["at"], F.concat(s["done"], last)).otherwise(s["done"])

    return F.aggregate(cigar_parts(cigar), state, step, close)


def region_name(chrom: Column, first: Column, last: Column, interval: int = 1000) -> Column:
    """chrom_from_to of the interval that holds the middle; a middle on a bound gives it twice."""
    middle = F.floor((first + last) / 2)
    low = F.floor(middle / interval) * interval
    high = F.ceil(middle / interval) * interval
    return F.concat_ws("_", chrom, low.cast("string"), high.cast("string"))


def bed_records(alignments: DataFrame) -> DataFrame:
    """chrom, start, end, name, score, strand of the mapped records (flag bit 4 unset, a chrom and a start that isn't negative).

    `alignments` has read_id, flag, chrom, start, cigar and mapq. First and last reads of a pair (bits 64 and 128) get /1 and /2.
    """
    bit = lambda b: F.col("flag").bitwiseAND(b) != 0
    ends = F.concat(F.when(bit(64), "/1").otherwise(""), F.when(bit(128), "/2").otherwise(""))
    return alignments.filter(~bit(4) & F.col("chrom").isNotNull() & (F.col("start") >= 0)).select(
        "chrom", "start", (F.col("start") + reference_length(F.col("cigar"))).alias("end"), F.concat(F.col("read_id").cast("string"), ends).alias("name"),
        F.col("mapq").alias("score"), F.when(bit(16), "-").otherwise("+").alias("strand"),
    )


def tag_and_assign(alignments: DataFrame, tags: DataFrame, genes: DataFrame, mapq: int = 30, keep_untagged: bool = False, width: int = 100_000) -> DataFrame:
    """read_id, barcode, umi, status, score, gene: tags and genes of mapped records in one plan.

    `tags` has read_id, barcode and umi; of several rows of a read the smallest counts. Records without tags are left out
    unless `keep_untagged`. Each record is assigned by itself.
    """
    first = tags.groupBy("read_id").agg(F.min(F.struct("barcode", "umi")).alias("_t")).select("read_id", "_t.*")
    tagged = alignments.join(first, "read_id", "left" if keep_untagged else "inner")
    # By columns, the read's first, so that they stay where the join put them.
    mapped = tagged.filter((F.col("flag").bitwiseAND(4) == 0) & F.col("chrom").isNotNull() & (F.col("start") >= 0)).select(
        "read_id", "flag", "chrom", "start", "cigar", "mapq", "barcode", "umi"
    ).distinct()
    records = mapped.select(
        "read_id", "barcode", "umi", "chrom", "start", (F.col("start") + reference_length(F.col("cigar"))).alias("end"),
        F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+").alias("strand"), F.col("mapq").alias("score"),
    )
    return _name_genes(records, ["read_id", "barcode", "umi"], genes, mapq, width)
