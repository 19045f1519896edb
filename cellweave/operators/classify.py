"""Classes of reads by the primers and tails at their ends, and reads cut to what lies between.

The distances of the primers to the ends come from one array kernel; the decision is an ordered list of
conditions over them. Before that, the places of all primers in the whole read are put into clusters: a read
with too many joins several molecules and is taken apart between neighbouring clusters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions import seq as S
from cellweave.functions.edits import best_ends, first_starts
from cellweave.sources.fastq import write_fastq

# Numbers and names of the classes.
CLASSES = {
    0: "high-confidence strand:+", 1: "high-confidence strand:-", 2: "low-confidence strand:+", 3: "low-confidence strand:-",
    4: "double-rtp-double-polyat", 5: "non-tso-polya-rtp", 6: "rtp-polyt-non-tso", 7: "tso-rtp-non-polyat", 8: "rtp-tso-non-polyat",
    9: "single-5'-tso", 10: "single-5'-rtp", 11: "single-3'-tso", 12: "single-3'-rtp", 13: "double-tso", 14: "double-rtp",
    15: "non-primer", 16: "too short", 17: "low quality", 18: "irrescuable", 19: "rescued strand:+", 20: "rescued strand:-",
}

# The outputs that classes go to; reads of FULL also go to the merged output.
BUCKETS = {
    "full-length": (0, 1, 2, 3), "non-full-length": (4, 5, 6, 7, 8, 9, 10, 11, 12), "discarded": (13, 14, 15, 18), "failed-filter": (16, 17), "rescued": (19, 20),
}
FULL = (0, 1, 2, 3, 19, 20)
MERGED = "full-length-plus-rescued"


def threshold(stated: str, length: int) -> int:
    """Edits allowed: a whole number as it is, a rate times the length of the primer, rounded half up."""
    try:
        return int(stated)
    except ValueError:
        return int(float(stated) * length + 0.5)


@dataclass(frozen=True)
class Primers:
    """Both primers, the edits allowed in them, and how far from the ends they are looked for."""

    tso: str
    rtp: str
    tso_edits: str = "0.2"
    rtp_edits: str = "0.25"
    first: int = 200
    last: int = 200
    skip: int = 0
    tail: int = 10
    umi: int = 41


def _distance(pattern: str):
    @F.pandas_udf("struct<d: int, end: int>")
    def run(texts: pd.Series) -> pd.DataFrame:
        d, who, ends = best_ends(pattern, texts.fillna("").tolist())
        last = np.zeros(len(d), np.int64)
        np.maximum.at(last, who, ends)
        return pd.DataFrame({"d": d, "end": last.astype(np.int32)})

    return run


def _complement(primer: str) -> str:
    return primer.translate(str.maketrans("ACGT", "TGCA"))


def primer_places(primers: Primers, texts: list[str]) -> pd.DataFrame:
    """who, at, id, sorted: all places of the four primers in whole texts, where the primers end and their reverse complements start.

    Of each primer the places at its smallest distance count, if that is within its limit. Numbers: 0 and 1 the primers, 2 the
    reverse complement of the second, 3 that of the first.
    """
    p = primers
    t_limit, r_limit = threshold(p.tso_edits, len(p.tso)), threshold(p.rtp_edits, len(p.rtp))
    searches = [(p.tso, t_limit, False), (p.rtp, r_limit, False), (_complement(p.rtp)[::-1], r_limit, True), (_complement(p.tso)[::-1], t_limit, True)]
    rows = []
    for number, (pattern, limit, start) in enumerate(searches):
        d, who, ends = best_ends(pattern, texts)
        near = d[who] <= limit
        who, ends = who[near], ends[near]
        rows.append(pd.DataFrame({"who": who, "at": first_starts(pattern, texts, d, who, ends) if start else ends - 1, "id": number}))
    return pd.concat(rows).sort_values(["who", "at", "id"], ignore_index=True)


def clusters(places: pd.DataFrame, gap: int) -> pd.DataFrame:
    """who, first, last and the last place of each primer (p0 to p3, NaN without) of runs of places at most `gap` apart."""
    fresh = (places["who"] != places["who"].shift()) | (places["at"] - places["at"].shift() > gap)
    runs = places.assign(run=fresh.cumsum(), **{f"p{i}": places["at"].where(places["id"] == i) for i in range(4)})
    return runs.groupby("run").agg(who=("who", "first"), first=("at", "first"), last=("at", "last"), **{f"p{i}": (f"p{i}", "max") for i in range(4)})


def _piece(text: str, t: float, r: float, rc: float, tc: float, tail: int, span: int) -> tuple[int, int, int] | None:
    """Class, start and end of the molecule between the first two places (of one cluster) and the last two (of the next); NaN is none."""
    has_t, has_r, has_rc, has_tc = (x == x for x in (t, r, rc, tc))
    ahead = text.find("T" * tail, int(r) + 1, int(r) + 1 + span) if has_r else -1  # the first T tail behind
    back = text.rfind("A" * tail, max(int(rc) - span, 0), int(rc)) if has_rc else -1  # the last A tail before
    if has_r and has_rc and ahead >= 0 and back >= 0:
        return None
    if has_t and has_rc:
        number, start, end = 19, int(t) + 1, back + tail if back >= 0 else -1
    elif has_r and has_tc:
        number, start, end = 20, ahead if ahead >= 0 else len(text), int(tc)
    else:
        return None
    return (number, start, end) if start < end <= len(text) else None


def _joined(primers: Primers):
    """Of each text the number of clusters, whether it joins molecules, and these."""
    p = primers
    gap, span = abs(len(p.tso) - len(p.rtp)) + 5, max(3 * p.tail, p.umi + p.tail + 10)

    @F.pandas_udf("struct<n: int, joined: boolean, pieces: array<struct<c: int, s: int, e: int>>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        own = texts.fillna("").tolist()
        found = clusters(primer_places(p, own), gap)
        ends = found.groupby("who").agg(n=("first", "size"), first=("first", "first"), last=("last", "last")).reindex(range(len(own)))
        sizes = np.array([len(t) for t in own])
        n = ends["n"].fillna(0).astype(int).to_numpy()
        far = (ends["first"] >= p.first).to_numpy() & (ends["last"].to_numpy() + p.last < sizes)
        joined = (n > 2) | (n == 2) & far
        pieces: list[list[dict]] = [[] for _ in own]
        after = found.shift(-1)
        pairs = found.assign(rc=after["p2"], tc=after["p3"])[(found["who"] == after["who"]) & joined[found["who"].to_numpy(int)]]
        for who, t, r, rc, tc in pairs[["who", "p0", "p1", "rc", "tc"]].itertuples(index=False):
            made = _piece(own[int(who)], t, r, rc, tc, p.tail, span)
            if made:
                pieces[int(who)].append(dict(zip("cse", made)))
        return pd.DataFrame({"n": n.astype(np.int32), "joined": joined, "pieces": pieces})

    return run


def classify(reads: DataFrame, primers: Primers, min_length: int = 300, min_quality: float = 7.0) -> DataFrame:
    """read_id, class, name, seq, qual, cut_start, cut_end: each read with its class, cut and turned to the sense strand.

    A read with more than two clusters of primers, or with two that both lie far from its ends, joins molecules: each that
    lies between neighbouring clusters with the tail it needs becomes a row of its own, numbered in its read_id (classes 19 and
    20), and a read without any keeps its sequence in class 18. A read without a primer anywhere has class 15.
    A NULL sequence counts as empty. Reads too short or of low quality keep their sequence, as do those of which the cuts
    would leave nothing, which count as without primers. The last class but two compares the distance of the
    second primer at the front with the limit of the first.
    """
    p, n = primers, F.length("seq")
    t_limit, r_limit = threshold(p.tso_edits, len(p.tso)), threshold(p.rtp_edits, len(p.rtp))
    ends = {"_t": p.tso, "_r": p.rtp}, {"_tc": _complement(p.tso[p.skip :]), "_rc": _complement(p.rtp[p.skip :])}
    tc_limit, rc_limit = threshold(p.tso_edits, len(p.tso) - p.skip), threshold(p.rtp_edits, len(p.rtp) - p.skip)
    rows = reads.select("read_id", F.coalesce("seq", F.lit("")).alias("seq"), F.coalesce("qual", F.lit("")).alias("qual"))
    rows = rows.withColumn("_gate", S.passes_gate(S.phred(F.col("qual")), max(min_length, len(p.tso), len(p.rtp), p.tail), min_quality))
    passed = F.col("_gate") == 0
    rows = rows.withColumn("_j", _joined(p)(F.when(passed, F.col("seq")).otherwise("")))
    rows = rows.withColumns({"_front": F.substring("seq", 1, p.first), "_back": F.reverse(F.when(n > p.last, F.right("seq", F.lit(p.last))).otherwise(F.col("seq")))})
    for side, text in zip(ends, ("_front", "_back")):
        rows = rows.withColumns({name: _distance(pattern)(F.col(text)) for name, pattern in side.items()})
    poly = lambda text, base: F.when(F.locate(base * p.tail, F.col(text)) > 0, F.locate(base * p.tail, F.col(text)) - 1)
    rows = rows.withColumns({"_a": poly("_back", "A"), "_tt": poly("_front", "T")})

    def follows(at: Column, end: Column) -> Column:
        """Whether a tail begins where the UMI behind the primer allows."""
        gap = at - end
        low, high = (0, 3) if p.umi == 0 else (int(p.umi * 0.5 + 0.5), int(p.umi * 1.5 + 0.5))
        return F.coalesce((gap >= 0) & gap.between(low, high), F.lit(False))

    rows = rows.withColumns({
        "_t_ok": F.col("_t.d") <= t_limit, "_r_ok": F.col("_r.d") <= r_limit, "_tc_ok": F.col("_tc.d") <= tc_limit, "_rc_ok": F.col("_rc.d") <= rc_limit,
        "_plus": follows(F.col("_a"), F.col("_rc.end")), "_minus": follows(F.col("_tt"), F.col("_r.end")),
    })
    t, r, tc, rc, plus, minus = (F.col(c) for c in ("_t_ok", "_r_ok", "_tc_ok", "_rc_ok", "_plus", "_minus"))
    has_a, has_t = F.col("_a").isNotNull(), F.col("_tt").isNotNull()
    bare = ~has_a & ~has_t
    sense, anti = t & rc & plus, r & tc & minus
    at = {"t": F.col("_t.end"), "r": F.col("_r.end"), "tc": F.col("_tc.end"), "rc": F.col("_rc.end"), "a": F.col("_a"), "tt": F.col("_tt"), "0": F.lit(0)}
    direct = p.umi == 0
    # In order: the condition, the class, and where the cuts at both ends are.
    rules = [
        (F.col("_gate") > 0, None, "0", "0"),
        (F.col("_j.n") == 0, 15, "0", "0"),
        (sense & ~anti, 0, "t", "a" if direct else "rc"),
        (~sense & anti, 1, "tt" if direct else "r", "tc"),
        (r & rc & plus & minus, 4, "tt", "a"),
        (t & has_a & ~(rc & plus), 2, "t", "a"),
        (tc & has_t & ~(r & minus), 3, "tt", "tc"),
        (~t & rc & plus, 5, "0", "a"),
        (r & ~tc & minus, 6, "tt", "0"),
        (t & rc & bare, 7, "t", "rc"),
        (r & tc & bare, 8, "r", "tc"),
        (t & tc & bare, 13, "t", "tc"),
        (r & rc & bare, 14, "r", "rc"),
        (t & ~rc & ~tc & ~r, 9, "t", "0"),
        (r & ~tc & ~rc & ~t, 10, "r", "0"),
        (tc & ~r & ~t & ~rc, 11, "0", "tc"),
        (rc & ~t & (F.col("_r.d") > t_limit) & ~tc, 12, "0", "rc"),
    ]
    chosen = F.lit(None)
    for condition, number, start, end in reversed(rules):
        value = F.struct((F.col("_gate") if number is None else F.lit(number)).cast("int").alias("c"), at[start].cast("int").alias("s"), at[end].cast("int").alias("e"))
        chosen = F.when(condition, value).otherwise(chosen)
    other = F.struct(F.lit(15).alias("c"), F.lit(0).alias("s"), F.lit(0).alias("e"))
    rows = rows.withColumn("_c", F.coalesce(chosen, other))
    left = n > F.col("_c.s") + F.col("_c.e")
    rows = rows.withColumn("_c", F.when(left | (F.col("_gate") > 0), F.col("_c")).otherwise(other))
    # Every read gives an array of molecules: its own one, or those of a joined read.
    one = F.struct("read_id", F.col("_c.c").alias("c"), F.col("_c.s").alias("s"), (n - F.col("_c.e")).alias("e"))
    lost = F.struct("read_id", F.lit(18).alias("c"), F.lit(0).alias("s"), n.alias("e"))

    def named(x: Column, i: Column) -> Column:
        strand = F.when(x["c"] == 19, "plus").otherwise("minus")
        name = F.concat(F.col("read_id").cast("string"), F.lit("_rescued_No"), (i + 1).cast("string"), F.lit("_strand_"), strand)
        return F.struct(name.alias("read_id"), x["c"].alias("c"), x["s"].alias("s"), x["e"].alias("e"))

    single = F.when(F.col("_j.joined"), lost).otherwise(one)
    # No array is empty; an outer explode keeps the optimizer from testing that beneath the searches, which would run them twice.
    rows = rows.withColumn("_out", F.when(F.size("_j.pieces") > 0, F.transform("_j.pieces", named)).otherwise(F.array(single)))
    rows = rows.select("seq", "qual", F.explode_outer("_out").alias("_o"))
    part = lambda c: F.substring(F.col(c), F.col("_o.s") + 1, F.col("_o.e") - F.col("_o.s"))
    turned = F.col("_o.c").isin(1, 3, 20)
    names = F.create_map(*(F.lit(x) for pair in CLASSES.items() for x in pair))
    return rows.select(
        F.col("_o.read_id").alias("read_id"),
        F.col("_o.c").alias("class"),
        names[F.col("_o.c")].alias("name"),
        F.when(turned, S.revcomp(part("seq"))).otherwise(part("seq")).alias("seq"),
        F.when(turned, F.reverse(part("qual"))).otherwise(part("qual")).alias("qual"),
        F.col("_o.s").alias("cut_start"),
        (F.length("seq") - F.col("_o.e")).alias("cut_end"),
    )


def fan_out(classified: DataFrame, merged_only: bool = False) -> DataFrame:
    """The reads with `bucket`, the output that their class goes to; full-length and rescued reads also come in the merged one."""
    name = F.lit(None)
    for bucket, classes in BUCKETS.items():
        name = F.when(F.col("class").isin(*classes), bucket).otherwise(name)
    full = F.col("class").isin(*FULL)
    if merged_only:
        return classified.filter(full).withColumn("bucket", F.lit(MERGED))
    both = F.when(full, F.array(name, F.lit(MERGED))).otherwise(F.array(name))
    return classified.withColumn("bucket", F.explode(both))


def write_classified(classified: DataFrame, path: str, merged_only: bool = False) -> None:
    """Compressed FASTQ text, a folder for each output."""
    write_fastq(fan_out(classified, merged_only), path, by="bucket")


def source_id(read_id: Column) -> Column:
    """The read that a row of a joined read came from; other ids as they are."""
    return F.regexp_replace(read_id, r"_rescued_No[0-9]+_strand_(plus|minus)$", "")


def run_summary(classified: DataFrame) -> DataFrame:
    """type, n, percent: reads by what became of them, and the rows of joined reads; percent is 0 where there is nothing to divide by.

    Reads count once in the first block, of which "Full-length+rescued" counts rows; the second block is of rows of joined reads.
    """
    c = F.col("class")
    per_read = classified.withColumn("_rescued", c.isin(19, 20)).groupBy(F.when(c.isin(19, 20), source_id(F.col("read_id"))).alias("_of"), "_rescued").agg(
        F.count("*").alias("rows"), F.count_if(c == 16).alias("short"), F.count_if(c == 17).alias("low"), F.count_if(c == 18).alias("lost"),
        F.count_if(c == 19).alias("plus"), F.count_if(c == 20).alias("minus"), F.count_if(c <= 3).alias("full"),
    )
    reads = F.when(F.col("_rescued"), 1).otherwise(F.col("rows"))
    one = per_read.agg(
        *(F.coalesce(F.sum(x), F.lit(0)).alias(name) for x, name in (
            (reads, "total"), (F.col("short"), "short"), (F.col("low"), "low"), (F.col("lost"), "lost"), (F.col("plus"), "plus"), (F.col("minus"), "minus"), (F.col("full"), "full"),
            (F.when(F.col("_rescued"), 1).otherwise(0), "rescued"),
        ))
    )
    col = F.col
    chimeric, rows = col("lost") + col("rescued"), col("plus") + col("minus") + col("lost")
    clean = col("total") - col("short") - col("low") - chimeric
    lines = [
        ("Total", col("total"), col("total")), ("Length-filtered", col("short"), col("total")), ("QC-filtered", col("low"), col("total")),
        ("Full-length+rescued", col("full") + col("plus") + col("minus"), col("total")), ("Chimeric", chimeric, col("total")), ("Non-chimeric", clean, col("total")),
        ("Full-length", col("full"), col("total")), ("Chimeric reads rescued", col("rescued"), chimeric), ("Rescued strand:+", col("plus"), rows),
        ("Rescued strand:-", col("minus"), rows), ("Irrescuable", col("lost"), rows),
    ]
    percent = lambda a, b: F.coalesce(F.try_divide(a * 100.0, b), F.lit(0.0)).cast("double")
    made = F.array(*(F.struct(F.lit(name).alias("type"), a.cast("long").alias("n"), percent(a, b).alias("percent")) for name, a, b in lines))
    return one.select(F.explode(made).alias("_m")).select("_m.*")


def merge_statistics(parts: DataFrame) -> DataFrame:
    """`class_statistics` of several runs, unioned, as one: counts add up and shares are taken anew."""
    sums = parts.groupBy("class", "name").agg(F.sum("n").alias("n"), F.sum("bases").alias("bases"))
    total = sums.agg(F.sum("n").alias("_all"))
    return sums.crossJoin(F.broadcast(total)).select(  # one row
        "class", "name", "n", "bases", F.coalesce(F.try_divide(F.col("n") * 100, F.col("_all")), F.lit(0.0)).cast("double").alias("percent")
    )


def class_statistics(classified: DataFrame) -> DataFrame:
    """class, name, n, bases, percent for every class, those without a read too; percent is 0 where there are no reads."""
    spark = classified.sparkSession
    counts = classified.groupBy("class").agg(F.count("*").alias("_n"), F.sum(F.length("seq")).alias("_b"))
    frame = spark.createDataFrame(list(CLASSES.items()), "class int, name string")
    total = counts.agg(F.sum("_n").alias("_all"))
    return frame.join(counts, "class", "left").crossJoin(F.broadcast(total)).select(  # one row
        "class", "name", F.coalesce("_n", F.lit(0)).alias("n"), F.coalesce("_b", F.lit(0)).alias("bases"),
        F.coalesce(F.try_divide(F.col("_n") * 100, F.col("_all")), F.lit(0.0)).cast("double").alias("percent"),
    )
