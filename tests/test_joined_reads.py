"""Primer places, joined reads and their outputs against plain readings of the rules."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellweave.functions import edits
from cellweave.functions.seq import tail_lengths
from cellweave.operators import classify as K

_TURN = str.maketrans("ACGT", "TGCA")


def _turn(s):
    return s[::-1].translate(_TURN)


def _places(pattern, text):
    """Smallest distance to a part, and for each end at it the smallest start."""
    by_end = {e: [(edits.distance(pattern, text[s:e]), s) for s in range(e + 1)] for e in range(1, len(text) + 1)}
    best = min([len(pattern)] + [min(v)[0] for v in by_end.values()])
    return best, [(e, min(s for d, s in v if d == best)) for e, v in by_end.items() if best < len(pattern) and min(v)[0] == best]


@pytest.mark.parametrize("size", [3, 6, 70])
def test_best_parts(size, monkeypatch):
    monkeypatch.setattr(edits, "CELLS", 40)
    rng = random.Random(size)
    for _ in range(40 if size < 70 else 4):
        pattern = "".join(rng.choice("ACG") for _ in range(size))
        texts = ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 14))) for _ in range(5)]
        d, who, ends = edits.best_ends(pattern, texts)
        starts = edits.first_starts(pattern, texts, d, who, ends)
        for i, text in enumerate(texts):
            best, places = _places(pattern, text)
            assert d[i] == best and [(int(e), int(s)) for w, e, s in zip(who, ends, starts) if w == i] == places
    assert len(edits.best_ends("ACG", [])[0]) == 0 and edits.best_ends("", ["AC"])[0].tolist() == [0]


def _molecules(text, p):
    """Clusters of the places and the molecules between them, as the rule is read."""
    limits = (K.threshold(p.tso_edits, len(p.tso)), K.threshold(p.rtp_edits, len(p.rtp)))
    hits = []
    for number, (pattern, limit) in enumerate([(p.tso, limits[0]), (p.rtp, limits[1]), (_turn(p.rtp), limits[1]), (_turn(p.tso), limits[0])]):
        best, places = _places(pattern, text)
        hits += [(e - 1 if number < 2 else s, number) for e, s in places if best <= limit]
    groups = []
    for at, number in sorted(hits):
        if groups and at - groups[-1][-1][0] <= abs(len(p.tso) - len(p.rtp)) + 5:
            groups[-1].append((at, number))
        else:
            groups.append([(at, number)])
    joined = len(groups) > 2 or len(groups) == 2 and groups[0][0][0] >= p.first and groups[1][-1][0] + p.last < len(text)
    out, span = [], max(3 * p.tail, p.umi + p.tail + 10)
    for a, b in zip(groups, groups[1:]) if joined else ():
        t, r, rc, tc = (max([x for x, n in g if n == k], default=None) for g, k in ((a, 0), (a, 1), (b, 2), (b, 3)))
        tt = text[r + 1 :][:span].find("T" * p.tail) if r is not None else -1
        up = text[max(rc - span, 0) : rc] if rc is not None else ""
        aa = len(up) - up.rfind("A" * p.tail) - p.tail if "A" * p.tail in up else -1
        if r is not None and rc is not None and tt >= 0 and aa >= 0:
            continue
        if t is not None and rc is not None:
            if aa >= 0 and t + 1 < rc - aa:
                out.append((19, t + 1, rc - aa))
        elif r is not None and tc is not None and tt >= 0 and r + tt + 1 < tc:
            out.append((20, r + tt + 1, tc))
    return len(groups), joined, out


@pytest.mark.parametrize("limits", [("0", "0"), ("0.2", "0.25")])
def test_joined_reads(spark, limits):
    rng = random.Random(3)
    p = K.Primers(tso="ACGTTGCAAC", rtp="GGATCCTTAG", tso_edits=limits[0], rtp_edits=limits[1], first=12, last=12, tail=6, umi=4)

    def odd(s):
        if rng.random() < 0.3:
            at = rng.randrange(len(s))
            s = s[:at] + rng.choice(["", "A", "CG"]) + s[at + 1 :]
        return s

    def molecule():
        body = "".join(rng.choice("CGT") for _ in range(rng.randint(0, 20)))
        s = odd(p.tso) + body + "A" * rng.choice([0, 5, 8]) + "GCTC" + odd(_turn(p.rtp))
        return s if rng.random() < 0.5 else _turn(s)

    texts = ["".join(molecule() + "CCTG" * rng.randint(0, 3) for _ in range(rng.randint(1, 3))) for _ in range(60)]
    texts += ["TTCCTTCC" * 5 + molecule() + "GGCCGGCC" * 5, "CTCTCTCT" * 10, p.rtp + "T" * 8 + "CCGG" + "A" * 8 + _turn(p.rtp) + "CCTG" * 4 + p.tso]
    rows = [(str(i), s, "I" * len(s)) for i, s in enumerate(texts)] + [("none", None, None), ("empty", "", "")]
    df = spark.createDataFrame(rows, "read_id string, seq string, qual string").withColumn("class", F.lit("x"))
    classified = K.classify(df, p, min_length=20).cache()
    got = {}
    for r in classified.collect():
        got.setdefault(r.read_id.split("_rescued_No")[0], []).append(r)
    kinds = set()
    for i, text in enumerate(texts):
        n, joined, pieces = _molecules(text, p)
        out = got[str(i)]
        kinds |= {r["class"] for r in out}
        if not joined:
            assert len(out) == 1 and out[0]["class"] < 18 and (n > 0 or out[0]["class"] in (15, 16))
        elif not pieces:
            assert [(r["class"], r.seq) for r in out] == [(18, text)]
        else:
            want = [(f"{i}_rescued_No{k}_strand_{'plus' if c == 19 else 'minus'}", c, text[s:e] if c == 19 else _turn(text[s:e]), s, len(text) - e) for k, (c, s, e) in enumerate(pieces, 1)]
            assert sorted((r.read_id, r["class"], r.seq, r.cut_start, r.cut_end) for r in out) == sorted(want)
    assert {18, 19, 20} <= kinds and {got[x][0]["class"] for x in ("none", "empty")} == {16}

    buckets = K.fan_out(classified).groupBy("bucket").count().collect()
    count = lambda *classes: sum(r["class"] in classes for rows in got.values() for r in rows)
    assert {r.bucket: r["count"] for r in buckets} == {k: v for k, v in {
        "full-length": count(0, 1, 2, 3), "non-full-length": count(*range(4, 13)), "discarded": count(13, 14, 15, 18), "failed-filter": count(16, 17), "rescued": count(19, 20),
        "full-length-plus-rescued": count(0, 1, 2, 3, 19, 20)}.items() if v}
    assert {r.bucket for r in K.fan_out(classified, merged_only=True).collect()} == {K.MERGED}
    summary = {r.type: (r.n, r.percent) for r in K.run_summary(classified).collect()}
    rescued = sum(rows[0]["class"] >= 19 for rows in got.values())
    assert summary["Total"] == (len(rows), 100.0) and summary["Chimeric"][0] == rescued + count(18) and summary["Chimeric reads rescued"][0] == rescued
    assert summary["Full-length+rescued"][0] == count(0, 1, 2, 3, 19, 20) and summary["Irrescuable"][0] == count(18)
    assert {r.type: r.n for r in K.run_summary(classified.limit(0)).collect()}["Total"] == 0
    stats = K.class_statistics(classified)
    merged = {r["class"]: (r.n, round(r.percent, 6)) for r in K.merge_statistics(stats.unionByName(stats)).collect()}
    assert merged == {r["class"]: (2 * r.n, round(r.percent, 6)) for r in stats.collect()}


def test_edited_primers_are_found(spark, tmp_path):
    """Reads with edits in their primers: the classes that full-length sense and antisense reads have, unless an edit goes too far."""
    from cellweave.plans import reads

    rng = random.Random(1)
    seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    rows = [(f"r{i}", seq(15), seq(15), seq(20), seq(20)) for i in range(60)]
    spark.createDataFrame(rows, "read_id string, putative_umi string, putative_umi_5p string, bc5n string, bc3n string").write.parquet(f"{tmp_path}/readids_umi_bc_clean.parquet")
    out = reads.classify_edited(spark, str(tmp_path)).collect()
    p = reads._LONG_PRIMERS
    limit = {x: K.threshold(e, len(x)) for x, e in ((p.tso, p.tso_edits), (p.rtp, p.rtp_edits))}
    assert len({r.read_id for r in out}) == 60 and sum(r["class"] in (0, 1, 2, 3, 7, 8) for r in out) > 50
    assert sum(r["class"] in (1, 3, 8) for r in out) > 5 and limit == {p.tso: 4, p.rtp: 6}


def test_tails():
    def plain(window):
        start = window.rfind("AAAA") if window else -1
        if start < 0:
            return None
        while start > 0 and (window[start - 1] == "A" or window.count("A", max(start - 10, 0), start) >= 7):
            start -= 1
        return len(window) - start if len(window) - start >= 8 else None

    rng = random.Random(2)
    windows = [None, "", "A", "A" * 100] + ["".join(rng.choice("AAAAAACG") for _ in range(rng.randint(0, 100))) for _ in range(1500)]
    windows += ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 30))) + "A" * rng.randint(0, 15) + "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 9))) for _ in range(1500)]
    got = tail_lengths(pd.Series(windows, dtype=object))
    assert [None if np.isnan(x) else int(x) for x in got] == [plain(w) for w in windows]
