from pyspark.sql import functions as F

from cellweave.functions import seq as S
from cellweave.functions.text import clean_key


def _one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return row.select(column.alias("x")).first().x


def test_clean_key(spark):
    rows = [(" na ",), ("NaN",), ("none",), ("",), ("  ",), (None,), (" acGt ",), ("NAN1",)]
    out = [r.x for r in spark.createDataFrame(rows, "v string").select(clean_key("v").alias("x")).collect()]
    assert out == [None] * 6 + ["ACGT", "NAN1"]


def test_py_slice_agrees_with_python(spark):
    text = "ACGTACG"
    cases = [(a, b) for a in range(-9, 10) for b in range(-9, 10)]
    df = spark.createDataFrame([(text, a, b) for a, b in cases], "s string, a int, b int")
    out = df.select("a", "b", S.py_slice(F.col("s"), F.col("a"), F.col("b")).alias("x")).collect()
    assert all(r.x == text[r.a : r.b] for r in out)


def test_find(spark):
    df = spark.createDataFrame([("xxABxABx",), ("none",), ("",)], "s string")
    out = df.select(S.find(F.col("s"), "AB").alias("f"), S.rfind_from_end(F.col("s"), "AB").alias("r")).collect()
    assert [(r.f, r.r) for r in out] == [(2, -3), (-1, -1), (-1, -1)]


def test_revcomp(spark):
    df = spark.createDataFrame([(" acgtN-R",)], "s string")
    row = df.select(S.revcomp(F.lit("AcGtN")).alias("a"), S.revcomp_upper(F.col("s")).alias("b")).first()
    assert (row.a, row.b) == ("NaCgT", "NNNACGT")


def _tail(s):
    """Plain reading of the tail rule."""
    s = s.upper()
    anchor = s.rfind("AAAA")
    if anchor < 0:
        return None
    start, i = anchor, anchor - 1
    while i >= 0 and (s[i] == "A" or s[max(i - 9, 0) : i + 1].count("A") >= 7):
        start, i = i, i - 1
    return start - len(s) if len(s) - start >= 8 else None


def test_poly_a_start(spark):
    import random

    rng = random.Random(5)
    seqs = ["".join(rng.choice("AAAACG") for _ in range(rng.randint(0, 140))) for _ in range(120)] + ["A" * 20, "AAAA", "", "CAAAAAAAA"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, s string")
    window = df.select("i", F.upper(S.py_slice(F.concat("s", F.lit("GG")), -102, -2)).alias("w"))
    out = {r.i: r.x for r in window.select("i", S.poly_a_start(F.col("w"), F.lit(-2)).alias("x")).collect()}
    for i, s in enumerate(seqs):
        want = _tail(s[-100:])
        assert out[i] == (None if want is None else want - 2), s


def test_quality(spark):
    row = spark.range(1).select(
        S.min_quality(F.lit("I5!")).alias("m"), S.min_quality(F.lit("")).alias("none"),
        S.mean_quality(F.array(*[F.lit(20)] * 5)).alias("q"),
        S.passes_gate(F.array(*[F.lit(20)] * 5), 6, 7.0).alias("short"), S.passes_gate(F.array(*[F.lit(3)] * 6), 6, 7.0).alias("poor"),
    ).first()
    assert (row.m, row.none, row.short, row.poor) == (0, None, 16, 17) and abs(row.q - 20) < 1e-5
