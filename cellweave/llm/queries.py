"""The pN_ queries over the given tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.text import clean_key, is_missing
from cellweave.llm import canonical, encoding, frequent, leakage, linking, mixing, percentiles
from cellweave.session import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# 1. Frequent barcodes

_P1_FIELDS = {"putative_barcode": "correction_map_3p", "bc3n": "readids_umi_bc_clean"}


def _per_field(spark: SparkSession, sf_dir: str, result: Callable[[DataFrame], DataFrame]) -> DataFrame:
    parts = []
    for field, table in _P1_FIELDS.items():
        keys = _table(spark, sf_dir, table).select(clean_key(field).alias("item"))
        parts.append(result(keys).withColumn("field", F.lit(field)))
    return reduce(DataFrame.unionByName, parts)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_field(spark, sf_dir, lambda keys: frequent.heavy_items(keys, "item", 0.01)).select("field", "item")


def p1_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate counts of the most frequent barcodes of each field with the bound of their error."""
    return _per_field(spark, sf_dir, lambda keys: frequent.frequent_items(keys, "item")).select(
        "field", "item", "approx_count", "max_error", "n_rows"
    )


def p1_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The barcodes with at least 1% of the rows, and whether the summary has each within its bound.

    The summary depends on how the rows are parted, its guarantee doesn't.
    """

    def bounded(keys: DataFrame) -> DataFrame:
        summary = frequent.frequent_items(keys, "item")
        exact = keys.join(F.broadcast(summary), "item").groupBy("item", "approx_count", "max_error", "n_rows").agg(F.count("*").alias("n"))  # as many rows as counters
        within = F.col("n").between(F.col("approx_count"), F.col("approx_count") + F.col("max_error"))
        return exact.filter(F.col("n") / F.col("n_rows") >= 0.01).select("item", F.col("n").alias("n_rows"), within.alias("within"))

    return _per_field(spark, sf_dir, bounded).select("field", "item", "n_rows", "within")


# 2. Groups of barcodes


def _barcode_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between barcodes and from barcodes to cells; the first letter keeps cells behind all barcodes."""
    rows = (
        _table(spark, sf_dir, "read_assigned_cell")
        .select(clean_key("bc5n").alias("a"), clean_key("bc3n").alias("b"), clean_key("cell_id").alias("c"))
        .distinct()
    )
    a, b = (F.concat(F.lit("0"), F.col(x)) for x in "ab")
    cell = F.concat(F.lit("1"), F.col("c"))
    hub = F.coalesce(cell, a, b)
    ends = F.array(F.struct(hub.alias("u"), a.alias("v")), F.struct(hub.alias("u"), b.alias("v")))
    return rows.select(F.explode(ends).alias("_e")).select("_e.*").filter("u IS NOT NULL AND v IS NOT NULL")


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every barcode with the smallest barcode of its group."""
    groups = linking.link_groups(_barcode_links(spark, sf_dir), "u", "v")
    return groups.filter(F.col("node").startswith("0")).select(
        F.expr("substring(group_id, 2)").alias("group_barcode"), F.expr("substring(node, 2)").alias("barcode")
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_groups(spark, sf_dir).filter("group_barcode <> barcode")


# 4. Medians per sample and day

_P4_FIELDS = {"length": "read_length", "quality": "mean_quality"}


def _qc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value counts per field, sample and day, and merged over the days of each sample (scope)."""
    reads = _table(spark, sf_dir, "read_qc_reads").select("read_id", "sample_name", "ended_at", *_P4_FIELDS.values())
    # A second load has the same values; of numbers the largest is kept without sorting.
    once = reads.groupBy("read_id", "sample_name").agg(
        F.max(F.to_date("ended_at")).alias("day"), *(F.max(c).alias(c) for c in _P4_FIELDS.values())
    )
    fields = F.array(*(F.struct(F.lit(f).alias("field"), F.col(c).cast("double").alias("v")) for f, c in _P4_FIELDS.items()))
    values = once.select("sample_name", "day", F.explode(fields).alias("_f")).select(
        "sample_name", "day", F.col("_f.field").alias("field"), F.when(F.col("_f.v") >= 0, F.col("_f.v")).alias("v")
    )
    by_day = materialize(percentiles.value_counts(values, ["field", "sample_name", "day"], "v"), "day-counts").df
    all_days = percentiles.merge_counts(by_day, ["field", "sample_name"]).withColumns(
        {"scope": F.lit("all"), "day": F.lit(None).cast("date")}
    )
    return by_day.filter("day IS NOT NULL").withColumn("scope", F.lit("day")).unionByName(all_days)


def p4_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of read length and quality per sample and day, and per sample over all days (day NULL)."""
    found = percentiles.percentiles(_qc_counts(spark, sf_dir), ["field", "sample_name", "scope", "day"], [0.05, 0.25, 0.5, 0.75, 0.95])
    return found.select("field", "sample_name", "scope", "day", "prob", F.round("value", 6).alias("value"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = percentiles.percentiles(_qc_counts(spark, sf_dir), ["field", "sample_name", "scope", "day"], [0.5])
    stated = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}.median").alias("stated")) for f in _P4_FIELDS))
    summaries = _table(spark, sf_dir, "read_qc_summary").select(
        "summary_id", "sample_name", F.to_date("qc_day").alias("qc_day"), F.explode(stated).alias("_s")
    ).select("summary_id", "sample_name", "qc_day", "_s.*")
    true = medians.select(
        F.col("field").alias("_field"), F.col("sample_name").alias("_sample"), F.col("day").alias("_day"), F.col("value").alias("true")
    )
    same = (
        (F.col("field") == F.col("_field"))
        & F.col("sample_name").eqNullSafe(F.col("_sample"))
        & F.col("qc_day").eqNullSafe(F.col("_day"))
    )
    off = F.abs(F.col("stated") - F.col("true"))
    wrong = F.when(F.col("field") == "length", off > F.lit(0.1) * F.col("true")).otherwise(off > 1.0)
    return summaries.join(true, same).filter(wrong).select("summary_id", "field")


# 5. Barcodes and the reference list


def _asked_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id and value: reads with a barcode that isn't, as stored, an entry; each once."""
    entries = _table(spark, sf_dir, "whitelist_3p").select("barcode").filter("barcode IS NOT NULL").distinct()
    if entries.count() <= canonical.BROADCAST_ENTRIES:
        entries = F.broadcast(entries)
    stored = F.col("putative_barcode")
    value = F.upper(F.trim(F.substring_index(F.trim(stored), "-", 1)))
    reads = _table(spark, sf_dir, "correction_map_3p").filter(~is_missing(stored))
    return (
        reads.join(entries, stored == F.col("barcode"), "left_anti").select("read_id", value.alias("value")).distinct()
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _asked_reads(spark, sf_dir)
    nearest = canonical.nearest_entries(reads, "value", _table(spark, sf_dir, "whitelist_3p"), "barcode", k=2)
    only = nearest.filter("n_best = 1").select(F.col("value").alias("_value"), "entry")
    return reads.join(only, F.col("value") == F.col("_value"), "left").select(
        "read_id", F.coalesce("entry", F.lit("UNMATCHED")).alias("barcode")
    )


def p5_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that map to no entry or to several alike, with their reads."""
    reads = _asked_reads(spark, sf_dir)
    nearest = canonical.nearest_entries(reads, "value", _table(spark, sf_dir, "whitelist_3p"), "barcode", k=2)
    counted = reads.groupBy(F.col("value").alias("item")).agg(F.count("*").alias("n_reads"))
    return (
        counted.join(nearest, F.col("item") == F.col("value"), "left")
        .filter("n_best IS NULL OR n_best > 1")
        .select("item", "n_reads", F.coalesce("n_best", F.lit(0)).alias("n_nearest"), "distance")
    )


# 6. Test items in the corpus


def p6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the items they leak, with the length and place of the longest shared run."""
    return leakage.leaks(
        _table(spark, sf_dir, "documents"), "doc_id", "text", _table(spark, sf_dir, "eval_passages"), "item_no", "text"
    ).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_no"), "shared_words", "doc_word")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_leaks(spark, sf_dir).select("doc_id", "item_no")


# 7. Mixture of sources


def _by_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = mixing.mix_report(_by_words(spark, sf_dir), "doc_id", "source", _table(spark, sf_dir, "mix_targets"))
    return report.filter("falls_short").select("source")


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats and actual shares of the sources, with sizes in tokens."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = mixing.token_sizes(documents, "text").drop("text")
    return mixing.mix_report(sized, "doc_id", "source", _table(spark, sf_dir, "mix_targets"))


# 8. Wrongly decoded text


def p8_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected documents, the chains of wrong decodings and the restored text."""
    documents = _table(spark, sf_dir, "documents")
    model = encoding.train(documents, "text")
    return encoding.repair_encoding(documents, "doc_id", "text", model).withColumnRenamed("key", "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_repairs(spark, sf_dir).select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_frequent, p1_bounds, p2_found, p2_groups, p4_found, p4_percentiles, p5_found, p5_unmatched,
        p6_found, p6_leaks, p7_found, p7_report, p8_found, p8_repairs,
    )
}


def _clean(column: str) -> str:
    return (
        f"CASE WHEN upper(trim({column}, ' ')) NOT IN ('', 'NA', 'NAN', 'NONE') THEN upper(trim({column}, ' ')) END"
    )


_P1_SQL = " UNION ALL ".join(
    f"""SELECT '{field}' AS field, item FROM (
        SELECT {_clean(field)} AS item FROM {table}) WHERE item IS NOT NULL
        GROUP BY item HAVING count(*) >= 0.01 * (SELECT count({_clean(field)}) FROM {table})"""
    for field, table in _P1_FIELDS.items()
)

_P1_BOUNDS = " UNION ALL ".join(
    f"""SELECT '{field}' AS field, item, count(*) AS n_rows, true AS within FROM (
        SELECT {_clean(field)} AS item FROM {table}) WHERE item IS NOT NULL
        GROUP BY item HAVING count(*) >= 0.01 * (SELECT count({_clean(field)}) FROM {table})"""
    for field, table in _P1_FIELDS.items()
)

_P2_GROUPS = f"""
WITH RECURSIVE r AS (SELECT DISTINCT {_clean("bc5n")} AS a, {_clean("bc3n")} AS b, {_clean("cell_id")} AS c FROM read_assigned_cell),
n AS (SELECT DISTINCT c, x FROM (SELECT c, a AS x FROM r UNION ALL SELECT c, b FROM r) WHERE x IS NOT NULL),
hub AS (SELECT c, min(x) AS h FROM n WHERE c IS NOT NULL GROUP BY c),
e AS (SELECT a AS u, b AS v FROM r WHERE a IS NOT NULL AND b IS NOT NULL
      UNION SELECT hub.h, n.x FROM n JOIN hub ON n.c = hub.c),
l AS (SELECT u, v FROM e UNION SELECT v, u FROM e UNION SELECT x, x FROM n),
reach(node, root) AS (SELECT DISTINCT x, x FROM n UNION SELECT l.v, reach.root FROM reach JOIN l ON reach.node = l.u WHERE l.v > reach.root),
g AS (SELECT node AS barcode, min(root) AS group_barcode FROM reach GROUP BY node)
SELECT group_barcode, barcode FROM g"""

_P4_READS = """
WITH once AS (SELECT read_id, any_value(sample_name) AS sample_name, any_value(CAST(ended_at AS DATE)) AS day,
    any_value(read_length) AS read_length, any_value(mean_quality) AS mean_quality FROM read_qc_reads GROUP BY read_id),
v AS (SELECT 'length' AS field, sample_name, day, CAST(read_length AS DOUBLE) AS v FROM once WHERE read_length >= 0
    UNION ALL SELECT 'quality', sample_name, day, mean_quality FROM once WHERE mean_quality >= 0)"""

# All entries have 26 letters. Within 2 edits one of three parts of an entry stays, somewhere in the value.
_P5_SQL = """
WITH w AS (SELECT DISTINCT barcode FROM whitelist_3p),
r AS (SELECT DISTINCT read_id, upper(trim(split_part(trim(putative_barcode, ' '), '-', 1), ' ')) AS v FROM correction_map_3p
    WHERE upper(trim(putative_barcode, ' ')) NOT IN ('', 'NA', 'NAN', 'NONE') AND putative_barcode NOT IN (SELECT barcode FROM w)),
v AS (SELECT DISTINCT v FROM r),
q AS (SELECT barcode, unnest([substr(barcode, 1, 6), substr(barcode, 7, 13), substr(barcode, 20)]) AS s FROM w),
p AS (SELECT DISTINCT v, substr(v, i, n) AS s FROM (SELECT v, n, unnest(range(1, length(v) - n + 2)) AS i FROM v, (VALUES (6), (13), (7)) AS k(n))),
m AS (SELECT v, barcode, levenshtein(v, barcode) AS d FROM (SELECT DISTINCT v, barcode FROM p JOIN q USING (s)) WHERE abs(length(v) - length(barcode)) <= 2),
b AS (SELECT v, min(d) AS d FROM m WHERE d <= 2 GROUP BY v),
x AS (SELECT m.v, count(*) AS n_best, min(barcode) AS barcode, any_value(m.d) AS d FROM m JOIN b ON m.v = b.v AND m.d = b.d GROUP BY m.v)
"""

_P6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
i AS (SELECT item_no, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_passages),
dg AS (SELECT doc_id, array_to_string(w[s:s + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS s FROM d)),
ig AS (SELECT DISTINCT item_no, array_to_string(w[s:s + 11], ' ') AS g FROM (SELECT item_no, w, unnest(range(1, len(w) - 10)) AS s FROM i))
SELECT DISTINCT doc_id, item_no FROM dg JOIN ig USING (g)"""

# 12-grams that both hold, by the distance of their places: runs of them are runs of words, 11 longer.
_P6_LEAKS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
i AS (SELECT item_no, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_passages),
dg AS (SELECT doc_id, s, array_to_string(w[s:s + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS s FROM d)),
ig AS (SELECT item_no, s, array_to_string(w[s:s + 11], ' ') AS g FROM (SELECT item_no, w, unnest(range(1, len(w) - 10)) AS s FROM i)),
m AS (SELECT doc_id, item_no, dg.s AS s, dg.s - ig.s AS gap FROM dg JOIN ig USING (g)),
r AS (SELECT doc_id, item_no, gap, min(s) AS s, count(*) + 11 AS n FROM (SELECT *, s - row_number() OVER (PARTITION BY doc_id, item_no, gap ORDER BY s) AS run FROM m) GROUP BY doc_id, item_no, gap, run)
SELECT doc_id, item_no, CAST(n AS INTEGER) AS shared_words, CAST(s - 1 AS INTEGER) AS doc_word FROM r QUALIFY row_number() OVER (PARTITION BY doc_id, item_no ORDER BY n DESC, s) = 1"""

_P7_SQL = rf"""
WITH s AS (SELECT lower(trim(source, ' ')) AS source, len(list_filter(regexp_split_to_array(text, '{mixing.WHITE}'), lambda x: x <> '')) AS size FROM documents),
t AS (SELECT lower(trim(source, ' ')) AS source, target_share, max_repeats FROM mix_targets),
a AS (SELECT source, sum(size) AS size FROM s GROUP BY source)
SELECT t.source FROM t LEFT JOIN a ON t.source = a.source
WHERE coalesce(a.size, 0) * t.max_repeats < t.target_share * (SELECT sum(size) FROM s)"""

ORACLES: dict[str, str] = {
    "p1_found": _P1_SQL,
    "p2_groups": _P2_GROUPS,
    "p2_found": _P2_GROUPS + " WHERE group_barcode <> barcode",
    "p4_percentiles": _P4_READS
    + """, q AS (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS prob),
    s AS (SELECT field, sample_name, 'day' AS scope, day, v FROM v WHERE day IS NOT NULL UNION ALL SELECT field, sample_name, 'all', NULL, v FROM v)
    SELECT field, sample_name, scope, day, CAST(prob AS DOUBLE) AS prob,
        round(CASE prob WHEN 0.05 THEN quantile_cont(v, 0.05) WHEN 0.25 THEN quantile_cont(v, 0.25) WHEN 0.5 THEN quantile_cont(v, 0.5)
            WHEN 0.75 THEN quantile_cont(v, 0.75) ELSE quantile_cont(v, 0.95) END, 6) AS value
    FROM s, q GROUP BY field, sample_name, scope, day, prob""",
    "p4_found": _P4_READS
    + """, m AS (SELECT field, sample_name, day, median(v) AS true FROM v GROUP BY field, sample_name, day
        UNION ALL SELECT field, sample_name, NULL, median(v) FROM v GROUP BY field, sample_name),
    s AS (SELECT summary_id, sample_name, CAST(qc_day AS DATE) AS qc_day, 'length' AS field, length.median AS stated FROM read_qc_summary
        UNION ALL SELECT summary_id, sample_name, CAST(qc_day AS DATE), 'quality', quality.median FROM read_qc_summary)
    SELECT s.summary_id, s.field FROM s JOIN m ON s.field = m.field AND s.sample_name = m.sample_name AND s.qc_day IS NOT DISTINCT FROM m.day
    WHERE abs(s.stated - m.true) > CASE s.field WHEN 'length' THEN 0.1 * m.true ELSE 1.0 END""",
    "p5_found": _P5_SQL + "SELECT read_id, CASE WHEN n_best = 1 THEN barcode ELSE 'UNMATCHED' END AS barcode FROM r LEFT JOIN x ON r.v = x.v",
    "p5_unmatched": _P5_SQL + """SELECT r.v AS item, count(*) AS n_reads, coalesce(any_value(n_best), 0) AS n_nearest, any_value(d) AS distance FROM r LEFT JOIN x ON r.v = x.v
        WHERE n_best IS NULL OR n_best > 1 GROUP BY r.v""",
    "p1_bounds": _P1_BOUNDS,
    "p6_leaks": _P6_LEAKS,
    "p6_found": _P6_SQL,
    "p7_found": _P7_SQL,
}
