"""Profiles of the keys of the molecule table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.selection import heavy_keys, key_profile

_FIELDS = ("barcode", "gene")


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_profile(spark.read.parquet(f"{sf_dir}/cell_umi_gene.parquet"), _FIELDS, "umi")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_keys(_profile(spark, sf_dir), 0.01).select("field", "item")


def p3_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct umi, share of rows and quantiles of the rows per umi, for each barcode and gene."""
    return _profile(spark, sf_dir).withColumn("share", F.round("share", 9)).withColumnsRenamed({"n_units": "n_umi"})


QUERIES = {f.__name__: f for f in (p3_found, p3_profile)}


def _clean(column: str) -> str:
    return f"CASE WHEN upper(trim({column}, ' ')) NOT IN ('', 'NA', 'NAN', 'NONE') THEN upper(trim({column}, ' ')) END"


_ROWS = "WITH r AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS field, {_clean(f)} AS item, {_clean('umi')} AS umi FROM cell_umi_gene" for f in _FIELDS
) + "), k AS (SELECT * FROM r WHERE item IS NOT NULL)"

ORACLES = {
    "p3_found": _ROWS
    + """ SELECT field, item FROM k GROUP BY field, item
    HAVING count(*) >= 0.01 * (SELECT count(*) FROM k AS a WHERE a.field = k.field)""",
    "p3_profile": _ROWS
    + """, n AS (SELECT field, count(*) AS total FROM k GROUP BY field),
    s AS (SELECT field, item, umi, count(*) AS c FROM k WHERE umi IS NOT NULL GROUP BY ALL),
    q AS (SELECT field, item, count(*) AS u, quantile_disc(c, 0.5) AS a, quantile_disc(c, 0.9) AS b FROM s GROUP BY field, item),
    p AS (SELECT field, item, count(*) AS n_rows FROM k GROUP BY field, item)
    SELECT p.field, p.item, p.n_rows, coalesce(q.u, 0) AS n_umi, round(p.n_rows / n.total, 9) AS share,
        CAST(q.a AS DOUBLE) AS units_p50, CAST(q.b AS DOUBLE) AS units_p90
    FROM p JOIN n ON p.field = n.field LEFT JOIN q ON p.field = q.field AND p.item = q.item""",
}
