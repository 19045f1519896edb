"""Tables and SQL pieces that several query modules use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_clean(column: str) -> str:
    """SQL of `clean_key`."""
    return f"CASE WHEN upper(trim({column}, ' ')) NOT IN ('', 'NA', 'NAN', 'NONE') THEN upper(trim({column}, ' ')) END"


#: SQL of the molecule rows, as the table m.
SQL_MOLECULES = f"""m AS (SELECT * FROM (SELECT trim(read_id, ' ') AS read_id, {sql_clean('gene')} AS gene, {sql_clean('barcode')} AS barcode,
    {sql_clean('umi')} AS umi FROM cell_umi_gene) WHERE gene IS NOT NULL AND barcode IS NOT NULL AND umi IS NOT NULL),
k AS (SELECT *, NOT regexp_matches(gene, '[A-Za-z0-9]+_[0-9]+_[0-9]+') AS known FROM m)"""
