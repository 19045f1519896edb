"""Most frequent values of a column by Misra-Gries summaries.

Every partition keeps at most `counters` counters. When a block of rows brings more distinct values
than that, the next-largest counter is subtracted from all and those that reach nothing go. Two
summaries merge by adding counters and subtracting in the same way. A value that holds more than
1 / (counters + 1) of the rows is in the final summary for certain; its counter is at most
`max_error` below the true count and never above it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import materialize

#: Rows and bytes of a block that is counted at once.
_BLOCK, _BLOCK_BYTES = 200_000, 64 << 20
#: Summaries that one task merges.
FAN = 64
_SUMMARY = "part int, item string, n long, error long, total long"


def _shrink(items: pa.Array, n: np.ndarray, counters: int) -> tuple[pa.Array, np.ndarray, int]:
    """Subtract the next-largest counter, so that at most `counters` stay; also what was subtracted."""
    if len(n) <= counters:
        return items, n, 0
    cut = int(np.partition(n, len(n) - counters - 1)[len(n) - counters - 1])
    keep = n > cut
    return items.filter(pa.array(keep)), n[keep] - cut, cut


def _add(table: pa.Table, counters: int) -> tuple[pa.Array, np.ndarray, int]:
    summed = table.group_by("item").aggregate([("n", "sum")])
    return _shrink(summed["item"].combine_chunks(), summed["n_sum"].to_numpy().astype(np.int64), counters)


def _summary(part: int, items: pa.Array, n: np.ndarray, error: int, total: int) -> pa.Table:
    """One row per counter and one without an item that carries the error and the rows seen."""
    size = len(n)
    return pa.table(
        {
            "part": pa.array([part] * (size + 1), pa.int32()),
            "item": pa.concat_arrays([items.cast(pa.string()), pa.nulls(1, pa.string())]),
            "n": pa.array([*n.tolist(), 0], pa.int64()),
            "error": pa.array([0] * size + [error], pa.int64()),
            "total": pa.array([0] * size + [total], pa.int64()),
        }
    )


def _summarize(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, n = pa.array([], pa.string()), np.zeros(0, np.int64)
        error = total = held = size = 0
        blocks: list[pa.Array] = []

        def fold() -> None:
            nonlocal items, n, error, blocks, held, size
            counts = pc.value_counts(pa.chunked_array(blocks, pa.string()))
            table = pa.table(
                {
                    "item": pa.chunked_array([items, counts.field("values").cast(pa.string())]),
                    "n": pa.chunked_array([pa.array(n, pa.int64()), counts.field("counts")]),
                }
            )
            items, n, cut = _add(table, counters)
            error, blocks, held, size = error + cut, [], 0, 0

        for batch in batches:
            column = batch.column(0).cast(pa.string())
            blocks.append(column)
            held += len(column)
            size += column.nbytes
            total += len(column)
            if held >= _BLOCK or size >= _BLOCK_BYTES:
                fold()
        if held:
            fold()
        if total:
            yield from _summary(TaskContext.get().partitionId(), items, n, error, total).to_batches()

    return run


def _merge(counters: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        kept = rows[rows["item"].notna()]
        table = pa.table({"item": pa.array(kept["item"], pa.string()), "n": pa.array(kept["n"], pa.int64())})
        items, n, cut = _add(table, counters)
        part, error, total = int(rows["_to"].iloc[0]), int(rows["error"].sum()) + cut, int(rows["total"].sum())
        return _summary(part, items, n, error, total).to_pandas()

    return run


def frequent_items(df: DataFrame, column: str, counters: int = 1000) -> DataFrame:
    """The Misra-Gries summary of a STRING column: item, approx_count, max_error, n_rows (all LONG but item).

    NULL items are not counted; put other missing values to NULL before. `n_rows` is the number of
    rows counted. Every item with more than n_rows / (counters + 1) rows is there, and
    approx_count <= true count <= approx_count + max_error. An empty table, or one with NULLs
    alone, gives no row. Values of any length are kept whole.
    """
    values = df.select(F.col(column).cast("string").alias("item")).filter("item IS NOT NULL")
    summaries = materialize(values.mapInArrow(_summarize(counters), _SUMMARY), "summaries").df
    parts = (summaries.agg(F.max("part")).first()[0] or 0) + 1
    while True:  # a tree whose depth follows the number of partitions
        parts = -(-parts // FAN)
        merged = summaries.withColumn("_to", F.floor(F.col("part") / FAN).cast("int"))
        summaries = merged.groupBy("_to").applyInPandas(_merge(counters), _SUMMARY)
        if parts == 1:
            break
    size = F.max(F.struct("total", "error")).over(_all_rows())
    return summaries.withColumn("_size", size).filter("item IS NOT NULL").select(
        "item",
        F.col("n").alias("approx_count"),
        F.col("_size.error").alias("max_error"),
        F.col("_size.total").alias("n_rows"),
    )


def _all_rows():
    from pyspark.sql import Window

    return Window.partitionBy("part")  # one summary is left: at most counters + 1 rows


def heavy_items(df: DataFrame, column: str, min_share: float, counters: int = 1000) -> DataFrame:
    """The items that hold at least `min_share` of the non-NULL rows, with exact counts.

    Columns: item, approx_count, max_error, n_items, n_rows. The summary gives the candidates, all of which
    are counted again exactly (at most `counters` of them, so that they are broadcast). `counters`
    must exceed 1 / min_share, otherwise an item could be missed.
    """
    if (counters + 1) * min_share <= 1:
        raise ValueError("counters must exceed 1 / min_share")
    summary = frequent_items(df, column, counters).filter(
        (F.col("approx_count") + F.col("max_error")) / F.col("n_rows") >= min_share
    )
    exact = (
        df.select(F.col(column).cast("string").alias("item"))
        .join(F.broadcast(summary), "item")
        .groupBy("item", "approx_count", "max_error", "n_rows")
        .agg(F.count("*").alias("n_items"))
    )
    return exact.filter(F.col("n_items") / F.col("n_rows") >= min_share).select(
        "item", "approx_count", "max_error", "n_items", "n_rows"
    )
