"""Running sums over a global order without gathering a group or the table in one task.

The rows are range-sorted by group and order. While a range is written, each of its groups gets its running
sum within the range. Only the first group of a range can have begun before it, so what is to be added
is one number for each range: the total of that group in the ranges before, taken from the last rows of the
ranges. There is one exchange of the rows, and the rest is a table of two rows for each range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.session import Stage, materialize


def run_starts(batch: pa.Table, group: Sequence[str]) -> np.ndarray:
    """Whether a row differs from the one before it in a group column; NULL equals NULL and NaN equals NaN."""
    new = np.zeros(batch.num_rows, bool)
    for column in group:
        codes = batch[column].combine_chunks().dictionary_encode().indices
        at = codes.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= at[1:] != at[:-1]
    return new


def _sums_within(group: list[str], values: dict[str, str], fields: list[str]):
    """Adds to the sorted rows of a task their part, running sums, whether they are of its first group, and its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before: pa.Table | None = None  # the last row seen
        held: tuple[pa.Table, np.ndarray] | None = None  # the last batch, whose last row may end the range
        carried = dict.fromkeys(values, 0)
        leading, first = True, True

        def out(table: pa.Table, edge: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield from table.append_column("_edge", pa.array(edge, pa.int8())).select(fields).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            new = run_starts(rows if before is None else pa.concat_tables([before, rows]), group)[0 if before is None else 1 :]
            before = rows.slice(rows.num_rows - 1)
            breaks = np.flatnonzero(new)
            made = rows
            for name, column in values.items():
                x = rows[column].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
                x = x.astype(np.int64 if x.dtype.kind in "iu" else np.float64)
                total = np.cumsum(x)
                # What the running total was before each group of the batch; the first may go on from the batch before.
                base = np.concatenate([[-carried[name]], (total - x)[breaks]])
                summed = total - base[np.cumsum(new)]
                carried[name] = summed[-1]
                made = made.append_column(f"_w_{name}", pa.array(summed))
            lead = np.zeros(len(new), bool)
            if leading:
                lead[: breaks[0] if len(breaks) else len(new)] = True
                leading = not len(breaks)
            made = made.append_column("_lead", pa.array(lead)).append_column("_part", pa.array(np.full(len(new), part, np.int32)))
            if held:
                yield from out(*held)
            edge = np.zeros(len(new), np.int8)
            edge[0] += first
            first = False
            held = (made, edge)
        if held:
            held[1][-1] += 2
            yield from out(*held)

    return run


def running_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    partitions: int | None = None,
    name: str = "prefix",
) -> tuple[DataFrame, Stage]:
    """Add, for each `values` item output -> input column, the running sum of the input column.

    The sum goes over the rows of the same `group` up to and including the row in `order`. `order`
    must tell the rows of a group apart, so that the sums don't depend on ties. Sums are LONG for whole numbers and
    DOUBLE for others. NULLs in a summed column count as 0; NULLs in `group` form a group; an empty table gives an
    empty one. The sorted rows are written once to the shared folder, because the numbers of the ranges must not change
    between the two uses of them; the second result is that written table.
    """
    group, keys = list(group), [*group, *order]
    kinds = {c: df.schema[c].dataType for c in values.values()}
    whole = {c: isinstance(k, T.IntegralType) for c, k in kinds.items()}
    inputs = {out: f"_i_{out}" for out in values}
    typed = df.select("*", *(F.col(c).cast("long" if whole[c] else "double").alias(inputs[out]) for out, c in values.items()))
    ranged = typed.repartitionByRange(partitions, *keys) if partitions else typed.repartitionByRange(*keys)
    fields = T.StructType(
        [
            *df.schema.fields,
            *(T.StructField(f"_w_{out}", T.LongType() if whole[c] else T.DoubleType()) for out, c in values.items()),
            T.StructField("_lead", T.BooleanType()),
            T.StructField("_part", T.IntegerType()),
            T.StructField("_edge", T.ByteType()),
        ]
    )
    stage = materialize(ranged.sortWithinPartitions(*keys).mapInArrow(_sums_within(group, inputs, fields.names), fields), name)

    # At most two rows for each range: its first and its last.
    edges = stage.df.filter("_edge > 0")
    struct = F.struct(*(F.col(g) for g in group)) if group else F.lit(0)
    first = F.col("_edge").isin(1, 3)
    sums = [F.sum(f"_w_{out}") for out in values]
    along = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    tails = edges.filter("_edge >= 2").select(
        F.col("_part").alias("_tpart"), struct.alias("_tail"), *(s.over(along).alias(f"_c_{out}") for out, s in zip(values, sums))
    )
    heads = edges.filter(first).select("_part", struct.alias("_head"))
    by_part = Window.orderBy("_part")
    goes_on = F.lag("_tail").over(by_part).eqNullSafe(F.col("_head")) & F.lag(F.lit(1)).over(by_part).isNotNull()
    offsets = heads.join(tails, F.col("_part") == F.col("_tpart")).select(
        F.col("_part").alias("_opart"), *(F.when(goes_on, F.lag(f"_c_{out}").over(by_part)).otherwise(0).alias(f"_o_{out}") for out in values)
    )
    joined = stage.df.join(F.broadcast(offsets), F.col("_part") == F.col("_opart"))  # one row for each range
    return (
        joined.select(
            *(F.col(c) for c in df.columns),
            *((F.col(f"_w_{out}") + F.when(F.col("_lead"), F.col(f"_o_{out}")).otherwise(0)).alias(out) for out in values),
        ),
        stage,
    )
