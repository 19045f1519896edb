"""Mix sources to target shares by weighted fair queueing.

Each source is put in a shuffled order, and a document's virtual finish time is the size of the source
up to and with it divided by the source's target share. The documents of all sources in the order of
their finish times keep to the shares at every point; the order is cut off at the total budget. Small
sources are repeated, whole pass after whole pass, up to their cap; when one has nothing left, the
others take its room in proportion to their shares.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.prefix import running_sum
from cellweave.session import materialize

#: Folder of the public vocabulary files; a parameter of `token_sizes`.
TOKENIZERS = "/opt/tokenizers"


def word_count(text: Column) -> Column:
    """Words between white space; 0 for an empty or NULL text."""
    return F.coalesce(F.size(F.filter(F.split(text, WHITE), lambda w: w != "")), F.lit(0)).cast("long")


def token_sizes(df: DataFrame, text: str, folder: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """`df` with `size` LONG: tokens of the text under a byte-level vocabulary file; 0 for NULL and empty texts."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(f"{folder}/{vocabulary}", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        coder = tiktoken.Encoding("byte_bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            yield pd.Series([len(coder.encode_ordinary(t)) if t else 0 for t in batch], dtype="int64")

    return df.withColumn("size", F.pandas_udf(run, "long")(F.col(text)))


# Fixed value: the pattern that splits text before byte pairs are merged.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Fixed value: white space, that beyond ASCII included.
WHITE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def source_key(col: Column) -> Column:
    """Source names as they are compared: trimmed and in lower case; NULL where missing."""
    name = F.lower(F.trim(col))
    return F.when((name != "") & ~name.isin("na", "nan", "none"), name)


def _wanted(targets: DataFrame) -> DataFrame:
    """One row per named source: rows of one name add up their shares, and its largest cap holds."""
    named = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats")
    return named.filter("source IS NOT NULL").groupBy("source").agg(
        F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")
    )


def _budget(sized: DataFrame) -> DataFrame:
    return sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("_budget"))


def fair_queue(sized: DataFrame, key: str, source: str, targets: DataFrame, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The shuffled documents of the target sources with `_upto`, the size of the source up to and with each; and the sources.

    The second table has one row per source: source, target_share, max_repeats, _all (the size of a pass), _longest (its
    largest document) and _last (the size at the end of the last permitted pass). Rows without a source, of a
    source without a target, positive share or permitted pass, and of size 0 aren't in the queue.
    """
    wanted = _wanted(targets).filter("target_share > 0 AND max_repeats > 0")
    rows = (
        sized.select(source_key(F.col(source)).alias("source"), F.col(key).alias("key"), "size")
        .filter("size > 0")
        .join(F.broadcast(wanted), "source")  # one row for each target source
        .withColumn("_mixed", F.xxhash64(F.lit(seed), F.col("key"), F.col("size")))
    )
    queued, _ = running_sum(rows, ["source"], ["_mixed", "key", "size"], {"_upto": "size"}, name="queue")
    ends = queued.groupBy("source", "target_share", "max_repeats").agg(F.max("_upto").alias("_all"), F.max("size").alias("_longest"))
    return queued, ends.withColumn("_last", (F.col("max_repeats") - 1) * F.col("_all") + F.col("_all"))


def _cut_off(ends: DataFrame, limit: DataFrame) -> DataFrame:
    """One row, _level: a virtual finish time beyond which no document can be within the budget.

    Up to a time t a source has given min(share * t, all its passes), less one document at most. The level is where these
    sum up to the budget and one document of each source: sources with nothing left by then count whole.
    """
    run_out = Window.orderBy("_ends", "source")  # one row for each target source
    before, after = run_out.rowsBetween(Window.unboundedPreceding, -1), run_out.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = ends.crossJoin(F.broadcast(limit)).withColumn("_ends", F.col("_last") / F.col("target_share")).select(
        "_ends",
        F.coalesce(F.sum("_last").over(before), F.lit(0)).alias("_gone"),
        F.sum("target_share").over(after).alias("_weights"),
        (F.col("_budget") + F.sum("_longest").over(whole)).alias("_need"),
    )
    level = (F.col("_need") - F.col("_gone")) / F.col("_weights")
    # The first source that would run out beyond its level; where none does, all passes are needed.
    first = F.min(F.when(level <= F.col("_ends"), F.struct("_ends", level.alias("_level"))))["_level"]
    return steps.agg((F.coalesce(first, F.max("_ends"), F.lit(0.0)) * (1 + 1e-9)).alias("_level"))


def _order(queued: DataFrame, ends: DataFrame, limit: DataFrame) -> DataFrame:
    room = ends.select("source", "_all").crossJoin(F.broadcast(_cut_off(ends, limit)))  # one row for each target source
    begun = F.least(F.col("max_repeats") - 1, F.floor(F.col("_level") * F.col("target_share") / F.col("_all")).cast("int"))
    passes = (
        queued.join(F.broadcast(room), "source")
        .select("*", F.explode(F.sequence(F.lit(0), begun)).alias("pass_no"))
        .withColumn("finish", (F.col("pass_no") * F.col("_all") + F.col("_upto")) / F.col("target_share"))
        .filter("finish <= _level")
        .select("source", "key", "pass_no", "size", "finish")
    )
    ordered, _ = running_sum(passes, [], ["finish", "source", "key", "pass_no"], {"upto": "size"}, name="mixture")
    return ordered.crossJoin(F.broadcast(limit)).filter("upto <= _budget").drop("_budget")  # one row


def mix_order(sized: DataFrame, key: str, source: str, targets: DataFrame, seed: int = 7, budget: int | None = None) -> DataFrame:
    """source, key, pass_no, size, finish, upto: the documents of the mixture in their order.

    `key` tells rows apart (rows that agree in it and in size are interchangeable). `finish` is the
    virtual finish time and `upto` the size of the mixture up to and with the row; rows stand while
    `upto` is within the budget (by default the size of all rows). Rows without a source, of a
    source without a target or a positive share, and of size 0 aren't mixed. An empty table gives
    an empty mixture. Passes and documents that the budget can't reach aren't sorted.
    """
    queued, ends = fair_queue(sized, key, source, targets, seed)
    limit = _budget(sized) if budget is None else sized.sparkSession.range(1).select(F.lit(budget).cast("long").alias("_budget"))
    return _order(queued, ends, limit)


def mix_report(sized: DataFrame, key: str, source: str, targets: DataFrame, seed: int = 7) -> DataFrame:
    """One row per target source: share wanted and reached, size, passes used and whether it falls short.

    The budget is the size of all rows, those without a source included. A source falls short if the virtual finish
    time of its last permitted pass, read off the queue, lies before the budget, at which time its share is due. Both are
    compared times the share, which is exact at the limit. A source that isn't in the queue ends at 0.
    """
    sized = materialize(sized.select(key, source, "size"), "sizes").df  # sizes are worked out once
    queued, ends = fair_queue(sized, key, source, targets, seed)
    ends = materialize(ends, "sources").df
    limit = _budget(sized)
    mixed = _order(queued, ends, limit).groupBy("source").agg(
        F.sum("size").alias("_mixed"), F.count("*").alias("_rows"), (F.max("pass_no") + 1).alias("_passes")
    )
    total = mixed.agg(F.sum("_mixed").alias("_total"))
    due = F.col("target_share") * F.col("_budget")
    return (
        _wanted(targets)
        .join(F.broadcast(ends.select("source", "_all", "_last")), "source", "left")  # one row for each target source
        .join(mixed, "source", "left")
        .crossJoin(F.broadcast(total))  # one row
        .crossJoin(F.broadcast(limit))  # one row
        .select(
            "source",
            "target_share",
            F.coalesce(F.col("_mixed") / F.col("_total"), F.lit(0.0)).alias("actual_share"),
            F.coalesce("_all", F.lit(0)).alias("available"),
            F.coalesce("_mixed", F.lit(0)).alias("mixed"),
            F.coalesce("_rows", F.lit(0)).alias("mixed_docs"),
            F.coalesce("_passes", F.lit(0)).alias("passes"),
            "max_repeats",
            (F.coalesce("_last", F.lit(0)) < due).alias("falls_short"),
        )
    )
