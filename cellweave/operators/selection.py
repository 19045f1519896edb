"""Per-key results where a few keys hold most of the rows.

Counts are combined before they move, so a hot key sends one row per task. Quantiles come from
distributed exact selection: every key starts with the range of its values, counts them in bins of
that range, keeps the bin that holds the wanted rank and splits it again, until the bin holds one
value. Only bin counts travel; the values of a key are never brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.text import clean_key
from cellweave.session import materialize

#: A key with at least one in so many rows counts as hot. There can't be more hot keys than this,
#: which bounds the broadcast of their state.
HOT_KEYS = 10_000


def _magnitude(v: Column) -> Column:
    """Grows with the value and evenly with its binary exponent."""
    return F.signum(v) * F.coalesce(F.log2(F.abs(v)) + 1100, F.lit(0.0))


def _split_bins(rows: DataFrame, bins: int) -> DataFrame:
    """Bins of equal width, or of equal ratio where the ends differ in sign or more than fourfold.

    The ends fall into different bins, so that every round narrows the range: at most a few rounds until
    the values agree in their exponent, and then log2(bins) bits a round.
    """
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    wide = (lo <= 0) & (hi >= 0) | (F.abs(hi) > 4 * F.abs(lo)) | (F.abs(lo) > 4 * F.abs(hi))
    at, a, e = (F.when(wide, _magnitude(x)).otherwise(x) for x in (v, lo, hi))
    place = F.least(F.floor(F.try_divide(at - a, (e - a) / bins)), F.lit(bins - 1))
    return rows.withColumn(
        "_bin", F.when(v <= lo, 0).when(v >= hi, bins - 1).when(e > a, F.greatest(place, F.lit(0))).otherwise(bins - 1)
    )


def _in_ranges(values: DataFrame, ranges: DataFrame, g: list[str]) -> DataFrame:
    """The values inside a live range of their group, with its ends. The ranges of a group don't overlap.

    Hot and cold groups stand in folders of their own, so that each value is read once; the ranges of
    hot groups are broadcast, and their values stay where they are.
    """
    found = None
    for hot in (True, False):
        part = ranges.filter(F.col("_hot") == hot).select(*(F.col(c).alias(f"{c}r") for c in g), "_lo", "_hi")
        rows = values.filter(F.col("_hot") == hot).select(*g, "_v", "_n", "_hot")
        on = [F.col(c).eqNullSafe(F.col(f"{c}r")) for c in g] + [F.col("_v").between(F.col("_lo"), F.col("_hi"))]
        met = rows.join(F.broadcast(part) if hot else part, on).drop(*(f"{c}r" for c in g))
        found = met if found is None else found.unionByName(met)
    return found


def select_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probs: Sequence[float],
    weight: str | None = None,
    bins: int = 1024,
    interpolate: bool = False,
) -> DataFrame:
    """Exact quantiles per group: columns of `group`, `prob`, `value` (DOUBLE), `n` (LONG) and `total` (DOUBLE).

    The quantile is the smallest value whose cumulative weight reaches `ceil(prob * n)` (at
    least 1), i.e. QUANTILE_DISC; with `interpolate` it lies on the line between the values of the two ranks around
    `1 + prob * (n - 1)`, i.e. QUANTILE_CONT. `n` is the weight and `total` the weighted sum of the
    values of the group. Values that are NULL, NaN or infinite and rows whose weight is NULL or not positive are left
    out; a group without any other row doesn't appear. NULL is a group of its own. Ties and repeated rows count as
    often as they occur. An empty table gives an empty result. Group columns may not be called `prob`, `value`, `n` or `total`.
    """
    g = [f"_g{i}" for i in range(len(group))]
    v = F.col(value).cast("double")
    base = df.select(
        *(F.col(c).alias(a) for c, a in zip(group, g)),
        v.alias("_v"),
        (F.col(weight).cast("long") if weight else F.lit(1).cast("long")).alias("_n"),
    ).filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") != float("inf")) & (F.col("_n") > 0))
    sums = base.groupBy(*g).agg(
        F.sum("_n").alias("_all"),
        F.sum(F.col("_n") * F.col("_v")).alias("_sum"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
        F.count("*").alias("_rows"),
    )
    counted = materialize(sums, "groups")
    n_rows = counted.df.agg(F.sum("_rows")).first()[0] or 0
    groups = counted.df.withColumn("_hot", F.col("_rows") * HOT_KEYS >= F.lit(n_rows))
    hot = groups.filter("_hot").select(*(F.col(c).alias(f"{c}r") for c in g), F.lit(True).alias("_is"))
    marked = base.join(F.broadcast(hot), [F.col(c).eqNullSafe(F.col(f"{c}r")) for c in g] or F.lit(True), "left")
    values = materialize(marked.select(*g, "_v", "_n", F.coalesce("_is", F.lit(False)).alias("_hot")), "values", by="_hot")

    at = F.col("_prob") * (F.col("_all") - 1)
    sides = [F.floor(at) + 1, F.ceil(at) + 1] if interpolate else [F.greatest(F.ceil(F.col("_prob") * F.col("_all")), F.lit(1))]
    wanted = groups.select("*", F.explode(F.array(*(F.lit(float(p)) for p in probs))).alias("_prob")).select(
        *g, "_hot", "_lo", "_hi", "_prob", F.explode(F.array(*sides)).alias("_want")
    ).distinct()
    stage = materialize(wanted.withColumn("_rank", F.col("_want")), "ranks")
    done: list[DataFrame] = []
    first = True
    while True:
        done.append(stage.df.filter("_lo = _hi"))
        active = stage.df.filter("_lo < _hi")
        if active.isEmpty():
            break
        inside = _in_ranges(values.df, active.select(*g, "_hot", "_lo", "_hi").distinct(), g)
        if not first:
            # The first ranges hold all values; from then on only what lies in a live range is read again.
            smaller = materialize(inside, "values", by="_hot")
            values.drop()
            values, inside = smaller, smaller.df
        first = False
        hist = _split_bins(inside, bins).groupBy(*g, "_lo", "_bin").agg(
            F.sum("_n").alias("_c"), F.min("_v").alias("_to_lo"), F.max("_v").alias("_to_hi")
        )
        upto = Window.partitionBy(*g, "_lo").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
        cumulated = hist.withColumn("_cum", F.sum("_c").over(upto)).select(
            *(F.col(c).alias(f"{c}r") for c in g), F.col("_lo").alias("_of"), "_c", "_cum", "_to_lo", "_to_hi"
        )
        on = [F.col(c).eqNullSafe(F.col(f"{c}r")) for c in g]
        picked = active.join(cumulated, [*on, F.col("_lo") == F.col("_of")]).filter(
            (F.col("_cum") >= F.col("_rank")) & (F.col("_cum") - F.col("_c") < F.col("_rank"))
        )
        stage = materialize(
            picked.select(
                *g, "_hot", F.col("_to_lo").alias("_lo"), F.col("_to_hi").alias("_hi"), "_prob", "_want", (F.col("_rank") - F.col("_cum") + F.col("_c")).alias("_rank")
            ),
            "ranks",
        )
    values.drop()
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    low, high = F.min("_lo"), F.max("_lo")
    per_prob = out.groupBy(*g, "_prob").agg(low.alias("_a"), high.alias("_b"))
    sizes = groups.select(*(F.col(c).alias(f"{c}r") for c in g), "_all", "_sum")
    joined = per_prob.join(sizes, [F.col(c).eqNullSafe(F.col(f"{c}r")) for c in g] or F.lit(True))
    return joined.select(
        *(F.col(a).alias(c) for c, a in zip(group, g)),
        F.col("_prob").alias("prob"),
        (F.col("_a") + (at - F.floor(at)) * (F.col("_b") - F.col("_a")) if interpolate else F.col("_a")).alias("value"),
        F.col("_all").alias("n"),
        F.col("_sum").alias("total"),
    )


def key_profile(
    df: DataFrame, keys: Sequence[str], unit: str, probs: Sequence[float] = (0.5, 0.9)
) -> DataFrame:
    """Row counts, distinct units, share of rows and rows per unit for each value of each key column.

    Columns: field, item, n_rows LONG, n_units LONG, share DOUBLE and `units_p50`-like DOUBLE columns with
    exact quantiles of the rows per unit. Key and unit values are compared trimmed and in upper
    case; missing ones (NULL, blank, NA, NaN, None) of a key are left out of that key, rows with a
    missing unit count as rows only. `share` is over the rows in which the key is not missing. An
    item without any unit has n_units 0 and NULL quantiles. Repeated rows count each time; an
    empty table gives an empty result.

    Rows and units of a key are the sums that the selection of its quantiles keeps; only rows without a unit, which have no
    place in it, are counted beside it.
    """
    pairs = F.array(*(F.struct(F.lit(k).alias("field"), clean_key(k).alias("item")) for k in keys))
    rows = df.select(F.explode(pairs).alias("_p"), clean_key(unit).alias("_unit")).select("_p.*", "_unit")
    units = materialize(
        rows.filter("item IS NOT NULL").groupBy("field", "item", "_unit").agg(F.count("*").alias("_n")), "units"
    )
    sizes = units.df.filter("_unit IS NOT NULL").groupBy("field", "item", "_n").agg(F.count("*").alias("_w"))
    found = select_quantiles(sizes, ["field", "item"], "_n", probs, weight="_w")
    per_key = found.groupBy("field", "item").agg(
        F.max("n").alias("_units"),
        F.max(F.col("total").cast("long")).alias("_in_units"),
        *(F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(f"units_p{round(p * 100)}") for p in probs),
    )
    bare = units.df.filter("_unit IS NULL").select("field", "item", F.col("_n").alias("_bare"))
    zero = F.lit(0).cast("long")
    counted = per_key.join(bare, ["field", "item"], "full").withColumn("n_rows", F.coalesce("_in_units", zero) + F.coalesce("_bare", zero))
    written = materialize(counted, "profile").df
    totals = written.groupBy("field").agg(F.sum("n_rows").alias("_all"))  # one row per key column
    return written.join(F.broadcast(totals), "field").select(
        "field",
        "item",
        "n_rows",
        F.coalesce("_units", zero).alias("n_units"),
        (F.col("n_rows") / F.col("_all")).alias("share"),
        *(f"units_p{round(p * 100)}" for p in probs),
    )


def heavy_keys(profile: DataFrame, min_share: float) -> DataFrame:
    """The rows of a `key_profile` whose share of their field's rows is at least `min_share`.

    Put in any order, the rows of an item with such a share cover a rank that is a multiple of the share. So the
    items are placed by a hash, the values at these ranks are selected by refining histograms of the
    counts, and only items at a selected place are looked at; their shares decide. At most 1 / min_share places a
    field are selected, and they are broadcast.
    """
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be above 0 and 1 at most")
    placed = profile.withColumn("_place", F.shiftright(F.xxhash64("item"), 12).cast("double"))  # 52 bits are exact in a DOUBLE
    ranks = [min(i * min_share, 1.0) for i in range(1, int(1 / min_share) + 2)]
    found = select_quantiles(placed, ["field"], "_place", sorted(set(ranks)), weight="n_rows", bins=4096)
    places = found.select(F.col("field").alias("_field"), F.col("value").alias("_at")).distinct()
    hits = placed.join(F.broadcast(places), (F.col("field") == F.col("_field")) & (F.col("_place") == F.col("_at")), "left_semi")
    return hits.filter(F.col("share") >= min_share).drop("_place")
