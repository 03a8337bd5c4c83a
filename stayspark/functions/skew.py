"""Building blocks that stay parallel when one key holds a large share of the rows.

A window partitioned by a key sorts the whole key in one task. The helpers below either aggregate
before the shuffle, keep only what can still matter per key, or cut a key into *segments*
(contiguous ranges of its order), scan the segments in parallel and stitch them together through a
frame that has one row per segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALTS = 32


def within_rows(df: DataFrame, max_rows: int) -> bool:
    """Whether the frame has at most ``max_rows`` rows; reads no further than needed."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting; otherwise leave the shuffled join to the optimizer,
    where adaptive execution splits skewed partitions."""
    return F.broadcast(df) if within_rows(df, max_rows) else df


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """The row with the greatest order per key, by a combinable aggregate (no per-key sort)."""
    return _extreme_per_key(df, keys, order, columns, F.max_by)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    return _extreme_per_key(df, keys, order, columns, F.min_by)


def _extreme_per_key(df, keys, order, columns, pick) -> DataFrame:
    columns = [c for c in (columns or df.columns) if c not in keys]
    by = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    picked = df.groupBy(*keys).agg(
        pick(F.struct(*[F.col(c) for c in columns]), by).alias("_row")
    )
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def top_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank_col: str = "rank",
    salt_by: str | None = None,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """First ``n`` rows per key.

    Spark plans a partial rank limit before the shuffle, so a hot key sends at most ``n`` rows per
    input partition. With ``salt_by`` the key is also cut in ``salts`` parts that are limited on
    their own first, which bounds the last sort at ``n * salts`` rows however many partitions the
    input has.
    """
    if salt_by is not None:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
        w = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
        df = df.drop("_salt", "_rn")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def segmented_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    segment: Column,
    values: dict[str, Column],
    include_current: bool = True,
) -> DataFrame:
    """Running sums along ``order`` inside each key.

    ``segment`` must not decrease along ``order``. Each (key, segment) is scanned on its own and
    the total of the earlier segments is added through an equi-join, so the largest sort is one
    segment, not one key.
    """
    segmented = df.withColumn("_seg", segment)
    totals = segmented.groupBy(*keys, "_seg").agg(
        *[F.sum(v).alias(f"_t_{name}") for name, v in values.items()]
    )
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_seg").alias("_ks"),
        *[
            F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_c_{name}")
            for name in values
        ],
    )
    end = Window.currentRow if include_current else -1
    inside = (
        Window.partitionBy(*keys, "_seg")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, end)
    )
    local = segmented
    for name, v in values.items():
        local = local.withColumn(f"_l_{name}", F.coalesce(F.sum(v).over(inside), F.lit(0)))
    on = [local[k].eqNullSafe(carry[f"_k{i}"]) for i, k in enumerate(keys)]
    on.append(local["_seg"].eqNullSafe(carry["_ks"]))
    joined = local.join(carry, on, "inner")
    return joined.select(
        *df.columns,
        *[(F.col(f"_l_{name}") + F.col(f"_c_{name}")).alias(name) for name in values],
    )


def segmented_lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    segment: Column,
    value: str,
    out: str,
) -> DataFrame:
    """Previous ``value`` along ``order`` (plain ascending columns) inside each key, without sorting a
    key in one task. ``segment`` must not decrease along ``order``."""
    segmented = df.withColumn("_seg", segment)
    by = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    lasts = segmented.groupBy(*keys, "_seg").agg(F.max_by(F.col(value), by).alias("_last"))
    carry = lasts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_seg").alias("_ks"),
        F.lag("_last").over(Window.partitionBy(*keys).orderBy("_seg")).alias("_carry"),
    )
    inside = Window.partitionBy(*keys, "_seg").orderBy(*order)
    local = segmented.withColumn("_prev", F.lag(value).over(inside))
    on = [local[k].eqNullSafe(carry[f"_k{i}"]) for i, k in enumerate(keys)]
    on.append(local["_seg"].eqNullSafe(carry["_ks"]))
    return local.join(carry, on, "inner").select(
        *df.columns, F.coalesce("_prev", "_carry").alias(out)
    )
