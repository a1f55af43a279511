"""Ranks, folds, quantiles and top-k lists that survive a hot group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.session import cut


def parts_of(df: DataFrame, rows: int) -> int:
    """Partitions of about ``rows`` rows, at least as many as the cores of the session."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def salts_of(df: DataFrame, keys: Sequence[str], rows: int) -> Column:
    """Into how many groups of about ``rows`` rows each key is split, as a column.

    Keys are counted with map-side sums, and only those above ``rows`` reach the
    driver, one for each ``rows`` rows at most. Their salts are a literal of the
    plan, so no shuffle by a hot key comes before it is split.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > rows)
    code = F.xxhash64(*keys) if keys else F.lit(0).cast("long")
    hot = sizes.select(code.alias("code"), F.ceil(F.col("n") / rows).alias("salts")).collect()
    one = F.lit(1).cast("long")
    if not hot:
        return one
    known = F.create_map(*[F.lit(x).cast("long") for r in hot for x in (r["code"], r["salts"])])
    return F.coalesce(F.try_element_at(known, code), one)


def split_hot(df: DataFrame, keys: Sequence[str], spread: Sequence[str], rows: int) -> DataFrame:
    """Adds ``salt`` so that no (keys, salt) group holds much more than ``rows`` rows."""
    return df.withColumn("salt", F.pmod(F.xxhash64(*spread), salts_of(df, keys, rows)))


def cumulative(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column) -> DataFrame:
    """Adds ``upto`` (the weights up to and with a row) and ``whole`` (all of them) within each key.

    Rows are range-partitioned by (keys, order) and written once, so a hot key
    spreads over many slices; only the slices' sums are added up per key.
    """
    sliced = cut(
        df.withColumn("weight", weight)
        .repartitionByRange(*keys, *order)
        .withColumn("slice", F.spark_partition_id()),
        "ranked",
    )
    sums = sliced.groupBy(*keys, "slice").agg(F.sum("weight").alias("sum"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys,
        "slice",
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"),
        F.sum("sum").over(whole).alias("whole"),
    )
    local = Window.partitionBy(*keys, "slice").orderBy(*order)
    so_far = F.sum("weight").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        sliced.withColumn("local", so_far)
        .join(offsets, [*keys, "slice"])
        .withColumn("upto", F.col("offset") + F.col("local"))
        .drop("slice", "offset", "local")
    )


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``position`` (1-based) and ``group_rows`` within each key; ``order`` tells the rows of a key apart."""
    ranked = cumulative(df, keys, order, F.lit(1).cast("long"))
    return ranked.withColumnsRenamed({"upto": "position", "whole": "group_rows"}).drop("weight")


def kfold(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, into: str = "fold") -> DataFrame:
    """Contiguous folds 0..k-1 in the column ``into``; the first ``n mod k`` folds get one row more.

    A group smaller than ``k`` gets as many folds as it has rows.
    """
    return kfolds(df, keys, order, {into: k})


def kfolds(df: DataFrame, keys: Sequence[str], order: Sequence[str], folds: dict[str, int]) -> DataFrame:
    """A column of contiguous folds for each name in ``folds``, all from one ranking of the rows."""
    n, p = F.col("group_rows"), F.col("position") - 1

    def fold(k: int) -> Column:
        most = F.least(F.lit(k).cast("long"), n)
        small, extra = F.floor(n / most), n % most
        head = extra * (small + 1)
        return F.when(p < head, F.floor(p / (small + 1))).otherwise(extra + F.floor((p - head) / small)).cast("int")

    ranked = row_numbers(df, keys, order)
    return ranked.withColumns({into: fold(k) for into, k in folds.items()}).drop("position", "group_rows")


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Exact linear-interpolated quantiles, one column per name in ``probs``.

    Equal values are one row with a count, so a value that a third of a group
    shares is one row in its slice; only the rows around each wanted rank are
    kept after that, and no group is gathered.
    """
    counted = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    )
    ranked = cumulative(counted, keys, [value], F.col("n"))
    aggs = []
    for name, q in probs.items():
        rank = (F.col("whole") - 1) * F.lit(q)
        part = rank - F.floor(rank)

        def holds(position: Column) -> Column:
            return (position <= F.col("upto")) & (position > F.col("upto") - F.col("n"))

        low = F.floor(rank) + 1
        share = F.when(holds(low), 1 - part).otherwise(0.0) + F.when(holds(low + 1), part).otherwise(0.0)
        aggs.append(F.sum(F.when(share > 0, share * F.col(value))).alias(name))
    return ranked.groupBy(*keys).agg(*aggs)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows per key; Spark trims each task to ``k`` before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)
