"""Score combination, top-k and seeded samples."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.config import ScoringWeights
from gleaner.functions.scores import order_hash, weighted
from gleaner.stage import staged

# Up to this many rows one task may order the result, which gets as many from every partition; above
# it the order is found by range partitions.
SMALL_K = 1_000


def combine_scores(
    df: DataFrame,
    weights: ScoringWeights,
    learning: str = "learning_value",
    quality: str | None = None,
    diversity: str | None = None,
    out: str = "final_score",
) -> DataFrame:
    """Add the weighted sum. Quality and diversity count as 1 where no column is named or it is null."""

    def part(name: str | None) -> Column:
        return F.lit(1.0) if name is None else F.coalesce(F.col(name).cast("double"), F.lit(1.0))

    score = weighted(weights, F.col(learning), part(quality), part(diversity))
    return df.withColumn(out, score)


def join_scores(df: DataFrame, scores: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """Attach score columns held in another table; rows without an entry get null."""
    return df.join(scores.select(id_col, *columns), id_col, "left")


def in_band(df: DataFrame, low: float, high: float, score: str = "learning_value") -> DataFrame:
    """Rows whose score lies in the band, ends included; a null score is outside."""
    return df.filter(F.col(score).between(low, high))


def most_per_group(
    df: DataFrame, most: int, group: str, score: str = "final_score", id_col: str = "sample_id"
) -> DataFrame:
    """At most ``most`` rows of each group, the best by score, ties to the smaller id.

    The limit is applied before the shuffle too, so of a large group a task sends ``most`` rows.
    """
    if most < 1:
        raise ValueError("most must be at least 1")
    order = Window.partitionBy(group).orderBy(F.desc(score), F.asc(id_col))
    return df.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= most).drop("_nth")


def take_ranked(
    df: DataFrame, order: Sequence[Column], k: int, out: str = "rank", small_k: int = SMALL_K
) -> DataFrame:
    """The first ``k`` rows in ``order`` with their rank from 1. ``order`` must leave no ties.

    A large ``k`` never meets in one task: rows are range-partitioned and sorted, and a row's rank is
    its place in the partition plus the sizes of the partitions before it.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if k <= small_k:
        top = df.orderBy(*order).limit(k)
        return top.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seen", F.monotonically_increasing_id())
    )
    # Range bounds come from a sample, so the ranked copy is written once and then read.
    held = staged(placed, "ranked")
    parts = held.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_seen").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition.
    offsets = parts.select(
        "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    rank = (F.col("_before") + F.col("_seen") - F.col("_first") + 1).alias(out)
    ranked = held.join(F.broadcast(offsets), "_part").select(*df.columns, rank)
    return ranked.filter(F.col(out) <= k)


def top_k(
    df: DataFrame,
    k: int,
    score: str = "final_score",
    id_col: str = "sample_id",
    available: int | None = None,
    small_k: int = SMALL_K,
) -> DataFrame:
    """The ``k`` best rows, ties to the smaller id, with ``rank``. Fewer rows give all and a warning."""
    if available is not None and k > available:
        warnings.warn(f"top_k ({k}) exceeds the {available} rows left; all are used", stacklevel=2)
    # Only ids and scores are put in order; the rows are fetched afterwards.
    chosen = take_ranked(df.select(id_col, score), [F.desc(score), F.asc(id_col)], k, small_k=small_k)
    ranks = chosen.select(id_col, "rank")
    return df.join(F.broadcast(ranks) if k <= small_k else ranks, id_col)


def random_sample(
    df: DataFrame, n: int, seed: int = 42, id_col: str = "sample_id", small_k: int = SMALL_K
) -> DataFrame:
    """Exactly ``n`` random rows (all, if there are fewer), the same for any partitioning."""
    keyed = df.select(id_col, order_hash(F.col(id_col), seed).alias("_h"))
    total = keyed.count()
    if total > 4 * n >= 4:
        # The hash is uniform: nearly all of the rows that are wanted lie below this bound.
        bound = int((1.2 * n + 50) / total * 2**32)
        near = keyed.filter(F.col("_h") < f"{min(bound, 2**32 - 1):08x}")
        if near.count() >= n:
            keyed = near
    chosen = take_ranked(keyed, [F.asc("_h"), F.asc(id_col)], n, small_k=small_k)
    ids = chosen.select(id_col)
    return df.join(F.broadcast(ids) if n <= small_k else ids, id_col, "left_semi")
