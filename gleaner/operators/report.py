"""The run report: one row of stage sizes and score statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.scores import as_percent, reduction

EMPTY_NOTE = "No row passed the filters; looser thresholds would keep some."


def score_stats(scored: DataFrame, score: str = "final_score") -> DataFrame:
    """Mean, population standard deviation, minimum and maximum, one row."""
    value = F.col(score)
    return scored.agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def stage_counts(flagged: DataFrame, **flags: Column) -> DataFrame:
    """Rows for which each flag holds, in one pass."""
    return flagged.agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()])


def build_report(
    stats: DataFrame,
    config_name: str,
    original: int,
    filtered: int,
    deduplicated: int,
    selected: int,
    timestamp: str | None = None,
    validation: dict[str, float] | None = None,
) -> DataFrame:
    """One row; ``stats`` is the row from ``score_stats``."""
    empty = deduplicated == 0
    checked = None
    if validation:
        checked = F.struct(*[F.lit(float(v)).alias(k) for k, v in validation.items()])
    kind = "struct<baseline_loss:double,optimized_loss:double,loss_reduction_percentage:double>"
    final = F.struct("mean", "std", "min", "max")
    n, left = F.lit(original).cast("bigint"), F.lit(selected).cast("bigint")
    return stats.select(
        F.lit(timestamp or datetime.now().isoformat()).alias("timestamp"),
        F.lit(config_name).alias("config_used"),
        n.alias("original_size"),
        F.lit(filtered).cast("bigint").alias("size_after_quality_filter"),
        F.lit(deduplicated).cast("bigint").alias("size_after_deduplication"),
        left.alias("optimized_size"),
        as_percent(reduction(n, left)).alias("reduction_percentage"),
        (F.lit(None).cast(final_type()) if empty else final).alias("final_scores_stats"),
        F.lit(EMPTY_NOTE if empty else None).cast("string").alias("note"),
        (checked if checked is not None else F.lit(None).cast(kind)).alias("validation_results"),
    )


def final_type() -> str:
    return "struct<mean:double,std:double,min:double,max:double>"
