"""Compare a selection with a random sample of the same size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.scores import relative_improvement
from gleaner.operators.language_model import MIX, fit
from gleaner.operators.select import random_sample


def message_texts(conversations: DataFrame, messages: str = "messages") -> DataFrame:
    return conversations.select(F.explode(messages).alias("m")).select("m.content")


def corpus_loss(texts: DataFrame, text: str = "content", mix: float = MIX) -> DataFrame:
    """Mean token loss of a model fitted on the texts themselves, one row."""
    return fit(texts, text, mix).cross_entropy()


def compare_losses(baseline: DataFrame, optimized: DataFrame) -> DataFrame:
    """One row from two one-row ``loss`` frames."""
    sides = baseline.select(F.lit("baseline").alias("side"), "loss").unionByName(
        optimized.select(F.lit("optimized").alias("side"), "loss")
    )

    def loss(side: str):
        return F.max(F.when(F.col("side") == side, F.col("loss")))

    both = sides.agg(
        loss("baseline").alias("baseline_loss"), loss("optimized").alias("optimized_loss")
    )
    gain = relative_improvement(F.col("baseline_loss"), F.col("optimized_loss"))
    return both.withColumn("loss_reduction_percentage", gain)


def compare_with_random(
    original: DataFrame,
    optimized: DataFrame,
    original_size: int,
    optimized_size: int,
    id_col: str = "sample_id",
    messages: str = "messages",
    seed: int = 42,
    mix: float = MIX,
) -> DataFrame:
    """Loss of a random sample of ``original`` against the loss of ``optimized``."""
    n = min(original_size, optimized_size)
    baseline = random_sample(original, n, seed, id_col)
    return compare_texts(message_texts(baseline, messages), message_texts(optimized, messages), mix)


def compare_texts(baseline: DataFrame, optimized: DataFrame, mix: float = MIX) -> DataFrame:
    """The same for two frames of message texts in a ``content`` column."""
    return compare_losses(corpus_loss(baseline, mix=mix), corpus_loss(optimized, mix=mix))
