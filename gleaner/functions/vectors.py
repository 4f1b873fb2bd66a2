"""Dense vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def norm(vector: Column) -> Column:
    square = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.sqrt(square)


def unit(vector: Column) -> Column:
    """The vector over its length; a zero vector stays zero.

    The length is bound by an outer one-element transform, so it is computed once per row and not
    once per entry.
    """
    return F.transform(
        F.array(norm(vector)),
        lambda length: F.transform(
            vector, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(F.lit(0.0))
        ),
    )[0]


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Null when either side has no direction."""
    return F.try_divide(inner_product(a, b), norm(a) * norm(b))


def mean_pool(df: DataFrame, key: str, vector: str, out: str = "vector") -> DataFrame:
    """One mean vector per key, pooled map-side before the single shuffle."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    dense = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    pooled = dense.groupBy(key).agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return pooled.select(key, vector_to_array("_m").alias(out))
