"""An approximate similarity join: vectors meet in the buckets of random hyperplanes. Opt-in; ``neighbors`` is exact."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators.lookup import count_lookup
from gleaner.operators.neighbors import (
    MATCH,
    _block_match,
    _codec,
    _unpack,
    distinct_vectors,
    nearest_matches,
)
from gleaner.stage import staged

BITS = 8
BANDS = 16
BLOCK_ROWS = 2048
RECALL_ROWS = 1000


def planes(dims: int, bands: int, bits: int, seed: int = 42) -> np.ndarray:
    """Normal vectors of 1 and -1, by the first hex digit of the md5 of ``seed:band:bit:position``."""
    names = (f"{seed}:{k // bits}:{k % bits}:{d}" for d in range(dims) for k in range(bands * bits))
    signs = [1.0 if int(hashlib.md5(n.encode()).hexdigest()[0], 16) < 8 else -1.0 for n in names]
    return np.array(signs).reshape(dims, bands * bits)


def hyperplane_matches(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    threshold: float,
    bands: int = BANDS,
    bits: int = BITS,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The distinct vectors, and the nearest partner of each among those that share a bucket with it.

    A bucket is ``bits`` sides of hyperplanes; there are ``bands`` of them. Two vectors at angle ``a`` share
    one with probability ``1 - (1 - (1 - a / pi) ** bits) ** bands``. Within a bucket the products are
    exact. Rows of a bucket of more than ``block_rows`` are cut into blocks that meet in pairs; no pair
    is written, only the best partner of each row.
    """
    if not 0.0 < threshold <= 1.0:
        raise ValueError("threshold must be in (0, 1]")
    codec = _codec(df, vector_col)
    reps = staged(distinct_vectors(df, id_col, vector_col), "vectors")
    twins = reps.filter("twin IS NOT NULL").select(
        "id", F.col("twin").alias("match_id"), F.lit(1.0).alias("similarity")
    )
    size = F.length("packed")
    shortest, longest = reps.agg(F.min(size), F.max(size)).first()
    if longest is None:
        return reps, twins
    if shortest != longest:
        raise ValueError("vectors differ in length")
    dims = longest // codec.itemsize
    normals = planes(dims, bands, bits, seed)
    places = 1 << np.arange(bits, dtype=np.int64)

    def sides(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            above = _unpack(batch.column("packed"), dims) @ normals >= 0
            marks = above.reshape(-1, bands, bits) @ places + (np.arange(bands, dtype=np.int64) << bits)
            ids = batch.column("id").take(pa.array(np.repeat(np.arange(batch.num_rows), bands)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(marks.ravel())], names=["id", "bucket"])

    vectors = reps.filter("packed IS NOT NULL").select("id", "packed")
    marks = staged(vectors.mapInArrow(sides, "id long, bucket long"), "buckets")
    sizes = staged(marks.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    total, buckets = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    held = count_lookup(marks, sizes, ["bucket"], "n", buckets, total).filter("n IS NOT NULL")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    met = held.select("bucket", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    sent = met.join(vectors, "id").select(
        "bucket", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "id", "packed"
    )
    pairs = sent.groupBy("bucket", "left", "right").applyInArrow(_block_match(threshold, dims), MATCH)
    order = F.struct(-F.col("similarity"), F.col("match_id"))
    best = (
        pairs.unionByName(twins)
        .groupBy("id")
        .agg(F.min_by(F.struct("match_id", "similarity"), order).alias("b"))
        .select("id", "b.match_id", "b.similarity")
    )
    return reps, best


def measured_recall(
    df: DataFrame, id_col: str, vector_col: str, threshold: float, rows: int = RECALL_ROWS, **settings
) -> float:
    """The share of true nearest partners that the buckets find, over the ``rows`` ids of smallest hash.

    The exact join runs over those rows, which is what bounds its cost.
    """
    sample = staged(df.orderBy(F.xxhash64(id_col), id_col).limit(rows), "sample")
    _, exact = nearest_matches(sample, id_col, vector_col, threshold)
    _, found = hyperplane_matches(sample, id_col, vector_col, threshold, **settings)
    hits = exact.join(found.select("id", F.col("match_id").alias("found")), "id", "left")
    total, right = hits.agg(F.count("*"), F.count_if(F.col("found") == F.col("match_id"))).first()
    return right / total if total else 1.0
