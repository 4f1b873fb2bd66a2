import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.functions.vectors import cosine, inner_product, mean_pool, norm, unit
from gleaner.operators.features import hashed_vectors, idf_weights, packed_vectors
from gleaner.operators.neighbors import (
    distinct_vectors,
    drop_near_duplicates,
    kept_ids,
    nearest_matches,
)

T = math.cos(math.radians(15))


def v(degrees):
    return [math.cos(math.radians(degrees)), math.sin(math.radians(degrees))]


CASES = {
    "chain": ({0: v(0), 1: v(10), 2: v(18)}, T, {1, 2}),
    "isolated": ({0: v(0), 1: v(12), 2: v(20), 3: v(90)}, T, {1, 2}),
    "three identical": ({5: v(0), 7: v(0), 9: v(0)}, T, {7, 9}),
    "identical pair and near": ({0: v(10), 1: v(0), 2: v(0)}, T, {1, 2}),
    "shielded by a copy": ({0: v(10), 1: v(0), 2: v(0), 3: v(11)}, T, {2, 3}),
    "opposite": ({0: [1.0, 0.0], 1: [-1.0, 0.0]}, T, set()),
    "zero vectors": ({0: [0.0, 0.0], 1: [0.0, 0.0]}, T, set()),
    "single": ({0: v(0)}, T, set()),
    "empty": ({}, T, set()),
    "equality": ({0: [1.0, 0.0, 0.0, 0.0], 1: [0.5, 0.5, 0.5, 0.5]}, 0.5, {1}),
    "unnormalised": ({0: [3.0, 0.0], 1: [7.0, 0.0]}, T, {1}),
    "below": ({0: v(0), 1: v(16)}, T, set()),
    "missing": ({0: None, 1: v(0), 2: [], 3: [math.nan, 1.0], 4: v(0)}, T, {4}),
    "signed zero": ({0: [1.0, 0.0], 1: [1.0, -0.0]}, 1.0, {1}),
    "tiny and huge": ({0: [1e-200, 0.0], 1: [1e200, 0.0]}, T, {1}),
}


def brute_force(rows, threshold):
    """The removal rule spelled out over all pairs."""
    good = {
        i: np.array(x) / np.linalg.norm(x)
        for i, x in rows.items()
        if x and np.isfinite(x).all() and np.any(x)
    }
    removed = set()
    for i, x in good.items():
        best = None
        for j, y in good.items():
            if i != j:
                s = round(float(x @ y), 9)
                if s >= round(threshold, 9) and (best is None or (-s, j) < best):
                    best = (-s, j)
        if best:
            removed.add(max(i, best[1]))
    return removed


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(list(rows.items()), f"k long, e array<{kind}>")


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("block_rows", [None, 1])
def test_planted_rows(spark, name, block_rows):
    rows, threshold, removed = CASES[name]
    df = frame(spark, rows)
    kept = {r[0] for r in kept_ids(df, "k", "e", threshold, block_rows, 2).collect()}
    assert kept == set(rows) - removed
    if name not in ("tiny and huge",):
        assert brute_force(rows, threshold) == removed


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    dims = 3 if seed < 2 else 6
    rows = {}
    for i in range(260):
        if rows and rng.random() < 0.25:
            base = rng.choice(list(rows.values()))
            noise = rng.choice([0.0, 0.0, 0.05, 0.2])
            scale = rng.choice([1.0, 2.0, 4.0])
            rows[i * 3] = [scale * (x + noise * rng.gauss(0, 1)) for x in base]
        else:
            rows[i * 3] = [rng.gauss(0, 1) for _ in range(dims)]
    threshold = rng.choice([0.9, 0.97, 0.6])
    want = set(rows) - brute_force(rows, threshold)
    for block_rows in (None, 7, 40):
        df = frame(spark, rows).repartition(5)
        kept = {r[0] for r in kept_ids(df, "k", "e", threshold, block_rows, 2).collect()}
        assert kept == want


def test_block_size_does_not_matter_on_real_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    results = [
        {tuple(r) for r in nearest_matches(df, "vec_id", "embedding", 0.4, b, 2)[1].collect()}
        for b in (None, 30, 101)
    ]
    assert results[0] == results[1] == results[2] and results[0]


def test_a_third_of_all_rows_are_copies(spark):
    """Copies leave each task as two rows, and the join sees one vector for all of them."""
    ids = spark.range(0, 9000, numPartitions=6)
    own = F.array(*[F.hash(F.col("id") * 31 + d).cast("double") for d in range(24)])
    copies = F.array(*[F.lit(float(d + 1)) for d in range(24)])
    df = ids.select("id", F.when(F.col("id") % 3 == 1, copies).otherwise(own).alias("e"))
    reps, _ = nearest_matches(df, "id", "e", 0.95)
    assert reps.count() == 6001
    plan = distinct_vectors(df, "id", "e")._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 2, Partial" in plan
    kept = {r[0] for r in kept_ids(df, "id", "e", 0.95).collect()}
    assert {i for i in kept if i % 3 == 1} == {1}
    assert len(kept) == 6001


def test_rows_keep_their_columns(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], "a"), (2, [1.0, 0.0], "b"), (3, [0.0, 1.0], "c")], "k long, e array<float>, t string"
    )
    out = drop_near_duplicates(df, "k", "e", 0.9)
    assert out.columns == df.columns
    assert sorted(r["t"] for r in out.collect()) == ["a", "c"]


def test_bad_arguments(spark):
    df = frame(spark, {0: [1.0], 1: [1.0, 2.0]})
    for threshold in (0.0, -0.5, 1.1):
        with pytest.raises(ValueError, match="threshold"):
            kept_ids(df, "k", "e", threshold)
    with pytest.raises(ValueError, match="whole-number"):
        kept_ids(df.withColumn("k", F.col("k").cast("string")), "k", "e", 0.5)
    with pytest.raises(ValueError, match="length"):
        kept_ids(df, "k", "e", 0.5)


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.select(
        norm(F.col("a")), unit(F.col("a")), inner_product(F.col("a"), F.col("b")), cosine(F.col("a"), F.col("b"))
    ).collect()
    assert rows[0][0] == 5.0 and rows[0][1] == pytest.approx([0.6, 0.8])
    assert rows[0][2] == 24.0 and rows[0][3] == pytest.approx(0.96)
    assert rows[1][0] == 0.0 and rows[1][1] == [0.0, 0.0] and rows[1][3] is None


def test_mean_pool(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 6.0]), (2, [5.0, 5.0])], "k long, e array<float>")
    got = {r["k"]: r["vector"] for r in mean_pool(df, "k", "e").collect()}
    assert got == {1: [2.0, 4.0], 2: [5.0, 5.0]}


def test_hashed_counts(spark):
    df = spark.createDataFrame([(1, "Ab ab, cd"), (2, ""), (3, None)], "k long, t string")
    rows = {r["k"]: r["vector"] for r in hashed_vectors(df, F.col("t"), "k", 64).collect()}
    assert sum(rows[1]) == 4 and max(rows[1]) >= 2 and len(rows[1]) == 64
    assert not any(rows[2]) and not any(rows[3])
    packed = {r["k"]: r["vector"] for r in packed_vectors(df, F.col("t"), "k", 64).collect()}
    assert np.frombuffer(packed[1], np.float32).tolist() == rows[1]
    assert packed[2] is None and packed[3] is None
    weights = idf_weights(hashed_vectors(df, F.col("t"), "k", 64), 64)
    seen = [i for i, x in enumerate(rows[1]) if x]
    assert all(weights[i] == pytest.approx(math.log(4 / 2)) for i in seen)
    with pytest.raises(ValueError, match="dims"):
        hashed_vectors(df, F.col("t"), "k", 0)
