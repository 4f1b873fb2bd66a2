"""The sparse similarity join and the clusters of its matches against brute force."""

import collections
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.config import PRESETS, CurationConfig, load_config
from gleaner.operators.clusters import match_clusters
from gleaner.operators.sparse_join import sparse_kept_ids, sparse_nearest, sparse_vectors
from gleaner.plans.curate import curate


def brute_nearest(texts, threshold, idf):
    counts = {
        i: collections.Counter(hashlib.md5(w.encode()).hexdigest()[:7] for w in t.lower().split())
        for i, t in texts.items() if t and t.split()
    }
    df = collections.Counter(c for words in counts.values() for c in words)
    rare = {c: 1 + math.log((len(texts) + 1) / (n + 1)) if idf else 1.0 for c, n in df.items()}
    unit = {}
    for i, words in counts.items():
        weighted = {c: n * rare[c] for c, n in words.items()}
        length = math.sqrt(sum(w * w for w in weighted.values()))
        unit[i] = {c: w / length for c, w in weighted.items()}
    out = {}
    for i, x in unit.items():
        found = [
            (-round(sum(w * y.get(c, 0) for c, w in x.items()), 9), j) for j, y in unit.items() if j != i
        ]
        if found and -min(found)[0] >= threshold:
            out[i] = (min(found)[1], -min(found)[0])
    return out


def corpus(seed=0):
    """Families of texts with a few words changed, copies, a word in every text, short and empty texts."""
    rng = np.random.default_rng(seed)
    texts = {}
    for family in range(12):
        base = [f"w{x}" for x in rng.integers(0, 3000, int(rng.integers(5, 80)))] + ["common"] * int(rng.integers(0, 6))
        for _ in range(int(rng.integers(1, 14))):
            words = list(base)
            for _ in range(int(rng.integers(0, 6))):
                words[int(rng.integers(0, len(words)))] = f"w{rng.integers(0, 3000)}"
            texts[len(texts) * 3 + 1] = " ".join(words)
    for extra in ("", None, "common", "common common", "common w1", "one", "two"):
        texts[len(texts) * 3 + 1] = extra
    texts[9000], texts[9001], texts[9002] = texts[1], texts[1], texts[4]
    return texts


@pytest.mark.parametrize("threshold, idf, block", [(0.95, True, 512), (0.8, True, 5), (0.8, False, 16), (0.5, True, 512), (1.0, True, 512)])
def test_nearest_matches_brute_force(spark, threshold, idf, block):
    texts = corpus()
    rows = spark.createDataFrame(list(texts.items()), "id long, text string").repartition(3)
    vectors = sparse_vectors(rows, F.col("text"), "id")
    got = {r["id"]: (r["match_id"], round(r["similarity"], 9)) for r in sparse_nearest(vectors, "id", "vector", threshold, idf, block).collect()}
    want = brute_nearest(texts, threshold, idf)
    assert got == {i: (j, pytest.approx(s, abs=2e-9)) for i, (j, s) in want.items()}
    removed = {max(i, j) for i, (j, _) in want.items()}
    kept = {r["id"] for r in sparse_kept_ids(vectors, "id", "vector", threshold, idf, block).collect()}
    assert kept == set(texts) - removed


def test_no_words_at_all(spark):
    rows = spark.createDataFrame([(1, ""), (2, None)], "id long, text string")
    vectors = sparse_vectors(rows, F.col("text"), "id")
    assert sparse_nearest(vectors, "id", "vector", 0.9).count() == 0
    assert {r["id"] for r in sparse_kept_ids(vectors, "id", "vector", 0.9).collect()} == {1, 2}
    assert sparse_kept_ids(vectors.limit(0), "id", "vector", 0.9).count() == 0


def test_vectors_travel_by_shared_rare_words_only(spark):
    """Unrelated texts that share frequent words send no vector at all."""
    from gleaner.operators import sparse_join

    rows = [(k, "the of and to " + " ".join(f"own{k}x{j}" for j in range(20))) for k in range(200)]
    vectors = sparse_vectors(spark.createDataFrame(rows, "id long, text string"), F.col("text"), "id")
    reps = sparse_join.distinct_vectors(vectors, "id", "vector")
    weighted = sparse_join._weighted(vectors, "vector", reps, True)
    met = sparse_join._met(sparse_join._postings(weighted, 0.9), 0.9, 512)
    assert met.count() == 0


def test_a_row_meets_a_wide_block_once_whatever_words_it_shares(spark):
    from gleaner.operators import sparse_join

    rng = np.random.default_rng(3)
    pool = [f"w{k}" for k in range(150)]
    rows = [(k, " ".join(rng.choice(pool, 60, replace=False))) for k in range(120)]
    vectors = sparse_vectors(spark.createDataFrame(rows, "id long, text string"), F.col("text"), "id")
    reps = sparse_join.distinct_vectors(vectors, "id", "vector")
    weighted = sparse_join._weighted(vectors, "vector", reps, True)
    met = sparse_join._met(sparse_join._postings(weighted, 0.9), 0.9, 16384)
    wide = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))
    assert 0 < met.count() <= 120 * wide
    assert met.select("id", "first", "second").distinct().count() == met.count()
    # None is near another, so no vector is sent.
    near = met.join(sparse_join._short_forms(weighted), "id").groupBy("first", "second")
    assert near.applyInArrow(sparse_join._open_blocks(0.9), sparse_join.ROUTE).count() == 0


def test_numbers_of_words_are_looked_up_in_parts(spark, monkeypatch):
    from gleaner.operators import sparse_join

    texts = corpus(4)
    rows = spark.createDataFrame(list(texts.items()), "id long, text string")
    vectors = sparse_vectors(rows, F.col("text"), "id")

    def numbered():
        reps = sparse_join.distinct_vectors(vectors, "id", "vector")
        return {r["id"]: (r["rows"], r["packed"]) for r in sparse_join._weighted(vectors, "vector", reps, True).collect()}

    whole = numbered()
    monkeypatch.setattr(sparse_join, "LOOKUP_WORDS", 100)
    assert numbered() == whole and len(whole) > 50


@pytest.mark.parametrize("few", [False, True])
def test_long_rows_are_compared_by_finer_parts(monkeypatch, few):
    import pyarrow as pa

    from gleaner.operators import sparse_join

    monkeypatch.setattr(sparse_join, "TILE_ROWS", 16)
    if few:
        monkeypatch.setattr(sparse_join, "PARTS", 4)
        monkeypatch.setattr(sparse_join, "FINE", 1024)
    rng = np.random.default_rng(5)
    base = [np.sort(rng.choice(50_000, 3000, replace=False)) for _ in range(10)]
    rows, packed = [], []
    for k in range(50):
        codes = np.unique(np.append(base[k % 10][: 3000 - 40 * (k // 10)], rng.choice(50_000, 100)))
        rows.append(codes)
        packed.append(sparse_join._planes(codes, np.ones(len(codes), int), np.full(len(codes), 2)))
    side = np.arange(50) // 10 % 2
    columns = [pa.array(np.arange(50) * 7), pa.array(np.zeros(50, int)), pa.array(packed, pa.binary())]
    table = pa.table(columns, names=["id", "rows", "packed"])
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for same, left, right in ((True, np.arange(50), np.arange(50)), (False, a, b)):
        got = {i: (j, s) for i, j, s in zip(*(x.tolist() for x in sparse_join.best_partners(table, same, left, right, 0.9)))}
        want = {}
        for i in range(50):
            others = [j for j in range(50) if j != i and (same or side[i] != side[j])]
            found = [(-round(len(np.intersect1d(rows[i], rows[j])) / math.sqrt(len(rows[i]) * len(rows[j])), 9), j * 7) for j in others]
            if -min(found)[0] >= 0.9:
                want[i * 7] = (min(found)[1], pytest.approx(-min(found)[0], abs=2e-9))
        assert got == want and len(want) >= 40


def brute_clusters(matches):
    out = {}
    for start in matches:
        seen, at = [], start
        while at in matches and at not in seen:
            seen.append(at)
            at = matches[at]
        out[start] = min(at, matches[at]) if at in matches else at
    return out


def test_clusters_of_chains_stars_and_pairs(spark):
    matches = {1: 2, 2: 1, 3: 2, 4: 3, 5: 4, 10: 99, 11: 10}
    matches |= {100 + k: 99 + k for k in range(1, 70)} | {100: 101}
    matches |= {k: 500 for k in range(501, 900)} | {500: 501}
    rows = spark.createDataFrame(list(matches.items()), "id long, match_id long")
    got = {r["id"]: r["cluster"] for r in match_clusters(rows).collect()}
    assert got == brute_clusters(matches)
    assert match_clusters(rows.limit(0)).count() == 0


def conversations(spark):
    texts = ["alpha beta gamma delta epsilon zeta eta theta"] * 4 + ["one two three four five six seven eight"]
    rows = [(k, [("user", t + f" q{k % 2}"), ("assistant", t)]) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "sample_id long, messages array<struct<role:string,content:string>>")


def loose():
    return load_config("llama_3_2_instruct").with_filters(
        min_tokens_per_turn=1, min_total_tokens=1, balanced_conversation_ratio=1.0
    )


@pytest.mark.parametrize("method", ["hashed", "sparse"])
def test_a_run_may_cap_clusters(spark, method):
    config = loose().with_dedup(method=method, similarity_threshold=0.7)
    plain = curate(conversations(spark), config, 5, skip_deduplication=True)
    assert plain.selected.count() == 5
    # Each row's nearest is its copy, so the copies are two clusters.
    capped = curate(conversations(spark), config.with_selection(max_similar_samples=1), 5, skip_deduplication=True)
    ids = {r["sample_id"] for r in capped.selected.collect()}
    assert len(ids) == 3 and len(ids & {0, 2}) == len(ids & {1, 3}) == 1
    kept = curate(conversations(spark), config.with_selection(max_similar_samples=1), 5)
    assert {r["sample_id"] for r in kept.selected.collect()} == {0, 1, 4}


def test_a_run_may_bound_the_learning_value(spark):
    config = loose().with_selection(min_perplexity_score=0.5)
    every = curate(conversations(spark), loose(), 5, skip_deduplication=True)
    want = {r["sample_id"] for r in every.scored.collect() if r["learning_value"] >= 0.5}
    assert 0 < len(want) < 5
    got = curate(conversations(spark), config, 5, skip_deduplication=True)
    assert {r["sample_id"] for r in got.selected.collect()} == want
    assert got.report.first()["optimized_size"] == len(want)


def test_unused_sections_are_named():
    raw = PRESETS["llama_3_2_instruct"] | {"advanced": {"max_similar_samples": 5}}
    with pytest.warns(UserWarning, match="no effect"):
        config = CurationConfig.from_mapping("own", raw)
    assert config.selection.max_similar_samples is None
    limits = {"min_perplexity_score": 0.1, "max_similar_samples": 5}
    config = CurationConfig.from_mapping("own", PRESETS["llama_3_2_instruct"] | {"selection": limits})
    assert config.selection.band == (0.1, math.inf) and config.selection.max_similar_samples == 5
