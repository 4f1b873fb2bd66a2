"""What a task holds while it counts features and compares blocks is bounded, and results are those of plain code."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner import stage
from gleaner.config import load_config
from gleaner.operators import features, neighbors, sparse_join
from gleaner.plans.curate import RunOptions, deduplicate


def _peak(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_counting_features_of_a_batch_holds_few_characters_at_a_time():
    grams = pa.array(["abcd efgé" * 2000] * 500)
    codes = pa.array(["00ff12ab" * 2000] * 500)
    assert _peak(lambda: features._gram_counts(grams, 512, 3)) < 100
    assert _peak(lambda: features._bucket_counts(codes, 512)) < 100


def test_texts_of_any_length_are_counted_whole(monkeypatch):
    monkeypatch.setattr(features, "TILE_CHARS", 16)
    monkeypatch.setattr(features, "TILE_CELLS", 64)
    texts = [None, "", "ab", "abc", "é\U0001F600x", "abcdé" * 40, "x", "yz" * 7] + ["q" * n for n in range(40)]
    got = features._gram_counts(pa.array(texts), 16, 3)
    codes = [None, "", "00ff", "00ff12ab" * 9, "0a0b"]
    found = features._bucket_counts(pa.array(codes), 32)
    for row, text in enumerate(texts):
        points = [ord(c) for c in text or ""]
        want = Counter()
        for at in range(len(points) - 2):
            a, b, c = points[at : at + 3]
            want[((a * features.GRAM_BASE + b) * features.GRAM_BASE + c) % features.GRAM_MODULUS % 16] += 1
        assert {k: v for k, v in enumerate(got[row]) if v} == want
    for row, code in enumerate(codes):
        want = Counter(int((code or "")[at : at + 4], 16) % 32 for at in range(0, len(code or ""), 4))
        assert {k: v for k, v in enumerate(found[row]) if v} == want
    assert features._gram_counts(pa.array([], pa.string()), 16, 3).shape == (0, 16)
    assert found.dtype == np.float32


def _brute(vectors: dict[int, np.ndarray], threshold: float) -> dict[int, tuple[int, float]]:
    out = {}
    for key, v in vectors.items():
        others = [(-round(float(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)), 9), k) for k, w in vectors.items() if k != key]
        value, partner = min(others)
        if -value >= threshold:
            out[key] = (partner, -value)
    return out


def test_vectors_of_any_width_are_compared_exactly():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 5, (40, 24)).astype(np.float64)
    scales = np.array([1, 100, 30_000, 0.5])[np.arange(160) % 4]
    rows = base[np.arange(160) // 4] * scales[:, None]
    rows[::7, 3] += 1
    vectors = dict(zip(rng.permutation(160).tolist(), rows, strict=True))
    packed = []
    for k in vectors:
        v = vectors[k]
        whole = (v == v.astype(np.int64)).all()
        kind = np.float32 if not whole or v.max() > 65535 else np.uint8 if v.max() < 256 else np.uint16
        packed.append(v.astype(kind).tobytes())
    assert len({len(p) for p in packed}) == 3
    side = np.arange(160) % 2
    parts = []
    for left, right in ((0, 0), (0, 1), (1, 1)):
        use = np.flatnonzero((side == left) | (side == right))
        columns = [np.full(len(use), left, np.int32), np.full(len(use), right, np.int32), side[use].astype(np.int32)]
        table = pa.table([pa.array(c) for c in columns] + [pa.array(np.array([*vectors])[use]), pa.array([packed[i] for i in use], pa.binary())], names=neighbors.SPREAD.names)
        parts += neighbors._block_match(0.9, 24)(table).to_pylist()
    got = {}
    for p in parts:
        got[p["id"]] = min(got.get(p["id"], (2.0, 0)), (-p["similarity"], p["match_id"]))
    assert {k: (m, -s) for k, (s, m) in got.items()} == _brute(vectors, 0.9)


def test_two_blocks_are_compared_tile_by_tile():
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 3, (16_000, 512)).astype(np.uint8)
    counts[1] = counts[9000]
    own = (np.arange(16_000) >= 8000).astype(np.int32)
    table = pa.table(
        [pa.array(np.zeros(16_000, np.int32)), pa.array(np.ones(16_000, np.int32)), pa.array(own), pa.array(np.arange(16_000)), pa.array([c.tobytes() for c in counts], pa.binary())],
        names=neighbors.SPREAD.names,
    )
    found = []
    assert _peak(lambda: found.extend(neighbors._block_match(0.95, 512)(table).to_pylist())) < 150
    assert [(f["id"], f["match_id"], f["similarity"]) for f in found] == [(1, 9000, 1.0), (9000, 1, 1.0)]


def test_partners_are_found_once_and_counts_travel_narrow(spark):
    rows = [(k, [float(k % 5), 1.0, float(k % 3), 2.0 + (k == 4) * 300, 0.5 * (k == 5)]) for k in range(30)]
    frame = spark.createDataFrame(rows, "id long, v array<float>")
    best = neighbors.nearest_rows(frame, "id", "v", 0.99)
    plan = best._jdf.queryExecution().toString()
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan
    packed = neighbors._packed(frame, "id", "v")
    sizes = {r["id"]: len(r["packed"]) for r in neighbors._narrowed(packed, np.dtype(np.float32)).collect()}
    assert sizes == {k: 10 if k == 4 else 20 if k == 5 else 5 for k in range(30)}


def test_entries_of_sparse_vectors_are_listed_in_pieces(monkeypatch):
    monkeypatch.setattr(sparse_join, "LISTED_ENTRIES", 10)
    lists = [[1] * n for n in (3, 0, 7, 1, 25, 4, 6, 1)]
    batch = pa.record_batch([pa.array(range(8)), pa.array(lists)], names=["id", "code"])
    parts = [*sparse_join._cut([batch, batch.slice(0, 0)], "code")]
    assert [p.column("id").to_pylist() for p in parts] == [[0, 1, 2], [3], [4], [5, 6], [7]]
    packed = pa.record_batch([pa.array([b"12345678" * len(v) for v in lists], pa.binary())], names=["packed"])
    assert [p.num_rows for p in sparse_join._cut([packed], "packed", 8)] == [3, 1, 1, 2, 1]


def test_chunks_of_two_blocks_are_not_put_together():
    rng = np.random.default_rng(7)
    counts = rng.integers(0, 3, (16_000, 512)).astype(np.uint8)
    counts[1] = counts[9000]
    own = (np.arange(16_000) % 2).astype(np.int32)
    own[[1, 9000]] = 0, 1
    table = pa.table(
        [pa.array(np.zeros(16_000, np.int32)), pa.array(np.ones(16_000, np.int32)), pa.array(own), pa.array(np.arange(16_000)), pa.array([c.tobytes() for c in counts], pa.binary())],
        names=neighbors.SPREAD.names,
    )
    chunked = pa.concat_tables([table.slice(at, 3000) for at in range(0, 16_000, 3000)])
    usual = pa.default_memory_pool()
    pool = pa.proxy_memory_pool(usual)
    pa.set_memory_pool(pool)
    try:
        found = neighbors._block_match(0.95, 512)(chunked).to_pylist()
    finally:
        pa.set_memory_pool(usual)
    assert pool.max_memory() < 5_000_000
    assert sorted((f["id"], f["match_id"], f["similarity"]) for f in found) == [(1, 9000, 1.0), (9000, 1, 1.0)]


@pytest.mark.parametrize("block_rows", [None, 25])
def test_weights_of_dimensions_are_applied_where_vectors_are_read(spark, block_rows):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 6, (50, 16)) * (rng.random((50, 16)) < 0.5)
    base[:, 0] += 1
    counts = base[np.arange(200) // 4] + (rng.random((200, 16)) < 0.03)
    counts[100:110, 5] += 300
    weights = (1 + rng.random(16) * 5).astype(np.float32)
    first = {}
    for key, row in enumerate(counts.tolist()):
        first.setdefault(tuple(row), key)
    vectors = {k: (np.array(v, np.float32) * weights).astype(np.float64) for v, k in first.items()}
    frame = spark.createDataFrame([(k, [float(x) for x in v]) for v, k in first.items()], "id long, v array<float>")
    _, best = neighbors.nearest_matches(frame, "id", "v", 0.93, block_rows, 2, weights)
    got = {r["id"]: (r["match_id"], r["similarity"]) for r in best.collect()}
    assert got == _brute(vectors, 0.93)
    assert len(got) > 20
    with pytest.raises(ValueError, match="weight"):
        neighbors.nearest_matches(frame, "id", "v", 0.93, weights=weights[:3])


def test_a_run_with_rare_words_weighing_more_sends_counts(spark):
    words = [f"w{k}" for k in range(60)]
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(words, 30)) for _ in range(40)]
    texts += [t + " w1" for t in texts[:10]] + texts[:5] + [""]
    rows = [(k, [("user", t)]) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "sample_id long, messages array<struct<role:string,content:string>>")
    config = load_config("llama_3_2_instruct").with_dedup(similarity_threshold=0.9)
    since = stage.written()
    kept, _ = deduplicate(frame, config, RunOptions())
    path = next(p for p in stage._written[since:] if "/narrow-" in p)
    widths = {r[0] for r in spark.read.parquet(path).select(F.length("packed")).distinct().collect()}
    assert widths == {config.deduplication.dims}
    vectors = features.packed_vectors(frame, F.array_join("messages.content", "\n"), "sample_id", config.deduplication.dims, True)
    want = {r[0] for r in neighbors.kept_ids(vectors, "sample_id", "vector", 0.9).collect()}
    assert {r[0] for r in kept.collect()} == want
    assert 40 <= len(want) < 55
