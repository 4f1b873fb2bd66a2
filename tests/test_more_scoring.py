"""Leave-one-out losses, character n-grams, hyperplane buckets and streams against brute force."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner import curate, load_config
from gleaner.functions.tokens import tokens
from gleaner.operators.features import GRAM_BASE, GRAM_MODULUS, hashed_vectors, packed_vectors
from gleaner.operators.hyperplanes import hyperplane_matches, measured_recall
from gleaner.operators.language_model import fit, mean_nll, mean_nll_left_out
from gleaner.operators.neighbors import kept_ids, nearest_matches
from gleaner.streaming.stages import filter_stream, run_available


def refit_loss(texts, left_out):
    """The loss of one text under a model counted anew over the others."""
    pairs, prevs, words = collections.Counter(), collections.Counter(), collections.Counter()
    for k, text in enumerate(texts):
        if k != left_out:
            found = text.split()
            for pair in zip(["", *found], found, strict=False):
                pairs[pair] += 1
                prevs[pair[0]] += 1
                words[pair[1]] += 1
    room = max(sum(words.values()) + len(words), 1)
    own = texts[left_out].split()
    losses = [
        -math.log(0.5 * (pairs[p, w] / prevs[p] if prevs[p] else 0) + 0.5 * (words[w] + 1) / room)
        for p, w in zip(["", *own], own, strict=False)
    ]
    return sum(losses) / len(losses) if losses else None


def test_left_out_losses_equal_refitted_models(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 40, int(rng.integers(1, 30)))) for _ in range(40)]
    texts += ["only once here", "", "w1", "same text twice", "same text twice", "q " * 50]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    model = fit(rows, "text")
    got = {r["id"]: r["mean_nll"] for r in mean_nll_left_out(rows, "id", tokens(F.col("text")), model).collect()}
    want = {k: refit_loss(texts, k) for k in range(len(texts)) if texts[k].strip()}
    assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}
    plain = {r["id"]: r["mean_nll"] for r in mean_nll(rows, "id", tokens(F.col("text")), model, all_seen=True).collect()}
    # A row that occurs once no longer vouches for itself; one that occurs twice still has its copy.
    assert got[40] > plain[40] + 1 and got[43] - plain[43] < got[40] - plain[40]


def test_a_text_alone_in_its_corpus(spark):
    rows = spark.createDataFrame([(1, "a b a")], "id long, text string")
    loss = mean_nll_left_out(rows, "id", tokens(F.col("text")), fit(rows, "text")).first()["mean_nll"]
    assert loss == pytest.approx(refit_loss(["a b a"], 0))


def test_a_run_scored_by_left_out_losses(spark):
    rows = [(k, [("user", f"question {k} about things"), ("assistant", "answer " + "word " * (k + 3) + f"end{k}")]) for k in range(6)]
    frame = spark.createDataFrame(rows, "sample_id long, messages array<struct<role:string,content:string>>")
    config = load_config("llama_3_2_instruct").with_filters(min_tokens_per_turn=1, min_total_tokens=1, balanced_conversation_ratio=1.0)
    run = curate(frame, config, 3, scorer="ngram_perplexity_left_out", skip_deduplication=True)
    assert run.selected.count() == 3 and run.scored.agg(F.max("learning_value")).first()[0] == 1.0
    with pytest.raises(ValueError, match="leave_out"):
        curate(frame, config, 3, scorer="ngram_perplexity_left_out", token_budget=10, skip_deduplication=True)


@pytest.mark.parametrize("ngram", [1, 2, 3, 5])
def test_character_counts(spark, ngram):
    texts = ["Hello hello", "", None, "ab", "你好你好吗", "\U0001f600x\U0001f600x", "a" * 5000]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(2)
    got = {r["id"]: r["vector"] for r in hashed_vectors(rows, F.col("text"), "id", 64, ngram=ngram).collect()}
    for k, text in enumerate(texts):
        want, low = [0.0] * 64, (text or "").lower()
        for at in range(len(low) - ngram + 1):
            h = 0
            for c in low[at : at + ngram]:
                h = (h * GRAM_BASE + ord(c)) % GRAM_MODULUS
            want[h % 64] += 1
        assert list(got[k]) == want


def test_characters_find_what_words_miss(spark):
    rows = spark.createDataFrame(
        [(1, "colourful sentence without any mistake"), (2, "colorful sentense without any mistakes"), (3, "a wholly other text")],
        "id long, text string",
    )

    def kept(ngram):
        vectors = packed_vectors(rows, F.col("text"), "id", 512, ngram=ngram)
        return {r["id"] for r in kept_ids(vectors, "id", "vector", 0.75).collect()}

    assert kept(0) == {1, 2, 3} and kept(3) == {1, 3}
    with pytest.raises(ValueError, match="ngram"):
        load_config("llama_3_2_instruct").with_dedup(method="sparse", ngram=3)


def test_buckets_find_nearly_all_nearest_rows(spark):
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(60, 32))
    rows = [(k, (middle[k % 60] + 0.25 * rng.normal(size=32)).tolist()) for k in range(600)]
    rows += [(1000 + k, rows[0][1]) for k in range(50)] + [(2000, [0.0] * 32), (2001, None)]
    frame = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    _, exact = nearest_matches(frame, "id", "v", 0.9)
    _, found = hyperplane_matches(frame, "id", "v", 0.9, bands=16, bits=6, block_rows=20)
    want = {r["id"]: (r["match_id"], round(r["similarity"], 9)) for r in exact.collect()}
    got = {r["id"]: (r["match_id"], round(r["similarity"], 9)) for r in found.collect()}
    assert len(want) > 300 and set(got) <= set(want)
    assert sum(got.get(k) == v for k, v in want.items()) >= 0.97 * len(want)
    # What is found is a true partner, and never nearer than the nearest.
    assert all(0.9 <= got[k][1] <= want[k][1] for k in got)
    assert measured_recall(frame, "id", "v", 0.9, rows=300, bands=16, bits=6) >= 0.9
    assert hyperplane_matches(frame.limit(0), "id", "v", 0.9)[1].count() == 0


def test_a_second_batch_adds_only_its_rows(spark, tmp_path):
    config = load_config("llama_3_2_instruct").with_filters(min_tokens_per_turn=1, min_total_tokens=1, balanced_conversation_ratio=1.0)
    shape = "id long, messages array<struct<role:string,content:string>>"
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def arrive(ids):
        rows = [(k, [("user", "a question here"), ("assistant", "I cannot say" if k % 3 == 0 else "an answer")]) for k in ids]
        spark.createDataFrame(rows, shape).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        run_available(filter_stream(stream, config.quality_filters, "id"), sink, progress)
        return sorted(r["id"] for r in spark.read.schema(shape).parquet(sink).collect())

    assert arrive(range(10)) == [k for k in range(10) if k % 3]
    assert arrive(range(10, 15)) == [k for k in range(15) if k % 3]
    assert arrive([]) == [k for k in range(15) if k % 3]


def test_tokenizers_are_called_in_batches(spark):
    from gleaner.functions.plugins import message_counter, token_counter

    def load():
        class Many:
            def __call__(self, text):
                raise AssertionError("one text at a time")

            def batch(self, texts):
                assert all(t is not None for t in texts)
                return [t.split() for t in texts]

        return Many()

    rows = spark.createDataFrame([(1, "a b", ["x", None, "y z"]), (2, None, []), (3, "", None)], "id long, t string, m array<string>")
    for make in (load, lambda: str.split):
        got = rows.select("id", token_counter(make)(F.col("t")).alias("n"), message_counter(make)(F.col("m")).alias("ms")).collect()
        assert {r["id"]: (r["n"], r["ms"]) for r in got} == {1: (2, [1, 0, 2]), 2: (0, []), 3: (0, None)}
