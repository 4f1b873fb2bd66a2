import math

import pytest
from pyspark.sql import functions as F

import gleaner.operators.language_model as lm
import gleaner.operators.lookup as lookup
from gleaner.config import ScoringWeights
from gleaner.functions.plugins import encoder, map_batches, nll_scorer, token_counter
from gleaner.functions.scores import (
    as_percent,
    hash_uniform,
    perplexity,
    random_score,
    reduction,
    relative_improvement,
)
from gleaner.functions.tokens import tokens, within_budget
from gleaner.operators.compare import compare_losses, compare_with_random
from gleaner.operators.report import build_report, score_stats
from gleaner.operators.select import combine_scores, join_scores, random_sample, take_ranked, top_k

MESSAGES = "messages array<struct<role string, content string>>"


def scores(spark, pairs):
    return spark.createDataFrame(pairs, "sample_id long, final_score double")


def test_hash_score(spark):
    row = spark.range(7, 8).select(hash_uniform(F.col("id"), 42), random_score(F.col("id"))).first()
    assert row[0] == 1409445407 / 2**32
    assert row[1] == pytest.approx(0.3 + 0.7 * 1409445407 / 2**32)


def test_combine(spark):
    df = spark.createDataFrame([(1, 0.4, None), (2, 0.4, 0.0)], "k long, learning_value double, q double")
    w = ScoringWeights(0.5, 0.3, 0.2)
    got = [r["final_score"] for r in combine_scores(df, w, quality="q").collect()]
    assert got == [pytest.approx(0.7), pytest.approx(0.4)]
    other = spark.createDataFrame([(2, 5)], "k long, z int")
    assert {r["k"]: r["z"] for r in join_scores(df, other, "k", "z").collect()} == {1: None, 2: 5}


@pytest.mark.parametrize("small_k", [100, 0])
def test_top_k(spark, small_k):
    tied = scores(spark, [(3, 1.0), (1, 1.0), (2, 1.0)])
    assert {(r["sample_id"], r["rank"]) for r in top_k(tied, 2, small_k=small_k).collect()} == {(1, 1), (2, 2)}
    with pytest.warns(UserWarning, match="exceeds"):
        out = top_k(tied, 10, available=3, small_k=small_k)
    assert out.count() == 3
    for k in (0, -1):
        with pytest.raises(ValueError):
            top_k(tied, k, small_k=small_k)


def test_both_ways_of_ranking_agree(spark):
    df = spark.range(2000).select(
        F.col("id").alias("sample_id"), F.round(hash_uniform(F.col("id"), 1), 2).alias("final_score")
    )
    small = {tuple(r) for r in top_k(df.repartition(3), 700).select("sample_id", "rank").collect()}
    large = {tuple(r) for r in top_k(df.repartition(9), 700, small_k=1).select("sample_id", "rank").collect()}
    assert small == large and len(small) == 700
    order = [F.desc("final_score"), F.asc("sample_id")]
    fewer = {r["sample_id"] for r in take_ranked(df, order, 300).collect()}
    assert fewer <= {s for s, _ in small}


def test_random_sample(spark):
    ids = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id").distinct()
    fixed = {47, 19, 57, 8, 65}
    for df in (ids, ids.repartition(13)):
        assert {r[0] for r in random_sample(df, 5, id_col="conv_id").collect()} == fixed
        assert {r[0] for r in random_sample(df, 5, id_col="conv_id", small_k=1).collect()} == fixed
    assert random_sample(ids, 10**6, id_col="conv_id").count() == ids.count()


def test_scalar_scores(spark):
    row = spark.range(1).select(
        perplexity(F.lit(20.0)),
        perplexity(F.lit(0.0)),
        perplexity(F.lit(None).cast("double")),
        as_percent(reduction(F.lit(10000), F.lit(5000))),
        as_percent(reduction(F.lit(0), F.lit(0))),
        relative_improvement(F.lit(2.0), F.lit(1.5)),
        relative_improvement(F.lit(0.0), F.lit(1.5)),
        within_budget(F.split(F.lit("a b c"), " "), F.lit(2), 4),
        within_budget(F.split(F.lit("a b c"), " "), F.lit(9), 4),
    ).first()
    assert tuple(row) == (10000.0, 1.0, None, "50.00%", "100.00%", 25.0, 0.0, ["a", "b"], [])


def test_normalise(spark):
    df = spark.createDataFrame([(2.0,), (4.0,), (8.0,)], "perplexity double")
    assert sorted(r["learning_value"] for r in lm.normalised(df).collect()) == [0.25, 0.5, 1.0]
    zero = spark.createDataFrame([(0.0,)] * 3, "perplexity double")
    assert [r["learning_value"] for r in lm.normalised(zero).collect()] == [0.0] * 3
    assert lm.normalised(df.filter("false")).count() == 0


def expected_losses(corpus, texts, mix=0.5):
    """The model spelled out with dictionaries."""
    pairs, words, prevs = {}, {}, {}
    for text in corpus:
        prev = ""
        for w in text.split():
            pairs[prev, w] = pairs.get((prev, w), 0) + 1
            words[w] = words.get(w, 0) + 1
            prevs[prev] = prevs.get(prev, 0) + 1
            prev = w
    size = sum(words.values()) + len(words)
    out = {}
    for k, text in texts.items():
        prev, total, n = "", 0.0, 0
        for w in text.split():
            follow = pairs.get((prev, w), 0) / prevs[prev] if prev in prevs else 0.0
            total -= math.log(mix * follow + (1 - mix) * (words.get(w, 0) + 1) / size)
            prev, n = w, n + 1
        if n:
            out[k] = total / n
    return out


@pytest.mark.parametrize("broadcast_rows", [20000, 2])
def test_language_model(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(lm, "BROADCAST_ROWS", broadcast_rows)
    long = "x" * 100
    corpus = ["the cat sat", "the cat ran", f"a dog ran the cat {long}", "the the the the the cat"]
    texts = {1: "the cat sat", 2: f"new words ran {long}", 3: "", 4: "the the dog dog dog zzz zzz zzz"}
    model = lm.fit(spark.createDataFrame([(c,) for c in corpus], "content string"), "content")
    rows = spark.createDataFrame(list(texts.items()), "k long, t string")
    got = {r["k"]: r["mean_nll"] for r in lm.mean_nll(rows, "k", tokens(F.col("t")), model, False).collect()}
    assert got == pytest.approx(expected_losses(corpus, texts))
    known = dict(enumerate(corpus))
    rows = spark.createDataFrame(list(known.items()), "k long, t string")
    got = {r["k"]: r["mean_nll"] for r in lm.mean_nll(rows, "k", tokens(F.col("t")), model, True).collect()}
    assert got == pytest.approx(expected_losses(corpus, known))
    per_text = expected_losses(corpus, known)
    sizes = {k: len(t.split()) for k, t in known.items()}
    mean = sum(per_text[k] * sizes[k] for k in sizes) / sum(sizes.values())
    assert model.cross_entropy().first()[0] == pytest.approx(mean)


@pytest.mark.parametrize("all_seen", [False, True])
def test_texts_are_cut_once_and_open_pairs_alone_are_shuffled(spark, monkeypatch, all_seen):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 40)
    monkeypatch.setattr(lm, "BROADCAST_ROWS", 40)
    corpus = [" ".join(f"w{(k * k + 3 * j) % (7 + 9 * k)}" for j in range(30)) for k in range(12)]
    texts = dict(enumerate(corpus))
    if not all_seen:
        # A pair that the model lacks, one that it has once, and a rare word after an unknown one.
        texts = {k: f"{t} new1 new2 {corpus[-1][:9]} zz {corpus[-1].split()[-1]} " + "new1 new2 " * 200 for k, t in texts.items()}
        texts[50] = ""
    model = lm.fit(spark.createDataFrame([(c,) for c in corpus], "content string"), "content")
    assert model.pair_rows > 40 and model.vocabulary > 40
    cut = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        cut.add(1)
        return text

    rows = spark.createDataFrame(list(texts.items()), "k long, t string")
    parts = lm._explode_pairs(rows, tokens(F.col("t")), "k")
    n = parts.count()
    settled = lm._settled(parts, "k", model, lm.staged(model.pairs.withColumnRenamed("n", "pair_n"), "t"), all_seen)
    still_open = settled.filter("word IS NOT NULL")
    assert 0 < still_open.count() < n / 2 and settled.agg(F.sum("c")).first()[0] == n
    rows = rows.select("k", read("t").alias("t"))
    got = {r["k"]: r["mean_nll"] for r in lm.mean_nll(rows, "k", tokens(F.col("t")), model, all_seen).collect()}
    assert got == pytest.approx(expected_losses(corpus, texts))
    assert cut.value == len(texts)


def test_frequent_keys_fit_a_broadcast(spark, monkeypatch):
    table = spark.createDataFrame([(n,) for n in [1] * 50 + [2] * 6 + [3] * 4 + [4, 9]], "n long")
    for limit, least in ((100, 1), (62, 1), (61, 2), (12, 2), (11, 4), (2, 4), (1, 8), (0, 16)):
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", limit)
        assert lookup.frequent_from(table, "n") == least
    assert lookup.frequent_from(table.limit(0), "n") == 1


def test_learning_values(spark):
    rows = [
        (1, [("user", "a b"), ("assistant", "c d")]),
        (2, [("user", "a b"), ("assistant", "a b"), ("user", "thanks")]),
        (3, [("assistant", "c c c d")]),
        (4, [("user", "a"), ("assistant", "")]),
        (5, []),
    ]
    df = spark.createDataFrame(rows, f"sample_id long, {MESSAGES}")
    got = {r["sample_id"]: r for r in lm.learning_values(df, "sample_id").collect()}
    assert {k for k, r in got.items() if r["perplexity"] == 0.0} == {2, 4, 5}
    corpus = [m[1] for _, messages in rows for m in messages]
    losses = expected_losses(corpus, {1: "c d", 3: "c c c d"})
    for k, loss in losses.items():
        assert got[k]["perplexity"] == pytest.approx(math.exp(loss))
    assert max(r["learning_value"] for r in got.values()) == 1.0
    # All of the budget goes to the context of row 1; of row 3, context 7 tokens, two fit.
    cut = {r["sample_id"]: r["perplexity"] for r in lm.learning_values(df, "sample_id", token_budget=10).collect()}
    assert cut[1] == 0.0 and cut[3] > 0.0 and cut[3] != got[3]["perplexity"]


def test_statistics_and_report(spark):
    stats = score_stats(scores(spark, [(i, float(i)) for i in (1, 2, 3, 4)]))
    assert stats.first()["std"] == pytest.approx(1.118034, abs=1e-6)
    row = build_report(stats, "mine", 10000, 8500, 7200, 5000, "now").first()
    assert row["reduction_percentage"] == "50.00%" and row["note"] is None
    assert row["final_scores_stats"]["max"] == 4.0 and row["validation_results"] is None
    row = build_report(score_stats(scores(spark, [])), "mine", 4, 0, 0, 0).first()
    assert row["reduction_percentage"] == "100.00%" and row["note"] and row["final_scores_stats"] is None


def test_comparison(spark):
    def side(x):
        return spark.createDataFrame([(x,)], "loss double")

    assert tuple(compare_losses(side(2.0), side(1.5)).first()) == (2.0, 1.5, 25.0)
    assert compare_losses(side(0.0), side(1.5)).first()[2] == 0.0
    rows = [(i, [("user", f"w{i} common words here"), ("assistant", "common words here")]) for i in range(8)]
    df = spark.createDataFrame(rows, f"sample_id long, {MESSAGES}")
    whole = compare_with_random(df, df, 8, 20).first()
    assert whole["baseline_loss"] == pytest.approx(whole["optimized_loss"]) and whole[2] == pytest.approx(0.0)


def test_user_functions(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "k long, t string")
    assert [r[0] for r in df.select(token_counter(lambda: str.split)(F.col("t"))).collect()] == [3, 0]

    def load_encoder():
        return lambda texts: [[len(t), 1.0] for t in texts]

    assert [r[0] for r in df.select(encoder(load_encoder)(F.col("t"))).collect()] == [[5.0, 1.0], [0.0, 1.0]]

    def load_scorer():
        return lambda contexts, responses: [len(c) + 10.0 * len(r) for c, r in zip(contexts, responses)]

    assert [r[0] for r in df.select(nll_scorer(load_scorer)(F.col("t"), F.lit("x"))).collect()] == [15.0, 10.0]
    doubled = map_batches(df, lambda b: b[["k"]] * 2, "k long")
    assert sorted(r[0] for r in doubled.collect()) == [2, 4] and doubled.columns == ["k"]
