"""Bigram language model fitted and applied by counting and joining.

A message is a sequence of tokens after a start mark. In a rendered conversation that mark is the
opening of the message, which is also what precedes a response in its context. The probability of
``word`` after ``prev`` mixes its share among the followers of ``prev`` with an add-one unigram
estimate, so unseen pairs and words keep some mass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.scores import perplexity
from gleaner.functions.template import CHATML, ChatTemplate, context_messages, response_message
from gleaner.functions.tokens import tokens, within_budget
from gleaner.operators.bitmap import may_be_in
from gleaner.operators.lookup import BROADCAST_ROWS, count_lookup, frequent_from
from gleaner.stage import staged

START = ""
PAIR = ["prev", "word"]
MIX = 0.5
# Longer words are counted under their md5, so that a row of counts has a bounded size.
LONG_WORD = 32


def pairs_of(token_array: Column) -> Column:
    """``(prev, word)`` for every token, and a last entry without a word.

    The outer one-element transform binds the tokens, so the text is split once.
    """
    start = F.array(F.lit(START))
    return F.transform(
        F.array(token_array), lambda found: F.arrays_zip(F.concat(start, found), found)
    )[0]


@dataclass(frozen=True)
class BigramModel:
    """``pairs``: prev, word, n, prev_n, word_n, nll. ``words``: word, n. Plus their sizes."""

    pairs: DataFrame
    words: DataFrame
    total: int
    vocabulary: int
    pair_rows: int
    mix: float

    def cross_entropy(self) -> DataFrame:
        """Token-weighted mean loss of the corpus the model was fitted on, one row."""
        loss = F.try_divide(F.sum(F.col("n") * F.col("nll")), F.sum("n"))
        return self.pairs.agg(F.coalesce(loss, F.lit(0.0)).alias("loss"))


def _explode_pairs(df: DataFrame, token_array: Column, *keep: str) -> DataFrame:
    def short(name: str) -> Column:
        w = F.col(name)
        hashed = F.concat(F.lit("#"), F.md5(w))
        return F.when(F.length(w) > LONG_WORD, hashed).otherwise(w).alias(name)

    found = F.inline(pairs_of(token_array)).alias(*PAIR)
    rows = df.select(*keep, found).filter(F.col("word").isNotNull())
    return rows.select(*keep, short("prev"), short("word"))


def fit(corpus: DataFrame, text: str, mix: float = MIX) -> BigramModel:
    """Fit on every text of ``corpus``; one pass over it, combined map-side."""
    seen = _explode_pairs(corpus.select(text), tokens(F.col(text)))
    counts = staged(seen.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n")), "pairs")
    words = staged(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    starts = counts.groupBy("prev").agg(F.sum("n").alias("prev_n"))
    total, vocabulary = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    ).first()
    pair_rows = counts.count()
    word_n = words.withColumnRenamed("n", "word_n")
    # There are at most as many prevs as words, and the start mark.
    joined = count_lookup(counts, word_n, ["word"], "word_n", vocabulary, total)
    joined = count_lookup(joined, starts, ["prev"], "prev_n", vocabulary + 1, total)
    chance = F.lit(mix) * F.col("n") / F.col("prev_n") + F.lit(1.0 - mix) * (
        F.col("word_n") + 1
    ) / F.lit(float(max(total + vocabulary, 1)))
    pairs = joined.select("prev", "word", "n", "prev_n", "word_n", (-F.log(chance)).alias("nll"))
    return BigramModel(pairs, words, total, vocabulary, pair_rows, mix)


def mean_nll(
    responses: DataFrame, id_col: str, token_array: Column, model: BigramModel, all_seen: bool
) -> DataFrame:
    """``id_col`` and ``mean_nll`` of each response that has tokens.

    ``all_seen`` states that the responses are part of the model's corpus, so that every pair is
    known and no pair is more frequent in the responses than the model's counts say.
    """
    parts = _explode_pairs(responses, token_array, id_col)
    known = model.pairs.select("prev", "word", F.col("n").alias("pair_n"), "nll")
    if model.pair_rows <= BROADCAST_ROWS:
        # A small model is broadcast whole, words and pairs.
        scored = count_lookup(parts, known, PAIR, "pair_n", model.pair_rows, model.total)
        if not all_seen:
            words = model.words.withColumnRenamed("n", "word_n")
            scored = count_lookup(scored, words, ["word"], "word_n", model.vocabulary, model.total)
            scored = scored.withColumn("nll", F.coalesce("nll", _unseen_loss(model)))
        return scored.groupBy(id_col).agg(F.avg("nll").alias("mean_nll"))
    losses = staged(known, "losses")
    held = staged(_settled(parts, id_col, model, losses, all_seen), "settled")
    open_pairs = held.filter("word IS NOT NULL").drop("loss")
    if all_seen:
        # Pairs left open are rare in the corpus, and so here.
        found = open_pairs.join(losses, PAIR, "left")
    else:
        found = count_lookup(open_pairs, *_losses_of(open_pairs, model, losses))
    looked_up = found.select(id_col, "c", (F.col("c") * F.col("nll")).alias("loss"))
    sums = held.filter("word IS NULL").select(id_col, "c", "loss").unionByName(looked_up)
    return sums.groupBy(id_col).agg((F.sum("loss") / F.sum("c")).alias("mean_nll"))


def _settled(
    parts: DataFrame, id_col: str, model: BigramModel, losses: DataFrame, all_seen: bool
) -> DataFrame:
    """``id_col``, ``prev``, ``word``, and their count ``c`` and ``loss``, from one pass over the tokens.

    Tokens whose loss the broadcast tables tell are summed up in a row without a pair. Those are the pairs
    frequent in the model, and pairs that its bitmap rules out if the word's count is known. Only the other
    pairs, at most one row of each per text, have to be looked up by a shuffle.
    """
    common = losses.filter(F.col("pair_n") >= frequent_from(losses, "pair_n")).select(*PAIR, "nll")
    known = parts.join(F.broadcast(common), PAIR, "left")
    if not all_seen:
        whole = model.vocabulary <= BROADCAST_ROWS
        words = model.words if whole else model.words.filter(F.col("n") >= frequent_from(model.words, "n"))
        words = words.select(F.col("word").alias("known_word"), F.col("n").alias("word_n"))
        # Each lookup is only for the tokens that those before it left open.
        known = may_be_in(known, losses, PAIR, model.pair_rows, "pair_known", F.col("nll").isNull())
        unseen = F.col("nll").isNull() & ~F.col("pair_known")
        known = known.join(F.broadcast(words), F.when(unseen, F.col("word")) == F.col("known_word"), "left")
        if not whole:
            rare = unseen & F.col("word_n").isNull()
            known = may_be_in(known, model.words, ["word"], model.vocabulary, "word_known", rare)
            unseen &= ~F.col("word_known")
        known = known.withColumn("nll", F.coalesce("nll", F.when(unseen, _unseen_loss(model))))
    left_open = [F.when(F.col("nll").isNull(), F.col(name)).alias(name) for name in PAIR]
    rows = known.select(id_col, *left_open, "nll")
    return rows.groupBy(id_col, *PAIR).agg(F.count(F.lit(1)).alias("c"), F.sum("nll").alias("loss"))


def mean_nll_left_out(
    responses: DataFrame, id_col: str, token_array: Column, model: BigramModel
) -> DataFrame:
    """Like ``mean_nll`` for responses of the model's corpus, each judged by a model without itself.

    A response's own pairs and words are taken off the counts, and the words that only it has off the
    vocabulary; so no text vouches for itself, and copies of it elsewhere still do.
    """
    own = _explode_pairs(responses, token_array, id_col).groupBy(id_col, *PAIR).agg(F.count("*").alias("c"))
    known = model.pairs.select("prev", "word", F.col("n").alias("pair_n"), "prev_n", "word_n")
    found = count_lookup(own, known, PAIR, "pair_n", model.pair_rows, model.total)
    # The windows hold the different pairs of one response.
    of_row, of_prev, of_word = (Window.partitionBy(id_col, *more) for more in ([], ["prev"], ["word"]))
    parts = found.select(
        "*",
        F.sum("c").over(of_row).alias("own_total"),
        F.sum("c").over(of_prev).alias("own_prev"),
        F.sum("c").over(of_word).alias("own_word"),
    )
    only_here = F.when(F.col("word_n") == F.col("own_word"), F.col("c") / F.col("own_word"))
    parts = parts.withColumn("own_vocabulary", F.round(F.coalesce(F.sum(only_here).over(of_row), F.lit(0.0))))
    followers = F.col("prev_n") - F.col("own_prev")
    share = F.when(followers > 0, (F.col("pair_n") - F.col("c")) / followers).otherwise(F.lit(0.0))
    room = F.greatest(F.lit(model.total + model.vocabulary) - F.col("own_total") - F.col("own_vocabulary"), F.lit(1.0))
    chance = F.lit(model.mix) * share + F.lit(1.0 - model.mix) * (F.col("word_n") - F.col("own_word") + 1) / room
    loss = F.sum(F.col("c") * -F.log(chance)) / F.sum("c")
    return parts.groupBy(id_col).agg(loss.alias("mean_nll"))


def _unseen_loss(model: BigramModel) -> Column:
    """Loss of a pair the model does not have, from ``word_n``, null for a new word."""
    floor = math.log(max(model.total + model.vocabulary, 1)) - math.log(1.0 - model.mix)
    return F.lit(floor) - F.log(F.coalesce(F.col("word_n"), F.lit(0)) + 1)


def _losses_of(
    parts: DataFrame, model: BigramModel, losses: DataFrame
) -> tuple[DataFrame, list[str], str, int, int]:
    """The loss of every pair that occurs in ``parts``, with its number of rows there, for ``count_lookup``.

    Counting the pairs first makes the joins to the model run over distinct keys, whatever pair the
    texts repeat that is rare in the model.
    """
    counts = staged(parts.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("rows")), "pairs")
    model_words = model.words.withColumnRenamed("n", "word_n")
    own_words = counts.groupBy("word").agg(F.sum("rows").alias("own_n"))
    words = staged(own_words.join(model_words, "word", "left"), "words")
    total, vocabulary = words.agg(F.coalesce(F.sum("own_n"), F.lit(0)), F.count(F.lit(1))).first()
    known = counts.join(losses.select(*PAIR, "nll"), PAIR, "left")
    joined = count_lookup(known, words, ["word"], "own_n", vocabulary, total)
    loss = F.coalesce("nll", _unseen_loss(model)).alias("nll")
    held = staged(joined.select(*PAIR, "rows", loss), "losses")
    return held, PAIR, "rows", held.count(), total


def response_tokens(
    messages: Column, template: ChatTemplate = CHATML, token_budget: int | None = None
) -> Column:
    """Tokens of the final message, if an assistant wrote it; otherwise none.

    With a budget, context and response share it, and what does not fit is left out.
    """
    last = response_message(messages)
    found = tokens(last["content"])
    if token_budget is not None:
        context = template.count_rendered(context_messages(messages)) + F.lit(
            template.prompt_tokens
        )
        found = within_budget(found, context, token_budget)
    return F.when(last["role"] == "assistant", found).otherwise(F.array().cast("array<string>"))


def learning_values(
    conversations: DataFrame,
    id_col: str,
    messages: str = "messages",
    corpus: DataFrame | None = None,
    corpus_text: str = "content",
    template: ChatTemplate = CHATML,
    token_budget: int | None = None,
    mix: float = MIX,
    leave_out: bool = False,
) -> DataFrame:
    """``id_col``, ``perplexity`` and ``learning_value`` for every conversation.

    The model is fitted on ``corpus``, by default on all messages of the conversations. Conversations
    without a final assistant message, or without tokens in it, score 0. With ``leave_out`` each final
    message is judged by the model of all others; a corpus of its own and a token budget rule that out.
    """
    if leave_out and (corpus is not None or token_budget is not None):
        raise ValueError("leave_out needs whole messages of the corpus itself")
    own = corpus is None
    if own:
        corpus = conversations.select(F.explode(messages).alias("m")).select(
            F.col("m.content").alias(corpus_text)
        )
    model = fit(corpus, corpus_text, mix)
    found = response_tokens(F.col(messages), template, token_budget)
    if leave_out:
        losses = mean_nll_left_out(conversations, id_col, found, model)
    else:
        losses = mean_nll(conversations, id_col, found, model, all_seen=own)
    return normalised(with_perplexity(conversations.select(id_col), losses, id_col))


def with_perplexity(ids: DataFrame, losses: DataFrame, id_col: str) -> DataFrame:
    joined = ids.join(losses, id_col, "left")
    return joined.select(
        id_col, F.coalesce(perplexity(F.col("mean_nll")), F.lit(0.0)).alias("perplexity")
    )


def normalised(
    df: DataFrame, column: str = "perplexity", out: str = "learning_value"
) -> DataFrame:
    """Divide by the largest value of the whole column; all zeros stay zeros."""
    held = staged(df, "scores")
    top = held.agg(F.max(column)).first()[0]
    return held.withColumn(out, F.col(column) / F.lit(top) if top else F.lit(0.0))
