"""Hooks for user code: a tokenizer, an encoder, a language-model scorer, a batch map.

Each takes a ``load`` function without arguments. It runs in the Python worker, once per worker for
the tokenizer and once per task for the models, so nothing heavy is pickled with the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def token_counter(load: Callable[[], Callable[[str], Sequence]]) -> Callable[[Column], Column]:
    """Count tokens with the user's tokenizer: ``load()`` returns text -> sequence of tokens.

    A tokenizer with an attribute ``batch`` (list of texts -> list of sequences) is called once per batch.
    """

    @F.pandas_udf("int")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = _batch_sizes(load())
        for batch in texts:
            yield pd.Series(sizes(batch.tolist()), dtype="int32")

    return count


def _batch_sizes(encode: Callable) -> Callable[[list[str | None]], np.ndarray]:
    """Numbers of tokens of many texts, by one call where the tokenizer takes many; 0 for null."""
    many = getattr(encode, "batch", None) or (lambda texts: [encode(t) for t in texts])

    def sizes(texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts), np.int32)
        given = [k for k, t in enumerate(texts) if t is not None]
        if given:
            out[given] = [len(found) for found in many([texts[k] for k in given])]
        return out

    return sizes


def message_counter(load: Callable[[], Callable[[str], Sequence]]) -> Callable[[Column], Column]:
    """The same for an array of texts, such as ``messages.content``: one count per entry."""

    @F.pandas_udf("array<int>")
    def count(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = _batch_sizes(load())
        for batch in lists:
            # All messages of a batch at once; rows without messages stay null.
            held = [None if texts is None else list(texts) for texts in batch]
            found = sizes([t for texts in held if texts is not None for t in texts])
            ends = np.cumsum([0 if texts is None else len(texts) for texts in held])
            yield pd.Series(
                [None if t is None else found[end - len(t) : end].tolist() for t, end in zip(held, ends.tolist(), strict=True)],
                dtype=object,
            )

    return count


def encoder(load: Callable[[], Callable[[list[str]], np.ndarray]]) -> Callable[[Column], Column]:
    """Turn texts to vectors: ``load()`` returns list of texts -> float matrix."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in texts:
            matrix = np.asarray(model(batch.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(matrix))

    return encode


def nll_scorer(
    load: Callable[[], Callable[[list[str], list[str]], Sequence[float]]],
) -> Callable[[Column, Column], Column]:
    """Mean negative log-likelihood of responses: ``load()`` returns (contexts, responses) -> numbers."""

    @F.pandas_udf("double")
    def score(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for contexts, responses in pairs:
            values = model(contexts.fillna("").tolist(), responses.fillna("").tolist())
            yield pd.Series(np.asarray(values, dtype=np.float64))

    return score


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Apply ``fn`` to batches of rows; the output has the columns of ``schema`` only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)
