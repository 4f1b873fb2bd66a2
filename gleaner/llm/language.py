"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import id_bucket, large_batches

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
FOLDS = 3
HELD_OUT = 1
# Languages are labels of a model, tens or hundreds; more would make the matrix too wide to send.
MOST_LANGUAGES = 2000
_END = 0x10FFFF + 1
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@dataclass(frozen=True)
class LanguageModel:
    """``log_probs`` has a row per language and one more column, of zeros, for no n-gram."""

    languages: tuple[str, ...]
    priors: np.ndarray
    log_probs: np.ndarray


def _symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, each followed by an end mark, and where each starts."""
    lowered = [(t or "").lower() for t in texts]
    lengths = np.array([len(t) for t in lowered], np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(int(starts[-1]), _END, np.uint32)
    body = np.ones(len(out), bool)
    body[starts[1:] - 1] = False
    out[body] = points
    return out, starts[:-1]


def _grams(symbols: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram at each position; ``BUCKETS`` where a text ends within it."""
    n = len(symbols) - order + 1
    if n <= 0:
        return np.full(len(symbols), BUCKETS, np.int32)
    h = np.full(n, np.uint32(0x27D4EB2F * order & 0xFFFFFFFF))
    ends = np.zeros(n, bool)
    for k in range(order):
        part = symbols[k : k + n]
        h = (h ^ (part * np.uint32(_MULTIPLIERS[k]))) * np.uint32(0x01000193 + 2 * k)
        ends |= part == _END
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    out = np.full(len(symbols), BUCKETS, np.int32)
    out[:n] = (h & np.uint32(BUCKETS - 1)).astype(np.int32)
    out[:n][ends] = BUCKETS
    return out


def fit_language(docs: DataFrame, held_out: int = HELD_OUT, folds: int = FOLDS) -> LanguageModel:
    """Count the n-grams of all rows with a language whose id is not in the held-out fold.

    Each task adds up one row of counts per language it meets; the rows are summed by language, so
    what reaches the driver is the model itself. Null ids, texts and languages are left out.
    """
    learn = docs.filter(
        (id_bucket(F.col("doc_id"), folds) != held_out) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).select(F.col("lang").alias("lang"), F.col("text").alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in large_batches(batches, size=4 << 20):
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in dict.fromkeys(langs.tolist()):
                own = batch.column("text").filter(pa.array(langs == lang)).to_pylist()
                symbols, _ = _symbols(own)
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS + 2, np.int64)
                for order in ORDERS:
                    sums[lang][: BUCKETS + 1] += np.bincount(_grams(symbols, order), minlength=BUCKETS + 1)
                sums[lang][BUCKETS] = 0
                sums[lang][BUCKETS + 1] += len(own)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at, pa.int64()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    counts = (
        learn.mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
        .orderBy("lang")
    )
    languages, rows, sizes = [], [], []
    for row in counts.toLocalIterator():
        if len(languages) == MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages; is 'lang' a language?")
        total = np.zeros(BUCKETS + 2)
        total[row["at"]] = row["n"]
        languages.append(row["lang"])
        sizes.append(total[BUCKETS + 1])
        smooth = total[:BUCKETS] + 0.5
        rows.append(np.append(np.log(smooth / smooth.sum()), 0.0))
    if not languages:
        return LanguageModel((), np.empty(0), np.empty((0, BUCKETS + 1)))
    priors = np.log(np.array(sizes) / sum(sizes))
    return LanguageModel(tuple(languages), priors, np.array(rows, np.float32))


def identify(texts: list[str | None], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """The index of the likeliest language of each text and its posterior probability."""
    symbols, starts = _symbols(texts)
    grams = np.concatenate([_grams(symbols, order)[:, None] for order in ORDERS], axis=1)
    scores = np.empty((len(model.languages), len(texts)))
    for k, log_prob in enumerate(model.log_probs):
        per_position = log_prob[grams].sum(axis=1, dtype=np.float64)
        scores[k] = np.add.reduceat(per_position, starts) + model.priors[k]
    best = scores.argmax(axis=0)
    posterior = 1 / np.exp(scores - scores.max(axis=0)).sum(axis=0)
    return best, posterior


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    ``score`` is the posterior probability of the prediction. A text that is null or has no letter
    gets ``und`` with score 0, as does every text if no row can be learned from. A null id is in no
    fold: it is neither learned from nor held out. Ties go to the first language by code point.
    """
    model = fit_language(docs)
    # Plain values: executors need not have this package installed to read them.
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.priors, model.log_probs))
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    given = docs.select("doc_id", F.when(known, F.col("text")).alias("text"))

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = LanguageModel(*sent.value)
        for batch in large_batches(batches, size=4 << 20):
            texts = batch.column("text").to_pylist()
            use = np.array([t is not None for t in texts]) & bool(held.languages)
            names, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if use.any():
                best, sure = identify([t for t, u in zip(texts, use, strict=True) if u], held)
                names[use] = np.array(held.languages, object)[best]
                score[use] = sure
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    schema = given.select("doc_id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    held_out = F.coalesce(id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return given.mapInArrow(predict, schema).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )
