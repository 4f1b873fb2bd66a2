"""Quality by compression: dictionaries of good and of bad text, and what each saves on a text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import id_bucket, large_batches, small_batches

# The fit reads at most so many labelled texts of each class, none longer than TEXT_CHARS. Half of
# them build the dictionaries, the other half fit the score.
CLASS_SAMPLE = 3000
TEXT_CHARS = 50_000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
# Texts meet the dictionaries in pieces, so that a text's own repeats do not drown what they know.
PIECE_BYTES = 256
RIDGE = 0.03
FOLDS = 5
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries (empty: none) and the logistic weights over the standardised sizes."""

    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


def _pieces(text: bytes) -> list[bytes]:
    return [text[at : at + PIECE_BYTES] for at in range(0, len(text), PIECE_BYTES)]


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; few samples are one themselves, as zstandard cannot train on them."""
    try:
        pieces = [piece for text in samples for piece in _pieces(text)]
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False
    )


def compressed_sizes(texts: Iterable[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """Per text: size of its pieces under the good and the bad dictionary, whole without, and plain."""
    with_good, with_bad, without = _compressor(good), _compressor(bad), _compressor(b"")
    rows = []
    for text in texts:
        text = bytes(text)
        pieces = _pieces(text)
        rows.append(
            (
                sum(len(with_good.compress(p)) for p in pieces),
                sum(len(with_bad.compress(p)) for p in pieces),
                len(without.compress(text)),
                len(text),
            )
        )
    return np.array(rows, np.float64).reshape(-1, 4)


def _features(sizes: np.ndarray) -> np.ndarray:
    """The normalised difference, the rates of compression and the length, with their squares."""
    good, bad, alone, plain = sizes.T
    base = np.stack(
        [
            (bad - good) / (bad + good + 1),
            np.log((good + 10) / (plain + 10)),
            np.log((alone + 10) / (plain + 10)),
            np.log(plain + 1),
        ],
        axis=1,
    )
    return np.concatenate([base, base**2], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted, slightly regularised logistic regression by Newton steps that never go uphill."""
    design = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(design.shape[1])
    ridge = RIDGE * np.eye(len(w))

    def loss(v: np.ndarray) -> float:
        margin = design @ v
        return float((weight * (np.logaddexp(0, margin) - y * margin)).sum() + v @ ridge @ v / 2)

    current = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        slope = design.T @ (weight * (y - p)) - ridge @ w
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(curve, slope)
        while (after := loss(w + step)) > current and np.abs(step).max() > 1e-9:
            step /= 2
        if not after < current - 1e-9:
            break
        w, current = w + step, after
    return w


def fit_quality(docs: DataFrame, labels: DataFrame, held_out_fold: int = 0, folds: int = FOLDS) -> QualityModel:
    """Fit on labelled rows whose id is not in the held-out fold.

    Each class gives the rows with the smallest id hashes, ``CLASS_SAMPLE`` at most. The classes count
    in the score by how often all labelled rows have them. Null labels, ids and texts are left out.
    With one class or none, every score is that class's share (0.5 without labels).
    """
    small_batches(docs.sparkSession)
    learn = labels.filter(
        (id_bucket(F.col("doc_id"), folds) != held_out_fold) & F.col("quality").isin(0, 1)
    ).select("doc_id", F.col("quality").alias("label"))
    totals = {r["label"]: r["n"] for r in learn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    spread = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [
        learn.filter(F.col("label") == c).orderBy(spread, "doc_id").limit(CLASS_SAMPLE) for c in (0, 1)
    ]
    sample = (
        docs.filter((F.length("text") > 0) & (F.length("text") <= TEXT_CHARS))
        .select("doc_id", F.col("text"))
        .join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
        .orderBy(spread, "doc_id", "text", "label")
        .limit(2 * CLASS_SAMPLE)
    )
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sample.toLocalIterator():
        texts[row["label"]].append(row["text"].encode())
    share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2) if totals else 0.5
    if min(map(len, texts.values())) < 2:
        odds = float(np.log(share / (1 - share)))
        return QualityModel(b"", b"", (0.0,) * 8, (1.0,) * 8, (odds, *(0.0,) * 8))
    good, bad = _dictionary(texts[1][::2]), _dictionary(texts[0][::2])
    fit = [(t, c) for c in (0, 1) for t in texts[c][1::2]]
    x = _features(compressed_sizes([t for t, _ in fit], good, bad))
    y = np.array([c for _, c in fit], np.float64)
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum()) * len(y)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = _logistic((x - centre) / scale, y, weight)
    return QualityModel(good, bad, tuple(centre), tuple(scale), tuple(w))


def text_scores(column: pa.Array, model: QualityModel) -> np.ndarray:
    """The probability (0 to 1) that each text is good. Whole texts are compressed; null is empty."""
    texts = (t.as_buffer() if t.is_valid else b"" for t in column)
    x = (_features(compressed_sizes(texts, model.good, model.bad)) - np.array(model.centre)) / np.array(model.scale)
    z = model.weights[0] + x @ np.array(model.weights[1:])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    ``predicted`` is 1 from a score of ``THRESHOLD`` on. A null id is in no fold, so not held out;
    an empty table gives no rows; labels may repeat or be absent. Other columns are not read.
    """
    model = fit_quality(docs, labels)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in large_batches(batches, release=True):
            value = pa.array(text_scores(batch.column("text"), model), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), value], names=["doc_id", "score"])

    given = docs.select("doc_id", "text")
    scored = given.mapInArrow(score, given.select("doc_id", F.lit(0.0).alias("score")).schema)
    held_out = F.coalesce(id_bucket(F.col("doc_id"), FOLDS) == 0, F.lit(False))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    model = fit_quality(docs, labels)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in large_batches(batches, release=True):
            yield batch.filter(pa.array(text_scores(batch.column("text"), model) >= THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
