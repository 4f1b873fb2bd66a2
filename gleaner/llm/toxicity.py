"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled, noisy-or joins the two."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import id_bucket, large_batches, small_batches
from gleaner.stage import staged

# The fit reads at most so many labelled texts of each class, none longer than TEXT_CHARS.
CLASS_SAMPLE = 5000
TEXT_CHARS = 50_000
# Words are known by their n-grams of characters, with a mark for the word's ends.
ORDERS = (3, 4, 5, 6, 7)
BUCKET_BITS = 19
BUCKETS = 1 << BUCKET_BITS
# An n-gram is used if it is in so many sampled texts and tells the classes apart (chi-squared).
LEAST_TEXTS = 3
LEAST_LIFT = 20.0
MOST_GRAMS = 8192
# Longer sentences are cut.
SENTENCE_CHARS = 400
FOLDS = 3
HELD_OUT = 1
THRESHOLD = 0.7
# A sentence from this probability on is reported as offending.
OFFENDING = 0.5
# Log-odds of a sentence before its n-grams speak.
BIAS = -6.0
STEPS = 250
STEP_SIZE = 0.1
SPARSITY = 0.3
_ENDS = ".!?\n。！？"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_LETTERS: list[np.ndarray] = []


@dataclass(frozen=True)
class ToxicityModel:
    """``weights`` of the n-gram ``buckets``, and the ``leak``: the rate (-log(1 - p)) at which a document
    is labelled for no sentence of its own."""

    buckets: np.ndarray
    weights: np.ndarray
    leak: float


@dataclass
class Pieces:
    """The sentences of some texts, one after the other: their texts and where in these they lie."""

    text_of: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    texts: int


def _letters() -> np.ndarray:
    """Which code points are letters or digits; made once in a worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(k).isalnum() for k in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _lower(text: str) -> str:
    """Lower case, code point by code point where the whole would change its length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(k if len(k) == 1 else c for c in text for k in [c.lower()])


def split(texts: list[str | None]) -> tuple[np.ndarray, Pieces, np.ndarray]:
    """The symbols of all texts (0 for what is no letter or digit), their sentences, and the sentence of each symbol.

    Sentences end at full stops, exclamation and question marks and line ends, and after ``SENTENCE_CHARS``.
    A sentence end counts as the start of the next sentence, and every text is followed by a 0.
    """
    lowered = [_lower(t or "") for t in texts]
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) + 1 for t in lowered], np.int64)
    begins = np.cumsum(lengths) - lengths
    symbols = np.where(_letters()[points], points, 0)
    is_start = np.isin(points, np.array([ord(c) for c in _ENDS], np.uint32))
    is_start[begins] = True
    starts = np.flatnonzero(is_start)
    sizes = np.diff(np.append(starts, len(points)))
    cuts = -(-sizes // SENTENCE_CHARS)
    first = np.repeat(starts, cuts)
    step = np.arange(len(first)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    starts = first + step * SENTENCE_CHARS
    sizes = np.diff(np.append(starts, len(points)))
    text_of = np.searchsorted(begins, starts, side="right") - 1
    sentence = np.repeat(np.arange(len(starts)), sizes)
    return symbols, Pieces(text_of, starts - begins[text_of], sizes, len(texts)), sentence


def grams(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, where n-grams without a word's end inside start, and their buckets."""
    h = symbols.astype(np.uint64)
    values, size = h, len(h)
    # How many word symbols follow each position without a break.
    breaks = np.where(symbols != 0, size, np.arange(size))
    follow = np.minimum.accumulate(breaks[::-1])[::-1][1:] - np.arange(1, size)
    for order in range(2, max(ORDERS) + 1):
        n = size - order + 1
        if n <= 0:
            return
        h = h[:n] * _BASE + values[order - 1 :]
        if order in ORDERS:
            at = np.flatnonzero(follow[:n] >= order - 2)
            mixed = (h[at] ^ np.uint64(order)) * _SPREAD
            mixed ^= mixed >> np.uint64(29)
            mixed *= _BASE
            yield at, (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _found(symbols: np.ndarray, sentence: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentence and number of the chosen n-grams that occur, each once a sentence. ``place``: number by bucket, or -1."""
    width = int(place.max()) + 2
    pairs = []
    for at, bucket in grams(symbols):
        number = place[bucket]
        hit = np.flatnonzero(number >= 0)
        pairs.append(sentence[at[hit]] * width + number[hit])
    both = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
    return both // width, both % width


def _places(buckets: np.ndarray) -> np.ndarray:
    place = np.full(BUCKETS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    return place


def sentence_rates(weight: np.ndarray) -> np.ndarray:
    """-log(1 - p) of sentences whose n-grams weigh so much; 0 without a net weight towards toxic.

    So a text does not become suspicious by its length.
    """
    return np.maximum(np.logaddexp(0, BIAS + weight) - np.logaddexp(0, BIAS), 0)


def sentence_scores(texts: list[str | None], model: ToxicityModel, place: np.ndarray) -> tuple[Pieces, np.ndarray]:
    """The sentences of some texts and the rates that the weights of their different n-grams give."""
    symbols, pieces, sentence = split(texts)
    rows, columns = _found(symbols, sentence, place)
    return pieces, sentence_rates(np.bincount(rows, model.weights[columns], minlength=len(pieces.starts)))


def document_scores(pieces: Pieces, rates: np.ndarray, model: ToxicityModel) -> np.ndarray:
    """Noisy-or: the probability that any sentence, or the leak, makes the document toxic."""
    return -np.expm1(-(np.bincount(pieces.text_of, rates, minlength=pieces.texts) + model.leak))


def train(rows: np.ndarray, columns: np.ndarray, text_of: np.ndarray, labels: np.ndarray, buckets: np.ndarray) -> ToxicityModel:
    """Fit n-gram weights and leak to document labels by gradient steps on the noisy-or likelihood.

    ``rows, columns``: sentences and numbers of the n-grams in them. Weights shrink by a constant
    (proximal) amount, so n-grams that do not help end at zero.
    """
    count = len(text_of)
    weights, leak = np.zeros(len(buckets)), float(np.log(np.clip(labels.mean(), 1e-4, 0.9) / 10))
    first, second = np.zeros(len(buckets) + 1), np.zeros(len(buckets) + 1)
    for step in range(1, STEPS + 1):
        weight = np.bincount(rows, weights[columns], minlength=count)
        total = np.bincount(text_of, sentence_rates(weight), minlength=len(labels)) + np.logaddexp(0, leak)
        # Of the loss -log P(label) by the sum of rates: 1 for clean texts, -1 / (e^rate - 1) for toxic ones.
        pull = np.where(labels > 0, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-9), 1.0)
        by_sentence = pull[text_of] * (weight >= 0) / (1 + np.exp(-BIAS - weight))
        slope = np.append(
            np.bincount(columns, by_sentence[rows], minlength=len(buckets)), pull.sum() / (1 + np.exp(-leak))
        )
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        rate = STEP_SIZE / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        move = rate * first / (1 - 0.9**step)
        weights, leak = weights - move[:-1], leak - move[-1]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - SPARSITY * rate[:-1], 0)
    kept = np.abs(weights) > 1e-3
    return ToxicityModel(buckets[kept], weights[kept], float(np.logaddexp(0, leak)))


def labelled_texts(docs: DataFrame, labels: DataFrame, held_out: int = HELD_OUT, folds: int = FOLDS) -> DataFrame:
    """``doc_id, text, label`` to learn from: of each class the rows with the smallest id hashes, outside the held-out fold."""
    learn = labels.filter(
        (id_bucket(F.col("doc_id"), folds) != held_out) & F.col("toxic").isin(0, 1)
    ).select("doc_id", F.col("toxic").cast("int").alias("label"))
    spread = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [learn.filter(F.col("label") == c).orderBy(spread, "doc_id").limit(CLASS_SAMPLE) for c in (0, 1)]
    # At most 2 * CLASS_SAMPLE ids are broadcast.
    return (
        docs.filter((F.length("text") > 0) & (F.length("text") <= TEXT_CHARS))
        .select("doc_id", "text")
        .join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
        .orderBy(spread, "doc_id", "text", "label")
        .limit(2 * CLASS_SAMPLE)
    )


def telling_grams(sample: DataFrame, share: float) -> np.ndarray:
    """The buckets of the n-grams whose presence in a sampled text tells most about its label."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, toxic = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            labels = batch.column("label").to_pylist()
            for text, label in zip(batch.column("text").to_pylist(), labels, strict=True):
                symbols, _, _ = split([text])
                seen = np.unique(np.concatenate([b for _, b in grams(symbols)] or [np.empty(0, np.int64)]))
                both[seen] += 1
                toxic[seen] += label
        at = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (at, both[at], toxic[at])], names=["bucket", "n", "toxic"])

    expected = F.col("n") * F.lit(share)
    lift = (F.col("toxic") - expected) ** 2 / (expected * F.lit(1 - share))
    counts = sample.mapInArrow(count, "bucket long, n long, toxic long").groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic")
    )
    best = counts.filter((F.col("n") >= LEAST_TEXTS) & (lift >= LEAST_LIFT)).orderBy(lift.desc(), "bucket").limit(MOST_GRAMS)
    return np.sort(np.array([row["bucket"] for row in best.collect()], np.int64))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on labelled rows whose id is not in the held-out fold.

    Each class gives ``CLASS_SAMPLE`` texts at most. N-grams are counted and looked up in tasks; the driver
    receives the counts of the chosen ones per sentence. Null labels, ids and texts and empty texts are left
    out. With one class or none, every score is that class's share (0.5 without labels).
    """
    small_batches(docs.sparkSession)
    sample = staged(labelled_texts(docs, labels), "labelled").repartition(32)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    constant = ToxicityModel(np.empty(0, np.int64), np.empty(0), float(-np.log1p(-share)))
    if len(sizes) < 2:
        return constant
    buckets = telling_grams(sample, share)
    if not len(buckets):
        return constant

    def looked_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _places(buckets)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                symbols, pieces, sentence = split([text])
                rows, columns = _found(symbols, sentence, place)
                out.append((len(pieces.starts), rows.astype(np.int32).tobytes(), columns.astype(np.int32).tobytes()))
            size, rows, columns = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.string()), batch.column("label"), pa.array(size, pa.int64()),
                    pa.array(rows, pa.binary()), pa.array(columns, pa.binary()),
                ],
                names=["id", "label", "size", "rows", "columns"],
            )

    shape = "id string, label int, size long, rows binary, columns binary"
    # A fixed order: sums of floating point numbers depend on it.
    parts = sorted(tuple(r) for r in sample.mapInArrow(looked_up, shape).toLocalIterator())
    y = np.array([p[1] for p in parts], np.float64)
    size = np.array([p[2] for p in parts], np.int64)
    before = np.cumsum(size) - size
    rows = np.concatenate([np.frombuffer(p[3], np.int32) + b for p, b in zip(parts, before, strict=True)])
    columns = np.concatenate([np.frombuffer(p[4], np.int32) for p in parts])
    return train(rows, columns, np.repeat(np.arange(len(parts)), size), y, buckets)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, offending`` for every row of ``docs``.

    ``offending`` lists the sentences from a probability of ``OFFENDING`` on, in the text's order:
    ``start`` and ``length`` in code points, and ``score``. Null and empty texts, and those without
    words, have none, and the score of the leak alone. A null id is in no fold: neither learned
    from nor held out. Whole texts are read; an empty table gives no rows; labels may repeat or be absent.
    Other columns are not read.
    """
    model = fit_toxicity(docs, labels)
    # Plain values, a few thousand numbers: executors need not have this package installed to read them.
    sent = (model.buckets, model.weights, model.leak)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = ToxicityModel(*sent)
        place = _places(held.buckets)
        for batch in large_batches(batches, size=1 << 20):
            pieces, rates = sentence_scores(batch.column("text").to_pylist(), held, place)
            chance = -np.expm1(-rates)
            bad = np.flatnonzero(chance >= OFFENDING)
            cuts = np.searchsorted(pieces.text_of[bad], np.arange(pieces.texts + 1))
            listed = pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(x[bad]) for x in (pieces.starts, pieces.lengths, chance)], names=["start", "length", "score"]
                ),
            )
            value = np.clip(document_scores(pieces, rates, held), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(value, pa.float64()), listed], names=["doc_id", "score", "offending"]
            )

    given = docs.select("doc_id", "text")
    shape = "array<struct<start:bigint,length:bigint,score:double>>"
    schema = given.select("doc_id", F.lit(0.0).alias("score"), F.array().cast(shape).alias("offending")).schema
    held_out = F.coalesce(id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return given.mapInArrow(score, schema).select(
        "doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), "offending"
    )
