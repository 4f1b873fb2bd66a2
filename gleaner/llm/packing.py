"""Packing token sequences: combinations of lengths that fill a window, counted by least squares."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleaner.llm.common import large_batches, ragged, small_batches, spaced, text_bytes, word_hashes
from gleaner.stage import staged

# Text that is encoded at a time.
PIECE_BYTES = 1 << 20
WINDOW = 2048
# Lengths are packed in units of so many tokens; what is left of a document below one unit is a tail.
UNIT = 8
SLOTS = WINDOW // UNIT
CLOSING_ID = 1
TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 500_000


# Classes of bytes: white space, letters, digits, other ASCII, and what makes a word be left whole.
_SPACE, _LETTER, _DIGIT, _OTHER, _WHOLE = range(5)
_CLASS = np.full(256, _WHOLE, np.uint8)
_CLASS[:128] = _OTHER
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
# An apostrophe may begin an ending, a bar may be part of a special token, control characters may be white space.
_CLASS[[*range(9), *range(14, 32), 127, ord("'"), ord("|")]] = _WHOLE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _visible() -> dict[int, int]:
    """The vocabulary writes a byte as a printable character: those that are one as themselves, the
    others as the characters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: 256 + k for k, b in enumerate(others)}


def token_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text to encode, the starts and ends of what the vocabulary's rules never join, and which
    of these are words left whole.

    They lower-case and cut a word into runs of letters, single digits and runs of other characters.
    That is done here for words of ASCII and of the letters from U+00C0 to U+00FF; a word with
    anything else is left whole and as it is.
    """
    kinds = _CLASS[text]
    # 0xC3 and a second byte: a letter, but for the signs of multiplication and division.
    lead = np.flatnonzero(text[:-1] == 0xC3)
    follow = text[lead + 1]
    lead = lead[(follow >= 0x80) & (follow < 0xC0) & (follow != 0x97) & (follow != 0xB7)]
    kinds[lead] = kinds[lead + 1] = _LETTER
    lowered = _LOWER[text]
    capitals = lead[text[lead + 1] < 0x9F] + 1
    lowered[capitals] += 0x20
    before = np.concatenate([[np.uint8(_SPACE)], kinds[:-1]])
    word = kinds != _SPACE
    head = word & (before == _SPACE)
    own = np.cumsum(head, dtype=np.int32) - 1
    whole = np.zeros(int(own[-1]) + 2 if len(own) else 1, bool)
    whole[own[kinds == _WHOLE]] = True
    kept = whole[own]
    cut = head | (word & ((kinds != before) | (kinds == _DIGIT)) & ~kept)
    starts = np.flatnonzero(cut)
    stop = np.flatnonzero(~word & (before != _SPACE))
    # A token ends where the next one begins, or where its word ends.
    ends = np.append(starts[1:], len(text))
    ends = np.minimum(ends, stop[np.minimum(np.searchsorted(stop, starts, side="right"), len(stop) - 1)]) if len(stop) else ends
    return np.where(kept, text, lowered), starts, ends, kept[starts]


class WordTokenizer:
    """Ids of whole texts, put together from the ids of their words' parts.

    The vocabulary's own rules cut at white space, which is dropped, and between letters, digits and
    other characters, so a text's ids are those of the parts in order. Texts share parts; each
    distinct one is encoded once while the table holds at most ``CACHED_WORDS``.
    """

    def __init__(self, path: str):
        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, hashes: np.ndarray, parts: list[bytes], whole: list[bool]) -> None:
        visible, model = _visible(), self.tokenizer.model
        found = [
            self.tokenizer.encode(part.decode(), add_special_tokens=False).ids
            if own
            else [
                token.id
                for token in model.tokenize(
                    part.decode() if part.isascii() else part.decode("latin-1").translate(visible)
                )
            ]
            for part, own in zip(parts, whole, strict=True)
        ]
        lengths = np.array([len(i) for i in found], np.int64)
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        order = np.argsort(np.concatenate([self.hashes, hashes]), kind="stable")
        self.hashes = np.concatenate([self.hashes, hashes])[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.lengths = np.concatenate([self.lengths, lengths])[order]
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts ``data[offsets[i] : offsets[i + 1]]``, and how many each has."""
        # White space ends every text, so that no word runs into the next one.
        text, starts, ends, whole = token_spans(spaced(data, offsets))
        owner = np.searchsorted(offsets[1:] + np.arange(1, len(offsets)), starts, side="right")
        h = word_hashes(text, starts, ends)
        unique, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHED_WORDS:
            self.clear()
        at = np.minimum(np.searchsorted(self.hashes, unique), max(0, len(self.hashes) - 1))
        new = self.hashes[at] != unique if len(self.hashes) else np.ones(len(unique), bool)
        if new.any():
            raw = text.tobytes()
            own = first[new]
            parts = [raw[s:e] for s, e in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
            self._learn(unique[new], parts, whole[own].tolist())
        entry = np.searchsorted(self.hashes, unique)[inverse]
        lengths = self.lengths[entry]
        ids = self.ids[ragged(self.starts[entry], lengths)]
        counts = np.bincount(owner, weights=lengths, minlength=len(offsets) - 1).astype(np.int64)
        return ids, counts


@lru_cache(maxsize=1)
def combinations() -> tuple[np.ndarray, list[tuple[tuple[int, int], ...]]]:
    """Shallow combinations that fill a window to the unit, as columns and as (slots, times).

    One length any number of times, or that and one more piece, and all sets of three lengths.
    """
    found: set[tuple[tuple[int, int], ...]] = set()
    for a in range(1, SLOTS + 1):
        for times in range(1, SLOTS // a + 1):
            rest = SLOTS - a * times
            if rest == 0:
                found.add(((a, times),))
            elif rest != a:
                found.add(tuple(sorted(((a, times), (rest, 1)))))
        for b in range(a + 1, (SLOTS - a) // 2 + 1):
            c = SLOTS - a - b
            if c > b:
                found.add(((a, 1), (b, 1), (c, 1)))
    listed = sorted(found)
    matrix = np.zeros((SLOTS + 1, len(listed)))
    for j, combination in enumerate(listed):
        for slots, times in combination:
            matrix[slots, j] += times
    return matrix, listed


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, steps: int = 400) -> np.ndarray:
    """Least squares with no negative value: the active-set method of Lawson and Hanson.

    It may stop early, after ``steps`` variables have entered, with a non-negative point.
    """
    x, passive = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    gain = correlation = a.T @ b
    tolerance = 1e-9 * max(1.0, float(np.abs(gain).max(initial=0)))
    for _ in range(steps):
        slope = np.where(passive, -np.inf, gain)
        j = int(slope.argmax())
        if not slope[j] > tolerance:
            break
        passive[j] = True
        while True:
            own = np.flatnonzero(passive)
            normal = a[:, own].T @ a[:, own] + 1e-9 * np.eye(len(own))
            z = np.linalg.solve(normal, correlation[own])
            if z.min() > 0 or len(own) == 1:
                x[own] = np.maximum(z, 0)
                break
            low = z <= 0
            ratio = x[own][low] / np.maximum(x[own][low] - z[low], 1e-300)
            moved = x[own] + ratio.min() * (z - x[own])
            moved[low & (moved <= 1e-12)] = 0
            moved[np.flatnonzero(low)[ratio.argmin()]] = 0
            x[own] = moved
            passive[own[moved <= 0]] = False
        gain = a.T @ (b - a @ x)
        gain[passive] = 0
    return x


def repeats(histogram: np.ndarray, rounds: int = 4) -> list[tuple[int, int]]:
    """How often to use each combination: ``(index, times)``, never more than the pieces there are.

    Least squares may ask for more of a length than there is; what that leaves over of the other
    lengths is solved for again.
    """
    matrix, listed = combinations()
    left = histogram.astype(np.int64).copy()
    chosen = []
    for _ in range(rounds):
        total = left.sum()
        if not total:
            break
        x = non_negative_least_squares(matrix, left / total) * total
        for j in np.argsort(-x, kind="stable"):
            times = int(x[j] + 1e-6)
            if times <= 0:
                break
            times = min(times, *(int(left[slots]) // each for slots, each in listed[j]))
            if times > 0:
                for slots, each in listed[j]:
                    left[slots] -= times * each
                chosen.append((int(j), times))
    return chosen


def _seats(chosen: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Ranks of a length and where they sit: slots, first rank, end, first sequence, each, seat."""
    _, listed = combinations()
    used, sequence, seats = {}, 0, []
    for j, times in chosen:
        seat = 0
        for slots, each in listed[j]:
            start = used.get(slots, 0)
            seats.append((slots, start, start + times * each, sequence, each, seat))
            used[slots] = start + times * each
            seat += each
        sequence += times
    return seats


_PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, part long, at long, "
    "slots int, rank long"
)


def _cut(batches: Iterable[pa.RecordBatch], path: str, width: str) -> Iterator[pa.RecordBatch]:
    """Cut documents into full windows, one piece of whole units, and a tail below one unit.

    ``width``: the number type that the ids of pieces are kept in.

    ``slots`` is the piece's length in units: all of them for a full window, 0 for a tail. ``rank``
    counts the pieces of that length within the task, for tails their tokens.
    """
    tokenizer, part = WordTokenizer(path), TaskContext.get().partitionId()
    seen, at = np.zeros(SLOTS + 1, np.int64), 0
    for batch in large_batches(batches, size=PIECE_BYTES, release=True):
        ids, counts = tokenizer.encode(*text_bytes(batch.column("text")))
        sizes = counts + 1
        closed = np.empty(int(sizes.sum()), np.uint32)
        ends = np.cumsum(sizes)
        body = np.ones(len(closed), bool)
        body[ends - 1] = False
        closed[body], closed[ends - 1] = ids, CLOSING_ID
        full, rest = sizes // WINDOW, sizes % WINDOW
        whole, tail = rest // UNIT, rest % UNIT
        pieces = full + (whole > 0) + (tail > 0)
        doc = np.repeat(np.arange(len(sizes)), pieces)
        k = ragged(np.zeros(len(sizes), np.int64), pieces)
        start = np.minimum(k, full[doc]) * WINDOW + np.where(
            (k > full[doc]) & (whole[doc] > 0), whole[doc] * UNIT, 0
        )
        is_tail = (k == pieces[doc] - 1) & (tail[doc] > 0)
        length = np.where(k < full[doc], WINDOW, np.where(is_tail, tail[doc], whole[doc] * UNIT))
        slots = np.where(is_tail, 0, length // UNIT)
        step = np.where(slots == 0, length, 1)
        rank = np.empty(len(doc), np.int64)
        order = np.argsort(slots, kind="stable")
        sums = np.cumsum(step[order]) - step[order]
        heads = np.searchsorted(slots[order], np.arange(SLOTS + 1))
        base = np.concatenate([sums, [step.sum()]])[heads]
        rank[order] = sums - base[slots[order]] + seen[slots[order]]
        seen += np.bincount(slots, weights=step, minlength=SLOTS + 1).astype(np.int64)
        first = (ends - sizes)[doc] + start
        narrow, wide = closed.astype(width), closed.astype("<u4")
        spans = list(zip(first.tolist(), (first + length).tolist(), strict=True))
        crcs = [zlib.crc32(wide[s:e]) for s, e in spans]
        kept = [None if f == SLOTS else narrow[s:e].tobytes() for (s, e), f in zip(spans, slots.tolist(), strict=True)]
        doc_ids = batch.column("doc_id").take(pa.array(doc))
        columns = [
            doc_ids,
            start,
            length,
            pa.array(crcs, pa.int64()),
            sizes[doc],
            pa.array(kept, pa.binary()),
            np.full(len(doc), part, np.int64),
            np.arange(at, at + len(doc)),
            slots.astype(np.int32),
            rank,
        ]
        at += len(doc)
        yield pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "part", "at", "slots", "rank"],
        )


def _split(batches: Iterable[pa.RecordBatch], width: str) -> Iterator[pa.RecordBatch]:
    """Cut the pieces that reach over the end of a window, with the checksums of what results."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], width).astype("<u4")
            done, place = 0, row["place"]
            while done < len(ids):
                take = min(len(ids) - done, WINDOW - place % WINDOW)
                rows.append(
                    (row["doc_id"], row["start"] + done, take, zlib.crc32(ids[done : done + take]),
                     row["doc_tokens"], place)
                )
                done, place = done + take, place + take
        columns = list(zip(*rows, strict=True)) or [()] * 6
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def id_width(path: str) -> str:
    """The narrowest number type that holds all ids of a vocabulary."""
    largest = max([CLOSING_ID, *Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()])
    return "<u2" if largest < 1 << 16 else "<u4"


def packed(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of ``WINDOW`` tokens, only the last of which is padded.

    Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A document is
    its ids and the closing id, so a null or empty text has one token. It is cut into full windows,
    one piece of whole units and a tail of less than a unit.

    The pieces of whole units are packed by length: the histogram of lengths, at most ``SLOTS``
    numbers, goes to the driver, non-negative least squares says how often each combination is
    used, and the counts are rounded down. A piece finds its seat from its rank among the pieces of
    its length, which is its rank within its task plus the pieces of the tasks before. What the
    combinations leave over, and the tails, are packed greedily one after the other and cut where
    a window ends.

    Rows that share an id, and null ids, are documents of their own. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    vocabulary = path or public_tokenizers.path(TOKENIZER)
    width = id_width(vocabulary)

    def cut(batches):
        return _cut(batches, vocabulary, width)

    def split(batches):
        return _split(batches, width)

    pieces = staged(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, _PIECE), "pieces")
    # One row per task and length: what each task adds, and what those before it have.
    per_task = pieces.groupBy("part", "slots").agg(
        F.sum(F.when(F.col("slots") == 0, F.col("length")).otherwise(1)).alias("n")
    )
    earlier = Window.partitionBy("slots").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(per_task.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "bases")
    histogram = np.zeros(SLOTS + 1, np.int64)
    for row in bases.groupBy("slots").agg(F.sum("n").alias("n")).collect():
        histogram[row["slots"]] = row["n"]
    full = int(histogram[SLOTS])
    histogram[[0, SLOTS]] = 0
    chosen = repeats(histogram)
    seats = _seats(chosen)
    combined = sum(times for _, times in chosen)

    spark = docs.sparkSession
    numbered = (
        pieces.drop("ids")
        .join(bases.select("part", "slots", "base"), ["part", "slots"])
        .withColumn("global", F.col("base") + F.col("rank"))
    )
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    windows = numbered.filter(F.col("slots") == SLOTS).select(
        *keep, F.col("global").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    # At most one row per length and combination: a table of fixed bounds.
    table = spark.createDataFrame(
        seats or [(-1, 0, 0, 0, 1, 0)],
        "slots int, first long, end long, sequence long, each int, seat int",
    )
    inside = (F.col("global") >= F.col("first")) & (F.col("global") < F.col("end"))
    nth = F.col("global") - F.col("first")
    matched = (
        numbered.filter((F.col("slots") > 0) & (F.col("slots") < SLOTS))
        .join(F.broadcast(table.withColumnRenamed("slots", "_slots")), (F.col("slots") == F.col("_slots")) & inside)
        .select(
            *keep,
            (F.lit(full) + F.col("sequence") + F.floor(nth / F.col("each"))).cast("bigint").alias("sequence_id"),
            (F.col("seat") + F.pmod(nth, F.col("each"))).alias("order"),
        )
    )
    running = Window.partitionBy("sequence_id").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    matched = matched.select(*keep, "sequence_id", F.coalesce(F.sum("length").over(running), F.lit(0)).alias("offset"))

    # Left over: the ranks from the used count on, length after length, then the tails.
    used = np.zeros(SLOTS + 1, np.int64)
    for slots, _, end, *_ in seats:
        used[slots] = max(used[slots], end)
    ahead, places = 0, []
    for slots in range(1, SLOTS):
        left = int(histogram[slots] - used[slots])
        places.append((slots, int(used[slots]), ahead, slots * UNIT))
        ahead += left * slots * UNIT
    places.append((0, 0, ahead, 1))
    stream = spark.createDataFrame(places, "_slots int, used long, ahead long, width int")
    residual = (
        numbered.join(F.broadcast(stream), F.col("slots") == F.col("_slots"))
        .filter(F.col("global") >= F.col("used"))
        .withColumn("place", F.col("ahead") + (F.col("global") - F.col("used")) * F.col("width"))
    )
    crosses = F.floor(F.col("place") / WINDOW) != F.floor((F.col("place") + F.col("length") - 1) / WINDOW)
    crossing = residual.filter(crosses).select(*keep, "place", "part", "at")
    cut_up = crossing.join(pieces.select("part", "at", "ids"), ["part", "at"]).select(*keep, "place", "ids").mapInArrow(
        split, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long"
    )
    rest = residual.filter(~crosses).select(*keep, "place").unionByName(cut_up)
    rest = rest.select(
        *keep,
        (F.lit(full + combined) + F.floor(F.col("place") / WINDOW)).cast("bigint").alias("sequence_id"),
        F.pmod(F.col("place"), F.lit(WINDOW)).cast("bigint").alias("offset"),
    )
    return windows.unionByName(matched).unionByName(rest)
