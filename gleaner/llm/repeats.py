"""Repeated passages over all documents: what routes text to the shards of an index.

A window is ``width`` consecutive symbols of one document: words, or bytes. Two windows are equal only
if the smallest of their ``gram``-symbol hashes, the anchor, is the same and stands at the same
place. Consecutive windows with the same anchor are a segment. So segments are sent by anchor:

1. Of segments that are wholly equal the earliest one leads and the others follow. Only leaders have
   their symbols sent; one that no segment follows and that is alone under its anchor is no repeat.
2. The leaders of an anchor go to a shard, whose index is built over them, and all of them are streamed
   through it. What the index reports for a leader holds for the leader, where an earlier place is
   found, and for its followers, whose windows all stand later.
3. An anchor with very many different segments (the edge of a passage that stands in many different
   contexts) is cut finer first: into runs of a few windows, named by what all of them have in common,
   and then into single windows. So no shard gets an unbounded group. Equal runs are one here too; the
   later ones are repeats without a further search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import (
    large_batches,
    mix,
    ragged,
    spaced,
    spans_of_words,
    text_bytes,
    unique_ids,
    window_hashes,
    word_hashes,
)
from gleaner.llm.suffixes import Shard, Streamer
from gleaner.stage import staged

# Symbols of a shard, and different segments of an anchor from which on it is cut finer.
SHARD_SYMBOLS = 1 << 19
HOT_SEGMENTS = 2000
FINER = 8
# Bits of the packed place: start, number of windows, place of the anchor in the first of them.
_COUNT_BITS, _ANCHOR_BITS = 12, 12
_POSITION_BITS = 24
_CHUNK = 1 << 19


@dataclass(frozen=True)
class Kind:
    """How to read a text, and when an equal window makes a later one a repeat.

    ``words``: symbols are words, else bytes. ``within``: an earlier place in the same document
    counts too.
    """

    width: int
    gram: int
    words: bool
    within: bool
    index: Callable[[Shard], Streamer]

    @property
    def grams(self) -> int:
        return self.width - self.gram + 1


def _pack(start, count, anchor):
    return (start << (_COUNT_BITS + _ANCHOR_BITS)) | (count << _ANCHOR_BITS) | anchor


def _unpack(at):
    return (
        at >> (_COUNT_BITS + _ANCHOR_BITS),
        (at >> _ANCHOR_BITS) & ((1 << _COUNT_BITS) - 1),
        at & ((1 << _ANCHOR_BITS) - 1),
    )


def symbols_of(kind: Kind, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, and the offsets of each text's share."""
    data, offsets = text_bytes(column)
    if not kind.words:
        return data, offsets
    text = spaced(data, offsets)
    starts, ends = spans_of_words(text)
    bounds = np.searchsorted(starts, offsets + np.arange(len(offsets)))
    return word_hashes(text, starts, ends), bounds


def segments_of(kind: Kind, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, segment hash, document, first window, number of windows, place of the anchor."""
    found = []
    step = _CHUNK
    for first in range(0, max(1, len(symbols) - kind.width + 1), step):
        part = symbols[first : first + step + kind.width - 1]
        if len(part) < kind.width:
            break
        grams = window_hashes(part, kind.gram)
        # The smallest hash, and the leftmost of equal ones.
        low = (grams >> np.uint64(_POSITION_BITS)) << np.uint64(_POSITION_BITS)
        best, size = low | np.arange(len(grams), dtype=np.uint64), 1
        while 2 * size <= kind.grams:
            best = np.minimum(best[:-size], best[size:])
            size *= 2
        rest = kind.grams - size
        if rest:
            best = np.minimum(best[:-rest], best[rest:])
        anchor = (best & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        windows = np.arange(len(anchor))
        doc = np.searchsorted(offsets, first + windows, side="right") - 1
        inside = first + windows + kind.width <= offsets[doc + 1]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new & inside)
        if not len(heads):
            continue
        breaks = np.append(np.flatnonzero(new | ~inside), len(anchor))
        ends = breaks[np.searchsorted(breaks, heads, side="right")]
        count = ends - heads
        h = count.astype(np.uint64)
        for k in range(-(-(kind.width + kind.grams) // kind.gram)):
            piece = np.minimum(heads + k * kind.gram, ends - 1 + kind.width - kind.gram)
            h = mix((h ^ grams[piece]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
        found.append(
            (grams[anchor[heads]], h, doc[heads], first + heads - offsets[doc[heads]], count, anchor[heads] - heads)
        )
    if not found:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


# ``state``: what is known of a segment. Followers have an earlier equal segment, leaders a later one.
_ALONE, _LEADS, _FOLLOWS = 0, 1, 2
_ROW = "anchor long, segment long, doc_id long, copy long, at long, state long"
_NAMES = ["anchor", "segment", "doc_id", "copy", "at", "state"]
# A run cut from a segment: the segment that others follow (0: none), and where it starts.
_CUT = f"{_ROW}, root long, begin long"


def _rows(kind: Kind, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of all documents, each with what its batch tells of its state."""
    for batch in batches:
        held = []
        ids, copies = batch.column("doc_id").to_numpy(), batch.column("copy").to_numpy()
        base = 0
        for part in large_batches([batch], size=2 << 20):
            symbols, offsets = symbols_of(kind, part.column("text"))
            anchor, segment, doc, start, count, place = segments_of(kind, symbols, offsets)
            doc += base
            base += part.num_rows
            held.append((anchor.view(np.int64), segment.view(np.int64), ids[doc], copies[doc], _pack(start, count, place)))
        if not held:
            continue
        anchor, segment, doc, copy, at = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((at, copy, doc, segment))
        anchor, segment, doc, copy, at = (c[order] for c in (anchor, segment, doc, copy, at))
        new = np.ones(len(segment), bool)
        new[1:] = segment[1:] != segment[:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        follows = ~new if kind.within else doc != doc[head]
        group = np.cumsum(new) - 1
        led = np.bincount(group, follows, minlength=1)[group] > 0
        state = np.where(follows, _FOLLOWS, np.where(new & led, _LEADS, _ALONE))
        for first in range(0, len(anchor), 1 << 16):
            piece = slice(first, first + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[piece]) for c in (anchor, segment, doc, copy, at, state)], names=_NAMES
            )


def _collapsed(kind: Kind, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of anchor, segment and place, with their state among all rows of the segment.

    Rows that are alone, under their anchor too, are no repeats and are gone. Works on a batch at a
    time; its last row is held until the next batch tells whether its anchor or segment goes on, and
    so is a leader in the batch of the last segment.
    """
    held: np.ndarray | None = None  # the last segment's first row, if it is not passed on yet
    last: tuple[int, int, int] | None = None  # anchor, segment and its first document
    shared = False  # the last anchor has several rows, or a row that leads
    names: list[str] = []
    for batch in batches:
        names = batch.schema.names
        rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
        if not len(rows):
            continue
        anchor, segment, doc = rows[:, 0], rows[:, 1], rows[:, 2]
        state = rows[:, 5]
        new_anchor, new_segment = np.ones(len(rows), bool), np.ones(len(rows), bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new_segment[1:] = new_anchor[1:] | (segment[1:] != segment[:-1])
        if last is not None:
            new_anchor[0] = anchor[0] != last[0]
            new_segment[0] = new_anchor[0] or segment[0] != last[1]
        position = np.arange(len(rows))
        head = np.maximum.accumulate(np.where(new_segment, position, -1))
        head_doc = np.where(head >= 0, doc[np.maximum(head, 0)], last[2] if last is not None else 0)
        follows = ~new_segment & (kind.within | (doc != head_doc))
        if held is not None:
            if not new_segment[0]:
                held[0, 5] = _LEADS
            if shared or not new_anchor[0]:
                yield _batch(held, names)
            held = None
        # Segments led by a row of this batch, and anchors with more than one row.
        led = np.bincount(head + 1, follows | (state == _LEADS), minlength=len(rows) + 1)[head + 1] > 0
        starts = np.union1d(np.flatnonzero(new_anchor), [0])
        run = np.searchsorted(starts, position, side="right") - 1
        several = np.diff(np.append(starts, len(rows))) > 1
        several |= np.logical_or.reduceat(state == _LEADS, starts)
        several[0] |= not new_anchor[0]
        rows = rows.copy()
        rows[:, 5] = np.where(follows, _FOLLOWS, np.where(new_segment & led, _LEADS, _ALONE))
        out = several[run]
        if head[-1] >= 0:
            held = rows[head[-1]][None, :].copy()
            out[head[-1]] = False
        if out.any():
            yield _batch(rows[out], names)
        shared = bool(several[-1])
        last = (int(anchor[-1]), int(segment[-1]), int(head_doc[-1]))
    if held is not None and shared:
        yield _batch(held, names)


def _batch(rows: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=names)


def id_filter(ids: DataFrame, column: str, bits: int = 1 << 23) -> np.ndarray:
    """A bitmap of fixed size that has a bit for each value of ``column``, by its hash."""

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(bits, bool)
        for batch in batches:
            marks[batch.column("slot").to_numpy()] = True
        packed = np.packbits(marks)
        pages = packed.reshape(64, -1)
        used = np.flatnonzero(pages.any(axis=1))
        if len(used):
            blobs = [pages[k].tobytes() for k in used]
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(blobs, pa.binary())], names=["page", "bits"])

    def unite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, blob in zip(batch.column("page").to_pylist(), batch.column("bits"), strict=True):
                value = np.frombuffer(blob.as_buffer(), np.uint8)
                sums[page] = sums[page] | value if page in sums else value
        if sums:
            blobs = [v.tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(blobs, pa.binary())], names=["page", "bits"])

    slots = ids.select(F.pmod(F.xxhash64(column), F.lit(bits)).alias("slot"))
    schema = "page long, bits binary"
    marks = np.zeros(bits, bool).reshape(64, -1)
    for row in slots.mapInArrow(mark, schema).repartition("page").mapInArrow(unite, schema).toLocalIterator():
        marks[row["page"]] = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).view(bool)
    return np.packbits(marks.ravel())


def with_slots(frame: DataFrame, column: str, marks: np.ndarray) -> DataFrame:
    """``frame`` with the place ``_slot`` of each row in the bitmap."""
    return frame.withColumn("_slot", F.pmod(F.xxhash64(column), F.lit(len(marks) * 8)))


def marked(batches: Iterable[pa.RecordBatch], marks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows whose ``_slot`` is in the bitmap: surely all that were put in, and few others."""
    for batch in batches:
        slot = batch.column("_slot").to_numpy()
        kept = (marks[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1
        yield batch.filter(pa.array(kept.astype(bool)))


def only_marked(frame: DataFrame, column: str, marks: np.ndarray) -> DataFrame:
    """The rows whose ``column`` may be in the bitmap."""
    sent = frame.sparkSession.sparkContext.broadcast(marks)
    names = frame.columns

    def select(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in marked(batches, sent.value):
            yield batch.select(names)

    return with_slots(frame, column, marks).mapInArrow(select, frame.schema)


def _with_symbols(kind: Kind, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their open segments to a row per segment with its symbols."""
    for batch in large_batches(batches, size=2 << 20):
        symbols, offsets = symbols_of(kind, batch.column("text"))
        opened = batch.column("opened")
        counts = opened.value_lengths().to_numpy(zero_copy_only=False)
        flat = opened.flatten()
        doc = np.repeat(np.arange(batch.num_rows), counts)
        anchor, at, root = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        start, count, _ = _unpack(at)
        begin = (offsets[doc] + start).tolist()
        length = (count + kind.width - 1).tolist()
        blobs = [symbols[s : s + n].tobytes() for s, n in zip(begin, length, strict=True)]
        for first in range(0, len(blobs), 8192):
            piece = slice(first, first + 8192)
            own = pa.array(doc[piece])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[piece]),
                    batch.column("doc_id").take(own),
                    batch.column("copy").take(own),
                    pa.array(at[piece]),
                    pa.array(root[piece]),
                    pa.array(start[piece]),
                    pa.array(blobs[piece], pa.binary()),
                ],
                names=_SHARD,
            )


_SEGMENT = "anchor long, doc_id long, copy long, at long, root long, begin long, symbols binary"
_SHARD = ["anchor", "doc_id", "copy", "at", "root", "begin", "symbols"]


def _finer(kind: Kind, windows: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut segments into runs of ``windows`` windows whose anchors stand at the same places.

    The new anchor is what all windows of a run have in common; the new segment is the run itself. Runs
    of a leader stay even if they are alone: its followers wait for them.
    """
    size = 8 if kind.words else 1

    def number(*parts: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)

    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in _SHARD]
        for anchor, doc_id, copy, at, root, begin, blob in zip(*columns, strict=True):
            start, count, place = _unpack(at)
            first = 0
            while first < count:
                # Windows at first, first + 1, ... have the anchor at place - first, one less, ...
                group = (place - first) // windows
                low, high = place - (group + 1) * windows + 1, place - group * windows
                last = min(count, high + 1)
                text = blob[first * size : (last - 1 + kind.width) * size]
                common = blob[high * size : (low + kind.width) * size]
                name = number(anchor.to_bytes(8, "little", signed=True), group.to_bytes(4, "little"), common)
                cut = _pack(start + first, last - first, place - first)
                out.append((name, number(text), doc_id, copy, cut, _LEADS if root else _ALONE, root, begin, text))
                first = last
        columns = list(zip(*out, strict=True)) or [()] * 9
        arrays = [pa.array(c, pa.int64()) for c in columns[:8]] + [pa.array(columns[8], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*_NAMES, "root", "begin", "symbols"])


def _decide(kind: Kind, rows: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the segments of a shard (``doc_id, copy, at, root, begin, symbols``) in order of place: rows and
    offsets of the windows that the index finds, and whether it finds them at an earlier place."""
    kinds = np.uint64 if kind.words else np.uint8
    parts = [np.frombuffer(r[5], kinds) for r in rows]
    lengths = np.array([len(p) for p in parts], np.int64)
    _, flat = np.unique(np.concatenate(parts), return_inverse=True)
    flat = flat.astype(np.int64) + 1
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.zeros(int((lengths + 1).sum()), np.int64)
    text[ragged(starts, lengths)] = flat
    matrix = np.zeros((len(rows), int(lengths.max())), np.int64)
    matrix[np.arange(matrix.shape[1])[None, :] < lengths[:, None]] = flat
    index = kind.index(Shard(text, kind.width))
    docs = np.array([r[0] for r in rows], np.int64)
    for row, at, place in index.matches(matrix, lengths, starts):
        earlier = place < starts[row] + at
        if not kind.within:
            earlier &= docs[np.searchsorted(starts, place, side="right") - 1] < docs[row]
        yield row, at, earlier


def _runs(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first offset and number of each run of consecutive windows."""
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    return row[heads], at[heads], np.diff(np.append(heads, len(row)))


_FOUND = "doc_id long, copy long, at long, root long"


def _searched(kind: Kind, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gather whole anchors (sorted input) into shards, index each and stream its segments through it.

    A row with a document is a run of windows that stand earlier too. A row with a root is a run found
    in the segment that others follow; its place counts from the segment's start.
    """

    def shard(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows.sort(key=lambda r: r[:3])
        numbers = np.array([r[:5] for r in rows], np.int64)
        found = list(_decide(kind, rows))
        if not found:
            return
        row, at, earlier = (np.concatenate(c) for c in zip(*found, strict=True))
        start, _, _ = _unpack(numbers[:, 2])
        own, first, count = _runs(row[earlier], at[earlier])
        led = numbers[row, 3] != 0
        lead, from_, length = _runs(row[led], at[led])
        nothing, none = np.zeros(len(lead), np.int64), np.zeros(len(own), np.int64)
        absent = np.repeat([False, True], [len(own), len(lead)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([numbers[own, 0], nothing]), mask=absent),
                pa.array(np.concatenate([numbers[own, 1], nothing]), mask=absent),
                pa.array(np.concatenate([
                    _pack(start[own] + first, count, 0),
                    _pack(start[lead] + from_ - numbers[lead, 4], length, 0),
                ])),
                pa.array(np.concatenate([none, numbers[lead, 3]]), mask=~absent),
            ],
            names=["doc_id", "copy", "at", "root"],
        )

    size = 8 if kind.words else 1
    rows, group, filled, name = [], [], 0, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in _SHARD]
        for anchor, *row in zip(*columns, strict=True):
            if anchor != name:
                rows += group
                group, name = [], anchor
                if filled >= SHARD_SYMBOLS:
                    yield from shard(rows)
                    rows, filled = [], 0
            group.append(tuple(row))
            filled += len(row[5]) // size + 1
    rows += group
    if rows:
        yield from shard(rows)


def marks(docs: DataFrame, kind: Kind) -> DataFrame:
    """Windows that also stand earlier: ``doc_id, copy, at``, where ``at`` packs the first of
    consecutive windows and their number. ``docs``: ``doc_id, copy, text`` without null ids."""

    def on(function):
        return lambda batches: function(kind, batches)

    def collapse(batches):
        """Followers pass, all other rows are collapsed."""
        passed = []

        def others():
            for batch in batches:
                known = pc.equal(batch.column("state"), _FOLLOWS)
                if pc.any(known).as_py():
                    passed.append(batch.filter(known))
                yield batch.filter(pc.invert(known))

        for out in _collapsed(kind, others()):
            yield from passed
            passed.clear()
            yield out
        yield from passed

    first = docs.mapInArrow(on(_rows), _ROW)
    # Followers have no group yet: they are spread by their place.
    key = F.when(F.col("state") == _FOLLOWS, F.xxhash64("doc_id", "at")).otherwise(F.col("anchor"))
    sent = first.repartition(key).sortWithinPartitions("anchor", "segment", "doc_id", "copy", "at")
    found = staged(sent.mapInArrow(collapse, _ROW), "collapsed")
    followers = found.filter(F.col("state") == _FOLLOWS)
    opened = found.filter(F.col("state") != _FOLLOWS).select(
        "anchor", "doc_id", "copy", "at",
        F.when(F.col("state") == _LEADS, F.col("segment")).otherwise(F.lit(0)).alias("root"),
    )
    per_doc = opened.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("anchor", "at", "root")).alias("opened"))
    with_text = only_marked(docs, "doc_id", id_filter(opened, "doc_id"))
    cut = staged(with_text.join(per_doc, ["doc_id", "copy"]).mapInArrow(on(_with_symbols), _SEGMENT), "open-segments")
    ready, decided, led = [], [], []
    for windows in (FINER, 1):
        sizes = cut.groupBy("anchor").agg(F.count("*").alias("n"))
        hot = staged(sizes.filter(F.col("n") > HOT_SEGMENTS).select("anchor"), "hot")
        ready.append(cut.join(hot, "anchor", "left_anti"))
        if hot.isEmpty():
            cut = None
            break
        finer = cut.join(hot, "anchor", "left_semi").mapInArrow(
            lambda batches, w=windows: _finer(kind, w, batches), f"{_CUT}, symbols binary"
        )
        finer = staged(finer, "finer")
        again = finer.drop("symbols").repartition("anchor").sortWithinPartitions(*_NAMES).mapInArrow(collapse, _CUT)
        again = staged(again, "collapsed")
        equal = again.filter(F.col("state") == _FOLLOWS)
        decided.append(equal.select("doc_id", "copy", "at"))
        led.append(equal.filter("root <> 0").select("root", (F.col("at") - _place("begin")).alias("run")))
        left = again.filter(F.col("state") != _FOLLOWS).select("anchor", "doc_id", "copy", "at")
        cut = staged(finer.join(left, ["anchor", "doc_id", "copy", "at"]).select(*_SHARD), "open-segments")
    if cut is not None:
        # Single windows: equal ones were one row, so none is left open but rows of one document, and
        # windows that others follow.
        ready.append(cut)
    segments = ready[0]
    for more in ready[1:]:
        segments = segments.unionByName(more)
    searched = segments.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(on(_searched), _FOUND)
    searched = staged(searched, "searched")
    out = searched.filter("root is null").select("doc_id", "copy", "at")
    runs = searched.filter("root is not null").select("root", F.col("at").alias("run"))
    for more in led:
        runs = runs.unionByName(more)
    start = F.shiftright("at", _COUNT_BITS + _ANCHOR_BITS)
    expanded = followers.select(F.col("segment").alias("root"), "doc_id", "copy", start.alias("start")).join(runs, "root")
    decided.append(expanded.select("doc_id", "copy", (F.col("run") + _place("start")).alias("at")))
    for more in decided:
        out = out.unionByName(more)
    return out


def _place(start: str) -> Column:
    """A start where a packed place has it."""
    return F.shiftleft(F.col(start), _COUNT_BITS + _ANCHOR_BITS)


def covered(kind: Kind, docs: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """``docs`` with the parts that their repeated windows cover, as ``finish`` makes rows of them.

    ``finish(batch, symbols' spans of removal)`` gets, per document, start and end symbols.
    """
    clash = not unique_ids(docs)
    named = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        # Rows that share an id are told apart by their text.
        (F.xxhash64("text") if clash else F.lit(0).cast("bigint")).alias("copy"),
        F.col("text"),
    )
    windows = marks(named.filter("doc_id is not null").dropDuplicates(["doc_id", "copy"]) if clash
                    else named.filter("doc_id is not null"), kind)
    per_doc = windows.groupBy("doc_id", "copy").agg(F.collect_list("at").alias("marks"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in large_batches(batches, size=2 << 20):
            spans = []
            for given in batch.column("marks"):
                at = given.values.to_numpy() if given.is_valid else np.empty(0, np.int64)
                start, count, _ = _unpack(np.sort(at))
                end = start + count + kind.width - 1
                if len(start):
                    reach = np.maximum.accumulate(end)
                    head = np.ones(len(start), bool)
                    head[1:] = start[1:] > reach[:-1]
                    at = np.flatnonzero(head)
                    spans.append((start[at], np.append(reach[at[1:] - 1], reach[-1])))
                else:
                    spans.append((start, end))
            yield finish(batch, spans)

    return named.join(per_doc, ["doc_id", "copy"], "left").mapInArrow(work, schema)
