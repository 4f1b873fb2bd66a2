"""Similarity join on word shingles with signature trees."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import (
    large_batches,
    mix,
    ragged,
    small_batches,
    spaced,
    spans_of_words,
    text_bytes,
    unique_ids,
    word_hashes,
)
from gleaner.llm.components import components
from gleaner.llm.repeats import id_filter, marked, with_slots
from gleaner.stage import staged

WORDS = 5
# A pair links when TOP * intersection >= SHARE * union.
TOP, SHARE = 100, 80
# Shingles are counted by so many hash buckets; the counts only set an order.
COUNT_BITS = 20
COUNT_SLICES = 64
CLASS_SHIFT = 59
# A class is the binary logarithm of a bucket's count over the mean; classes from HOT on are dealt out in parts.
HOT_CLASS = 8
HOT_PARTS = 64
# Larger groups first try one centre; larger ones than BLOCK are cut.
SMALL_GROUP = 8
BLOCK = 2048
# Where whole sets meet, a block has about so many shingles at most; with bitmaps, so many times that.
BLOCK_SHINGLES = 1 << 20
BITMAP_BLOCKS = 8
FANOUT = 8
PAIRS = 1 << 15
# Bits of a bitmap per shingle, at least, and words of bitmaps that are compared at once.
BITS = 2
COMPARED = 1 << 20
# Pairs of a forest that are tested at once.
TESTED = 1024

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of all texts in order, and the offsets of each text's share.

    A text with fewer words has one shingle, of all its words; one without words has none.
    """
    lowered = spaced(_LOWER[data], offsets)
    starts, ends = spans_of_words(lowered)
    h = word_hashes(lowered, starts, ends)
    per_text = np.diff(np.searchsorted(starts, offsets + np.arange(len(offsets))))
    factor = np.uint64(0x9FB21C651E98DF25)
    out = h.copy()
    inside = np.arange(len(h)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    left = np.repeat(per_text, per_text) - inside
    for k in range(1, words):
        out *= factor
        following = np.zeros_like(h)
        if k < len(h):
            following[:-k] = h[k:]
        # Where a short text ends, its shingle ends too: the number of words is part of the hash.
        out += np.where(left > k, following, np.uint64(k))
    mix(out)
    use = (left >= words) | (inside == 0)
    sums = np.concatenate([[0], np.cumsum(use)])
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    return out[use], sums[bounds]


def count_classes(docs: DataFrame) -> np.ndarray:
    """A class per hash bucket: 0 for buckets about as full as the mean, one more per doubling.

    All shingles of all documents are counted. The result has a fixed size.
    """
    size = (1 << COUNT_BITS) // COUNT_SLICES

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in large_batches(batches, release=True):
            h, _ = shingle_hashes(*text_bytes(batch.column("text")))
            total += np.bincount(h >> np.uint64(64 - COUNT_BITS), minlength=1 << COUNT_BITS)
        if total.any():
            yield _counted(range(COUNT_SLICES), total.reshape(COUNT_SLICES, size))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                values = np.frombuffer(counts.as_buffer(), np.uint8)
                values = values.view(np.uint16 if len(values) == 2 * size else np.uint32)
                sums[part] = sums.get(part, 0) + values.astype(np.int64)
        if sums:
            yield _counted(sums, list(sums.values()))

    def _counted(parts, rows) -> pa.RecordBatch:
        # Two bytes a count where that is enough.
        kinds = [np.uint16 if r.max() < 1 << 16 else np.uint32 for r in rows]
        blobs = [np.minimum(r, 0xFFFFFFFF).astype(k).tobytes() for r, k in zip(rows, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(parts), pa.int32()), pa.array(blobs, pa.binary())], names=["part", "counts"]
        )

    schema = "part int, counts binary"
    summed = docs.select("text").mapInArrow(count, schema).repartition(COUNT_SLICES, "part").mapInArrow(add, schema)
    table = np.zeros((COUNT_SLICES, size), np.float64)
    for row in summed.toLocalIterator():
        values = np.frombuffer(row["counts"], np.uint8)
        table[row["part"]] = values.view(np.uint16 if len(values) == 2 * size else np.uint32)
    table = table.ravel()
    mean = max(1.0, table.mean())
    return np.clip(np.log2(np.maximum(table, 1) / mean), 0, 31).astype(np.uint8)


def text_sets(batch: pa.RecordBatch, classes: np.ndarray) -> list[np.ndarray]:
    """The sorted, distinct shingle numbers of each text: rare classes first, then by hash."""
    h, bounds = shingle_hashes(*text_bytes(batch.column("text")))
    numbers = (h >> np.uint64(64 - CLASS_SHIFT)) | (
        classes[h >> np.uint64(64 - COUNT_BITS)].astype(np.uint64) << np.uint64(CLASS_SHIFT)
    )
    return [np.unique(numbers[s:e]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def set_key(numbers: np.ndarray) -> int:
    """A number for the content of a set, as a signed 64-bit value."""
    positions = np.arange(1, len(numbers) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return int(mix(numbers + positions).sum(dtype=np.uint64).astype(np.int64))


def signature(numbers: np.ndarray) -> bytes:
    """A bitmap with ``BITS`` to twice as many bits per shingle; 64 at least."""
    bits = max(64, BITS << int(len(numbers) - 1).bit_length())
    at = ((numbers * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)) & np.uint64(bits - 1)
    out = np.zeros(bits, np.uint8)
    out[at] = 1
    return np.packbits(out, bitorder="little").tobytes()


def prefix_length(n: int) -> int:
    """Two sets that link have a common shingle among their first so many."""
    return n - -(-SHARE * n // TOP) + 1


def _sets(batches: Iterable[pa.RecordBatch], classes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per document; of equal sets in a task only the first has a prefix and a signature."""
    base, at = TaskContext.get().partitionId() << 36, 0
    known: dict[tuple[int, int], int] = {}
    for batch in large_batches(batches, release=True):
        sets = text_sets(batch, classes)
        uids, prefixes, signatures, keys = [], [], [], []
        for numbers in sets:
            key, uid = (set_key(numbers), len(numbers)), base + at
            first = known.setdefault(key, uid)
            new = first == uid and len(numbers) > 0
            uids.append(first)
            keys.append(key[0])
            prefixes.append(numbers[: prefix_length(len(numbers))].tobytes() if new else None)
            signatures.append(signature(numbers) if new else None)
            at += 1
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(uids, pa.int64()),
                pa.array(keys, pa.int64()),
                pa.array(prefixes, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            names=["doc_id", "text_hash", "n", "uid", "set_key", "prefix", "bits"],
        )


def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per set and prefix shingle; very frequent shingles are dealt out in parts."""
    for batch in batches:
        for first in range(0, batch.num_rows, 1024):
            part = batch.slice(first, 1024)
            blobs = part.column("prefix").to_pylist()
            lengths = np.array([len(b) // 8 for b in blobs], np.int64)
            token = np.frombuffer(b"".join(blobs), np.uint64)
            uid = np.repeat(part.column("uid").to_numpy(), lengths)
            n = np.repeat(part.column("n").to_numpy(), lengths).astype(np.int32)
            hot = (token >> np.uint64(CLASS_SHIFT)) >= HOT_CLASS
            salt = np.where(hot, mix(uid.astype(np.uint64)) % np.uint64(HOT_PARTS), np.uint64(0)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(salt), pa.array(uid), pa.array(n)],
                names=["token", "salt", "uid", "n"],
            )


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of shingles that several sets have (sorted input), and all rows of the very frequent ones."""
    held: list[np.ndarray] = []

    def done(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
        run = np.cumsum(new) - 1
        several = np.bincount(run)[run] > 1
        hot = (rows[:, 0].view(np.uint64) >> np.uint64(CLASS_SHIFT)) >= HOT_CLASS
        out = rows[several | hot]
        if len(out):
            arrays = [pa.array(np.ascontiguousarray(out[:, k])) for k in (0, 2, 3)]
            yield pa.RecordBatch.from_arrays(arrays, names=["token", "uid", "n"])

    for batch in batches:
        rows = np.stack(
            [batch.column(c).to_numpy().astype(np.int64) for c in ("token", "salt", "uid", "n")], axis=1
        )
        if not len(rows):
            continue
        held.append(rows)
        last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))
        if len(last):
            cut = int(last[-1]) + 1
            yield from done(np.concatenate([*held[:-1], rows[:cut]]))
            held = [rows[cut:]]
    if held:
        yield from done(np.concatenate(held))


class SignatureTree:
    """Sets in order of size under nodes with OR-combined bitmaps and ranges of sizes.

    ``levels[0]`` are the sets. A node keeps its bitmap (folded to the narrowest of the group, at
    most ``WIDTH`` words), the range of sizes, the most shingles that share a bit with another one of
    their set, and the common component of its sets, or -1.
    """

    WIDTH = 64

    def __init__(self, sizes: np.ndarray, bitmaps: list[np.ndarray], components: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        self.order = order
        ordered = [bitmaps[k] for k in order]
        # The whole bitmaps, by their width.
        self.widths = np.array([len(b) for b in ordered])
        self.whole = {w: np.stack([b for b in ordered if len(b) == w]) for w in set(self.widths.tolist())}
        self.place = np.zeros(len(ordered), np.int64)
        for w, rows in self.whole.items():
            self.place[self.widths == w] = np.arange(len(rows))
        width = min(self.WIDTH, int(self.widths.min()))
        words = np.stack([np.bitwise_or.reduce(b.reshape(-1, width), axis=0) for b in ordered])
        low = high = sizes[order].astype(np.int64)
        excess = low - np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        component = components[order]
        self.levels = [(words, low, high, excess, component)]
        while len(words) > 1:
            heads = np.arange(0, len(words), FANOUT)
            same = np.minimum.reduceat(component, heads) == np.maximum.reduceat(component, heads)
            component = np.where(same, component[heads], -1)
            words = np.bitwise_or.reduceat(words, heads, axis=0)
            low, high = np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
            excess = np.maximum.reduceat(excess, heads)
            self.levels.append((words, low, high, excess, component))

    def possible(self, level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether node pairs can hold a link: components, sizes, then the largest possible overlap."""
        words, low, high, excess, component = self.levels[level]
        keep = ~((component[x] == component[y]) & (component[x] >= 0))
        keep &= (TOP * high[x] >= SHARE * low[y]) & (TOP * high[y] >= SHARE * low[x])
        if level == 0:
            keep &= x < y
        at = np.flatnonzero(keep)
        common = np.bitwise_count(words[x[at]] & words[y[at]]).sum(axis=1, dtype=np.int64)
        overlap = common + np.minimum(excess[x[at]], excess[y[at]])
        keep[at] = (TOP + SHARE) * overlap >= SHARE * (low[x[at]] + low[y[at]])
        return keep

    def leaves(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Dual traversal: the pairs of sets, by their place in the tree, that the nodes and the folded bitmaps let pass."""
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, x, y = stack.pop()
            if len(x) > PAIRS:
                half = len(x) // 2
                stack += [(level, x[:half], y[:half]), (level, x[half:], y[half:])]
                continue
            keep = self.possible(level, x, y)
            x, y = x[keep], y[keep]
            if not len(x):
                continue
            if level == 0:
                yield x, y
                continue
            below = len(self.levels[level - 1][0])
            i = (x[:, None] * FANOUT + np.arange(FANOUT))[:, :, None]
            j = (y[:, None] * FANOUT + np.arange(FANOUT))[:, None, :]
            i, j = (v.ravel() for v in np.broadcast_arrays(i, j))
            use = (i < below) & (j < below) & (i <= j)
            stack.append((level - 1, i[use], j[use]))

    def pairs(self, whole_bitmaps: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of sets, by their given number, that may link."""
        for x, y in self.leaves():
            if whole_bitmaps:
                keep = self.fits(x, y)
                x, y = x[keep], y[keep]
            yield self.order[x], self.order[y]

    def forest(
        self, test: Callable[[np.ndarray, np.ndarray], np.ndarray], every: bool = False
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs for which ``test`` holds (it takes places in the tree), one fewer than sets at most.

        With the given components they connect all sets that any pairs for which ``test`` holds connect.
        With ``every``, sets of such pairs that are in no pair of the forest come as pairs with themselves.
        """
        label = np.unique(self.levels[0][4], return_inverse=True)[1]
        found: list[tuple[int, int]] = []
        met = np.zeros(len(label), bool)
        for x, y in self.leaves():
            for first in range(0, len(x), TESTED):
                i, j = x[first : first + TESTED], y[first : first + TESTED]
                if not every:
                    apart = label[i] != label[j]
                    i, j = i[apart], j[apart]
                holds = test(i, j)
                met[i[holds]] = met[j[holds]] = True
                for a, b in zip(i[holds].tolist(), j[holds].tolist(), strict=True):
                    if label[a] != label[b]:
                        label[label == label[b]] = label[a]
                        found.append((a, b))
        ends = np.array(found, np.int64).reshape(-1, 2)
        if every:
            met[ends] = False
            ends = np.concatenate([ends, np.repeat(np.flatnonzero(met), 2).reshape(-1, 2)])
        return self.order[ends[:, 0]], self.order[ends[:, 1]]

    def fits(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the whole bitmaps allow the overlap: a bit of one set alone is a shingle alone."""
        low = self.levels[0][1]
        out = np.zeros(len(x), bool)
        left, right = self.widths[x], self.widths[y]
        for a, b in set(zip(left.tolist(), right.tolist(), strict=True)):
            at = np.flatnonzero((left == a) & (right == b))
            width, step = min(a, b), max(1, COMPARED // max(a, b))
            for first in range(0, len(at), step):
                part = at[first : first + step]
                i, j = x[part], y[part]
                one, two = self.whole[a][self.place[i]], self.whole[b][self.place[j]]
                one = np.bitwise_or.reduce(one.reshape(len(part), -1, width), axis=1)
                two = np.bitwise_or.reduce(two.reshape(len(part), -1, width), axis=1)
                overlap = np.minimum(
                    low[i] - np.bitwise_count(one & ~two).sum(axis=1, dtype=np.int64),
                    low[j] - np.bitwise_count(two & ~one).sum(axis=1, dtype=np.int64),
                )
                out[part] = (TOP + SHARE) * overlap >= SHARE * (low[i] + low[j])
        return out

    def centre_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that may link with the set nearest to what most sets have."""
        words = self.levels[0][0]
        bits = np.unpackbits(words.view(np.uint8), axis=1)
        most = bits.sum(axis=0) * 2 > len(bits)
        centre = int((bits != most).sum(axis=1).argmin())
        others = np.delete(np.arange(len(bits)), centre)
        x, y = np.minimum(others, centre), np.maximum(others, centre)
        keep = self.possible(0, x, y)
        x, y = x[keep], y[keep]
        keep = self.fits(x, y)
        return self.order[x[keep]], self.order[y[keep]]


def _joined(batches: Iterable[pa.RecordBatch], forest: bool) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of each group (sorted by group): of large groups those with their centre, or with
    ``forest`` as many as connect all that may link, and every set that may link in one at least. Either way
    there are no more than sets, but for small groups."""

    def group(rows: list[tuple]) -> pa.RecordBatch | None:
        rows = list({r[0]: r for r in rows}.values())
        if len(rows) < 2:
            return None
        uids = np.array([r[0] for r in rows], np.int64)
        tree = SignatureTree(
            np.array([r[1] for r in rows]),
            [np.frombuffer(r[2], np.uint64) for r in rows],
            np.array([r[3] for r in rows], np.int64),
        )
        if forest:
            x, y = tree.forest(tree.fits, every=True)
        elif len(rows) <= SMALL_GROUP:
            found = list(tree.pairs()) or [(np.empty(0, np.int64),) * 2]
            x, y = (np.concatenate(side) for side in zip(*found, strict=True))
        else:
            x, y = tree.centre_pairs()
        a, b = np.minimum(uids[x], uids[y]), np.maximum(uids[x], uids[y])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    name, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("token", "i", "j", "uid", "n", "bits", "component")]
        for token, i, j, *row in zip(*columns, strict=True):
            if (token, i, j) != name:
                if (out := group(rows)) is not None:
                    yield out
                name, rows = (token, i, j), []
            rows.append(tuple(row))
    if (out := group(rows)) is not None:
        yield out


def _candidates(dealt: DataFrame, forest: bool) -> DataFrame:
    """Pairs of the sets of each group ``token, i, j``."""

    def join(batches):
        return _joined(batches, forest)

    return (
        dealt.select("token", "i", "j", "uid", "n", "bits", "component")
        .repartition("token", "i", "j")
        .sortWithinPartitions("token", "i", "j")
        .mapInArrow(join, "a long, b long")
        .distinct()
    )


def _in_blocks(groups: DataFrame, shingles: int) -> DataFrame:
    """A group of more than ``BLOCK`` sets or so many ``shingles`` is cut into blocks: a set goes to all
    pairs of blocks that contain its own."""
    cuts = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / shingles)).cast("int")
    own = F.pmod(F.xxhash64("uid"), F.col("cuts")).cast("int")
    return (
        groups.withColumn("cuts", cuts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
    )


def _neighbourhoods(members: DataFrame) -> DataFrame:
    """A first cut of the sets into groups: ``token`` is a set with which many shingles are shared.

    Of each shingle's sets the first is the head; a set goes to the head with which it shares most
    shingles. A large group is dealt out in parts, with its head in all of them. Which sets meet here
    decides how much is left for later, not what is found.
    """
    heads = members.groupBy("token").agg(F.min("uid").alias("head"), F.count("*").alias("members"))
    heads = heads.filter("members > 1").select("token", "head")
    shared = members.join(heads, "token").filter("uid <> head")
    shared = shared.groupBy("uid", "head").agg(F.count("*").alias("common"), F.max("n").alias("n"))
    best = shared.groupBy("uid").agg(
        F.max_by("head", F.struct("common", -F.col("head"))).alias("token"), F.max("n").alias("n")
    )
    best = staged(best, "best")
    sizes = best.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("cuts"))
    own = best.join(sizes, "token").withColumn("i", F.pmod(F.xxhash64("uid"), F.col("cuts")).cast("int"))
    sets = members.select("uid", "n").distinct()
    of_heads = (
        sizes.join(sets.withColumnRenamed("uid", "token"), "token")
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .withColumn("uid", F.col("token"))
    )
    columns = ["token", "i", "uid", "n"]
    both = own.select(*columns).unionByName(of_heads.select(*columns))
    return both.withColumn("j", F.col("i")).withColumn("component", F.lit(-1).cast("bigint"))


def _whole_sets(docs: DataFrame, wanted: DataFrame, classes) -> DataFrame:
    """``name, numbers``: the sets of the documents that ``wanted`` names, read from their texts again."""
    marks = id_filter(wanted, "name")
    sent = docs.sparkSession.sparkContext.broadcast(marks)

    def rebuild(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in large_batches(marked(batches, sent.value), release=True):
            blobs = [numbers.tobytes() for numbers in text_sets(batch, classes.value)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), pa.array(blobs, pa.binary())], names=["name", "numbers"]
            )

    texts = docs.select("text", F.xxhash64(F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("name"))
    return with_slots(texts, "name", marks).mapInArrow(rebuild, "name long, numbers binary")


def _verified(docs: DataFrame, pairs: DataFrame, sets: DataFrame, classes) -> DataFrame:
    """The pairs whose sets really link. Only documents of these pairs are read into sets again.

    Of the ends of a pair, the one with more pairs waits and the other is sent to it; a set with very
    many pairs waits in several slices.
    """
    degree = (
        pairs.select(F.col("a").alias("uid"))
        .unionByName(pairs.select(F.col("b").alias("uid")))
        .groupBy("uid")
        .agg(F.count("*").alias("degree"))
    )
    one = degree.select(F.col("uid").alias("a"), F.col("degree").alias("of_a"))
    two = degree.select(F.col("uid").alias("b"), F.col("degree").alias("of_b"))
    ends = pairs.join(one, "a").join(two, "b")
    first = F.col("of_a") >= F.col("of_b")
    routes = ends.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("uid"),
        F.ceil(F.greatest("of_a", "of_b") / 256).cast("int").alias("slices"),
    )
    routes = staged(routes.withColumn("slice", F.pmod(F.xxhash64("uid"), F.col("slices")).cast("int")), "routes")
    members = routes.select("uid", "hub", "slice", F.lit(1).alias("role"))
    hubs = routes.select(F.col("hub").alias("uid"), "hub", "slice", F.lit(0).alias("role")).distinct()
    sides = hubs.unionByName(members)
    named = sets.filter("prefix is not null").select("uid", "doc_id", "text_hash")
    sides = staged(sides.join(named, "uid").withColumn("name", F.xxhash64("doc_id", "text_hash")), "sides")

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, hub = None, None
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("hub", "slice", "role", "uid")]
            for h, s, role, uid, blob in zip(*columns, batch.column("numbers"), strict=True):
                numbers = np.frombuffer(blob.as_buffer(), np.uint64)
                if role == 0:
                    name, hub = (h, s), numbers
                elif name == (h, s):
                    at = np.searchsorted(hub, numbers)
                    at[at == len(hub)] = 0
                    common = int((hub[at] == numbers).sum())
                    if TOP * common >= SHARE * (len(hub) + len(numbers) - common):
                        found.append((h, uid))
            columns = list(zip(*found, strict=True)) or [(), ()]
            a, b = (np.array(c, np.int64) for c in columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
            )

    contents = _whole_sets(docs, sides, classes)
    return staged(
        sides.join(contents, "name")
        .select("hub", "slice", "role", "uid", "numbers")
        .repartition("hub", "slice")
        .sortWithinPartitions("hub", "slice", "role")
        .mapInArrow(check, "a long, b long"),
        "links",
    )


class Overlaps:
    """Counts the shingles that sets of one group share."""

    def __init__(self, sets: list[np.ndarray]):
        self.lengths = np.array([len(s) for s in sets], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        # Shingles by number within the group, so that a set can be marked in a table.
        values, at = np.unique(np.concatenate(sets), return_inverse=True)
        self.at = at.astype(np.int32)
        self.inside = np.zeros(len(values), np.uint8)

    def link(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether each of the pairs links."""
        out = np.zeros(len(x), bool)
        order = np.argsort(x, kind="stable")
        heads = np.flatnonzero(np.diff(x[order], prepend=-1))
        for part in np.split(order, heads[1:]) if len(x) else []:
            k, others = int(x[part[0]]), y[part]
            mine = self.at[self.starts[k] : self.starts[k] + self.lengths[k]]
            self.inside[mine] = 1
            sizes = self.lengths[others]
            found = self.inside[self.at[ragged(self.starts[others], sizes)]]
            common = np.add.reduceat(found, np.cumsum(sizes) - sizes, dtype=np.int64)
            self.inside[mine] = 0
            out[part] = TOP * common >= SHARE * (self.lengths[k] + sizes - common)
        return out


def _tree_of(sets: list[np.ndarray], components: np.ndarray) -> SignatureTree:
    bitmaps = [np.frombuffer(signature(s), np.uint64) for s in sets]
    return SignatureTree(np.array([len(s) for s in sets], np.int64), bitmaps, components)


def count_links(uids: np.ndarray, own: np.ndarray, sets: list[np.ndarray], across: bool) -> np.ndarray:
    """How many of the others each set links with; ``across`` takes only pairs of different blocks ``own``."""
    # The traversal passes over pairs of one component. Here those are pairs that meet elsewhere.
    tree, overlaps = _tree_of(sets, own if across else np.full(len(sets), -1)), Overlaps(sets)
    counts = np.zeros(len(uids), np.int64)
    for x, y in tree.pairs(whole_bitmaps=False):
        links = overlaps.link(x, y)
        np.add.at(counts, x[links], 1)
        np.add.at(counts, y[links], 1)
    return counts


def connecting_links(components: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links, one fewer than sets at most, that with the given components connect all sets that links connect."""
    tree, overlaps = _tree_of(sets, components), Overlaps(sets)
    return tree.forest(lambda x, y: overlaps.link(tree.order[x], tree.order[y]))


def _sets_by_group(
    batches: Iterable[pa.RecordBatch], key: str, value: str
) -> Iterator[tuple[tuple, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """``(key, i, j)``, the uids, their ``value`` and the whole sets of each group of two or more (sorted input)."""

    def group() -> tuple:
        uids = np.array(list(rows), np.int64)
        return name, uids, np.array([r[0] for r in rows.values()], np.int64), [r[1] for r in rows.values()]

    name, rows = None, {}
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (key, "i", "j", "uid", value)]
        for k, i, j, uid, given, blob in zip(*columns, batch.column("numbers"), strict=True):
            if (k, i, j) != name:
                if len(rows) > 1:
                    yield group()
                name, rows = (k, i, j), {}
            # Rows with equal id and text come more than once.
            if uid not in rows:
                rows[uid] = given, np.frombuffer(blob.as_py(), np.uint64)
    if len(rows) > 1:
        yield group()


def _links_in_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of links that each set has in a pair of blocks (sorted input)."""
    for name, uids, own, sets in _sets_by_group(batches, "root", "own"):
        counts = count_links(uids, own, sets, name[1] != name[2])
        yield pa.RecordBatch.from_arrays([pa.array(uids), pa.array(counts)], names=["canon", "n_links"])


def _connecting(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect what is not yet one component in a pair of blocks (sorted input)."""
    for _, uids, component, sets in _sets_by_group(batches, "cluster", "component"):
        x, y = connecting_links(component, sets)
        a, b = np.minimum(uids[x], uids[y]), np.maximum(uids[x], uids[y])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _open_groups(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``token, uid, n, component, members, shingles``: the groups whose sets are not all in one component.

    Groups of the same sets are one; the first shingle stands for all.
    """
    placed = members.join(roots.withColumnRenamed("node", "uid"), "uid", "left").select(
        "token", "uid", "n", F.coalesce("root", "uid").alias("component")
    )
    placed = staged(placed, "placed")
    named = placed.groupBy("token").agg(
        F.count("*").alias("members"),
        F.sum("n").alias("shingles"),
        F.bit_xor(F.xxhash64("uid")).alias("name"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    named = named.filter("low <> high").groupBy("members", "shingles", "name").agg(F.min("token").alias("token"))
    return staged(placed.join(named.drop("name"), "token"), "open")


def _remaining_links(docs: DataFrame, members: DataFrame, links: DataFrame, sets: DataFrame, classes) -> DataFrame:
    """Links that with ``links`` connect all that any links connect.

    Each open group gives a forest of pairs that its bitmaps allow, so no more pairs than sets. The
    components of these pairs and the links are clusters, and no link leaves a cluster. So each set that
    has a possible partner goes to one cluster, however many shingles it shares; there the whole sets
    meet, in pairs of blocks, and a union-find in the task keeps the links that connect something.
    """
    roots = components(links)
    groups = _open_groups(members, roots)
    if groups.isEmpty():
        return links
    named = sets.filter("prefix is not null").select("uid", "n", F.xxhash64("doc_id", "text_hash").alias("name"))
    bits = sets.filter("prefix is not null").select("uid", "bits")
    tried = _candidates(_in_blocks(groups, BITMAP_BLOCKS * BLOCK_SHINGLES).join(bits, "uid"), True)
    tried = staged(tried, "tried")
    clusters = components(links.select("a", "b").unionByName(tried))
    met = tried.select(F.col("a").alias("uid")).unionByName(tried.select(F.col("b").alias("uid"))).distinct()
    met = (
        met.join(clusters.select(F.col("node").alias("uid"), F.col("root").alias("cluster")), "uid")
        .join(roots.select(F.col("node").alias("uid"), "root"), "uid", "left")
        .join(named, "uid")
        .select("uid", "cluster", "n", "name", F.coalesce("root", "uid").alias("component"))
    )
    met = staged(met, "met")
    if met.isEmpty():
        return links
    sizes = met.groupBy("cluster").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    connecting = (
        _in_blocks(met.join(sizes, "cluster").join(_whole_sets(docs, met, classes), "name"), BLOCK_SHINGLES)
        .select("cluster", "i", "j", "uid", "component", "numbers")
        .repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j")
        .mapInArrow(_connecting, "a long, b long")
    )
    return links.select("a", "b").unionByName(connecting)


def _degrees(docs: DataFrame, links: DataFrame, roots: DataFrame, sets: DataFrame, classes) -> DataFrame:
    """``canon, n_links``: with how many other sets each set of a component links.

    No link leaves a component. Where ``links`` holds every pair of a component, its numbers are known.
    The sets of the other components are read again and meet whole, in pairs of blocks, so that each
    pair is tested once; only counts leave a task.
    """
    known = links.join(roots.withColumnRenamed("node", "a"), "a").groupBy("root").agg(F.count("*").alias("links"))
    named = sets.filter("prefix is not null").select("uid", "n", F.xxhash64("doc_id", "text_hash").alias("name"))
    nodes = staged(roots.withColumnRenamed("node", "uid").join(named, "uid"), "nodes")
    sizes = nodes.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("shingles")).join(known, "root")
    sizes = staged(sizes.withColumn("open", F.expr("2 * links < members * (members - 1)")), "sizes")
    whole = nodes.join(sizes.filter("not open"), "root").select(
        F.col("uid").alias("canon"), (F.col("members") - 1).alias("n_links")
    )
    rest = nodes.join(sizes.filter("open"), "root").select("uid", "root", "name", "members", "shingles")
    rest = staged(rest, "open")
    if rest.isEmpty():
        return whole
    counted = (
        _in_blocks(rest.join(_whole_sets(docs, rest, classes), "name"), BLOCK_SHINGLES)
        .select("root", "i", "j", "uid", "own", "numbers")
        .repartition("root", "i", "j")
        .sortWithinPartitions("root", "i", "j")
        .mapInArrow(_links_in_blocks, "canon long, n_links long")
    )
    return whole.unionByName(counted.groupBy("canon").agg(F.sum("n_links").alias("n_links")))


def linked(docs: DataFrame, count: bool = True) -> DataFrame:
    """``doc_id, n_shingles, n_links, component_id`` (and ``text_hash``) for every row of ``docs``.

    Words are runs of anything but ASCII white space, with A-Z lower-cased. The set of a text is its
    distinct shingles of five words; a shorter text has one shingle. Sets link when their Jaccard
    similarity is 0.8 or more. ``component_id`` is the smallest id reachable by links, also over rows
    with equal sets; null ids are passed over, and a component of null ids only has none. A null
    text or one without words has no shingle, no link and its own id. ``n_links`` counts all
    other different sets that the set links with; without ``count`` it is left out.

    1. All shingles are counted in a table of fixed size, which gives an order: rare ones first.
    2. Sets that link share one of the first fifth of their shingles in that order. Rows of those
       are grouped by shingle; what no other set has is gone.
    3. Sets go to the neighbour with which they share most. There a signature tree finds the pairs
       that may link, in large groups those with a centre; they are checked on the whole sets.
    4. Shingles whose sets are not yet in one component get a tree of their own, whose traversal
       prunes nodes within a component. A union-find leaves of the pairs that may link a forest. The
       components of all forests and links are clusters; the sets with a possible partner meet there as
       whole sets and are checked in the task. So no link between components is missed, no
       group gives more pairs than it has sets, and a set is sent to one cluster only.
    5. For ``n_links``, components of which not every pair has been found linked are read again; their
       sets meet in pairs of blocks and a tree without that pruning, and are counted there.

    The checks compare 64-bit hashes of shingles, so a wrong result needs a collision.
    """
    spark = docs.sparkSession
    small_batches(spark)
    counted = count_classes(docs)
    classes = spark.sparkContext.broadcast(counted)

    def sets_of(batches):
        return _sets(batches, classes.value)

    sets = staged(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("text_hash")
        ).mapInArrow(
            sets_of, "doc_id long, text_hash long, n long, uid long, set_key long, prefix binary, bits binary"
        ),
        "sets",
    )
    tokens = sets.filter("prefix is not null").select("uid", "n", "prefix").mapInArrow(
        _tokens, "token long, salt int, uid long, n int"
    )
    # Equal sets of different tasks are one: the smallest number stands for all.
    one = Window.partitionBy("set_key", "n")
    same = sets.select("uid", "set_key", "n").filter("n > 0").distinct()
    same = staged(same.withColumn("canon", F.min("uid").over(one)).select("uid", "canon"), "canon")
    shared = staged(
        tokens.repartition("token", "salt").sortWithinPartitions("token", "salt", "uid").mapInArrow(
            _shared, "token long, uid long, n long"
        ),
        "shared",
    )
    members = shared.join(same, "uid").select("token", F.col("canon").alias("uid"), "n").distinct()
    members = staged(members, "members")
    bits = sets.filter("prefix is not null").select("uid", "bits")
    near = _candidates(_neighbourhoods(members).join(bits, "uid"), False).select("a", "b").distinct()
    links = _verified(docs, staged(near, "pairs"), sets, classes)
    links = staged(_remaining_links(docs, members, links, sets, classes).distinct(), "links")
    roots = staged(components(links), "roots")
    placed = (
        sets.select("doc_id", "text_hash", "n", "uid")
        .join(same, "uid", "left")
        .join(roots.withColumnRenamed("node", "canon"), "canon", "left")
    )
    columns = ["doc_id", "text_hash", "n", F.coalesce("root", "canon").alias("root")]
    if count:
        placed = placed.join(_degrees(docs, links, roots, sets, classes), "canon", "left")
        columns.append(F.coalesce("n_links", F.lit(0)).alias("n_links"))
    placed = placed.select(*columns)
    placed = staged(placed, "placed")
    least = placed.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        *(["n_links"] if count else []),
        F.coalesce("least", F.when(F.col("root").isNull(), F.col("doc_id"))).alias("component_id"),
        "root",
        "text_hash",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns.

    Rows without a shingle stay. Where ids repeat or are null, the row with the smallest text hash of
    the smallest id stays (null last), and equal rows of that kind stay as one.
    """
    found = staged(linked(docs, count=False), "components")
    if unique_ids(docs):
        keep = found.filter("component_id = doc_id").select("doc_id")
        return docs.join(keep, "doc_id", "left_semi").select(docs.columns)
    order = Window.partitionBy("root").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash")
    first = found.filter("root is not null").withColumn("_nth", F.row_number().over(order)).filter("_nth = 1")
    keep = first.select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
    bare = found.filter("root is null").select("doc_id", "text_hash").distinct()
    bare = bare.select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.xxhash64("text") == F.col("_kept_hash"))
    without = docs.join(bare, same, "left_semi")
    number = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text")
    matched = docs.join(keep, same, "left_semi").withColumn("_nth", F.row_number().over(number)).filter("_nth = 1")
    return matched.select(docs.columns).unionByName(without.select(docs.columns))
