"""The similarity join of ``neighbors`` on sparse vectors in a wide space, by shared rare words.

Rule and results are those of ``neighbors``: each row's nearest other row at or above the threshold,
ties to the smallest id. Vectors hold one count per hashed word and are never made dense as a whole.

1. Copies collapse map-side, as there.
2. Each word's number of rows is counted, and every row lists its words by it, the rarest first. Words
   may weigh more the rarer they are, which makes step 3 sharper.
3. A row is known by its prefix: the first words, until what is left is shorter than the threshold. Two
   rows without a common prefix word stay below it: of the words they share, those past the end of the
   prefix that ends first make up less than the threshold, and there are none before it.
4. Rows of like length share a block, and some blocks a wide block. A row meets a wide block once, however
   many prefix words it has in common with rows there, and only if one of these may be their first common
   word, by the remaining lengths.
5. What is sent there is a short form: the lengths of a row's parts by the hash of the word, rounded up. The
   product of two short forms is no less than the similarity, so a task finds the blocks in which a row may
   have a partner, and only there its vector is sent.
6. A task multiplies the vectors of two blocks exactly where the product of their parts' lengths leaves a
   pair open, and returns each row's best partner, never pairs.

So a vector goes to the blocks in which it may have a partner, not to all blocks. Rows that do share a
frequent prefix word still have their short forms compared with each other: that part is quadratic in their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.tokens import tokens
from gleaner.operators.neighbors import DIGITS, MATCH, _Layout, distinct_vectors, survivors, with_copies
from gleaner.stage import staged

# Hex digits of a word's md5 that are its code: 28 bits.
CODE_DIGITS = 7
CODES = 16**CODE_DIGITS
# Bytes of an entry of a vector: its code and its count.
ENTRY_BYTES = 8
# Rows of a block; one of so many entries more counts as another.
BLOCK_ROWS = 16384
ROW_ENTRIES = 512
# Cells of like lengths for every doubling of the length, and the bits of a cell's number.
CELLS = 16
CELL_BITS = 9
# The highest number of 16 bits, which stands for 1.
TOP = (1 << 16) - 1
# Rows of words that are worked on together.
CHUNK_ROWS = 1 << 18
# Blocks of a wide block, whose short forms a task holds at a time.
WIDE = 4
# Parts of a short form, and the levels of their lengths: each is so many times the one below.
PARTS = 512
LEVELS = np.append(0, 2.0 ** (np.arange(-254, 1) / 20)).astype(np.float32)
# Parts where those leave many pairs of long rows open.
FINE = 4096
# Words whose numbers are sent to all tasks at a time.
LOOKUP_WORDS = 1 << 22
# Rows of a tile of products, and the entries that are multiplied at a time.
TILE_ROWS = 1024
CHUNK_ENTRIES = 1 << 21
# Entries of vectors that are listed at a time, whatever the number of rows in a batch.
LISTED_ENTRIES = 1 << 17
# Rounding of norms and sums: prefixes are a little longer than needed.
SLACK = 1e-9
# How far a product of lengths of parts, in single precision, may be off, for each part.
ROUGH = 2.0**-22


def word_codes(text: Column) -> Column:
    """The first hex digits of every word's md5, strung together."""
    codes = F.transform(tokens(F.lower(text)), lambda w: F.substring(F.md5(w), 1, CODE_DIGITS))
    return F.array_join(codes, "")


def sparse_vectors(df: DataFrame, text: Column, id_col: str) -> DataFrame:
    """``id_col`` and ``vector``: the counts of the text's words by code, as bytes; null without words."""

    @F.arrow_udf("binary")
    def counted(strings: pa.Array) -> pa.Array:
        out = []
        for value in strings.to_pylist():
            if not value:
                out.append(None)
                continue
            digits = np.frombuffer(value.encode("ascii"), np.uint8).astype(np.int32)
            digits = np.where(digits >= ord("a"), digits - (ord("a") - 10), digits - ord("0"))
            codes, counts = np.unique(digits.reshape(-1, CODE_DIGITS) @ _PLACES, return_counts=True)
            out.append(_planes(codes, counts))
        return pa.array(out, pa.binary())

    return df.select(id_col, counted(word_codes(text)).alias("vector"))


_PLACES = (16 ** np.arange(CODE_DIGITS - 1, -1, -1)).astype(np.int32)


def _planes(codes: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ascending codes as steps, and numbers of each, byte by byte: small numbers make runs of zeros, which compress."""
    table = np.stack([np.diff(codes, prepend=0), *columns]).astype("<i4")
    return table.view(np.uint8).reshape(len(table), -1, 4).transpose(0, 2, 1).tobytes()


def _listed(packed: pa.Array | pa.ChunkedArray, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """A table of the codes and ``columns`` numbers of all rows of ``_planes``, and the entries of each row."""
    values = packed.to_pylist()
    sizes = np.array([len(v) for v in values], np.int64) // (4 * (columns + 1))
    out = np.empty((columns + 1, int(sizes.sum())), np.int32)
    low = 0
    for value, size in zip(values, sizes.tolist(), strict=True):
        bytes_ = np.frombuffer(value, np.uint8).reshape(columns + 1, 4, size).transpose(0, 2, 1)
        part = out[:, low : low + size]
        part[:] = np.ascontiguousarray(bytes_).view("<i4")[:, :, 0]
        np.cumsum(part[0], out=part[0])
        low += size
    return out, sizes


def _cut(batches: Iterable[pa.RecordBatch], column: str, width: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``LISTED_ENTRIES`` entries; one row may have more."""
    for batch in batches:
        values = batch.column(column)
        sizes = pc.binary_length(values) if pa.types.is_binary(values.type) else pc.list_value_length(values)
        ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) // width)
        low = 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + LISTED_ENTRIES, side="right")))
            yield batch.slice(low, high - low)
            low = high


def _weighted(df: DataFrame, vector_col: str, reps: DataFrame, idf: bool) -> DataFrame:
    """``id, size, rows, packed``: each distinct vector with the number of rows of each of its words.

    The numbers are those of all rows of ``df``, copies included. ``rows`` is their total, 0 where words weigh alike.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            codes, place = np.unique(codes, return_inverse=True)
            return codes, np.bincount(place, n, len(codes)).astype(np.int64)

        codes, n = np.empty(0, np.int32), np.empty(0, np.int64)
        for batch in _cut(batches, "packed", ENTRY_BYTES):
            more = _listed(batch.column("packed"), 1)[0][0]
            codes, n = summed(np.append(codes, more), np.append(n, np.ones(len(more), np.int64)))
            if len(codes) > CHUNK_ENTRIES:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])
                codes, n = codes[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

    given = df.select(F.col(vector_col).alias("packed")).filter("packed IS NOT NULL")
    numbers = given.mapInArrow(counted, "code int, n long").groupBy("code").agg(F.sum("n").cast("int").alias("n"))
    # A word of one row needs no entry in the table.
    numbers = staged(numbers.filter("n > 1"), "words")
    spark, total = df.sparkSession, df.count() if idf else 0
    passes = max(1, math.ceil(numbers.count() / LOOKUP_WORDS))
    step = math.ceil(CODES / passes)
    vectors = reps.filter("packed IS NOT NULL").select("id", "packed")

    def lookup(low: int, columns: int):
        part = numbers.filter((F.col("code") >= low) & (F.col("code") < low + step)).toArrow().combine_chunks()
        codes, n = (part.column(c).to_numpy().astype(np.int32) for c in ("code", "n"))
        order = np.argsort(codes)
        shared = spark.sparkContext.broadcast((codes[order], n[order]))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, n = shared.value
            for batch in _cut(batches, "packed", 4 * (columns + 1)):
                table, sizes = _listed(batch.column("packed"), columns)
                held = np.ones(table.shape[1], np.int32) if columns == 1 else table[2].copy()
                if len(known):
                    place = np.minimum(np.searchsorted(known, table[0]), len(known) - 1)
                    hit = known[place] == table[0]
                    held[hit] = n[place[hit]]
                cuts = np.cumsum(sizes)
                packed = [_planes(table[0, a:b], table[1, a:b], held[a:b]) for a, b in zip(cuts - sizes, cuts, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())], names=["id", "packed"])

        return run

    for k in range(passes):
        vectors = vectors.mapInArrow(lookup(k * step, 1 if k == 0 else 2), "id long, packed binary")
        if k + 1 < passes:
            vectors = staged(vectors, "numbered")
    size = (F.length("packed") / 12).cast("int").alias("size")
    return staged(vectors.select("id", size, F.lit(total).cast("bigint").alias("rows"), "packed"), "weighted")


def _entries(packed: pa.Array | pa.ChunkedArray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, numbers and unit weights of all rows, and the row of each entry."""
    (codes, counts, n), sizes = _listed(packed, 2)
    row = np.repeat(np.arange(len(sizes)), sizes)
    weights = counts * (1.0 + np.log(rows + 1.0) - np.log(n + 1.0)) if rows else counts.astype(np.float64)
    norms = np.sqrt(np.bincount(row, weights * weights, len(sizes)))
    return codes, n, weights / norms[row], row


def _parts(codes: np.ndarray, weights: np.ndarray, row: np.ndarray, rows: int, parts: int = PARTS) -> np.ndarray:
    """The lengths of each row's parts, by the hash of the word."""
    part = (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % parts
    return np.sqrt(np.bincount(row * parts + part, weights * weights, rows * parts)).reshape(rows, parts).astype(np.float32)


def remaining(weights: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The squared length of each entry together with those that follow it in its row."""
    total = np.cumsum(weights**2)
    ends = np.searchsorted(row, row, side="right") - 1
    return total[ends] - total + weights**2


def _postings(vectors: DataFrame, threshold: float) -> DataFrame:
    """``code, id, weight, rest, size, first``: the prefix of every vector; ``rest`` is the length of what follows the word.

    A word is in the prefix while it and what follows it are at least as long as the threshold. Words of
    one row are left out but for the first of a vector.
    """

    def prefix_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches, "packed", 12):
            codes, n, weights, row = _entries(batch.column("packed"), batch.column("rows")[0].as_py())
            order = np.lexsort((codes, n, row))
            codes, n, weights = codes[order], n[order], weights[order]
            first = np.append(True, row[1:] != row[:-1])
            left = remaining(weights, row)
            inside = np.flatnonzero((left >= threshold**2 - SLACK) & ((n > 1) | first))
            rest = np.sqrt(np.maximum(left - weights**2, 0))[inside]
            taken = pa.array(row[inside])
            columns = [
                pa.array(codes[inside]), batch.column("id").take(taken), pa.array(weights[inside]), pa.array(rest),
                batch.column("size").take(taken), pa.array(first[inside]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["code", "id", "weight", "rest", "size", "first"])

    return vectors.mapInArrow(prefix_rows, "code int, id long, weight double, rest double, size int, first boolean")


ROUTE = T.StructType(
    [T.StructField(name, T.LongType() if name == "id" else T.IntegerType()) for name in ("first", "second", "own", "id", "block")]
)


def _met(postings: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """``first, second, own, id, block``: each row once for every pair of wide blocks in which it may have a partner.

    ``own`` is the row's wide block and ``block`` its block.
    """
    spark = postings.sparkSession
    cell = F.floor(F.log2("size") * CELLS).cast("int")
    cost = F.sum(F.floor(F.col("size") / ROW_ENTRIES) + 1).alias("cost")
    sizes = np.zeros(1 << CELL_BITS, np.int64)
    for found in postings.filter("first").groupBy(cell.alias("cell")).agg(cost).collect():
        sizes[found["cell"]] = found["cost"]
    wanted = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))
    layout = _Layout.of(sizes, max(1, min(block_rows, math.ceil(int(sizes.sum()) / wanted))))
    blocks = len(layout.first_cell)
    wide = max(min(blocks, wanted), math.ceil(blocks / WIDE))
    plan = (layout.first_cell, layout.end_cell, layout.first_block, layout.count)
    shared = spark.sparkContext.broadcast(plan)

    def routes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placed = _Layout(*shared.value)
        for table in _whole_groups(batches):
            key, ids, reach = (table.column(c).to_numpy() for c in ("key", "id", "reach"))
            code, weight, rest = (key >> CELL_BITS).astype(np.int32), (reach >> 16) / TOP, (reach & TOP) / TOP
            block = placed.block_of(key & (1 << CELL_BITS) - 1, ids).astype(np.int32)
            own = (block * np.int64(wide) // blocks).astype(np.int32)
            order = np.lexsort((own, code))
            code, ids, weight, rest, block, own = (x[order] for x in (code, ids, weight, rest, block, own))
            # The rows of a word in a wide block: their number, and the highest weight and rest.
            begin = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (own[1:] != own[:-1])))
            n = np.diff(np.append(begin, len(code)))
            most_weight, most_rest = np.maximum.reduceat(weight, begin), np.maximum.reduceat(rest, begin)
            of = np.repeat(np.arange(len(begin)), n)
            word = np.cumsum(np.append(True, code[begin][1:] != code[begin][:-1])) - 1
            start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            count = np.diff(np.append(start, len(word)))
            seen = []
            for step in range(int(count.max())):
                # As the first common word, it must make up the threshold with what follows it.
                rows = np.flatnonzero(count[word[of]] > step)
                other = start[word[of[rows]]] + step
                most = weight[rows] * most_weight[other] + rest[rows] * most_rest[other]
                good = (most >= threshold - SLACK) & ((other != of[rows]) | (n[other] > 1))
                rows, other = rows[good], other[good]
                seen.append((own[rows], own[begin[other]], ids[rows], block[rows]))
            mine, theirs, ids, block = (np.concatenate(parts) for parts in zip(*seen, strict=True))
            order = np.lexsort((theirs, ids))
            mine, theirs, ids, block = (x[order] for x in (mine, theirs, ids, block))
            new = np.append(True, (ids[1:] != ids[:-1]) | (theirs[1:] != theirs[:-1])) if len(ids) else np.empty(0, bool)
            mine, theirs, ids, block = (x[new] for x in (mine, theirs, ids, block))
            columns = [np.minimum(mine, theirs), np.maximum(mine, theirs), mine, ids, block]
            yield _batch(columns, ROUTE)

    # The narrowest form: bounds are rounded up to 16 bits.
    weight, rest = (F.ceil(F.col(c) * TOP).cast("long") for c in ("weight", "rest"))
    key = F.shiftleft(F.col("code").cast("long"), CELL_BITS) + cell
    sent = postings.select(key.alias("key"), "id", (F.shiftleft(weight, 16) + rest).alias("reach"))
    sent = sent.repartition(F.shiftright("key", CELL_BITS)).sortWithinPartitions("key")
    return sent.mapInArrow(routes, ROUTE).distinct()


def _batch(columns: list[np.ndarray], shape: T.StructType) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    arrays = [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, shape, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=shape.names)


def _whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in tables that hold all rows of a word, of some ``CHUNK_ROWS`` rows if words have few."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < CHUNK_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        code = table.column("key").to_numpy() >> CELL_BITS
        cut = int(np.flatnonzero(code == code[-1])[0])
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        held = table.to_batches()
        size = 0 if cut else size
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _short_forms(vectors: DataFrame) -> DataFrame:
    """``id`` and ``short``: the lengths of a vector's parts by their level, rounded up, a byte each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches, "packed", 12):
            codes, _, weights, row = _entries(batch.column("packed"), batch.column("rows")[0].as_py())
            for low in range(0, batch.num_rows, TILE_ROWS):
                high = min(low + TILE_ROWS, batch.num_rows)
                part = slice(*np.searchsorted(row, [low, high]))
                lengths = _parts(codes[part], weights[part], row[part] - low, high - low)
                levels = np.minimum(np.searchsorted(LEVELS, lengths), len(LEVELS) - 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, high - low), pa.array([x.tobytes() for x in levels], pa.binary())],
                    names=["id", "short"],
                )

    return vectors.mapInArrow(run, "id long, short binary")


def _tiles(same: bool, left: int, right: int) -> Iterator[tuple[slice, slice]]:
    """Tiles of the pairs of two blocks, or of a block and itself, each pair of rows in one at least."""
    for low in range(0, left, TILE_ROWS):
        for at in range(low if same else 0, right, TILE_ROWS):
            yield slice(low, min(low + TILE_ROWS, left)), slice(at, min(at + TILE_ROWS, right))


def _sides(table: pa.Table) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether the two blocks are one, and the rows of each."""
    first, second = (table.column(c)[0].as_py() for c in ("first", "second"))
    own = table.column("own").to_numpy()
    return first == second, np.flatnonzero(own == first), np.flatnonzero(own == second)


def _open_blocks(threshold: float):
    """The pairs of blocks in which rows of two wide blocks may have partners, by their short forms."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block").combine_chunks()
        same, a, b = _sides(table)
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        short = np.frombuffer(b"".join(table.column("short").to_pylist()), np.uint8).reshape(len(ids), PARTS)
        found = []
        for left, right in _tiles(same, len(a), len(b)):
            x, y = a[left], b[right]
            hit = LEVELS[short[x]] @ LEVELS[short[y]].T >= threshold - ROUGH * PARTS - 1e-6
            if same and left == right:
                np.fill_diagonal(hit, False)
            for rows, others, cells in ((x, y, hit), (y, x, hit.T)):
                begin = np.flatnonzero(np.append(True, block[others][1:] != block[others][:-1]))
                row, other = np.nonzero(np.logical_or.reduceat(cells, begin, axis=1))
                found.append(np.stack([rows[row], block[others][begin[other]]]))
        row, other = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((2, 0), np.int64)
        own = block[row]
        columns = [np.minimum(own, other), np.maximum(own, other), own, ids[row], own]
        return pa.Table.from_batches([_batch(columns, ROUTE)])

    return run


def _block_partners(threshold: float):
    """Each row's best partner among the rows of two blocks."""
    limit = round(threshold, DIGITS)

    def run(table: pa.Table) -> pa.Table:
        same, a, b = _sides(table)
        if len(a) and len(b) and table.num_rows > 1:
            found = best_partners(table, same, a, b, limit)
        else:
            found = [np.empty(0)] * 3
        return pa.Table.from_batches([_batch(found, MATCH)])

    return run


def best_partners(
    table: pa.Table, same: bool, a: np.ndarray, b: np.ndarray, limit: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``id, partner, similarity`` of the rows that find a partner on the other side.

    ``table``: rows of ``id, rows, packed``. A pair is multiplied if the product of the lengths of its parts
    reaches the best that one of the two has found so far.
    """
    ids = table.column("id").to_numpy()
    codes, _, weights, row = _entries(table.column("packed"), table.column("rows")[0].as_py())
    starts = np.searchsorted(row, np.arange(len(ids) + 1))
    known = np.unique(codes)
    place = np.searchsorted(known, codes).astype(np.int32)
    spread = np.zeros(len(known))
    value, partner = np.full(len(ids), -1.0), np.zeros(len(ids), np.int64)

    def bounds(x: np.ndarray, y: np.ndarray, parts: int) -> np.ndarray:
        forms = []
        for rows in (x, y):
            at, owner = _runs(starts, rows)
            forms.append(_parts(codes[at], weights[at], owner, len(rows), parts))
        return forms[0] @ forms[1].T + (ROUGH * parts + 1e-6)

    def products(one: int, others: np.ndarray) -> np.ndarray:
        mine = slice(starts[one], starts[one + 1])
        spread[place[mine]] = weights[mine]
        at, owner = _runs(starts, others)
        sums = np.bincount(owner, spread[place[at]] * weights[at], len(others))
        spread[place[mine]] = 0
        return np.round(sums, DIGITS)

    def take(rows: np.ndarray, others: np.ndarray, found: np.ndarray) -> None:
        """Ties go to the smallest id."""
        order = np.lexsort((ids[others], -found, rows))
        rows, others, found = rows[order], ids[others[order]], found[order]
        first = np.append(True, rows[1:] != rows[:-1])
        rows, others, found = rows[first], others[first], found[first]
        better = (found > value[rows]) | (found == value[rows]) & (others < partner[rows])
        value[rows[better]], partner[rows[better]] = found[better], others[better]

    lengths = np.diff(starts)
    for left, right in _tiles(same, len(a), len(b)):
        x, y = a[left], b[right]
        bound = bounds(x, y, PARTS)
        if same and left == right:
            # Each pair once, and no row with itself.
            bound[np.tril_indices(len(x))] = -1
        near = bound >= limit
        some, others = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        # A product of two rows takes some hundred times as long for an entry as one of all rows does for a part.
        if near.sum(axis=0) @ lengths[y] > len(some) * len(others) * FINE // 256:
            cells = np.ix_(some, others)
            bound[cells] = np.minimum(bound[cells], bounds(x[some], y[others], FINE))
        for i in np.flatnonzero(bound.max(axis=1) >= limit):
            one = x[i]
            near = np.flatnonzero(bound[i] >= limit)
            # The likeliest first, so that the others may be left out by what is found.
            near = near[np.argsort(-bound[i, near], kind="stable")]
            low, step = 0, 16
            while low < len(near):
                part = near[low : low + step]
                part = part[bound[i, part] >= np.maximum(limit, np.minimum(value[one], value[y[part]]))]
                for some in _chunks(lengths[y[part]]):
                    others = y[part[some]]
                    exact = products(one, others)
                    good = exact >= limit
                    others, exact = others[good], exact[good]
                    if len(others):
                        ones = np.full(len(others), one)
                        take(np.append(ones, others), np.append(others, ones), np.append(exact, exact))
                low, step = low + step, step * 2
    good = value >= limit
    return ids[good], partner[good], value[good]


def _runs(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of the given rows, one row after the other, and the place of each entry's row among them."""
    size = starts[rows + 1] - starts[rows]
    ends = np.cumsum(size)
    owner = np.repeat(np.arange(len(rows)), size)
    return np.arange(int(size.sum())) + (starts[rows] - (ends - size))[owner], owner


def _chunks(sizes: np.ndarray) -> Iterator[slice]:
    """Pieces of some ``CHUNK_ENTRIES`` entries; one row may have more."""
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CHUNK_ENTRIES, side="right")))
        yield slice(low, high)
        low = high


def sparse_matches(
    df: DataFrame, id_col: str, vector_col: str, threshold: float, idf: bool = True, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """The distinct vectors (``id, twin, packed``), and each one's nearest partner (``id, match_id, similarity``).

    ``vector_col`` holds vectors of ``sparse_vectors``. Rows with a null vector stay and match nothing.
    With ``idf`` a word weighs ``1 + ln((rows + 1) / (rows with it + 1))`` times its count.
    """
    if not 0.0 < threshold <= 1.0:
        raise ValueError("threshold must be in (0, 1]")
    reps = staged(distinct_vectors(df, id_col, vector_col), "vectors")
    twins = reps.filter("twin IS NOT NULL").select(
        "id", F.col("twin").alias("match_id"), F.lit(1.0).alias("similarity")
    )
    vectors = _weighted(df, vector_col, reps, idf)
    # Similarities reach the limit after rounding, so prefixes are made for a little less.
    least = threshold - 10.0**-DIGITS
    met = _met(_postings(vectors, least), least, block_rows)
    group = ["first", "second"]
    near = met.join(_short_forms(vectors), "id").groupBy(*group).applyInArrow(_open_blocks(least), ROUTE)
    sent = near.distinct().join(vectors, "id").select(*group, "own", "id", "rows", "packed")
    order = F.struct(-F.col("similarity"), F.col("match_id"))
    best = (
        sent.groupBy(*group)
        .applyInArrow(_block_partners(threshold), MATCH)
        .unionByName(twins)
        .groupBy("id")
        .agg(F.min_by(F.struct("match_id", "similarity"), order).alias("b"))
        .select("id", "b.match_id", "b.similarity")
    )
    return reps, best


def sparse_nearest(
    df: DataFrame, id_col: str, vector_col: str, threshold: float, idf: bool = True, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The nearest partner of every row, copies included; the rule of ``neighbors.nearest_rows``."""
    # Vectors and partners are read several times, and are dear to make.
    held = staged(df.select(id_col, vector_col), "given")
    reps, best = sparse_matches(held, id_col, vector_col, threshold, idf, block_rows)
    return with_copies(held, id_col, vector_col, reps, staged(best, "matches"))


def sparse_kept_ids(
    df: DataFrame, id_col: str, vector_col: str, threshold: float, idf: bool = True, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Ids that survive, one column named like ``id_col``; the rule of ``neighbors.kept_ids``."""
    held = staged(df.select(id_col, vector_col), "given")
    matches = sparse_matches(held, id_col, vector_col, threshold, idf, block_rows)
    return survivors(*matches).withColumnRenamed("id", id_col)
