"""Exact near-duplicate removal by cosine similarity.

Rule: a row whose nearest other row reaches the threshold takes the larger id of the two out. Only
the nearest row counts, ties go to the smallest id, and the partner may itself have been taken out.

Plan, for vectors of any number:

1. Copies of a vector are reduced map-side to their two smallest ids. Every later copy is always
   taken out, because the first one is at similarity 1 and has a smaller id.
2. Sampled vectors serve as pivots, and each distinct vector belongs to its nearest pivot's cell.
   Neighbouring cells share a block, a large cell is cut by hash into several, so blocks have a
   limited size and no group of the join exceeds two of them.
3. A vector is sent to the pair (own block, other block) only where the geometry allows a
   partner in some cell of the other block: it must lie within the threshold angle of the plane that
   separates the two cells, and of the ball around the other cell. Both bounds are exact, so
   nothing is lost.
4. Each pair of blocks is a matrix product that gives every row its best partner in the other
   block, never all pairs. It is made tile by tile in single precision; only what may be a row's best
   is multiplied again in double precision. A map-side-combined ``min_by`` picks the best over all blocks.

What travels is each vector in the narrowest numbers that hold it exactly, so counts take a quarter of
their bytes and blocks hold four times the rows. Weights of dimensions are applied where vectors are read, so
weighted counts travel as counts. The product remains quadratic in the rows that no bound tells apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.stage import staged

# Similarities are compared after rounding, so that equal vectors tie whatever order a product sums in.
DIGITS = 9
# A task holds two blocks. The larger they are, the fewer blocks each vector is sent to.
MAX_BLOCK_BYTES = 32 * 1024 * 1024
MIN_BLOCK_ROWS = 512
# With fewer blocks than this, comparing all of them costs less than placing the vectors in cells.
MIN_CELLS = 16
CELLS_PER_BLOCK = 64
# Pivots go to every task, so their total size is limited; with fewer pivots a cell has more blocks.
PIVOT_BYTES = 64 * 1024 * 1024
# Rows handed back to Spark at a time, and the entries of one tile of vectors or similarities.
SPREAD_ROWS = 4096
TILE_ENTRIES = 2_000_000
# Types that hold whole counts, and those of the vectors themselves, by their bytes.
NARROW = {1: np.dtype(np.uint8), 2: np.dtype(np.uint16), 4: np.dtype(np.float32), 8: np.dtype(np.float64)}

MATCH = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("match_id", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
    ]
)
PLACED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("packed", T.BinaryType()),
        T.StructField("cell", T.IntegerType()),
        T.StructField("angle", T.DoubleType()),
    ]
)
SPREAD = T.StructType(
    [
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("own", T.IntegerType()),
        T.StructField("id", T.LongType()),
        T.StructField("packed", T.BinaryType()),
    ]
)


def distinct_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``twin``, the two smallest ids, for each distinct vector, packed into bytes.

    The rank filter is applied before the shuffle too, so a vector with very many copies
    sends at most two rows per task. Rows without a direction have null bytes and stay apart, each
    under its own key.
    """
    key = F.when(F.col("packed").isNotNull(), F.xxhash64("packed")).otherwise(F.col("id"))
    keyed = _packed(df, id_col, vector_col).withColumn("h", key)
    first_two = Window.partitionBy("h", "packed").orderBy("id")
    ranked = keyed.withColumn("r", F.row_number().over(first_two)).filter("r <= 2")
    return (
        ranked.groupBy("h", "packed")
        .agg(F.min("id").alias("id"), F.max("id").alias("last"))
        .select("id", F.when(F.col("last") > F.col("id"), F.col("last")).alias("twin"), "packed")
    )


def _packed(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and the vector as bytes, null where it is missing, zero or not finite."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
    if isinstance(rows.schema["vector"].dataType, T.BinaryType):
        return rows.withColumnRenamed("vector", "packed")
    codec = _codec(df, vector_col)

    def pack(values: np.ndarray) -> bytes | None:
        good = values.size and np.isfinite(values).all() and values.any()
        # Adding zero turns a negative zero into the plain one, so equal vectors have equal bytes.
        return (values + codec.type(0)).tobytes() if good else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(codec, copy=False)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            packed = [pack(v) for v in np.split(flat, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(packed, pa.binary())], names=["id", "packed"]
            )

    return rows.mapInArrow(run, "id bigint, packed binary")


def _codec(df: DataFrame, vector_col: str) -> np.dtype:
    kind = df.schema[vector_col].dataType
    double = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.DoubleType)
    return np.dtype(np.float64 if double else np.float32)


def nearest_matches(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    threshold: float,
    block_rows: int | None = None,
    min_cells: int = MIN_CELLS,
    weights: np.ndarray | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The distinct vectors, and each one's nearest partner at or above the threshold.

    ``vector_col`` holds numbers, or float32 bytes that are null where a row has no direction. With
    ``weights``, one above zero for each dimension, the similarity is that of the vectors times these.
    """
    if not 0.0 < threshold <= 1.0:
        raise ValueError("threshold must be in (0, 1]")
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise ValueError("the similarity join needs whole-number ids")
    spark = df.sparkSession
    codec = _codec(df, vector_col)
    reps = staged(distinct_vectors(df, id_col, vector_col), "vectors")
    size = F.length("packed")
    n, shortest, longest = reps.agg(F.count("packed"), F.min(size), F.max(size)).first()
    twins = reps.filter("twin IS NOT NULL").select(
        "id", F.col("twin").alias("match_id"), F.lit(1.0).alias("similarity")
    )
    if n < 2:
        return reps, twins
    if shortest != longest:
        raise ValueError("vectors differ in length")

    dims = longest // codec.itemsize
    if weights is not None and (len(weights) != dims or not (np.isfinite(weights) & (weights > 0)).all()):
        raise ValueError("one weight above zero is needed for each dimension")
    vectors = staged(_narrowed(reps.filter("packed IS NOT NULL").select("id", "packed"), codec), "narrow")
    width = math.ceil(vectors.agg(F.avg(size)).first()[0])
    rows = block_rows or _block_rows(n, width, spark.sparkContext.defaultParallelism)
    blocks = math.ceil(n / rows)
    if blocks < min_cells:
        placed = vectors.select("*", F.lit(0).alias("cell"))
        pivots, sizes, radii = None, np.array([n]), np.array([math.pi])
    else:
        pivots = _pivots(vectors, n, blocks, min(n, blocks * CELLS_PER_BLOCK), dims, weights)
        placed = staged(_place(vectors, pivots, weights), "placed")
        sizes, radii = np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots))
        cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r"))
        for cell in cells.collect():
            sizes[cell["cell"]], radii[cell["cell"]] = cell["n"], cell["r"]

    layout = _Layout.of(sizes, rows)
    spread = _spread(placed, pivots, radii, layout, threshold, weights)
    pairs = spread.groupBy("left", "right").applyInArrow(_block_match(threshold, dims, weights), MATCH)
    order = F.struct(-F.col("similarity"), F.col("match_id"))
    best = (
        pairs.unionByName(twins)
        .groupBy("id")
        .agg(F.min_by(F.struct("match_id", "similarity"), order).alias("b"))
        .select("id", "b.match_id", "b.similarity")
    )
    return reps, best


def collapse_copies(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows with the smallest id of each text, read without case and with single spaces.

    Ids are compared within a task before they are shuffled, and rows are matched by id and text, so an id
    on several rows keeps only those whose text it is first with. Null counts as the empty text. A row
    without an id stays if its text has no row with one. Rows alike in id and text all stay.
    """
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[ \t\n\r\f\x0B]+", " "))
    rows = df.withColumn("_hash", F.sha2(plain, 256))
    first = rows.groupBy("_hash").agg(F.min(id_col).alias("_first")).withColumnRenamed("_hash", "_of")
    same = F.col(id_col).eqNullSafe(F.col("_first")) & (F.col("_hash") == F.col("_of"))
    return rows.join(first, same, "left_semi").drop("_hash")


def nearest_rows(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    threshold: float,
    block_rows: int | None = None,
) -> DataFrame:
    """The nearest partner at or above the threshold of every row: ``id, match_id, similarity``.

    Copies beyond the first have the first one, at similarity 1, unless a smaller id is as near.
    """
    # Vectors and partners are read twice, and are dear to make.
    held = staged(df.select(id_col, vector_col), "given")
    reps, best = nearest_matches(held, id_col, vector_col, threshold, block_rows)
    return with_copies(held, id_col, vector_col, reps, staged(best, "matches"))


def with_copies(df: DataFrame, id_col: str, vector_col: str, reps: DataFrame, best: DataFrame) -> DataFrame:
    """The partners of all rows of ``df`` from those of its distinct vectors."""
    rows = _packed(df, id_col, vector_col).filter("packed IS NOT NULL")
    first = reps.filter("packed IS NOT NULL").select(F.col("id").alias("first"), "packed")
    copies = rows.withColumn("h", F.xxhash64("packed")).join(
        first.withColumn("h", F.xxhash64("packed")), ["h", "packed"]
    )
    copies = copies.filter(F.col("id") > F.col("first")).select("id", "first")
    near = best.select(F.col("id").alias("first"), "match_id", F.col("similarity").alias("s"))
    as_near = F.when(F.col("s") >= 1.0, F.least("first", "match_id")).otherwise(F.col("first"))
    others = copies.join(near, "first", "left").select(
        "id", as_near.alias("match_id"), F.lit(1.0).alias("similarity")
    )
    return best.unionByName(others)


def kept_ids(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    threshold: float,
    block_rows: int | None = None,
    min_cells: int = MIN_CELLS,
) -> DataFrame:
    """Ids that survive, one column named like ``id_col``. Rows without a direction all do."""
    matches = nearest_matches(df, id_col, vector_col, threshold, block_rows, min_cells)
    return survivors(*matches).withColumnRenamed("id", id_col)


def survivors(reps: DataFrame, best: DataFrame) -> DataFrame:
    """``id`` of the distinct vectors that are not the larger id of a match."""
    removed = best.select(F.greatest("id", "match_id").alias("id")).distinct()
    return reps.select("id").join(removed, "id", "left_anti")


def drop_near_duplicates(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    threshold: float,
    block_rows: int | None = None,
) -> DataFrame:
    """The rows of ``df`` that survive, all columns."""
    return df.join(kept_ids(df, id_col, vector_col, threshold, block_rows), id_col, "left_semi")


def _block_rows(n: int, width: int, parallelism: int) -> int:
    """Blocks small enough to occupy every core, and no larger than a task should hold."""
    wanted = math.ceil(math.sqrt(4 * parallelism))
    largest = max(1, MAX_BLOCK_BYTES // width)
    return min(largest, max(MIN_BLOCK_ROWS, math.ceil(n / wanted)))


def _pivots(
    vectors: DataFrame, rows: int, groups: int, wanted: int, dims: int, weights: np.ndarray | None = None
) -> np.ndarray:
    """A sample of the vectors as unit rows, at most ``PIVOT_BYTES`` of them, neighbours together."""
    count = max(1, min(wanted, PIVOT_BYTES // (dims * 8)))
    # The hash is uniform, so a bound on it leaves little more than is wanted of each partition.
    near = vectors.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1.2 * count + 50) / rows * (1 << 30)))
    chosen = near.orderBy(F.xxhash64("id"), "id").limit(count).select("packed").collect()
    pivots = _unpack(pa.array([row["packed"] for row in chosen], pa.binary()), dims, weights)
    first = pivots[:groups].T
    tiles = [(pivots[at : at + 1024] @ first).argmax(axis=1) for at in range(0, len(pivots), 1024)]
    nearest = np.concatenate(tiles)
    return pivots[np.argsort(nearest, kind="stable")]


@dataclass(frozen=True)
class _Layout:
    """How cells map to blocks of limited size.

    Block ``b`` covers the cells from ``first_cell[b]`` up to ``end_cell[b]``. A cell's rows go to
    ``count`` blocks from ``first_block`` on, chosen by hash where there are several.
    """

    first_cell: np.ndarray
    end_cell: np.ndarray
    first_block: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, sizes: np.ndarray, block_rows: int) -> _Layout:
        spans: list[list[int]] = []
        first_block, count = [], []
        room = 0
        for cell, size in enumerate(sizes.tolist()):
            if size > block_rows:
                first_block.append(len(spans))
                count.append(math.ceil(size / block_rows))
                spans.extend([cell, cell + 1] for _ in range(count[-1]))
                room = 0
                continue
            if size > room:
                spans.append([cell, cell])
                room = block_rows
            elif not spans or spans[-1][1] != cell:
                spans.append([cell, cell])
                room = block_rows
            spans[-1][1] = cell + 1
            room -= size
            first_block.append(len(spans) - 1)
            count.append(1)
        first_cell, end_cell = np.array(spans, dtype=np.int64).T
        return cls(first_cell, end_cell, np.array(first_block), np.array(count))

    def block_of(self, cells: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return self.first_block[cells] + _mix(ids) % self.count[cells]

    def blocks_with(self, cell_mask: np.ndarray) -> np.ndarray:
        """Rows by blocks: is any cell of the block marked?"""
        marked = np.zeros((len(cell_mask), cell_mask.shape[1] + 1), dtype=np.int32)
        np.cumsum(cell_mask, axis=1, out=marked[:, 1:])
        return marked[:, self.end_cell] > marked[:, self.first_cell]


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows over their lengths; scaled first so that no square leaves the float range."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _narrowed(vectors: DataFrame, codec: np.dtype) -> DataFrame:
    """The same vectors, each in the narrowest numbers that hold it exactly; its length tells which."""

    def narrow(packed: bytes) -> bytes:
        values = np.frombuffer(packed, codec)
        for size in (1, 2):
            if values.min() >= 0 and values.max() < 1 << 8 * size and size < codec.itemsize:
                whole = values.astype(NARROW[size])
                if (whole == values).all():
                    return whole.tobytes()
        return packed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [narrow(value.as_py()) for value in batch.column("packed")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())], names=["id", "packed"])

    return vectors.mapInArrow(run, "id bigint, packed binary")


def _unpack(packed: pa.Array, dims: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Unit rows in double precision, from vectors of any width. Weighted ones are rounded as ``features`` does."""
    values = packed.to_pylist()
    widths = np.array([len(v) for v in values], np.int64) // dims
    matrix = np.empty((len(values), dims))
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        matrix[at] = np.frombuffer(b"".join([values[i] for i in at]), NARROW[width]).reshape(len(at), dims)
    if weights is not None:
        matrix = (matrix.astype(np.float32) * weights.astype(np.float32)).astype(np.float64)
    return _unit(matrix)


def _taken(packed: pa.ChunkedArray, rows: np.ndarray) -> pa.Array:
    """The given rows, in ascending order, without putting the chunks of the whole column together."""
    parts, start, low = [], 0, 0
    for chunk in packed.chunks:
        high = int(np.searchsorted(rows, start + len(chunk)))
        if high > low:
            parts.append(chunk.take(pa.array(rows[low:high] - start)))
        start, low = start + len(chunk), high
    return pa.concat_arrays(parts)


def _place(vectors: DataFrame, pivots: np.ndarray, weights: np.ndarray | None = None) -> DataFrame:
    """Find each vector's nearest pivot and the angle to it."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        step = max(1, TILE_ENTRIES // max(centres.shape))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                tile = batch.slice(at, step)
                dots = _unpack(tile.column("packed"), centres.shape[1], weights) @ centres.T
                nearest = dots.argmax(axis=1).astype(np.int32)
                angle = np.arccos(np.clip(dots.max(axis=1), -1.0, 1.0))
                yield pa.RecordBatch.from_arrays(
                    [tile.column("id"), tile.column("packed"), pa.array(nearest), pa.array(angle)],
                    names=PLACED.names,
                )

    return vectors.mapInArrow(run, PLACED)


def _spread(
    placed: DataFrame,
    pivots: np.ndarray | None,
    radii: np.ndarray,
    layout: _Layout,
    threshold: float,
    weights: np.ndarray | None = None,
) -> DataFrame:
    """Send each vector to every pair of blocks in which it may have a partner."""
    # The angle bounds get a margin that covers rounding of the similarity and of this arithmetic.
    slack = 1e-6
    reach = math.acos(threshold - 10.0**-DIGITS) + slack
    # Plain arrays only: what is broadcast is unpickled without this package.
    arrays = (layout.first_cell, layout.end_cell, layout.first_block, layout.count)
    shared = placed.sparkSession.sparkContext.broadcast((pivots, radii, arrays))

    def reachable(unit: np.ndarray, home: np.ndarray) -> np.ndarray:
        """For every row and cell: may the cell hold a partner of the row?"""
        centres, radius, _ = shared.value
        dots = unit @ centres.T
        own = np.take_along_axis(dots, home[:, None], axis=1)
        kinds, where = np.unique(home, return_inverse=True)
        apart = np.sqrt(np.maximum(2.0 - 2.0 * (centres[kinds] @ centres.T), 0.0))[where]
        near_plane = own - dots <= math.sin(min(reach, math.pi / 2)) * apart + slack
        near_ball = dots >= np.cos(np.minimum(radius + reach + slack, math.pi)) - slack
        mask = near_plane & near_ball
        mask[np.arange(len(home)), home] = True
        return mask

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radius, parts = shared.value
        plan = _Layout(*parts)
        step = max(1, TILE_ENTRIES // max(len(radius), len(plan.first_cell)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                tile = batch.slice(at, step)
                ids = tile.column("id").to_numpy()
                home = tile.column("cell").to_numpy()
                own = plan.block_of(home, ids)
                if centres is None:
                    mask = np.ones((len(ids), 1), dtype=bool)
                else:
                    mask = reachable(_unpack(tile.column("packed"), centres.shape[1], weights), home)
                row, other = np.nonzero(plan.blocks_with(mask))
                left = np.minimum(own[row], other).astype(np.int32)
                right = np.maximum(own[row], other).astype(np.int32)
                for part in range(0, len(row), SPREAD_ROWS):
                    cut = slice(part, part + SPREAD_ROWS)
                    take = pa.array(row[cut])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(left[cut]),
                            pa.array(right[cut]),
                            pa.array(own[row[cut]].astype(np.int32)),
                            tile.column("id").take(take),
                            tile.column("packed").take(take),
                        ],
                        names=SPREAD.names,
                    )

    return placed.mapInArrow(run, SPREAD)


def _mix(ids: np.ndarray) -> np.ndarray:
    """A non-negative hash of the ids, so that id patterns do not fill one block."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(33)).astype(np.int64)


def _block_match(threshold: float, dims: int, weights: np.ndarray | None = None):
    limit = round(threshold, DIGITS)
    # How far a product in single precision may be off.
    error = dims * 2.0**-22 + 1e-6
    inner = max(1, min(1024, TILE_ENTRIES // dims))
    outer = max(1, min(4096, TILE_ENTRIES // max(dims, inner)))

    class Best:
        """The best partner so far of every row of a block, exactly, and what another must reach to matter."""

        def __init__(self, ids: np.ndarray):
            self.ids = ids
            self.value = np.full(len(ids), -2.0)
            self.partner = np.zeros(len(ids), np.int64)

        def least(self, part: slice) -> np.ndarray:
            return np.maximum(self.value[part], limit) - error

        def take(self, rows: np.ndarray, partners: np.ndarray, values: np.ndarray) -> None:
            """Ties go to the smallest id."""
            order = np.lexsort((partners, -values, rows))
            rows, partners, values = rows[order], partners[order], values[order]
            first = np.append(True, rows[1:] != rows[:-1]) & (values >= limit)
            rows, partners, values = rows[first], partners[first], values[first]
            old = self.value[rows]
            better = (values > old) | (values == old) & (partners < self.partner[rows])
            self.value[rows[better]], self.partner[rows[better]] = values[better], partners[better]

        def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            good = self.value >= limit
            return self.ids[good], self.partner[good], self.value[good]

    def candidates(tile: np.ndarray, most: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells that may hold the best of their row: near its maximum in this tile and not below ``least``."""
        rows = np.flatnonzero(most >= least)
        floor = np.maximum(least[rows], most[rows] - 2 * error)
        row, column = np.nonzero(tile[rows] >= floor[:, None])
        return rows[row], column

    def products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Exact similarities of the cells; of a crowded tile all are computed at once."""
        if len(i) > a.shape[0] * b.shape[0] // 16:
            return np.round(a @ b.T, DIGITS)[i, j]
        step = max(1, TILE_ENTRIES // dims)
        parts = [np.einsum("ij,ij->i", a[i[at : at + step]], b[j[at : at + step]]) for at in range(0, len(i), step)]
        return np.round(np.concatenate(parts), DIGITS) if parts else np.empty(0)

    def compare(rows_a, rows_b, ids, packed, same: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        best_a = Best(ids[rows_a])
        best_b = best_a if same else Best(ids[rows_b])
        for low in range(0, len(rows_a), outer):
            part_a = slice(low, min(low + outer, len(rows_a)))
            a = _unpack(_taken(packed, rows_a[part_a]), dims, weights)
            a_single = a.astype(np.float32)
            for at in range(0, len(rows_b), inner):
                part_b = slice(at, min(at + inner, len(rows_b)))
                b = _unpack(_taken(packed, rows_b[part_b]), dims, weights)
                tile = a_single @ b.astype(np.float32).T
                if same:
                    # A row is not its own partner.
                    own = np.arange(max(low, at), min(part_a.stop, part_b.stop))
                    tile[own - low, own - at] = -4.0
                i, j = candidates(tile, tile.max(axis=1), best_a.least(part_a))
                if len(i):
                    best_a.take(i + low, best_b.ids[j + at], products(a, b, i, j))
                if same:
                    continue
                j, i = candidates(tile.T, tile.max(axis=0), best_b.least(part_b))
                if len(i):
                    best_b.take(j + at, best_a.ids[i + low], products(a, b, i, j))
        return [best_a.found()] if same else [best_a.found(), best_b.found()]

    def run(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        first = group.column("left")[0].as_py()
        same = first == group.column("right")[0].as_py()
        in_left = group.column("own").to_numpy() == first
        rows_a = np.flatnonzero(in_left)
        rows_b = rows_a if same else np.flatnonzero(~in_left)
        found = []
        if len(ids) > 1 and len(rows_a) and len(rows_b):
            found = compare(rows_a, rows_b, ids, group.column("packed"), same)
        columns = [
            pa.array(np.concatenate([f[i] for f in found]) if found else np.empty(0), kind)
            for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))
        ]
        return pa.Table.from_arrays(columns, names=MATCH.names)

    return run
