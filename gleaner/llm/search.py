"""Nearest neighbours by a block matrix join on int8 tiles with exact recomputation."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.stage import staged

K = 20
QUERY_ROWS = 2048
BLOCK_ROWS = 4096
# Rows of queries and candidates in one product.
TILE = 512
# Rounding of the float32 products and of the norms, relative to the vectors' lengths.
SLACK = 1e-5


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, the step of each row, the length of what is represented, and of what is not."""
    step = np.abs(vectors).max(axis=1) / 127
    step[step == 0] = 1
    values = np.rint(vectors / step[:, None])
    shown = values * step[:, None]
    error = np.sqrt(((vectors - shown) ** 2).sum(axis=1))
    return values.astype(np.int8), step, np.sqrt((shown**2).sum(axis=1)), error


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, added up in the order of the components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


class Nearest:
    """Heaps of the ``k`` best of each query: ``(score, -id)``, the worst on top."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.codes, self.steps, self.lengths, self.errors = quantised(vectors)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(len(ids))]
        self.floor = np.full(len(ids), -np.inf)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Merge a block of candidates."""
        ids, vectors = few_copies(ids, vectors, self.k + 1)
        codes, steps, lengths, errors = quantised(vectors)
        for q0 in range(0, len(self.ids), TILE):
            q = slice(q0, q0 + TILE)
            left = self.codes[q].astype(np.float32)
            for c0 in range(0, len(ids), TILE):
                c = slice(c0, c0 + TILE)
                # Products of int8 values in float32 are whole numbers and exact for up to 1,040 components.
                tile = (left @ codes[c].T.astype(np.float32)).astype(np.float64)
                tile *= self.steps[q][:, None]
                tile *= steps[c][None, :]
                bound = (
                    np.outer(self.errors[q], lengths[c])
                    + np.outer(self.lengths[q], errors[c])
                    + np.outer(self.errors[q], errors[c])
                )
                bound += SLACK * np.outer(self.lengths[q] + self.errors[q], lengths[c] + errors[c])
                own = self.ids[q][:, None] == ids[c][None, :]
                low = np.where(own, -np.inf, tile - bound)
                floor = self.floor[q]
                # Rows come in the order of their ids, and of those that share an id the best one counts.
                first = np.flatnonzero(np.diff(ids[c], prepend=ids[c][0] - 1))
                if len(first) < low.shape[1]:
                    low = np.maximum.reduceat(low, first, axis=1)
                if low.shape[1] >= self.k:
                    best = np.partition(low, low.shape[1] - self.k, axis=1)[:, low.shape[1] - self.k]
                    floor = np.maximum(floor, best)
                rows, columns = np.nonzero((tile + bound >= floor[:, None]) & ~own)
                self._merge(rows + q0, ids[columns + c0], vectors[columns + c0])

    def _merge(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        scores = exact_products(self.vectors[rows], vectors)
        better = scores >= self.floor[rows]
        rows = rows[better]
        for row, score, other in zip(rows.tolist(), scores[better].tolist(), ids[better].tolist(), strict=True):
            heap, entry = self.heaps[row], (score, -other)
            if len(heap) == self.k and entry <= heap[0]:
                continue
            known = next((e for e in heap if e[1] == -other), None)
            if known is not None:
                # Another row with this id: the better score counts.
                if entry > known:
                    heap[heap.index(known)] = entry
                    heapq.heapify(heap)
            elif len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heapreplace(heap, entry)
        for row in np.unique(rows).tolist():
            if len(self.heaps[row]) == self.k:
                self.floor[row] = self.heaps[row][0][0]


def few_copies(ids: np.ndarray, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Without the rows that ``most`` equal vectors with smaller ids make impossible to be among the best.

    Equal vectors have equal scores and ties go to the smaller id, so the others cannot be returned.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order] + 0.0)
    keys = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
    _, group = np.unique(keys, return_inverse=True)
    by_group = np.argsort(group, kind="stable")
    same = (np.diff(group[by_group]) == 0) & (np.diff(ids[by_group]) == 0)
    if same.any():
        repeated = by_group[1:][same]
        ids, vectors, group = (np.delete(x, repeated, axis=0) for x in (ids, vectors, group))
        by_group = np.argsort(group, kind="stable")
    heads = np.searchsorted(group[by_group], np.arange(group.max() + 1))
    nth = np.empty(len(ids), np.int64)
    nth[by_group] = np.arange(len(ids)) - heads[group[by_group]]
    return ids[nth < most], vectors[nth < most]


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows of each task packed into blocks of ``size`` vectors, one row per block and width.

    Components keep the precision they are given in; tasks widen them.
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(width: int) -> pa.RecordBatch:
            ids, vectors = (np.concatenate(x) for x in zip(*held.pop(width), strict=True))
            row = [[ids.tobytes()], [vectors.astype(f"<f{vectors.dtype.itemsize}").tobytes()], [width]]
            arrays = [pa.array(v, t) for v, t in zip(row, (pa.binary(), pa.binary(), pa.int32()), strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["ids", "vectors", "width"])

        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                vectors, ids = part.column("vector"), part.column("vec_id").to_numpy(zero_copy_only=False)
                lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
                flat = vectors.flatten().to_numpy(zero_copy_only=False)
                starts = np.cumsum(lengths) - lengths
                for width in np.unique(lengths).tolist():
                    at = np.flatnonzero(lengths == width)
                    own = flat[(starts[at][:, None] + np.arange(width)).ravel()].reshape(-1, width)
                    held.setdefault(width, []).append((ids[at], own))
                    if sum(len(x) for x, _ in held[width]) >= size:
                        yield block(width)
        for width in list(held):
            yield block(width)

    return rows.mapInArrow(pack, "ids binary, vectors binary, width int")


def nearest(vectors: DataFrame, query: Column, k: int = K) -> DataFrame:
    """The ``k`` rows with the largest inner product of every row that ``query`` selects.

    ``vectors`` has ``vec_id`` and ``embedding``. Returns ``query_id, rank, vec_id, score``, nearest
    first, ties to the smaller id; a row is no neighbour of its own id. Null ids, and vectors that
    are null, zero or hold a null or non-finite component, take no part; vectors of different
    lengths have no product and do not meet. Rows with the same id are all candidates, and each is
    a query whose results are merged under the id. Other columns are ignored; no rows give no rows.

    Candidates are packed into blocks and meet every block of queries: a tile of int8 products gives
    each score up to the error of rounding, and only pairs whose upper bound reaches a query's
    current ``k``-th lower bound are computed in double precision and offered to its heap. A task
    keeps the heaps of one query block over all candidate blocks that it is dealt. So what is shuffled
    is the vectors once per query block, and ``k`` rows per query and task. Of copies, ``k + 1`` per block are looked at.
    """
    spark = vectors.sparkSession
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"),
        query.alias("is_query"),
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    queries = staged(
        _blocks(rows.filter("is_query").select("vec_id", "vector").repartition(parts, "vec_id"), QUERY_ROWS)
        .withColumn("name", F.monotonically_increasing_id()),
        "query-blocks",
    )
    blocks = staged(
        _blocks(rows.select("vec_id", "vector"), BLOCK_ROWS).withColumn("name", F.monotonically_increasing_id()),
        "vector-blocks",
    )
    # One row per block of queries.
    numbered = queries.select("name").withColumn("q", F.row_number().over(Window.orderBy("name")) - 1)
    many = numbered.count()
    if not many:
        return _ranked(spark.createDataFrame([], _FOUND), k)
    # With few query blocks, several tasks share the candidates of each.
    splits = max(1, min(-(-parts // many), blocks.count()))
    dealt = F.pmod(F.xxhash64("name"), F.lit(splits))
    sides = ["q", "split", "kind", "ids", "vectors", "width"]
    left = queries.join(numbered, "name").withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    right = blocks.withColumn("split", dealt.cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    )
    met = left.withColumn("kind", F.lit(0)).select(*sides).unionByName(
        right.withColumn("kind", F.lit(1)).select(*sides)
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _searched(batches, k)

    found = (
        met.repartition(max(parts, min(many * splits, 4 * parts)), "q", "split")
        .sortWithinPartitions("q", "split", "kind")
        .mapInArrow(search, _FOUND)
    )
    return _ranked(found, k)


_FOUND = "query_id long, vec_id long, score double"


def _searched(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come as a block of queries and then the candidate blocks that it meets."""
    current, held = None, None

    def flush() -> Iterator[pa.RecordBatch]:
        for first in range(0, len(held.ids) if held else 0, 1024):
            entries = [
                (int(held.ids[row]), -other, score)
                for row in range(first, min(first + 1024, len(held.ids)))
                for score, other in held.heaps[row]
            ]
            columns = list(zip(*entries, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.float64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    for batch in batches:
        for n in range(batch.num_rows):
            q, split, kind, ids, vectors, width = (batch.column(c)[n] for c in range(6))
            ids = np.frombuffer(ids.as_buffer(), np.int64)
            buffer = vectors.as_buffer()
            kind_of = f"<f{buffer.size // (len(ids) * width.as_py())}"
            vectors = np.frombuffer(buffer, kind_of).reshape(-1, width.as_py()).astype(np.float64)
            if kind.as_py() == 0:
                yield from flush()
                current, held = (q.as_py(), split.as_py()), Nearest(ids, vectors, k)
            elif held is not None and current == (q.as_py(), split.as_py()) and vectors.shape[1] == held.vectors.shape[1]:
                held.offer(ids, vectors)
    yield from flush()


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of what the tasks found for each query, each id once."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
