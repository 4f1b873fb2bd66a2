"""Shared by the operators: tables, word boundaries, 64-bit window hashes in numpy."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
# Bytes of input after which a worker gives memory back.
GIVE_BACK = 16 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def id_bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def unique_ids(docs: DataFrame) -> bool:
    """Whether every row has an id of its own. Reads and shuffles ids only."""
    return docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").isEmpty()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (in place) over all bits."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def window_hashes(symbols: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive symbols, by joining doubled blocks."""
    n = len(symbols)
    if n < width:
        return np.empty(0, np.uint64)
    block, size = symbols.astype(np.uint64), 1
    out, done = None, 0
    left = width
    while True:
        if left & 1:
            if out is None:
                out, done = block.copy(), size
            else:
                m = n - done - size + 1
                power = np.uint64(pow(_BASE, size, 1 << 64))
                out = out[:m] * power
                out += block[done : done + m]
                done += size
        left >>= 1
        if not left:
            return mix(out)
        m = n - 2 * size + 1
        power = np.uint64(pow(_BASE, size, 1 << 64))
        block = block[:m] * power + block[size : size + m]
        size *= 2


def spans_of_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every word in UTF-8 bytes."""
    word = np.empty(len(data) + 2, bool)
    word[0] = word[-1] = False
    np.logical_not(_IS_SPACE[data], out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    return edges[::2], edges[1::2]


_CHUNK = 1 << 18
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, ``n`` at least."""
    size = 1 << max(18, int(n).bit_length())
    if size not in _POWERS:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            tables.append(np.multiply.accumulate(step))
        _POWERS.clear()
        _POWERS[size] = tuple(tables)
    return _POWERS[size]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word. Works on one chunk of the data at a time."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(starts, low + _CHUNK)))
        high = int(ends[last - 1])
        up, down = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        h = (sums[e] - sums[s]) * down[s]
        out[first:last] = mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        first = last
    return out


def spaced(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The texts one after the other, each followed by a space."""
    raw = data.tobytes()
    cuts = offsets.tolist()
    texts = [raw[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
    return np.frombuffer(b" ".join([*texts, b""]), np.uint8)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its values; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges ``starts[i] .. starts[i] + lengths[i]``, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python 16 MB at a time: a worker, and the JVM beside it, hold a few of these at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def give_back() -> None:
    """Return freed memory to the system. Workers are used again, and would keep what their largest task needed."""
    pa.default_memory_pool().release_unused()
    for trim in _trim():
        trim(0)


def _trim() -> list:
    """malloc_trim, where the C library has it."""
    try:
        return [ctypes.CDLL(None).malloc_trim]
    except (AttributeError, OSError):
        return []


def large_batches(batches, size: int = 4 << 20, release: bool = False):
    """Cut Arrow batches so that one holds at most about ``size`` bytes, unless it is a single row.

    With ``release``, memory is given back now and then, and at the end.
    """
    done = 0
    for batch in batches:
        todo = [batch]
        while todo:
            part = todo.pop()
            if part.num_rows > 1 and part.nbytes > size:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]
            elif part.num_rows:
                yield part
        done += batch.nbytes
        del batch, todo, part
        if release and done >= GIVE_BACK:
            done = 0
            give_back()
    if release:
        give_back()
