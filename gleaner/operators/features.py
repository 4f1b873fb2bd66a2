"""Text to vector: hashed counts of words or of character n-grams, with an optional inverse-document-frequency weight."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.tokens import tokens
from gleaner.stage import staged

# Hex digits of a word's md5 that choose its bucket.
CODE_DIGITS = 4
MAX_DIMS = 16**CODE_DIGITS
# Cells of the count matrix, and characters of texts, that are worked on at a time.
TILE_CELLS = 1 << 20
TILE_CHARS = 1 << 20
# The rolling hash of n-grams; products stay within 63 bits.
GRAM_BASE = 65_599
GRAM_MODULUS = (1 << 31) - 1


def word_codes(text: Column) -> Column:
    """The first hex digits of every word's md5, strung together.

    One string per row crosses to Python as a block, where a list of words would go one by one.
    """
    codes = F.transform(tokens(F.lower(text)), lambda w: F.substring(F.md5(w), 1, CODE_DIGITS))
    return F.array_join(codes, "")


def _bucket_counts(codes: pa.Array, dims: int) -> np.ndarray:
    """Count matrix, one row per text. Only a tile of rows is counted in wide numbers at a time."""
    return _tiled(codes, dims, CODE_DIGITS, 0, _code_buckets)


def _tiled(texts: pa.Array, dims: int, unit: int, overlap: int, buckets) -> np.ndarray:
    """Counts of all texts, whatever their lengths: neither rows nor characters of a tile exceed its size.

    ``buckets`` turns a piece of text into the buckets of its features. A long text is cut between units, and
    a piece also has the ``overlap`` characters that follow it.
    """
    out = np.zeros((len(texts), dims), np.float32)
    step = TILE_CHARS // unit * unit
    cells: list[np.ndarray] = []
    first = size = 0

    def count(low: int, high: int) -> None:
        if cells:
            sums = np.bincount(np.concatenate(cells), minlength=(high - low) * dims)
            out[low:high] += sums.reshape(high - low, dims).astype(np.float32)
            cells.clear()

    for row, scalar in enumerate(texts):
        value = scalar.as_py() or ""
        if row > first and (size + len(value) > TILE_CHARS or (row + 1 - first) * dims > TILE_CELLS):
            count(first, row)
            first, size = row, 0
        size += len(value)
        for at in range(0, len(value), step):
            cells.append(buckets(value[at : at + step + overlap], dims) + (row - first) * dims)
            if len(value) > step:
                count(first, row + 1)
    count(first, len(texts))
    return out


def _code_buckets(codes: str, dims: int) -> np.ndarray:
    digits = np.frombuffer(codes.encode("ascii"), dtype=np.uint8)
    values = np.where(digits >= ord("a"), digits - (ord("a") - 10), digits - ord("0")).astype(np.int32)
    return values.reshape(-1, CODE_DIGITS) @ _PLACES % dims


_PLACES = (16 ** np.arange(CODE_DIGITS - 1, -1, -1)).astype(np.int32)


def _gram_counts(texts: pa.Array, dims: int, ngram: int) -> np.ndarray:
    """Count matrix of the texts' n-grams of characters, by a rolling hash over their code points."""
    return _tiled(texts, dims, 1, ngram - 1, lambda text, dims: _gram_buckets(text, dims, ngram))


def _gram_buckets(text: str, dims: int, ngram: int) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    size = max(len(points) - ngram + 1, 0)
    hashes = points[:size] % GRAM_MODULUS
    for k in range(1, ngram if size else 1):
        hashes = (hashes * GRAM_BASE + points[k : k + size]) % GRAM_MODULUS
    return hashes % dims


def _feature_counts(ngram: int):
    """What is sent to Python of a text, and how its features are counted there."""
    if not ngram:
        return word_codes, _bucket_counts
    return F.lower, lambda texts, dims: _gram_counts(texts, dims, ngram)


def count_vector(text: Column, dims: int, ngram: int = 0) -> Column:
    """Counts of the whole text's words in ``dims`` buckets, as ``array<float>``; or of its n-grams.

    With ``ngram``, every run of that many characters counts, white space too: for scripts without spaces
    and texts with typing errors. A shorter text has none.
    """
    _check_dims(dims)
    prepared, counted = _feature_counts(ngram)

    @F.arrow_udf("array<float>")
    def histogram(codes: pa.Array) -> pa.Array:
        counts = counted(codes, dims)
        offsets = np.arange(0, counts.size + 1, dims, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts.ravel()))

    return histogram(prepared(text))


def packed_count_vector(text: Column, dims: int, ngram: int = 0) -> Column:
    """The same as float32 bytes, the form the similarity join works on; null for a text without features."""
    _check_dims(dims)
    prepared, counted = _feature_counts(ngram)

    @F.arrow_udf("binary")
    def histogram(codes: pa.Array) -> pa.Array:
        counts = counted(codes, dims)
        filled = counts.any(axis=1)
        return pa.array([c.tobytes() if f else None for c, f in zip(counts, filled)], pa.binary())

    return histogram(prepared(text))


def _check_dims(dims: int) -> None:
    if not 1 <= dims <= MAX_DIMS:
        raise ValueError(f"dims must be from 1 to {MAX_DIMS}")


def hashed_vectors(
    df: DataFrame, text: Column, id_col: str, dims: int = 512, idf: bool = False, ngram: int = 0
) -> DataFrame:
    """``id_col`` and ``vector``: the word counts of the whole text, in ``dims`` buckets.

    Vectors are left unnormalised. Small counts are exact in float32 and the similarity join
    divides by the length itself.
    """
    counted = df.select(id_col, count_vector(text, dims, ngram).alias("vector"))
    if not idf:
        return counted
    counted = staged(counted, "counts")
    table = F.array(*[F.lit(float(w)) for w in idf_weights(counted, dims)])
    return counted.select(id_col, F.zip_with("vector", table, lambda x, w: x * w).alias("vector"))


def packed_vectors(
    df: DataFrame, text: Column, id_col: str, dims: int = 512, idf: bool = False, ngram: int = 0
) -> DataFrame:
    """``hashed_vectors`` packed for ``neighbors``.

    Here a weight is at least 1, so texts that consist of words all rows have keep a direction.
    """
    counted, weights = weighed_counts(df, text, id_col, dims, idf, ngram)
    if weights is None:
        return counted

    @F.arrow_udf("binary")
    def weigh(packed: pa.Array) -> pa.Array:
        rows = packed.to_pylist()
        return pa.array(
            [None if r is None else (np.frombuffer(r, np.float32) * weights).tobytes() for r in rows], pa.binary()
        )

    return counted.select(id_col, weigh("vector").alias("vector"))


def weighed_counts(
    df: DataFrame, text: Column, id_col: str, dims: int = 512, idf: bool = False, ngram: int = 0
) -> tuple[DataFrame, np.ndarray | None]:
    """``packed_vectors`` as counts and the weights of their buckets, null without ``idf``: counts travel narrow."""
    counted = df.select(id_col, packed_count_vector(text, dims, ngram).alias("vector"))
    if not idf:
        return counted, None
    counted = staged(counted, "counts")
    return counted, (1 + np.array(idf_weights(counted, dims))).astype(np.float32)


def idf_weights(counted: DataFrame, dims: int) -> list[float]:
    """``ln((n + 1) / (df + 1))`` per bucket. Presence is summed per task; the driver receives ``dims`` numbers."""
    packed = counted.schema["vector"].dataType.typeName() == "binary"

    def present(batches):
        seen = np.zeros(dims, np.int64)
        for batch in batches:
            column = batch.column("vector")
            for at in range(0, len(column), max(1, TILE_CELLS // dims)):
                part = column.slice(at, max(1, TILE_CELLS // dims)).drop_null()
                if packed:
                    values = np.frombuffer(b"".join(part.to_pylist()), np.float32)
                else:
                    values = part.flatten().to_numpy(zero_copy_only=False)
                seen += (values.reshape(-1, dims) > 0).sum(axis=0)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    rows = counted.select("vector").mapInArrow(present, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    seen = np.zeros(dims)
    for row in rows.collect():
        seen[row["bucket"]] = row["n"]
    return list(np.log((counted.count() + 1) / (seen + 1)))
