"""Keep rows by a set of ids without shuffling the rows that go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# So many ids are broadcast as they are: some 50 MB for ids of usual length.
BROADCAST_IDS = 1_000_000
# Bits for each id, up to a bitmap of MOST_BITS: 4 million words, about 100 MB in a task's hash table.
BITS_PER_ID = 16
MOST_BITS = 1 << 28
_WORD = 64


def bitmap_bits(count: int) -> int:
    """Bits of a bitmap for ``count`` ids: a power of two, never more than ``MOST_BITS``."""
    return min(MOST_BITS, max(_WORD, 1 << (BITS_PER_ID * count - 1).bit_length()))


def may_match(rows: DataFrame, ids: DataFrame, key: str, count: int) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is in ``ids``, and a few others: one in sixteen of them.

    A Bloom filter of one hash: ids set bits, which are put together map-side into words and broadcast;
    rows look up their word. With more ids than ``MOST_BITS / BITS_PER_ID`` more others remain, and nothing
    is lost. Null keys match nothing.
    """
    given = rows.filter(F.col(key).isNotNull())
    return may_be_in(given, ids, [key], count, "_may").filter("_may").select(*rows.columns)


def may_be_in(
    rows: DataFrame, ids: DataFrame, keys: Sequence[str], count: int, name: str, asked: Column | None = None
) -> DataFrame:
    """All rows, and by the same filter in ``name`` whether their ``keys`` may be in ``ids``.

    Rows for which ``asked`` does not hold are not looked up and get false.
    """
    bits = bitmap_bits(count)
    place = F.pmod(F.xxhash64(*keys), F.lit(bits))
    index, bit = F.floor(place / _WORD).cast("int"), (place % _WORD).cast("int")
    words = ids.dropna(subset=list(keys)).select(
        index.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("_bit")
    )
    bitmap = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    own = index if asked is None else F.when(asked, index)
    looked_up = rows.withColumn("_word", own).join(F.broadcast(bitmap), "_word", "left")
    is_set = F.call_function("shiftright", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1
    return looked_up.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias(name))


def keep_ids(rows: DataFrame, ids: DataFrame, key: str, count: int, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is in ``ids`` (``count`` different ones).

    Few ids are broadcast. With more, a bitmap of them takes nearly all other rows out in the scan; only
    what it lets through is shuffled and matched exactly.
    """
    if count <= broadcast_ids:
        return rows.join(F.broadcast(ids.select(key)), key, "left_semi")
    return may_match(rows, ids, key, count).join(ids.select(key), key, "left_semi")
