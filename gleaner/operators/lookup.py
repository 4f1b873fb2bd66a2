"""Equi-join to a table of counts whose keys occur very unevenly on the other side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys are at most two words of bounded length, so this many rows stay below some 140 MB, and with
# words of usual length below 40 MB.
BROADCAST_ROWS = 400_000


def frequent_from(table: DataFrame, count_col: str) -> int:
    """The lowest power of two that at most ``BROADCAST_ROWS`` rows of ``table`` reach with their count.

    These rows may be broadcast; they are more than those above an even share of all counts.
    """
    bits = F.length(F.bin(count_col)).alias("bits")
    levels = {row["bits"]: row["n"] for row in table.groupBy(bits).agg(F.count(F.lit(1)).alias("n")).collect()}
    level, reached = max(levels, default=0) + 1, 0
    while level > 1 and reached + levels.get(level - 1, 0) <= BROADCAST_ROWS:
        level -= 1
        reached += levels.get(level, 0)
    return 1 << (level - 1)


def count_lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    count_col: str,
    table_rows: int,
    table_total: int,
) -> DataFrame:
    """Left join of ``rows`` to ``table``, safe for frequent keys.

    The counts in ``count_col`` sum to ``table_total``, so fewer than ``BROADCAST_ROWS`` keys can have
    a count above ``table_total / BROADCAST_ROWS``. Those are broadcast; the others, each rare, are
    shuffled. A table that is small as a whole is broadcast as a whole.
    """
    keys = list(keys)
    if table_rows <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), keys, "left")
    limit = F.lit(table_total / BROADCAST_ROWS)
    frequent = table.filter(F.col(count_col) > limit)
    rare = table.filter(F.col(count_col) <= limit)
    hit = rows.join(F.broadcast(frequent), keys)
    missed = rows.join(F.broadcast(frequent.select(*keys)), keys, "left_anti")
    return hit.unionByName(missed.join(rare, keys, "left"))
