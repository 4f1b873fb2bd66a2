"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import WORD, word_count
from gleaner.stage import staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
# Bits of the hash in each of the two histograms.
BITS = 12


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Per source its size and target. ``sizes``: one row per source.

    The budget, ``share`` of all sizes, is dealt out by weight; what exceeds ``most`` times a source
    is dealt out again among the others until none is above. That fills every source to the same
    level per weight, so the level follows from the sources in order of the level that fills them.
    The table has one row per source: the windows without a key see source names, not documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    full = F.col("cap") / F.col("weight")
    by_level = Window.orderBy(full.asc(), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (
        F.lit(share) * F.sum("source_size").over(every)
        - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # The first source that its own level does not fill sets the level; later ones compute lower ones.
    tested = ranked.withColumn("level", level).withColumn("full", full)
    water = F.max(F.when(F.col("level") <= F.col("full"), F.col("level"))).over(every)
    target = F.when(
        water.isNull() | (F.col("full") <= water), F.col("cap").cast("double")
    ).otherwise(F.col("weight") * water)
    return tested.select("source", "source_size", target.alias("target"))


def _crossing(histogram: DataFrame, source: Column, bucket: str, budget: Column) -> DataFrame:
    """The bucket of each source in which its budget ends, and the words that lie before it."""
    running = Window.partitionBy("source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(running), F.lit(0))
    return (
        histogram.withColumn("before", before)
        .filter((F.col("before") <= budget) & (budget < F.col("before") + F.col("words")))
        .select(source, F.col(bucket).alias(f"edge_{bucket}"), (budget - F.col("before")).alias("left"))
    )


def _joined(left: DataFrame, right: DataFrame, *more: Column, how: str = "inner") -> DataFrame:
    """Join on the source, null being a source. Spark broadcasts the small side if its size allows."""
    name = right.select(F.col("source").alias("_source"), *[c for c in right.columns if c != "source"])
    on = F.col("source").eqNullSafe(F.col("_source"))
    for condition in more:
        on = on & condition
    return left.join(name, on, how).drop("_source")


def _hashed(docs: DataFrame, *columns: str) -> DataFrame:
    """The id's hash and its first two groups of bits, and the size in words."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return docs.select(
        *columns,
        word_count(F.col("text")).alias("size"),
        F.shiftright(h, 32 - BITS).alias("high"),
        F.shiftright(h, 32 - 2 * BITS).bitwiseAND((1 << BITS) - 1).alias("low"),
        h.alias("hash"),
    )


def _edges(narrow: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Per source: size, target, whole repeats, the bucket on the edge and the words left for it."""
    first = staged(
        narrow.groupBy("source", "high").agg(F.sum("size").alias("words")), "mix-histogram"
    )
    sizes = first.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    aim = F.round(F.col("target")).cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(aim / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("whole", whole).withColumn(
        "budget", aim - F.col("whole") * F.col("source_size")
    )
    plan = staged(plan, "mix-plan")

    coarse = _crossing(_joined(first, plan.select("source", "budget")), F.col("source"), "high", F.col("budget"))
    inside = _joined(narrow, coarse, F.col("high") == F.col("edge_high"))
    second = inside.groupBy("source", "low").agg(
        F.sum("size").alias("words"), F.max("left").alias("budget")
    )
    fine = _crossing(second, F.col("source"), "low", F.col("budget"))
    edges = _joined(coarse.select("source", "edge_high"), fine, how="left")
    return staged(_joined(plan, edges, how="left"), "mix-edges")


def _taken(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` (with their hashes and sizes) and ``taken``, the words that the mix takes of each."""
    placed = _joined(rows, edges)
    on_edge = (F.col("high") == F.col("edge_high")) & (F.col("low") == F.col("edge_low"))
    below = (F.col("high") < F.col("edge_high")) | (
        (F.col("high") == F.col("edge_high")) & (F.col("low") < F.col("edge_low"))
    )
    within = F.coalesce(on_edge, F.lit(False))
    plain = placed.filter(~within).withColumn(
        "extra", F.when(F.coalesce(below, F.lit(False)), F.col("size")).otherwise(0)
    )
    order = (
        Window.partitionBy("source")
        .orderBy("hash", F.col("doc_id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    room = F.col("left") - F.coalesce(F.sum("size").over(order), F.lit(0))
    # Whole or not at all, whichever is nearer to the target.
    last = placed.filter(within).withColumn("room", room).withColumn(
        "extra", F.when((F.col("room") > 0) & (2 * F.col("room") >= F.col("size")), F.col("size")).otherwise(0)
    ).drop("room")
    taken = (F.col("whole") * F.col("size") + F.col("extra")).cast("bigint")
    return plain.unionByName(last).withColumn("taken", taken)


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """Words that the mix takes of every document.

    ``doc_id, source, size, source_size, target, taken``, one row per row of ``docs``. A target is
    met by whole repeats of the source and, for the rest, by the documents whose hash lies below a
    threshold: words are summed by source and hash bucket, the bucket where the budget ends is
    summed again by its next bits, and only what falls into that last bucket (about one document in
    16 million) is put in order. The document on the edge is taken whole or not at all, so each source
    comes as near its target as half of that document.

    Null text has size 0 and takes nothing. A null source is a source, the last one. Rows with the
    same id (or null) share a hash and are taken in the order of their sizes. An empty table gives
    no rows. Other columns are ignored.
    """
    narrow = staged(_hashed(docs, "doc_id", "source"), "mix-sizes")
    rows = _taken(narrow, _edges(narrow, weights, share, most))
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken")


def mixture(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """The mix itself: the rows that it takes, as often as it takes them, with the columns of ``docs``.

    Documents are taken whole. Cases are those of ``mixed``.
    """
    narrow = staged(_hashed(docs, "doc_id", "source"), "mix-sizes")
    edges = _edges(narrow, weights, share, most)
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    rows = _taken(_hashed(docs.select(whole, "doc_id", "source", "text"), "row", "doc_id", "source"), edges)
    copies = F.explode(F.array_repeat(F.lit(True), F.floor(F.col("taken") / F.col("size")).cast("int")))
    rows = rows.filter("taken > 0").select("row", copies.alias("copy"))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
