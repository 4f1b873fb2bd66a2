"""Filter interaction audit: a table of failing ids per filter, and joins that follow every order of filters."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import WORD
from gleaner.stage import fresh_path, staged

TEXT_FILTERS = "ABCDE"
# Groups of equal texts with more than this share of all rows, so at most as many groups, are broadcast.
HOT_GROUPS = 1000
# All orders of the filters are listed: six filters have 720.
MOST_FILTERS = 6
_KINDS = ("removed", "good_lost", "toxic_lost")


def text_checks(text: Column) -> dict[str, Column]:
    """The conditions that need one text only. A null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("u")))
    few = F.transform(counts, lambda c: F.struct((c["n"] < 200).alias("A"), (100 * c["u"] < 50 * c["n"]).alias("B")))[0]
    return {
        "A": few["A"],
        "B": few["B"],
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") > 2 * F.length(text).cast("bigint"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def text_failures(docs: DataFrame) -> DataFrame:
    """``row, doc_id, part`` and a boolean for each of ``TEXT_FILTERS``, for every row of ``docs``.

    ``row`` numbers the rows, so rows that share an id or have none count one by one. E compares
    SHA-256 of whole texts. A row without an id repeats nothing and is repeated by nothing. ``part``
    is the source, the empty string if there is none.
    """
    one = F.struct(*(c.alias(name) for name, c in text_checks(F.col("text")).items()))
    facts = staged(
        docs.select("doc_id", "text", "source")
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.coalesce("source", F.lit("")).alias("part"),
            F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("sha"),
            one.alias("one"),
        ),
        "facts",
    ).select("row", "doc_id", "part", "sha", "one.*")
    groups = staged(
        facts.filter("doc_id is not null").groupBy("sha")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1"),
        "groups",
    )
    hot = F.col("n") * HOT_GROUPS > facts.count()
    # Rows of hot groups learn their first id from a broadcast and then travel by their own number.
    known = facts.join(
        F.broadcast(groups.filter(hot).select("sha", F.col("first").alias("hot_first"))), "sha", "left"
    ).withColumn("sha", F.when(F.col("hot_first").isNull(), F.col("sha")).otherwise(F.col("row").cast("string").cast("binary")))
    later = F.coalesce(F.col("doc_id") > F.coalesce("hot_first", "first"), F.lit(False))
    return known.join(groups.filter(~hot).drop("n"), "sha", "left").select(
        "row", "doc_id", "part", *"ABCD", later.alias("E")
    )


def failing_ids(failures: DataFrame, filters: Sequence[str]) -> DataFrame:
    """The failing-id relations: ``row, doc_id, part`` of the rows each filter fails, and ``target``, its number.

    Written with a folder for each filter, so each is a table of its own.
    """
    names = F.array(*(F.when(F.col(name), F.lit(k)) for k, name in enumerate(filters)))
    long = failures.select("row", "doc_id", "part", F.explode(F.array_compact(names)).alias("target"))
    path = fresh_path(failures.sparkSession, "failing")
    long.write.partitionBy("target").parquet(path)
    return failures.sparkSession.read.schema(long.schema).parquet(path)


def labelled_ids(fails: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """The failing rows whose id has 1 in ``column`` in some row of ``labels``.

    Rows without an id match nothing; they are spread by their numbers, not gathered in one task.
    """
    ones = labels.filter(F.col(column) == 1).select(F.col("doc_id").alias("key"), F.lit(True).alias("named")).distinct()
    keyed = fails.select("*", F.coalesce("doc_id", "row").alias("key"), F.col("doc_id").isNotNull().alias("named"))
    return keyed.join(ones, ["key", "named"], "left_semi").drop("key", "named")


def prefix_losses(fails: DataFrame, labels: DataFrame, filters: Sequence[str]) -> DataFrame:
    """``part, kind, target, before, n``: rows that filter ``target`` removes right after the filters in ``before``.

    ``before`` is a bit set: what went is the same in whatever order its filters came. Sets grow by
    one filter at a time, each above all it holds; a left-anti join against the relation of the filter
    added takes its rows out. All joins are on ``row``, so the rows are dealt out once for all of them.
    Kinds: all rows, those with quality 1, those with toxic 1 (left-semi joins with the labels).
    """
    every = len(filters)
    level = fails.withColumn("kind", F.lit(0))
    for kind, column in enumerate(("quality", "toxic"), start=1):
        level = level.unionByName(labelled_ids(fails, labels, column).withColumn("kind", F.lit(kind)))
    level = level.select("row", "part", "kind", "target", F.lit(0).alias("before"))
    gone = fails.select(F.col("row").alias("gone_row"), F.col("target").alias("gone_by"))

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("part", "kind", "target", "before").agg(F.count("*").alias("n"))

    counts = counted(level)
    for _ in range(every - 1):
        others = F.filter(
            F.array(*map(F.lit, range(every))),
            lambda k: (k != F.col("target")) & (F.pow(F.lit(2), k) > F.col("before")),
        )
        wider = level.withColumn("added", F.explode(others))
        # Only the row number is a join key: with the filter as another, each join would shuffle anew.
        met = (F.col("row") == F.col("gone_row")) & F.array_contains(F.array("added"), F.col("gone_by"))
        level = wider.join(gone, met, "left_anti").select(
            "row", "part", "kind", "target", (F.col("before") + F.pow(F.lit(2), F.col("added")).cast("int")).alias("before")
        )
        counts = counts.unionByName(counted(level))
    return counts


def _steps(filters: Sequence[str]) -> list[dict]:
    """Every step of every order: its filter, the set before it, and the steps up to it as keys."""
    out = []
    for order in permutations(range(len(filters))):
        before, path = 0, []
        for step, target in enumerate(order, start=1):
            path = [*path, target << len(filters) | before]
            out.append({"filter_order": "".join(filters[k] for k in order), "step": step, "target": target, "path": path})
            before |= 1 << target
    return out


def filter_audit(failures: DataFrame, labels: DataFrame, filters: Sequence[str] = TEXT_FILTERS) -> DataFrame:
    """What each filter removes in every order of the filters, per part of the table.

    ``failures``: ``row`` (distinct numbers), ``doc_id``, ``part`` and a boolean column per filter (null:
    passes). One row per part, order and step: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``; an empty table gives none. ``labels`` may repeat ids,
    have nulls or be empty.
    """
    if not 0 < len(filters) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters can be audited, not {len(filters)}")
    every = len(filters)
    failures = staged(
        failures.select("row", "doc_id", "part", *(F.coalesce(F.col(f), F.lit(False)).alias(f) for f in filters)), "failures"
    )
    fails = failing_ids(failures, filters)
    losses = prefix_losses(fails, labels, filters)
    # Numbers of a part by kind, filter and set before it: 3 * 5 * 32 of them for five filters.
    width = every << every
    place = (F.col("kind") * every + F.col("target")) * (1 << every) + F.col("before")
    found = losses.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct(place.alias("key"), F.col("n").alias("value")))).alias("n")
    )
    listed = F.from_json(
        F.lit(json.dumps(_steps(filters))),
        "array<struct<filter_order string, step int, target int, path array<int>>>",
    )
    none = F.lit(0).cast("bigint")
    every_place = F.sequence(F.lit(0), F.lit(len(_KINDS) * width - 1))
    parts = failures.groupBy("part").agg(F.count("*").alias("total")).join(found, "part", "left")
    dense = parts.select("part", "total", F.transform(every_place, lambda k: F.coalesce(F.try_element_at("n", k), none)).alias("n"))
    table = dense.select("part", "total", "n", F.explode(listed).alias("at")).select("part", "total", "n", "at.*")

    def number(kind: int, at: Column) -> Column:
        return F.get("n", at + kind * width)

    own = F.col("target") * (1 << every)
    here = F.element_at("path", -1)
    alone = own + ((1 << every) - 1) - F.pow(F.lit(2), F.col("target")).cast("int")
    orders = [math.factorial(k) * math.factorial(every - 1 - k) for k in range(every)]
    sets = F.filter(
        F.sequence(F.lit(0), F.lit((1 << every) - 1)),
        lambda s: s.bitwiseAND(F.pow(F.lit(2), F.col("target")).cast("int")) == 0,
    )
    weights = F.array(*(F.lit(w).cast("bigint") for w in orders))
    shapley = F.aggregate(
        F.transform(sets, lambda s: number(0, own + s) * F.get(weights, F.bit_count(s))),
        none, lambda a, b: a + b,
    )
    lost = F.aggregate(F.transform("path", lambda k: number(0, k)), none, lambda a, b: a + b)
    return table.select(
        "part", "filter_order", "step",
        (F.col("total") - lost).alias("kept"),
        number(0, here).alias("removed"),
        (number(0, own) - number(0, here)).alias("redundant"),
        number(0, alone).alias("unique_fails"),
        *(number(kind, here).alias(_KINDS[kind]) for kind in (1, 2)),
        shapley.alias("shapley"),
    )
