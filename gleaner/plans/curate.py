"""The whole run: filter, remove near-duplicates, score, select, report."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.config import CurationConfig, load_config
from gleaner.functions.plugins import message_counter, token_counter
from gleaner.functions.scores import perplexity, random_score
from gleaner.functions.template import CHATML, ChatTemplate, response_message
from gleaner.operators.bitmap import keep_ids
from gleaner.operators.clusters import match_clusters
from gleaner.operators.compare import compare_texts, message_texts
from gleaner.operators.features import weighed_counts
from gleaner.operators.language_model import learning_values, normalised
from gleaner.operators.neighbors import nearest_matches, survivors, with_copies
from gleaner.operators.quality import judge_conversations, passes_quality
from gleaner.operators.report import build_report, score_stats
from gleaner.operators.select import SMALL_K, combine_scores, in_band, most_per_group, random_sample, top_k
from gleaner.operators.sparse_join import sparse_matches, sparse_vectors
from gleaner.sources.normalize import assemble_turns
from gleaner.sources.readers import read_dataset, read_jsonl, read_jsonl_lenient
from gleaner.sources.writers import report_yaml, write_jsonl, write_report
from gleaner.stage import release, staged, written

GIANTS = 100_000
SCORERS = ("hash_random", "ngram_perplexity", "ngram_perplexity_left_out", "column", "udf")


@dataclass(frozen=True)
class CurationResult:
    """``selected``: the chosen rows with scores and ``rank``. ``scored``: id and scores of all candidates."""

    selected: DataFrame
    scored: DataFrame
    report: DataFrame


@dataclass(frozen=True)
class RunOptions:
    """What a run may set besides its config."""

    id_col: str = "sample_id"
    template: ChatTemplate = CHATML
    total_mode: str = "template"
    tokenizer: Callable[[], Callable[[str], Sequence]] | None = None
    skip_deduplication: bool = False
    vector_col: str | None = None
    encoder: Callable[[Column], Column] | None = None
    scorer: str = "hash_random"
    score_col: str | None = None
    nll: Callable[[Column, Column], Column] | None = None
    quality_col: str | None = None
    diversity_col: str | None = None
    token_budget: int | None = None
    validate: bool = False
    seed: int = 42


def _options(options: RunOptions | None, changes: dict) -> RunOptions:
    if options is not None and changes:
        raise ValueError("give either an options record or single options")
    chosen = options or RunOptions(**changes)
    if chosen.scorer not in SCORERS:
        raise ValueError(f"scorer is one of {', '.join(SCORERS)}")
    return chosen


def curate(
    df: DataFrame,
    config: CurationConfig,
    k: int,
    options: RunOptions | None = None,
    **changes,
) -> CurationResult:
    """Curate rows with a ``messages`` array and an id column."""
    run = _options(options, changes)
    if k < 1:
        raise ValueError("k must be at least 1")
    messages, own = F.col("messages"), {}
    source = df
    if run.tokenizer is not None:
        counted = df.withColumn("_counts", message_counter(run.tokenizer)(F.col("messages.content")))
        own["counts"] = F.col("_counts")
        if run.total_mode == "template":
            rendered = token_counter(run.tokenizer)(run.template.render(messages))
            counted = counted.withColumn("_total", rendered)
            own["total"] = F.col("_total")
        # Written, so that the tokenizer runs once per row and not once per check.
        source = staged(counted, "counted")
    passes = passes_quality(
        messages, config.quality_filters, template=run.template, total_mode=run.total_mode, **own
    )
    # The source is counted by the write that filters it.
    seen = Observation()
    passed = source.observe(seen, F.count(F.lit(1)).alias("n")).filter(passes).select(*df.columns)
    filtered = staged(passed, "filtered")

    def baseline(n: int) -> DataFrame:
        return message_texts(random_sample(df, n, run.seed, run.id_col))

    return _finish(baseline, seen.get["n"], filtered, config, k, run)


def curate_turns(
    turns: DataFrame,
    config: CurationConfig,
    k: int,
    options: RunOptions | None = None,
    turn_id: str = "conv_id",
    **changes,
) -> CurationResult:
    """Curate a flat table of ``turn_id, turn, role, text``.

    Conversations are judged on their facts first. Only those that pass, and so have no more
    messages than the filter allows, are put together.
    """
    run = _options(options, changes)
    if k < 1:
        raise ValueError("k must be at least 1")
    own = {}
    if run.tokenizer is not None:
        count = token_counter(run.tokenizer)
        own["counts"] = count(F.col("text"))
        if run.total_mode == "template":
            own["totals"] = count(run.template.message_text(F.col("role"), F.col("text")))
            own["opening"] = len(run.tokenizer()(run.template.bos)) if run.template.bos else 0
    judged = staged(
        judge_conversations(
            turns,
            config.quality_filters,
            template=run.template,
            total_mode=run.total_mode,
            id_col=turn_id,
            **own,
        ).select(turn_id, "n_messages", "passes"),
        "judged",
    )
    # A null id passes like any other, but matches nothing.
    ids = judged.filter(F.col("passes") & F.col(turn_id).isNotNull()).select(turn_id)
    total, original_size, passing = judged.agg(
        F.coalesce(F.sum("n_messages"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("passes"))
    ).first()
    light = without_giants(turns, judged, turn_id, total)
    bounded = assemble_turns(keep_ids(light, ids, turn_id, passing), turn_id)
    filtered = staged(bounded.withColumnRenamed(turn_id, run.id_col), "filtered")

    def baseline(n: int) -> DataFrame:
        sample = random_sample(judged.select(turn_id), n, run.seed, turn_id)
        return turns.join(sample, turn_id, "left_semi").select(F.col("text").alias("content"))

    return _finish(baseline, original_size, filtered, config, k, run)


def without_giants(turns: DataFrame, judged: DataFrame, turn_id: str, total: int) -> DataFrame:
    """Drop rejected conversations with a large share of all turns before anything is shuffled.

    Fewer than ``GIANTS`` conversations can exceed that share of the ``total``, so their ids are
    safe to broadcast.
    """
    giant = ~F.col("passes") & (F.col("n_messages") > F.lit(total / GIANTS))
    return turns.join(F.broadcast(judged.filter(giant).select(turn_id)), turn_id, "left_anti")


def _finish(
    baseline: Callable[[int], DataFrame],
    original_size: int,
    filtered: DataFrame,
    config: CurationConfig,
    k: int,
    run: RunOptions,
) -> CurationResult:
    check_ids(filtered, run.id_col)
    filtered_size = filtered.count()
    kept, clusters = filtered, None
    most_similar = config.selection.max_similar_samples
    if filtered_size > 0 and not (run.skip_deduplication and most_similar is None):
        ids, clusters = deduplicate(filtered, config, run, clustered=most_similar is not None)
        if not run.skip_deduplication:
            kept = filtered.join(staged(ids, "kept"), run.id_col, "left_semi")
    # From here on only ids and numbers move; the selected rows are fetched at the end.
    extra = [c for c in (run.quality_col, run.diversity_col) if c is not None]
    values = combine_scores(
        learning_value(kept, run, extra),
        config.scoring_weights,
        quality=run.quality_col,
        diversity=run.diversity_col,
    )
    scored = staged(values.select(run.id_col, "learning_value", "final_score"), "scored")
    kept_size = scored.count()
    if kept_size == 0:
        warnings.warn("no rows are left after filtering and deduplication", stacklevel=3)
    eligible, available = scored, kept_size
    if config.selection.band is not None:
        eligible = in_band(eligible, *config.selection.band)
    if clusters is not None:
        # A row without a similar one is a cluster of its own; ids of clusters are ids of rows.
        grouped = eligible.join(clusters, run.id_col, "left").withColumn("_cluster", F.coalesce("_cluster", F.col(run.id_col)))
        eligible = most_per_group(grouped, most_similar, "_cluster", id_col=run.id_col).drop("_cluster")
    if eligible is not scored:
        eligible = staged(eligible, "eligible")
        available = eligible.count()
    selected_size = min(k, available)
    best = top_k(eligible, k, id_col=run.id_col, available=available or None)
    source = filtered.drop("learning_value", "final_score", "rank")
    selected = source.join(F.broadcast(best) if k <= SMALL_K else best, run.id_col)
    validation = None
    if run.validate and kept_size:
        sides = compare_texts(baseline(selected_size), message_texts(selected))
        validation = sides.first().asDict()
    report = build_report(
        score_stats(scored),
        config.name,
        original_size,
        filtered_size,
        kept_size,
        selected_size,
        validation=validation,
    )
    return CurationResult(selected, scored, report)


def deduplicate(
    df: DataFrame, config: CurationConfig, run: RunOptions, clustered: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """Ids that survive near-duplicate removal under the configured kind of vector.

    With ``clustered`` also the id and ``_cluster`` of every row that has a similar one.
    """
    settings = config.deduplication
    whole = isinstance(df.schema[run.id_col].dataType, T.IntegralType)
    rows, id_col = (df, run.id_col) if whole else _numbered(df, run.id_col)
    if settings.text == "rendered":
        text = run.template.render(F.col("messages"))
    else:
        text = F.array_join("messages.content", "\n")
    threshold = settings.similarity_threshold
    sparse, weights = False, None
    if run.vector_col is not None:
        vectors = rows.select(id_col, F.col(run.vector_col).alias("vector"))
    elif run.encoder is not None:
        vectors = rows.select(id_col, run.encoder(text).alias("vector"))
    elif settings.method == "hashed":
        vectors, weights = weighed_counts(rows, text, id_col, settings.dims, settings.idf, settings.ngram)
    elif settings.method == "sparse":
        sparse, vectors = True, staged(sparse_vectors(rows, text, id_col), "counts")
    else:
        raise ValueError(f"method {settings.method} needs a vector column or an encoder")
    if sparse:
        reps, best = sparse_matches(vectors, id_col, "vector", threshold, settings.idf)
    else:
        reps, best = nearest_matches(vectors, id_col, "vector", threshold, weights=weights)
    if clustered:
        best = staged(best, "matches")
    kept = survivors(reps, best).withColumnRenamed("id", id_col)
    clusters = None
    if clustered:
        found = match_clusters(with_copies(vectors, id_col, "vector", reps, best))
        clusters = found.select(F.col("id").alias(id_col), F.col("cluster").alias("_cluster"))
    if whole:
        return kept, clusters
    names = rows.select(id_col, run.id_col)
    if clusters is not None:
        named = names.select(F.col(id_col).alias("_cluster"), F.col(run.id_col).alias("_name"))
        clusters = names.join(clusters, id_col).join(named, "_cluster").select(run.id_col, F.col("_name").alias("_cluster"))
    return names.join(kept, id_col).select(run.id_col), clusters


def _numbered(df: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """Put a number beside ids of another type, in their order; written, so it never changes."""
    ids = df.select(id_col).repartitionByRange(id_col).sortWithinPartitions(id_col)
    numbers = staged(ids.withColumn("_number", F.monotonically_increasing_id()), "numbers")
    return df.join(numbers, id_col), "_number"


def check_ids(df: DataFrame, id_col: str) -> None:
    """Stop if an id is missing or repeated: rows are matched by it."""
    bad = df.groupBy(id_col).count().filter(F.col(id_col).isNull() | (F.col("count") > 1)).first()
    if bad is not None:
        raise ValueError(f"{id_col} must be unique and not null; {bad[0]!r} occurs {bad[1]} times")


def learning_value(df: DataFrame, run: RunOptions, extra: list[str]) -> DataFrame:
    """The id, the ``extra`` columns and ``learning_value`` by the chosen scorer."""
    keep = [run.id_col, *dict.fromkeys(extra)]
    if run.scorer == "hash_random":
        return df.select(*keep, random_score(F.col(run.id_col), run.seed).alias("learning_value"))
    if run.scorer == "column":
        if run.score_col is None:
            raise ValueError("scorer 'column' needs score_col")
        return df.select(*keep, F.col(run.score_col).cast("double").alias("learning_value"))
    # These scorers read the texts more than once.
    held = staged(df.select(*keep, "messages"), "unique")
    if run.scorer.startswith("ngram_perplexity"):
        values = learning_values(
            held,
            run.id_col,
            template=run.template,
            token_budget=run.token_budget,
            leave_out=run.scorer == "ngram_perplexity_left_out",
        )
    else:
        values = _user_values(held, run)
    scores = values.select(run.id_col, "learning_value")
    return held.select(*keep).join(scores, run.id_col) if extra else scores


def _user_values(df: DataFrame, run: RunOptions) -> DataFrame:
    if run.nll is None:
        raise ValueError("scorer 'udf' needs nll")
    messages = F.col("messages")
    last = response_message(messages)
    loss = run.nll(run.template.render_context(messages), last["content"])
    # The model sees only rows that can be scored; the others keep 0.
    answered = df.filter(last["role"] == "assistant").select(
        run.id_col, perplexity(loss).alias("perplexity")
    )
    scores = df.select(run.id_col).join(answered, run.id_col, "left")
    return normalised(scores.fillna(0.0, ["perplexity"]))


class Curator:
    """Path-to-path runs. The config given to ``optimize`` wins over the constructor's."""

    def __init__(self, spark: SparkSession, config: str = "llama_3_2_instruct_optimized"):
        self.spark = spark
        self.config = config

    def optimize(
        self,
        dataset_path: str,
        output_dir: str,
        model: str | None = None,
        config: str | None = None,
        top_k: int = 10000,
        skip_deduplication: bool = False,
        validate: bool = False,
        test_model: str | None = None,
        fmt: str | None = None,
        id_col: str | None = None,
        ordered: bool = False,
        schema: T.StructType | None = None,
        split: str | None = "train",
        lenient: bool = False,
        clean: bool = False,
        **options,
    ) -> CurationResult:
        """Read, curate, and write ``optimized_dataset``, ``report`` and ``report_yaml`` below ``output_dir``.

        Rows are written as they come and carry their rank; ``ordered`` writes them from the lowest
        score to the highest.

        ``schema`` saves the pass that finds the columns of JSON lines; ``lenient`` sets lines that do not
        parse apart, in ``rejected_lines``; ``split`` names the rows to read where there is a split column.
        ``clean`` deletes the run's written stages at the end; the result's frames are then read from
        the output, and ``scored`` holds the selected rows only.

        ``model`` and ``test_model`` name no neural model here. As a switch, ``test_model`` selects
        scoring by the bigram model unless a scorer is given, and ``validate`` needs it.
        """
        settings = load_config(config or self.config)
        if test_model is not None:
            options.setdefault("scorer", "ngram_perplexity")
        elif validate:
            warnings.warn("validate is set without test_model; validation is skipped", stacklevel=2)
        before, folder, rejected = written(), output_dir.rstrip("/"), None
        if fmt is None and dataset_path.endswith(".jsonl"):
            if lenient:
                df, rejected = read_jsonl_lenient(self.spark, dataset_path, schema, id_col)
            else:
                df = read_jsonl(self.spark, dataset_path, schema, id_col)
        elif lenient or schema is not None:
            raise ValueError("schema and lenient are for JSON lines")
        else:
            df = read_dataset(self.spark, dataset_path, fmt, split, id_col=id_col, number=id_col is None)
        result = curate(
            df,
            settings,
            top_k,
            id_col=id_col or "sample_id",
            skip_deduplication=skip_deduplication,
            validate=validate and test_model is not None,
            **options,
        )
        rows = result.selected.orderBy(F.desc("rank")) if ordered else result.selected
        write_jsonl(rows, f"{folder}/optimized_dataset", mode="overwrite")
        write_report(result.report, f"{folder}/report", mode="overwrite")
        # One row, and one file of a few lines.
        text = self.spark.createDataFrame([(report_yaml(result.report),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{folder}/report_yaml")
        if rejected is not None:
            rejected.write.mode("overwrite").text(f"{folder}/rejected_lines")
        if not clean:
            return result
        chosen = self.spark.read.schema(result.selected.schema).json(f"{folder}/optimized_dataset")
        report = self.spark.read.schema(result.report.schema).json(f"{folder}/report")
        release(self.spark, before)
        return CurationResult(chosen, chosen.select(*result.scored.columns), report)
