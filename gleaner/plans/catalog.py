"""The registered queries: each takes a session and a folder of tables and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.config import CurationConfig, load_config
from gleaner.functions.plugins import encoder, map_batches, nll_scorer, token_counter
from gleaner.functions.scores import as_percent, balance_ratio, random_score, reduction
from gleaner.functions.template import (
    CHATML,
    HEADER,
    ROLE_TAG,
    ChatTemplate,
    context_messages,
    response_message,
    total_tokens,
)
from gleaner.functions.tokens import count_tokens, message_tokens, tokens, within_budget
from gleaner.functions.vectors import cosine, mean_pool, norm, unit
from gleaner.operators.clusters import match_clusters
from gleaner.operators.compare import compare_texts
from gleaner.operators.features import hashed_vectors, packed_vectors
from gleaner.operators.hyperplanes import hyperplane_matches
from gleaner.operators.language_model import fit, mean_nll, mean_nll_left_out, normalised, with_perplexity
from gleaner.operators.neighbors import collapse_copies, kept_ids, nearest_matches, nearest_rows
from gleaner.operators.quality import (
    conversation_facts,
    judge_conversations,
    matches_refusal,
    passes_quality,
    rejection_funnel as funnel,
    turn_count,
)
from gleaner.operators.report import score_stats, stage_counts
from gleaner.operators.sparse_join import sparse_kept_ids, sparse_nearest, sparse_vectors
from gleaner.operators.select import combine_scores, in_band, join_scores, most_per_group, random_sample, top_k
from gleaner.plans.curate import CurationResult, curate, curate_turns
from gleaner.sources.normalize import alpaca_messages, assemble_turns, to_messages
from gleaner.sources.readers import parse_records, parsed_lines, read_dataset, read_jsonl
from gleaner.sources.writers import write_jsonl, write_parquet
from gleaner.stage import fresh_path, staged
from gleaner.streaming.stages import filter_stream, run_available

Query = Callable[[SparkSession, str], DataFrame]

INSTRUCT = load_config("llama_3_2_instruct")
OPTIMIZED = load_config("llama_3_2_instruct_optimized")
BASE = load_config("llama_3_1_base")
# The test conversations are lopsided, so the queries that need survivors allow for that.
WIDE = INSTRUCT.with_filters(balanced_conversation_ratio=0.75)
RUN = WIDE.with_dedup(similarity_threshold=0.9)
VECTOR_THRESHOLD = 0.45
DOCUMENT_THRESHOLD = 0.95
SPARSE_THRESHOLD = 0.9
# The threshold on the test vectors is low, so buckets have few bits.
PLANES = {"bands": 24, "bits": 4}
CHARACTERS = 3
TOP_K = 25
# Phrases that do occur in the test conversations, in other letter case, after the preset ones.
EXTRA_PHRASES = ("ÉTION", "that WITH", r"und\s+Die")
REFUSING = WIDE.with_filters(refusal_patterns=INSTRUCT.quality_filters.refusal_patterns + EXTRA_PHRASES)
TOKEN_BUDGET = 200
MOST_SIMILAR = 2
PERPLEXITY_BAND = (0.1, 0.9)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return widened(spark.read.parquet(f"{folder}/conversations.parquet"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return widened(spark.read.parquet(f"{folder}/documents.parquet"))


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def widened(scan: DataFrame) -> DataFrame:
    """Spread a table over all cores if its scan has fewer splits than that.

    A small file is a single row group, which one task would tokenize alone. Data worth a cluster
    has more splits than cores and is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def exchanges(spark: SparkSession, folder: str) -> DataFrame:
    """Every user turn with the assistant turn right after it, as instruction rows."""
    turns = conversations(spark, folder)
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction")
    )
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    topic = F.when(F.col("turn") % 4 == 2, F.concat(F.lit("Turn "), F.col("turn").cast("string")))
    extra = F.when(F.col("turn") % 4 == 0, F.lit("")).otherwise(topic)
    return asked.join(answered, ["conv_id", "turn"]).withColumn("input", extra)


def exchange_messages(spark: SparkSession, folder: str) -> DataFrame:
    return exchanges(spark, folder).select(
        "conv_id",
        "turn",
        alpaca_messages(F.col("instruction"), F.col("input"), F.col("output")).alias("messages"),
    )


def text_md5(text: Column) -> Column:
    return F.md5(text)


# ---- sources and templates


@query
def assemble_messages(spark, folder):
    built = assemble_turns(conversations(spark, folder))
    return built.select(
        "conv_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.array_join("messages.role", ",").alias("roles"),
        text_md5(F.array_join("messages.content", "\n")).alias("content_md5"),
    )


@query
def alpaca_to_messages(spark, folder):
    rows = exchanges(spark, folder)
    key = F.concat_ws(":", "conv_id", "turn").alias("key")
    built = to_messages(rows.select(key, "instruction", "input", "output"), "key")
    return built.select(
        "key",
        F.array_join("messages.role", ",").alias("roles"),
        text_md5(F.col("messages")[0]["content"]).alias("user_md5"),
        text_md5(F.col("messages")[1]["content"]).alias("assistant_md5"),
    )


@query
def parse_json_records(spark, folder):
    record = F.to_json(F.struct("instruction", "input", "output"))
    held = exchanges(spark, folder).select("conv_id", "turn", record.alias("line"))
    parsed = parse_records(held, "line")
    return parsed.select(
        "conv_id",
        "turn",
        text_md5(F.col("instruction")).alias("instruction_md5"),
        F.length("input").cast("bigint").alias("input_length"),
        text_md5(F.col("output")).alias("output_md5"),
    )


@query
def jsonl_round_trip(spark, folder):
    path = fresh_path(spark, "jsonl") + ".jsonl"
    ordered = exchanges(spark, folder).select("instruction", "input", "output")
    write_jsonl(ordered, path)
    back = read_jsonl(spark, path)
    texts = back.select("sample_id", F.explode("messages.content").alias("content"))
    return texts.agg(
        F.count_distinct("sample_id").alias("n_rows"),
        F.min("sample_id").alias("first_id"),
        F.max("sample_id").alias("last_id"),
        F.sum(F.length("content")).alias("n_chars"),
        F.count_distinct(text_md5(F.col("content"))).alias("n_texts"),
    )


@query
def jsonl_lenient(spark, folder):
    """Lines of both layouts, and some that are cut off or have no known layout, in one scan."""
    turns = conversations(spark, folder)
    key = (F.col("conv_id") * 1000 + F.col("turn")).alias("id")
    listed = F.to_json(F.struct(key, F.array(F.struct("role", F.col("text").alias("content"))).alias("messages")))
    pair = F.to_json(F.struct(key, F.col("role").alias("instruction"), F.col("text").alias("response")))
    other = F.to_json(F.struct(key, "text"))
    line = F.when(F.col("turn") % 2 == 0, listed).when(F.col("conv_id") % 7 == 0, other).otherwise(pair)
    cut = F.when(F.col("conv_id") % 5 == 0, F.expr("substring(line, 1, length(line) - 3)")).otherwise(F.col("line"))
    path = fresh_path(spark, "lines")
    turns.select("conv_id", line.alias("line")).select(cut.alias("value")).write.text(path)
    rows = parsed_lines(spark, path, id_col="id")
    return rows.select(
        "id",
        F.coalesce(F.size("messages"), F.lit(0)).cast("bigint").alias("n_messages"),
        text_md5(F.array_join("messages.content", "|")).alias("content_md5"),
        text_md5(F.col("_corrupt_record")).alias("corrupt_md5"),
    )


@query
def dataset_split(spark, folder):
    path = fresh_path(spark, "splits")
    part = F.when(F.col("conv_id") % 3 == 0, F.lit("test")).otherwise(F.lit("train"))
    rows = exchange_messages(spark, folder).withColumn("split", part)
    write_parquet(rows, path)
    train = read_dataset(spark, path, "parquet", split="train")
    return train.select(
        "conv_id", "turn", "split", text_md5(F.col("messages")[1]["content"]).alias("answer_md5")
    )


def _render(template: ChatTemplate) -> Query:
    def run(spark, folder):
        built = assemble_turns(conversations(spark, folder))
        rendered = built.select("conv_id", template.render(F.col("messages")).alias("t"))
        return rendered.select(
            "conv_id",
            F.length("t").cast("bigint").alias("n_chars"),
            text_md5(F.col("t")).alias("text_md5"),
        )

    return run


for _template in (CHATML, HEADER, ROLE_TAG):
    QUERIES[f"render_{_template.name}"] = _render(_template)


@query
def scoring_text(spark, folder):
    messages = F.col("messages")
    texts = exchange_messages(spark, folder).select(
        "conv_id",
        "turn",
        HEADER.render_context(messages).alias("context"),
        HEADER.render_scored(messages).alias("whole"),
    )
    return texts.select(
        "conv_id",
        "turn",
        F.length("context").cast("bigint").alias("context_chars"),
        text_md5(F.col("context")).alias("context_md5"),
        F.length("whole").cast("bigint").alias("whole_chars"),
        text_md5(F.col("whole")).alias("whole_md5"),
    )


# ---- token counts


@query
def token_counts(spark, folder):
    turns = conversations(spark, folder)
    return turns.select("conv_id", "turn", count_tokens(F.col("text")).cast("bigint").alias("n_tokens"))


@query
def rendered_token_counts(spark, folder):
    chat = conversation_facts(conversations(spark, folder), INSTRUCT.quality_filters)
    header = conversation_facts(
        conversations(spark, folder), INSTRUCT.quality_filters, template=HEADER
    )
    return chat.select("conv_id", F.col("total_tokens").alias("chatml_tokens")).join(
        header.select("conv_id", F.col("total_tokens").alias("header_tokens")), "conv_id"
    )


@query
def total_tokens_with_specials(spark, folder):
    rows = exchange_messages(spark, folder)
    messages = F.col("messages")
    return rows.select(
        "conv_id",
        "turn",
        total_tokens(messages, HEADER, special_tokens=1).cast("bigint").alias("total_tokens"),
        message_tokens(messages)[0].cast("bigint").alias("user_tokens"),
        message_tokens(messages)[1].cast("bigint").alias("assistant_tokens"),
    )


@query
def turn_counts(spark, folder):
    sizes = conversations(spark, folder).groupBy("conv_id").agg(F.count("*").alias("n_messages"))
    return sizes.withColumn("turns", turn_count(F.col("n_messages")).cast("bigint"))


@query
def role_token_sums(spark, folder):
    facts = conversation_facts(conversations(spark, folder), INSTRUCT.quality_filters)
    return facts.select("conv_id", "user_tokens", "assistant_tokens")


@query
def conversation_balance(spark, folder):
    facts = conversation_facts(conversations(spark, folder), INSTRUCT.quality_filters)
    ratio = balance_ratio(F.col("user_tokens"), F.col("assistant_tokens"))
    return facts.select("conv_id", F.round(ratio, 6).alias("balance_ratio"))


@query
def truncate_to_budget(spark, folder):
    rows = exchange_messages(spark, folder)
    messages = F.col("messages")
    context = CHATML.count_rendered(context_messages(messages)) + CHATML.prompt_tokens
    counted = rows.select(
        "conv_id",
        "turn",
        context.cast("bigint").alias("context_tokens"),
        tokens(response_message(messages)["content"]).alias("found"),
    )
    kept = within_budget(F.col("found"), F.col("context_tokens").cast("int"), TOKEN_BUDGET)
    return counted.select(
        "conv_id",
        "turn",
        "context_tokens",
        F.size("found").cast("bigint").alias("response_tokens"),
        F.size(kept).cast("bigint").alias("kept_tokens"),
    )


@query
def user_tokenizer_counts(spark, folder):
    count = token_counter(lambda: str.split)
    turns = conversations(spark, folder)
    return turns.select("conv_id", "turn", count(F.col("text")).cast("bigint").alias("n_tokens"))


@query
def user_batch_map(spark, folder):
    def run(batch):
        return batch.assign(n_lines=batch["text"].str.count("\n") + 1)[["conv_id", "turn", "n_lines"]]

    return map_batches(
        conversations(spark, folder).select("conv_id", "turn", "text"),
        run,
        "conv_id bigint, turn bigint, n_lines bigint",
    )


# ---- quality filters


def _judge(config: CurationConfig, **options) -> Query:
    def run(spark, folder):
        judged = judge_conversations(
            conversations(spark, folder), config.quality_filters, **options
        )
        return judged.select(
            "conv_id",
            "n_messages",
            "starts_with_user",
            "roles_allowed",
            "total_tokens",
            F.col("fewest_tokens").cast("bigint").alias("fewest_tokens"),
            F.col("most_tokens").cast("bigint").alias("most_tokens"),
            "user_tokens",
            "assistant_tokens",
            "refused",
            "passes",
        )

    return run


QUERIES["quality_filter_instruct"] = _judge(INSTRUCT)
QUERIES["quality_filter_optimized"] = _judge(OPTIMIZED)
QUERIES["quality_filter_base"] = _judge(BASE)
QUERIES["quality_filter_wide"] = _judge(WIDE)
QUERIES["quality_filter_message_sums"] = _judge(WIDE, total_mode="sum", special_tokens=1)


@query
def quality_filter_nested(spark, folder):
    rows = exchange_messages(spark, folder)
    messages = F.col("messages")
    return rows.select(
        "conv_id",
        "turn",
        passes_quality(messages, WIDE.quality_filters).alias("passes"),
        passes_quality(messages, BASE.quality_filters).alias("passes_base"),
        passes_quality(
            messages, WIDE.quality_filters, total_mode="sum", special_tokens=1
        ).alias("passes_sum"),
    )


@query
def refusal_filter(spark, folder):
    turns = conversations(spark, folder).filter(F.col("role") == "assistant")
    phrases = INSTRUCT.quality_filters.refusal_patterns + EXTRA_PHRASES
    return turns.select("conv_id", "turn", matches_refusal(F.col("text"), phrases).alias("refused"))


@query
def filter_stage_counts(spark, folder):
    judged = judge_conversations(conversations(spark, folder), WIDE.quality_filters)
    return stage_counts(
        judged,
        original=F.lit(True),
        passed=F.col("passes"),
        starting_with_user=F.col("starts_with_user"),
        with_allowed_roles=F.col("roles_allowed"),
    )


# ---- vectors and near-duplicates


@query
def hashed_features(spark, folder):
    vectors = hashed_vectors(documents(spark, folder), F.col("text"), "doc_id")
    v = F.col("vector")
    return vectors.select(
        "doc_id",
        F.aggregate(v, F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("n_words"),
        F.size(F.filter(v, lambda x: x > 0)).cast("bigint").alias("n_buckets"),
        F.round(norm(v), 6).alias("length"),
    )


@query
def hashed_char_features(spark, folder):
    vectors = hashed_vectors(documents(spark, folder), F.col("text"), "doc_id", ngram=CHARACTERS)
    v = F.col("vector")
    return vectors.select(
        "doc_id",
        F.aggregate(v, F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("n_grams"),
        F.size(F.filter(v, lambda x: x > 0)).cast("bigint").alias("n_buckets"),
        F.round(norm(v), 6).alias("length"),
    )


@query
def hashed_features_idf(spark, folder):
    vectors = hashed_vectors(
        documents(spark, folder), F.col("text"), "doc_id", dims=64, idf=True
    )
    return vectors.select("doc_id", F.round(norm(F.col("vector")), 6).alias("length"))


@query
def unit_vectors(spark, folder):
    u = unit(F.col("embedding"))
    first = F.transform(
        F.array(u), lambda v: F.struct(F.get(v, F.lit(0)).alias("x"), norm(v).alias("n"))
    )[0]
    rows = embeddings(spark, folder).select("vec_id", first.alias("f"))
    return rows.select(
        "vec_id", F.round("f.x", 6).alias("first_entry"), F.round("f.n", 6).alias("length")
    )


@query
def cosine_to_next(spark, folder):
    rows = embeddings(spark, folder).select("vec_id", "embedding")
    following = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    pairs = rows.join(following, "vec_id")
    return pairs.select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


@query
def mean_pooled_vectors(spark, folder):
    pooled = mean_pool(embeddings(spark, folder), "label", "embedding")
    flat = pooled.select("label", F.posexplode("vector").alias("position", "x"))
    return flat.select(
        F.col("label").cast("bigint").alias("label"),
        F.col("position").cast("bigint").alias("position"),
        F.round("x", 6).alias("mean_entry"),
    )


@query
def dedup_vectors(spark, folder):
    return kept_ids(embeddings(spark, folder), "vec_id", "embedding", VECTOR_THRESHOLD)


@query
def nearest_vectors(spark, folder):
    _, best = nearest_matches(embeddings(spark, folder), "vec_id", "embedding", VECTOR_THRESHOLD)
    return best.select("id", "match_id", F.round("similarity", 6).alias("similarity"))


@query
def nearest_by_hyperplanes(spark, folder):
    """Approximate: partners among the vectors that share a bucket."""
    _, best = hyperplane_matches(embeddings(spark, folder), "vec_id", "embedding", VECTOR_THRESHOLD, **PLANES)
    return best.select("id", "match_id", F.round("similarity", 6).alias("similarity"))


@query
def nearest_documents(spark, folder):
    vectors = packed_vectors(documents(spark, folder), F.col("text"), "doc_id")
    best = nearest_rows(vectors, "doc_id", "vector", DOCUMENT_THRESHOLD)
    return best.select("id", "match_id", F.round("similarity", 6).alias("similarity"))


@query
def dedup_documents(spark, folder):
    vectors = packed_vectors(documents(spark, folder), F.col("text"), "doc_id")
    return kept_ids(vectors, "doc_id", "vector", DOCUMENT_THRESHOLD)


@query
def removed_documents(spark, folder):
    docs = documents(spark, folder)
    vectors = packed_vectors(docs, F.col("text"), "doc_id")
    kept = kept_ids(vectors, "doc_id", "vector", DOCUMENT_THRESHOLD)
    return docs.select("doc_id", "lang", "n_chars").join(kept, "doc_id", "left_anti")


@query
def dedup_documents_sparse(spark, folder):
    vectors = sparse_vectors(documents(spark, folder), F.col("text"), "doc_id")
    return sparse_kept_ids(vectors, "doc_id", "vector", DOCUMENT_THRESHOLD)


@query
def nearest_documents_sparse(spark, folder):
    """At a threshold that longer prefixes are needed for."""
    vectors = sparse_vectors(documents(spark, folder), F.col("text"), "doc_id")
    best = sparse_nearest(vectors, "doc_id", "vector", SPARSE_THRESHOLD)
    return best.select("id", "match_id", F.round("similarity", 6).alias("similarity"))


@query
def user_encoder_dedup(spark, folder):
    def load():
        import numpy as np

        letters = "etaoinshrdlu"

        def encode(texts):
            return np.array([[t.lower().count(c) for c in letters] for t in texts], dtype=np.float32)

        return encode

    docs = documents(spark, folder)
    vectors = docs.select("doc_id", encoder(load)(F.col("text")).alias("vector"))
    return kept_ids(vectors, "doc_id", "vector", 0.9999)


# ---- scores and selection


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    ids = conversations(spark, folder).select("conv_id").distinct()
    values = ids.withColumn("learning_value", random_score(F.col("conv_id")))
    return combine_scores(values, INSTRUCT.scoring_weights)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    for name in columns:
        df = df.withColumn(name, F.round(name, 6))
    return df


@query
def hash_random_scores(spark, folder):
    return _rounded(_scored(spark, folder).select("conv_id", "learning_value"), "learning_value")


@query
def combined_scores(spark, folder):
    return _rounded(_scored(spark, folder), "learning_value", "final_score")


@query
def quality_column_join(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    values = docs.withColumn("learning_value", random_score(F.col("doc_id")))
    joined = join_scores(values, labels, "doc_id", "quality")
    scored = combine_scores(joined, INSTRUCT.scoring_weights, quality="quality")
    return _rounded(scored.select("doc_id", "final_score"), "final_score")


@query
def top_k_selection(spark, folder):
    best = top_k(_scored(spark, folder), TOP_K, id_col="conv_id")
    return _rounded(best.select("conv_id", "final_score", "rank"), "final_score")


@query
def top_half_selection(spark, folder):
    """A selection too large for one task: half of all documents, ranked over range partitions."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id")
    values = docs.withColumn("learning_value", random_score(F.col("doc_id")))
    scored = combine_scores(values, INSTRUCT.scoring_weights)
    best = top_k(scored, max(docs.count() // 2, 1), id_col="doc_id", small_k=0)
    return _rounded(best.select("doc_id", "final_score", "rank"), "final_score")


@query
def score_statistics(spark, folder):
    return _rounded(score_stats(_scored(spark, folder)), "mean", "std", "min", "max")


@query
def random_baseline(spark, folder):
    ids = conversations(spark, folder).select("conv_id").distinct()
    return random_sample(ids, TOP_K, id_col="conv_id")


def _last_turns(turns: DataFrame) -> DataFrame:
    """The final turn of each conversation."""
    # The limit of one is applied before the shuffle too.
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("turn")))
    return turns.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


@query
def response_split(spark, folder):
    last = _last_turns(conversations(spark, folder))
    scorable = F.col("role") == "assistant"
    n = F.when(scorable, count_tokens(F.col("text"))).otherwise(F.lit(0)).cast("bigint")
    return last.select(
        "conv_id",
        F.col("turn").alias("context_messages"),
        F.col("role").alias("last_role"),
        scorable.alias("scorable"),
        n.alias("response_tokens"),
    )


@query
def response_perplexity(spark, folder):
    turns = conversations(spark, folder)
    model = fit(turns, "text")
    # Read twice, and a sort over whole texts.
    last = staged(_last_turns(turns), "last")
    answers = last.filter(F.col("role") == "assistant")
    losses = mean_nll(answers, "conv_id", tokens(F.col("text")), model, all_seen=True)
    scores = normalised(with_perplexity(last.select("conv_id"), losses, "conv_id"))
    return scores.select(
        "conv_id",
        F.round("perplexity", 4).alias("perplexity"),
        F.round("learning_value", 6).alias("learning_value"),
    )


@query
def response_perplexity_loo(spark, folder):
    """Each final answer judged by the model of everything else."""
    turns = conversations(spark, folder)
    model = fit(turns, "text")
    last = staged(_last_turns(turns), "last")
    answers = last.filter(F.col("role") == "assistant")
    losses = mean_nll_left_out(answers, "conv_id", tokens(F.col("text")), model)
    scores = normalised(with_perplexity(last.select("conv_id"), losses, "conv_id"))
    return _rounded(scores, "perplexity", "learning_value")


@query
def perplexity_under_other_corpus(spark, folder):
    """Loss of documents in a model of the conversations, where many words are new."""
    model = fit(conversations(spark, folder), "text")
    docs = documents(spark, folder)
    losses = mean_nll(docs, "doc_id", tokens(F.col("text")), model, all_seen=False)
    scores = with_perplexity(docs.select("doc_id"), losses, "doc_id")
    return scores.select("doc_id", F.round("perplexity", 3).alias("perplexity"))


def _length_model():
    def score(contexts, responses):
        return [len(r) / (1.0 + len(c)) for c, r in zip(contexts, responses)]

    return score


@query
def user_model_scores(spark, folder):
    messages = F.col("messages")
    loss = nll_scorer(_length_model)(CHATML.render_context(messages), response_message(messages)["content"])
    rows = exchange_messages(spark, folder).select("conv_id", "turn", loss.alias("mean_nll"))
    return _rounded(rows, "mean_nll")


@query
def compare_with_baseline(spark, folder):
    turns = conversations(spark, folder)
    judged = staged(
        judge_conversations(turns, WIDE.quality_filters).select("conv_id", "passes"), "judged"
    )
    chosen = judged.filter("passes").select("conv_id")
    sample = random_sample(judged.select("conv_id"), max(chosen.count(), 1), id_col="conv_id")

    def texts(ids: DataFrame) -> DataFrame:
        return turns.join(ids, "conv_id", "left_semi").select(F.col("text").alias("content"))

    result = compare_texts(texts(sample), texts(chosen))
    return _rounded(result, "baseline_loss", "optimized_loss", "loss_reduction_percentage")


@query
def reduction_ratio(spark, folder):
    judged = judge_conversations(conversations(spark, folder), WIDE.quality_filters)
    counts = stage_counts(judged, before=F.lit(True), after=F.col("passes"))
    share = reduction(F.col("before"), F.col("after"))
    return counts.select("before", "after", as_percent(share).alias("reduction_percentage"))


@query
def exact_dedup(spark, folder):
    docs = documents(spark, folder).select("doc_id", "lang", "text")
    return collapse_copies(docs, "doc_id", "text").select("doc_id", "lang")


@query
def rejection_funnel(spark, folder):
    return funnel(conversations(spark, folder), INSTRUCT.quality_filters)


@query
def perplexity_band(spark, folder):
    return in_band(response_perplexity(spark, folder), *PERPLEXITY_BAND).select("conv_id", "learning_value")


@query
def similar_clusters(spark, folder):
    vectors = packed_vectors(documents(spark, folder), F.col("text"), "doc_id")
    return match_clusters(nearest_rows(vectors, "doc_id", "vector", DOCUMENT_THRESHOLD))


@query
def max_similar(spark, folder):
    """The best rows of each cluster of similar documents; a document without a match is one alone."""
    docs = documents(spark, folder).select("doc_id", "text")
    clusters = similar_clusters(spark, folder).withColumnRenamed("id", "doc_id")
    scored = docs.select("doc_id", random_score(F.col("doc_id")).alias("final_score")).join(clusters, "doc_id", "left")
    grouped = scored.withColumn("cluster", F.coalesce("cluster", "doc_id"))
    return most_per_group(grouped, MOST_SIMILAR, "cluster", id_col="doc_id").select("doc_id", "cluster")


@query
def refused_conversations(spark, folder):
    """Whole conversations judged flat, with phrases that do occur among the refusals."""
    judged = judge_conversations(conversations(spark, folder), REFUSING.quality_filters)
    return judged.select("conv_id", "n_messages", "refused", "passes")


@query
def quality_filter_whole(spark, folder):
    """The same verdicts on rows that hold whole conversations of any length."""
    built = assemble_turns(conversations(spark, folder))
    passes = passes_quality(F.col("messages"), REFUSING.quality_filters)
    return built.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"), passes.alias("passes"))


# ---- streams


@query
def stream_filter(spark, folder):
    """Files that arrive in two batches, filtered by a stream that stops and goes on from its checkpoint."""
    built = assemble_turns(conversations(spark, folder))
    source, sink, progress = (fresh_path(spark, name) for name in ("arrivals", "filtered", "progress"))
    for part in (0, 1):
        built.filter(F.pmod(F.col("conv_id"), F.lit(2)) == part).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(built.schema).parquet(source)
        run_available(filter_stream(arriving, WIDE.quality_filters, "conv_id"), sink, progress)
    rows = spark.read.schema(built.schema).parquet(sink)
    return rows.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"))


# ---- whole runs


def _curated(spark: SparkSession, folder: str, **options) -> CurationResult:
    return curate_turns(conversations(spark, folder), RUN, TOP_K, **options)


def _selection(result: CurationResult, id_col: str = "sample_id") -> DataFrame:
    columns = result.selected.select(
        id_col,
        F.size("messages").cast("bigint").alias("n_messages"),
        "learning_value",
        "final_score",
        "rank",
    )
    return _rounded(columns, "learning_value", "final_score")


def _report_row(result: CurationResult) -> DataFrame:
    stats = [F.round(f"final_scores_stats.{n}", 6).alias(f"score_{n}") for n in ("mean", "std", "min", "max")]
    return result.report.select(
        "config_used",
        "original_size",
        "size_after_quality_filter",
        "size_after_deduplication",
        "optimized_size",
        "reduction_percentage",
        "note",
        *stats,
    )


@query
def curate_conversations(spark, folder):
    return _selection(_curated(spark, folder))


@query
def curate_by_perplexity(spark, folder):
    return _selection(_curated(spark, folder, scorer="ngram_perplexity"))


@query
def curate_without_dedup(spark, folder):
    return _selection(_curated(spark, folder, skip_deduplication=True))


@query
def curation_report(spark, folder):
    return _report_row(_curated(spark, folder))


@query
def curate_exchanges(spark, folder):
    """Rows with text ids, deduplicated."""
    rows = exchange_messages(spark, folder).select(
        F.concat_ws(":", "conv_id", "turn").alias("sample_id"), "messages"
    )
    return _selection(curate(rows, RUN, TOP_K)).drop("n_messages")


@query
def curate_by_column(spark, folder):
    rows = exchange_messages(spark, folder).select(
        F.concat_ws(":", "conv_id", "turn").alias("sample_id"), "messages", (F.col("turn") % 7 / 7.0).alias("given")
    )
    run = curate(rows, RUN, TOP_K, scorer="column", score_col="given", skip_deduplication=True)
    return _selection(run).drop("n_messages")


@query
def curate_by_model(spark, folder):
    rows = exchange_messages(spark, folder).select(
        F.concat_ws(":", "conv_id", "turn").alias("sample_id"), "messages"
    )
    run = curate(rows, RUN, TOP_K, scorer="udf", nll=nll_scorer(_length_model), skip_deduplication=True)
    return _selection(run).drop("n_messages")


@query
def empty_run_report(spark, folder):
    """Each exchange alone is one turn, which the strict preset does not take: nothing is left."""
    rows = exchange_messages(spark, folder).select(
        F.concat_ws(":", "conv_id", "turn").alias("sample_id"), "messages"
    )
    return _report_row(curate(rows, OPTIMIZED, TOP_K))
