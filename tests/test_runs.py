import json

import pytest
from pyspark.sql import functions as F

from gleaner import Curator, curate, curate_turns, load_config
from gleaner.config import PRESETS
from gleaner.functions.template import HEADER
from gleaner.sources.normalize import assemble_turns
from gleaner.streaming.stages import filter_stream

SAMPLE = [
    {"instruction": "Which bird sings at night in the garden?", "response": "At night the nightingale sings."},
    {"instruction": "How long do tomatoes ripen?", "response": "Seven weeks."},
    {"instruction": "Which bird sings at night in the garden?", "response": "The nightingale sings at night."},
]
WIDE = load_config("llama_3_2_instruct").with_filters(balanced_conversation_ratio=0.75)
RUN = WIDE.with_dedup(similarity_threshold=0.9)


@pytest.fixture(scope="module")
def turns(spark):
    return spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")


@pytest.fixture(scope="module")
def nested(turns):
    return assemble_turns(turns).withColumnRenamed("conv_id", "sample_id").withColumn("extra", F.lit("x"))


def picked(result):
    return {(r["sample_id"], r["rank"], round(r["final_score"], 9)) for r in result.selected.collect()}


def test_sample_file_gives_the_empty_result(spark, tmp_path):
    path = tmp_path / "sample.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in SAMPLE))
    with pytest.warns(UserWarning, match="no rows"):
        result = Curator(spark).optimize(str(path), str(tmp_path / "out"), top_k=3)
    assert result.selected.count() == 0 and "messages" in result.selected.columns
    report = json.loads(spark.read.text(str(tmp_path / "out/report")).first()[0])
    assert report["original_size"] == 3 and report["size_after_quality_filter"] == 0
    assert report["reduction_percentage"] == "100.00%" and "note" in report
    assert "final_scores_stats" not in report


def test_sample_file_with_a_loose_config(spark, tmp_path):
    import yaml

    from gleaner.config import PRESETS

    raw = json.loads(json.dumps(PRESETS["llama_3_2_instruct"]))
    raw["quality_filters"].update(
        min_tokens_per_turn=1, min_total_tokens=1, balanced_conversation_ratio=1.0
    )
    raw["deduplication"]["similarity_threshold"] = 0.9
    config = tmp_path / "loose.yaml"
    config.write_text(yaml.safe_dump(raw))
    path = tmp_path / "sample.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in SAMPLE))
    result = Curator(spark, str(config)).optimize(str(path), str(tmp_path / "out"), top_k=2)
    row = result.report.first()
    assert (row["original_size"], row["size_after_quality_filter"]) == (3, 3)
    assert row["size_after_deduplication"] == 2  # the two questions about Paris are near-duplicates
    written = spark.read.json(str(tmp_path / "out/optimized_dataset")).collect()
    assert {r["sample_id"] for r in written} == {0, 1}


def test_switches_of_the_path_run(spark, nested, tmp_path):
    source = str(tmp_path / "in")
    nested.select("sample_id", "messages").write.parquet(source)
    curator = Curator(spark)
    with pytest.warns(UserWarning, match="without test_model"):
        curator.optimize(source, str(tmp_path / "a"), config="llama_3_2_instruct", top_k=3, validate=True,
                         fmt="parquet", id_col="sample_id")
    report = json.loads(spark.read.text(str(tmp_path / "a/report")).first()[0])
    assert report["config_used"] == "llama_3_2_instruct" and "validation_results" not in report
    result = curator.optimize(source, str(tmp_path / "b"), "any", "llama_3_2_instruct", 3, validate=True,
                              test_model="bigram", fmt="parquet", id_col="sample_id", ordered=True)
    files = spark.read.json(str(tmp_path / "b/optimized_dataset")).coalesce(1)
    assert [r["rank"] for r in files.collect()] == [3, 2, 1]
    report = json.loads(spark.read.text(str(tmp_path / "b/report")).first()[0])
    assert set(report["validation_results"]) == {"baseline_loss", "optimized_loss", "loss_reduction_percentage"}
    assert result.scored.agg(F.max("learning_value")).first()[0] == 1.0
    with pytest.raises(ValueError, match="id column"):
        curator.optimize(source, str(tmp_path / "c"), fmt="parquet")


def test_a_giant_conversation_is_left_before_the_shuffle(spark, turns):
    from gleaner.operators.quality import judge_conversations
    from gleaner.plans.curate import without_giants

    giant = spark.range(300).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.lit("some words that repeat again and again in this turn").alias("text"),
    )
    both = turns.unionByName(giant)
    judged = judge_conversations(both, RUN.quality_filters)
    total = both.count()
    assert without_giants(both, judged, "conv_id", total).filter("conv_id = -1").count() == 0
    with_giant, plain = curate_turns(both, RUN, 20), curate_turns(turns, RUN, 20)
    assert picked(with_giant) == picked(plain)
    assert with_giant.report.first()["original_size"] == plain.report.first()["original_size"] + 1


def test_nested_and_flat_runs_agree(turns, nested):
    a = curate_turns(turns, RUN, 20, validate=True)
    b = curate(nested, RUN, 20, validate=True)
    assert picked(a) == picked(b)
    left, right = a.report.first().asDict(True), b.report.first().asDict(True)
    left.pop("timestamp"), right.pop("timestamp")
    assert left.pop("validation_results") == pytest.approx(right.pop("validation_results"))
    assert left.pop("final_scores_stats") == pytest.approx(right.pop("final_scores_stats"))
    assert left == right
    assert "extra" in b.selected.columns


def test_partitioning_does_not_matter_and_k_is_monotone(nested):
    few = picked(curate(nested.repartition(2), RUN, 5))
    many = picked(curate(nested.repartition(11), RUN, 15))
    assert few < many and len(few) == 5 and len(many) == 15


def test_sizes_shrink(turns):
    row = curate_turns(turns, RUN, 10).report.first()
    sizes = [
        row[c]
        for c in ("original_size", "size_after_quality_filter", "size_after_deduplication", "optimized_size")
    ]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == 10
    skipped = curate_turns(turns, RUN, 10, skip_deduplication=True).report.first()
    assert skipped["size_after_deduplication"] == skipped["size_after_quality_filter"]


def test_scorers(nested):
    by_loss = curate(nested, RUN, 10, scorer="ngram_perplexity").scored.agg(F.max("learning_value"))
    assert by_loss.first()[0] == 1.0
    given = nested.withColumn("mine", F.col("sample_id") / 100).withColumn("q", F.lit(0.5))
    out = curate(given, RUN, 1, scorer="column", score_col="mine", quality_col="q", diversity_col="q")
    row = out.selected.first()
    assert row["sample_id"] == out.scored.agg(F.max("sample_id")).first()[0]
    assert row["final_score"] == pytest.approx(0.5 * row["sample_id"] / 100 + 0.25)

    def load():
        return lambda contexts, responses: [len(r) / 1000 for r in responses]

    from gleaner.functions.plugins import nll_scorer

    values = curate(nested, RUN, 5, scorer="udf", nll=nll_scorer(load)).scored.collect()
    last = {r["sample_id"]: r["messages"][-1]["role"] for r in nested.collect()}
    assert all((r["learning_value"] > 0) == (last[r["sample_id"]] == "assistant") for r in values)
    for bad in ({"scorer": "none"}, {"scorer": "udf"}, {"scorer": "column"}):
        with pytest.raises(ValueError):
            curate(nested, RUN, 5, **bad)
    with pytest.raises(ValueError):
        curate(nested, RUN, 0)


@pytest.mark.parametrize("total_mode", ["template", "sum"])
def test_own_tokenizer(turns, nested, total_mode):
    def load():
        import re

        # The built-in tokens, as a user's tokenizer.
        return re.compile(r"[^\W_]+|[^\w\s]|_").findall

    for run in (
        lambda **o: curate(nested, RUN, 20, skip_deduplication=True, total_mode=total_mode, **o),
        lambda **o: curate_turns(turns, RUN, 20, skip_deduplication=True, total_mode=total_mode, **o),
        lambda **o: curate_turns(
            turns, RUN, 20, skip_deduplication=True, total_mode=total_mode, template=HEADER, **o
        ),
    ):
        assert picked(run(tokenizer=load)) == picked(run())

    def load_letters():
        return list

    few = curate_turns(turns, RUN, 20, skip_deduplication=True, tokenizer=load_letters)
    assert few.report.first()["size_after_quality_filter"] < 62


def test_vectors_from_a_column_or_an_encoder(nested):
    from gleaner.functions.plugins import encoder

    same = nested.withColumn("e", F.array(F.lit(1.0), F.lit(2.0)))
    assert curate(same, RUN, 5, vector_col="e").scored.count() == 1

    def load():
        return lambda texts: [[1.0, 0.0] for _ in texts]

    assert curate(nested, RUN, 5, encoder=encoder(load)).scored.count() == 1
    with pytest.raises(ValueError, match="encoder"):
        curate(nested, RUN.with_dedup(method="column"), 5)


def test_stream_matches_batch(spark, nested, tmp_path):
    from gleaner.operators.quality import quality_filter

    source = str(tmp_path / "in")
    nested.select("sample_id", "messages").repartition(4).write.json(source)
    schema = nested.select("sample_id", "messages").schema
    stream = filter_stream(spark.readStream.schema(schema).json(source), WIDE.quality_filters)
    run = (
        stream.writeStream.format("memory")
        .queryName("passed")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination(120)
    got = {r["sample_id"] for r in spark.table("passed").collect()}
    assert got == {r["sample_id"] for r in quality_filter(nested, WIDE.quality_filters).collect()}
    with pytest.raises(ValueError, match="streaming"):
        filter_stream(nested, WIDE.quality_filters)


def test_stages_can_be_released(spark, tmp_path):
    from gleaner import stage

    before = list(stage._written)
    stage._written.clear()
    try:
        held = stage.staged(spark.range(5), "numbers")
        assert held.count() == 5
        assert stage.release(spark) == 1 and stage.release(spark) == 0
    finally:
        stage._written.extend(before)


LOOSE = load_config("llama_3_2_instruct").with_filters(
    min_tokens_per_turn=1, min_total_tokens=1, balanced_conversation_ratio=1.0
)


def _pairs(spark, rows, kind="sample_id long"):
    made = [
        (key, [{"role": "user", "content": ask}, {"role": "assistant", "content": answer}])
        for key, ask, answer in rows
    ]
    return spark.createDataFrame(made, f"{kind}, messages array<struct<role:string,content:string>>")


SHORT = [
    (1, "Red apples", "grow slowly."),
    (2, "Count seven", "blue whales."),
    (3, "Paint every", "wooden fence."),
    (4, "Count seven", "blue whales."),
]


def test_unrelated_short_rows_stay_and_copies_go(spark):
    kept = curate(_pairs(spark, SHORT), LOOSE, 10).selected
    assert {r["sample_id"] for r in kept.collect()} == {1, 2, 3}


def test_text_ids_are_deduplicated(spark):
    rows = [(f"row-{k}", ask, answer) for k, ask, answer in SHORT]
    kept = curate(_pairs(spark, rows, "sample_id string"), LOOSE, 10).selected
    assert {r["sample_id"] for r in kept.collect()} == {"row-1", "row-2", "row-3"}


def test_repeated_and_missing_ids_are_errors(spark):
    for rows in ([*SHORT, (1, "far", "away")], [*SHORT, (None, "far", "away")]):
        with pytest.raises(ValueError, match="unique"):
            curate(_pairs(spark, rows), LOOSE, 10)


def test_parquet_without_an_id(spark, tmp_path):
    _pairs(spark, SHORT).drop("sample_id").coalesce(1).write.parquet(str(tmp_path / "in"))
    result = Curator(spark, "llama_3_1_base").optimize(
        str(tmp_path / "in"), str(tmp_path / "out"), fmt="parquet", top_k=3, skip_deduplication=True
    )
    assert result.report.first()["original_size"] == 4


def test_encoder_names_warn():
    with pytest.warns(UserWarning, match="neural encoder"):
        load_config("llama_3_2_instruct").with_dedup(method="sentence_transformer")


def test_rejected_rows_go_before_the_shuffle(spark):
    from gleaner.operators.bitmap import MOST_BITS, bitmap_bits, keep_ids, may_match

    turns = spark.range(20_000).select(F.when(F.col("id") % 50 != 49, F.col("id") % 5000).alias("conv_id"), F.lit("t").alias("text"), F.lit("x").alias("_word"))
    ids = spark.range(300).select((F.col("id") * 16).alias("conv_id"))
    want = turns.filter("conv_id % 16 = 0 and conv_id < 4800").count()
    for few in (0, 1_000):
        kept = keep_ids(turns, ids, "conv_id", 300, broadcast_ids=few)
        assert kept.count() == want and kept.columns == turns.columns
    passed = may_match(turns, ids, "conv_id", 300)
    assert want <= passed.count() < want + 0.12 * 20_000
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    named = turns.select(F.concat(F.lit("c"), "conv_id").alias("conv_id"))
    assert keep_ids(named, ids.select(F.concat(F.lit("c"), "conv_id").alias("conv_id")), "conv_id", 300, 0).count() == want
    assert keep_ids(turns, ids.limit(0), "conv_id", 0, 0).count() == 0 and keep_ids(turns, ids.limit(0), "conv_id", 0).count() == 0
    assert bitmap_bits(0) == bitmap_bits(1) == 64 and bitmap_bits(10**12) == MOST_BITS


def test_a_path_run_may_clean_up(spark, tmp_path):
    from gleaner.stage import stage_folder, written

    lines = [
        json.dumps({"instruction": f"Question {k} about several things?", "output": f"An answer number {k} with words"})
        for k in range(12)
    ]
    path = tmp_path / "rows.jsonl"
    path.write_text("\n".join([*lines, "not json"]) + "\n")
    config = tmp_path / "loose.yaml"
    raw = dict(PRESETS["llama_3_2_instruct"])
    raw["quality_filters"] = raw["quality_filters"] | {"min_tokens_per_turn": 1, "min_total_tokens": 1, "balanced_conversation_ratio": 1.0}
    config.write_text(json.dumps(raw))
    shape = spark.createDataFrame([], "instruction string, output string").schema
    before = written()
    result = Curator(spark, str(config)).optimize(
        str(path), str(tmp_path / "out"), top_k=5, skip_deduplication=True, lenient=True, clean=True, schema=shape
    )
    assert written() == before
    assert result.selected.count() == 5 and result.report.first()["original_size"] == 12
    assert [r[0] for r in spark.read.text(str(tmp_path / "out" / "rejected_lines")).collect()] == ["not json"]
    yaml_lines = [r[0] for r in spark.read.text(str(tmp_path / "out" / "report_yaml")).collect()]
    assert "original_size: 12" in yaml_lines
    assert stage_folder(spark)


def test_copies_are_matched_by_id_and_text(spark):
    from gleaner.operators.neighbors import collapse_copies

    rows = [(None, "only here"), (0, "b"), (1, "a"), (1, "b"), (None, "A "), (2, None), (3, ""), (None, "Only  Here")]
    frame = spark.createDataFrame(rows, "id long, text string")
    got = sorted(map(str, (tuple(r) for r in collapse_copies(frame, "id", "text").collect())))
    want = [(None, "only here"), (0, "b"), (1, "a"), (2, None), (None, "Only  Here")]
    assert got == sorted(map(str, want))
