import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gleaner.config import PRESETS, load_config
from gleaner.sources.normalize import assemble_turns, detect_format, to_messages
from gleaner.sources.readers import parse_records, parsed_lines, read_dataset, read_jsonl, read_jsonl_lenient, with_positions
from gleaner.sources.writers import report_yaml, write_jsonl, write_report

ALPACA = "instruction string, input string, output string, response string"


def contents(df):
    return [[m["content"] for m in row["messages"]] for row in df.collect()]


def test_instruction_rows(spark):
    rows = [("Q", None, "A", "B"), ("Q", "", "A", "B"), ("Q", "X", "A", "B")]
    df = to_messages(spark.createDataFrame(rows, ALPACA))
    assert df.columns == ["messages"]
    assert contents(df) == [["Q", "A"], ["Q", "A"], ["Q\nX", "A"]]
    assert [m["role"] for m in df.first()["messages"]] == ["user", "assistant"]


def test_response_column(spark):
    df = spark.createDataFrame([(1, "Q", "A")], "k long, instruction string, response string")
    out = to_messages(df, "k")
    assert out.columns == ["k", "messages"] and contents(out) == [["Q", "A"]]


def test_message_rows_keep_other_columns_and_field_order(spark):
    df = spark.createDataFrame(
        [([("hi", "user")], "I", "O", 7)],
        "messages array<struct<content string, role string>>, instruction string, output string, n int",
    )
    out = to_messages(df)
    assert out.columns == df.columns
    assert out.schema["messages"].dataType.elementType.names == ["role", "content"]
    assert contents(out) == [["hi"]]


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="unsupported"):
        detect_format(spark.createDataFrame([("x",)], "text string").schema)
    with pytest.raises(ValueError, match="unsupported"):
        detect_format(spark.createDataFrame([("x",)], "messages string").schema)


def test_jsonl_positions_follow_the_file(spark, tmp_path):
    path = tmp_path / "rows.jsonl"
    path.write_text(
        "".join(
            json.dumps({"instruction": f"Row {i} asks for a name.", "response": f"Name it item-{i}."})
            + "\n"
            for i in range(500)
        )
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_jsonl(spark, str(path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r["sample_id"] for r in rows) == list(range(500))
    for r in rows:
        assert r["messages"][0]["content"].startswith(f"Row {r['sample_id']} ")


@pytest.mark.parametrize("fmt", ["parquet", "json", "text", "csv"])
def test_positions_need_no_copy_of_the_rows(spark, tmp_path, monkeypatch, fmt):
    """Files of several splits and row groups; only numbers per file or split are written."""
    from gleaner.sources import readers

    written, real = [], readers.staged
    monkeypatch.setattr(readers, "staged", lambda df, label: written.append(df.columns) or real(df, label))
    path = str(tmp_path / "rows")
    rows = spark.range(0, 3000, 1, 3).select(F.format_string("row %05d %s", "id", F.repeat(F.lit("x"), 40)).alias("value"))
    rows.write.option("parquet.block.size", "8192").format(fmt).save(path)
    (tmp_path / "rows" / "zz-last.csv").write_text("") if fmt == "csv" else None
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        scan = spark.read.schema("value string").format(fmt).load(path)
        placed = with_positions(scan)
        got = {r["sample_id"]: r["value"][:9] for r in placed.filter("value > 'row 01'").collect()}
        every = placed.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {k: f"row {k:05d}" for k in range(1000, 3000)} and every == 3000
    assert all("value" not in columns for columns in written) and written


def test_positions_stop_if_the_splits_change(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 3000, 1, 2).select(F.format_string("row %05d", "id").alias("value")).write.text(path)
    placed = with_positions(spark.read.text(path))
    assert placed.select(F.max("sample_id")).first()[0] == 2999
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        with pytest.raises((PySparkException, Py4JJavaError), match="changed"):
            with_positions_again = placed.select("*", F.lit(1).alias("one"))
            with_positions_again.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_each_line_is_parsed_once_by_its_own_keys(spark, tmp_path):
    path = tmp_path / "mixed.jsonl"
    lines = [
        '{"id": 1, "instruction": "Q", "output": "A", "response": "no"}', '{"id": 2, "instruction": "Q", "input": "X", "response": "B"}',
        '{"id": 3, "messages": [{"role": "user", "content": "hi"}], "instruction": "I", "output": "O"}', "not json", "",
        '{"id": 4, "text": "x"}', '{"id": 5, "messages": "none"}', '{"id": "six", "instruction": "Q", "output": ""}', "[1, 2]", "   ",
    ]
    path.write_text("\n".join(lines) + "\n")
    rows = parsed_lines(spark, str(path), id_col="id").collect()
    good = {r["id"]: [m["content"] for m in r["messages"]] for r in rows if r["messages"] is not None}
    assert good == {1: ["Q", "A"], 2: ["Q\nX", "B"], 3: ["hi"], None: ["Q", ""]}
    assert {r["_corrupt_record"] for r in rows if r["messages"] is None} == {"not json", lines[5], lines[6], "[1, 2]"}
    numbered = parsed_lines(spark, str(path))
    assert {r["sample_id"] for r in numbered.filter("messages is null").collect()} == {3, 5, 6, 8}
    plan = parsed_lines(spark, str(path), id_col="id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_columns_that_appear_late_in_a_file(spark, tmp_path):
    path = tmp_path / "late.jsonl"
    lines = ['{"instruction":"Q","output":"A"}'] * 3000 + ['{"instruction":"Q","input":"X","output":"B"}']
    path.write_text("\n".join(lines) + "\n")
    rows = read_jsonl(spark, str(path))
    assert contents(rows.filter("sample_id = 3000")) == [["Q\nX", "B"]]
    assert contents(rows.filter("sample_id = 0")) == [["Q", "A"]]


def test_conversation_lines(spark, tmp_path):
    path = tmp_path / "talk.jsonl"
    path.write_text(
        '{"messages":[{"content":"hi","role":"user"}],"instruction":"I","output":"O","n":5}\n'
        '{"n":6,"messages":[{"role":"user","content":"there"}]}\n'
    )
    rows = read_jsonl(spark, str(path))
    assert set(rows.columns) == {"sample_id", "messages", "instruction", "output", "n"}
    assert [m[0] for m in contents(rows.orderBy("sample_id"))] == ["hi", "there"]
    named = read_jsonl(spark, str(path), id_col="n")
    assert {r["n"]: r["messages"][0]["content"] for r in named.collect()} == {5: "hi", 6: "there"}
    other = tmp_path / "other.jsonl"
    other.write_text('{"text":"x"}\n')
    with pytest.raises(ValueError, match="unsupported"):
        read_jsonl(spark, str(other))


def test_bad_line_stops_or_is_set_apart(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"instruction":"Q","output":"A"}\nnot json\n{"instruction":"R","output":"B"}\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_jsonl(spark, str(path)).collect()
    good, bad = read_jsonl_lenient(spark, str(path))
    assert sorted(c[0] for c in contents(good)) == ["Q", "R"]
    assert [r[0] for r in bad.collect()] == ["not json"]


def test_named_split(spark, tmp_path):
    df = spark.createDataFrame(
        [("train", "Q", "A"), ("test", "R", "B")], "split string, instruction string, output string"
    )
    path = str(tmp_path / "data")
    df.write.parquet(path)
    assert contents(read_dataset(spark, path, "parquet")) == [["Q", "A"]]
    assert contents(read_dataset(spark, path, "parquet", split="test")) == [["R", "B"]]
    df.createOrReplaceTempView("splits")
    assert len(contents(read_dataset(spark, "splits", split=None))) == 2


def test_records_in_a_text_column(spark):
    df = spark.createDataFrame([(1, '{"instruction":"Q","output":"A"}')], "k long, line string")
    row = parse_records(df, "line").first()
    assert (row["k"], row["instruction"], row["output"], row["input"]) == (1, "Q", "A", None)


@pytest.mark.parametrize("turns", [range(5000), (1700000000, 1700009000)])
def test_a_conversation_is_one_row(spark, turns):
    rows = [(1, t, "user" if k % 2 == 0 else "assistant", f"m{t}") for k, t in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    whole = assemble_turns(df).collect()
    assert len(whole) == 1 and [m["content"] for m in whole[0]["messages"]] == [f"m{t}" for t in turns]


def test_presets_and_yaml(tmp_path):
    import yaml

    assert load_config("llama_3_2_instruct").quality_filters.max_turns == 10
    assert load_config("llama_3_2_instruct_optimized").deduplication.similarity_threshold == 0.92
    assert load_config("llama_3_1_base").quality_filters.refusal_patterns == ()
    raw = json.loads(json.dumps(PRESETS["llama_3_1_base"]))
    raw["deduplication"] |= {"method": "faiss-gpu", "embedding_model": "m"}
    raw["batch_sizes"] = {"scoring": 32}
    path = tmp_path / "mine.yaml"
    path.write_text(yaml.safe_dump(raw))
    mine = load_config(str(path))
    assert mine.quality_filters == load_config("llama_3_1_base").quality_filters
    assert mine.deduplication.method == "hashed"
    with pytest.raises(FileNotFoundError):
        load_config("test_config")
    raw["quality_filters"]["min_turn"] = 1
    path.write_text(yaml.safe_dump(raw))
    with pytest.raises(ValueError, match="min_turn"):
        load_config(str(path))


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    write_jsonl(df, str(tmp_path / "out"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"a":1,"b":null}']
    report = df.select(F.lit("x").alias("config_used"), F.struct(F.lit(1.5).alias("mean")).alias("s"), "b")
    write_report(report, str(tmp_path / "report"))
    assert json.loads(spark.read.text(str(tmp_path / "report")).first()[0]) == {
        "config_used": "x",
        "s": {"mean": 1.5},
    }
    assert report_yaml(report) == "config_used: x\ns:\n  mean: 1.5\n"
