"""Readers: JSON lines, any Spark format, catalog tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.sources.normalize import MESSAGES, alpaca_messages, canonical_messages, detect_format, to_messages
from gleaner.stage import staged

RECORD = T.StructType(
    [
        T.StructField("messages", MESSAGES),
        T.StructField("instruction", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)
CORRUPT = "_corrupt_record"
BROADCAST_SPLITS = 1_000_000


def _schema(spark: SparkSession, path: str, mode: str, given: T.StructType | None) -> T.StructType:
    """The given schema, or the columns that occur anywhere in the data."""
    found = given or spark.read.option("mode", mode).json(path).schema
    return T.StructType([f for f in found.fields if f.name != CORRUPT])


def _check_name(schema: T.StructType, id_col: str | None) -> None:
    if id_col is None and "sample_id" in schema.names:
        raise ValueError("the data has a sample_id column: name it as id_col, or rename it")


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    id_col: str | None = None,
) -> DataFrame:
    """JSON lines to ``messages`` rows. A line that is not JSON stops the job.

    Without ``id_col`` every row gets ``sample_id``, its position in file order. The layout follows
    from the columns found anywhere in the data; a ``schema`` (such as ``RECORD``) saves that pass.
    """
    fixed = _schema(spark, path, "FAILFAST", schema)
    _check_name(fixed, id_col)
    raw = spark.read.schema(fixed).option("mode", "FAILFAST").json(path)
    detect_format(fixed)
    return to_messages(raw if id_col else with_positions(raw), id_col or "sample_id")


def read_jsonl_lenient(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    id_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Like ``read_jsonl``, with lines that do not parse set apart as the second result."""
    fixed = _schema(spark, path, "PERMISSIVE", schema)
    detect_format(fixed)
    _check_name(fixed, id_col)
    wide = T.StructType([*fixed.fields, T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(wide).option("mode", "PERMISSIVE").json(path)
    # Spark refuses to read the corrupt column alone from raw JSON, so both results use one copy.
    held = staged(raw if id_col else with_positions(raw), "jsonl")
    good = held.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = held.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return to_messages(good, id_col or "sample_id"), bad


def read_dataset(
    spark: SparkSession,
    source: str,
    fmt: str | None = None,
    split: str | None = "train",
    split_col: str = "split",
    id_col: str | None = None,
    number: bool = False,
    **options: str,
) -> DataFrame:
    """A path in any Spark format, or a catalog table when no format is given.

    Where the data has a split column, only the rows of ``split`` are read. ``number`` gives every row
    of a file source ``sample_id``, its position over all splits.
    """
    raw = spark.read.options(**options).format(fmt).load(source) if fmt else spark.table(source)
    if number:
        _check_name(raw.schema, id_col)
        raw, id_col = with_positions(raw), "sample_id"
    if split is not None and split_col in raw.columns:
        raw = raw.filter(F.col(split_col) == split)
    return to_messages(raw, id_col)


def parse_records(df: DataFrame, text: str, schema: T.StructType = RECORD) -> DataFrame:
    """JSON records held in a string column; the record's fields replace the column."""
    others = [c for c in df.columns if c != text]
    parsed = df.withColumn("_r", F.from_json(text, schema, {"mode": "FAILFAST"}))
    return parsed.select(*others, "_r.*")


def with_positions(df: DataFrame, out: str = "sample_id") -> DataFrame:
    """Add each row's position in file order to a frame read straight from files.

    Nothing but a few numbers per file or split is written: Parquet files know the index of a row, so one
    offset per file is enough; for other files, rows are counted per split. The positions are a
    property of the files, so they are the same however often a task runs.
    """
    try:
        indexed = df.select("*", F.col("_metadata.row_index").alias("_index"), F.xxhash64("_metadata.file_path").alias("_path"))
    except AnalysisException:
        return _positions_by_split(df, out)
    files = df.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    # One small row per file.
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift")
    offsets = staged(files.select(F.xxhash64("_file").alias("_path"), shift), "files")
    return _placed(indexed, offsets, ["_path"], F.col("_index"), df.columns, out)


def _placed(
    rows: DataFrame, offsets: DataFrame, key: list[str], index: Column, columns: list[str], out: str
) -> DataFrame:
    small = offsets.count() <= BROADCAST_SPLITS
    joined = rows.join(F.broadcast(offsets) if small else offsets, key, "left")
    changed = F.raise_error(F.lit("the files, or how they are split, changed while they were read")).cast("bigint")
    return joined.select(F.coalesce(F.col("_shift") + index, changed).alias(out), *columns)


def _positions_by_split(df: DataFrame, out: str) -> DataFrame:
    """Positions from the place of a row in its scan task, less the rows of the splits before its own there.

    Both scans split the files alike as long as the session's settings and cores stay; a split that was not
    counted stops the job.
    """
    tagged = df.select(
        "*",
        F.monotonically_increasing_id().alias("_seen"),
        F.xxhash64("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
    ).withColumn("_task", F.shiftright("_seen", 33))
    # With no column asked for, a reader may count lines that give no row.
    read = F.count(F.col(f"`{df.columns[0]}`")).alias("_read")
    counted = df.select(
        F.col(f"`{df.columns[0]}`"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_seen"),
    ).withColumn("_task", F.shiftright("_seen", 33))
    splits = counted.groupBy("_task", "_file", "_start").agg(
        F.min("_seen").alias("_first"), F.count(F.lit(1)).alias("_rows"), read
    )
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    # Four numbers per split; only an extreme number of splits goes through a shuffle.
    offsets = splits.select("_task", F.xxhash64("_file").alias("_path"), "_start", shift.alias("_shift"), "_read")
    offsets = staged(offsets, "splits").drop("_read")
    return _placed(tagged, offsets, ["_task", "_path", "_start"], F.col("_seen"), df.columns, out)


def parsed_lines(
    spark: SparkSession, path: str, id_col: str | None = None, id_type: str = "bigint"
) -> DataFrame:
    """JSON lines to the id, ``messages`` and ``_corrupt_record``, in one scan that parses each line once.

    The layout follows from the keys of each line: a ``messages`` list, else ``instruction`` (and
    ``input``) with ``output`` or ``response``. A line that is not JSON, or has neither, keeps its text in
    ``_corrupt_record`` and null messages. Empty lines are skipped. The id is the value of ``id_col`` as
    ``id_type`` (null if it is none), or the line's position.
    """
    lines = spark.read.text(path)
    if id_col is None:
        lines = with_positions(lines)
    record = lines.filter(F.trim("value") != "").withColumn("_v", F.try_parse_json("value"))

    def field(name: str, kind: str = "string") -> Column:
        return F.try_variant_get("_v", f"$.{name}", kind)

    answer = F.coalesce(field("output"), field("response"))
    question = field("instruction")
    listed = field("messages", "array<struct<role:string,content:string>>")
    pair = F.when(question.isNotNull() & answer.isNotNull(), alpaca_messages(question, field("input"), answer))
    messages = F.coalesce(canonical_messages(listed), pair)
    key = field(id_col, id_type).alias(id_col) if id_col else F.col("sample_id")
    built = record.select(key, messages.alias("messages"), "value")
    return built.select(
        id_col or "sample_id", "messages", F.when(F.col("messages").isNull(), F.col("value")).alias(CORRUPT)
    )
