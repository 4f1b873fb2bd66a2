"""Sinks: the selected rows and the run report."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A directory of JSON-lines part files. Fields without a value are written as null."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The one-row report as JSON; absent optional parts are left out."""
    report.coalesce(1).write.mode(mode).json(path)


def report_yaml(report: DataFrame) -> str:
    """The report as YAML text."""
    import yaml

    row = report.first().asDict(recursive=True)
    return yaml.safe_dump({k: v for k, v in row.items() if v is not None}, sort_keys=False)
