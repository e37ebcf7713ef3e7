"""Sinks: training records as JSON lines (nulls written), and a one-row report."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_records(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
