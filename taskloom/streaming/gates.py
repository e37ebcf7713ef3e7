"""A streaming twin of the text gate (an extension): candidates arrive as files, reasons leave as they are found."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.gates import text_reason


def gate_stream(spark: SparkSession, folder: str, schema: str = "doc_id long, text string, lang string, source string, n_chars long") -> DataFrame:
    docs = spark.readStream.schema(schema).parquet(folder)
    return docs.select("doc_id", text_reason(F.col("text"), F.lit("TYPE-A")).alias("reason"))
