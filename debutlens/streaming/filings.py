"""Landed filing pages as a stream: each new file's equity filings are stored once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import append_new, filings

ROW = "rcept_no string, corp_code string, corp_name string, report_nm string, rcept_dt string, html string"


def stream_filings(spark: SparkSession, path: str, *, field: str = "list", files_per_batch: int = 1000) -> DataFrame:
    """Equity filings of the JSON pages that arrive below `path`."""
    pages = spark.readStream.schema(f"{field} array<struct<{ROW}>>").option("multiLine", True).option("maxFilesPerTrigger", files_per_batch).json(path)
    return filings(pages.select(F.inline(field)))


def store_filings(stream: DataFrame, path: str, checkpoint: str, *, key: str = "rcept_no") -> StreamingQuery:
    """Appends to the table at `path` what it doesn't hold yet, then stops when all landed files are read.

    Within a batch, rows that repeat a key count once. A batch that is run again after a failure finds its own
    rows stored and adds none. Rows without a key can't be told apart and are left out.
    """

    def add(batch: DataFrame, _: int) -> None:
        append_new(batch.filter(F.col(key).isNotNull()).dropDuplicates([key]), path, key)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
