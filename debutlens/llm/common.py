"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import discard, scratch, shared_dir, stored

__all__ = ["BROADCAST_ROWS", "discard", "numbered", "scratch", "shared_dir", "small_side", "stored", "text_bytes"]

#: The largest side, in rows, that is broadcast; beyond it the same join shuffles both sides.
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marks `df` for broadcast if its counted rows (or values, where rows hold arrays) are within `most`, else leaves it
    to a shuffled join."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= most else df


def numbered(docs: DataFrame) -> DataFrame:
    """row (struct of all columns, whatever their names) and place (the row's number), numbered once and stored.

    A number depends on how a scan is split, and so on the cores known at the time: whoever needs the rows again takes
    them from this table and never numbers the input a second time.
    """
    return stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place")), "numbered")


def text_bytes(col: str) -> "F.Column":
    return F.coalesce(F.octet_length(F.col(col)), F.lit(0)).cast("long")
