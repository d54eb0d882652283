"""Global shuffle into shards: a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets of bounded bytes by a seeded hash of their place in the
input; pass two Fisher-Yates shuffles each bucket in memory and writes it. The buckets laid end to end are
one random order; the shards are equal cuts of that order (law `rows`: counts at most one apart).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch, text_bytes


def write_shards(docs: DataFrame, n_shards: int, path: str, *, text_col: str = "text", seed: int = 20240229, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Writes `docs` in one random order as `n_shards` shards below `path` and returns them read back.

    Returns row (struct of all input columns, so that any names may occur in the input), slot long (place in
    the shard, gapless from 0) and shard int. The scatter key is the row's place in the input, never a column:
    repeated rows, equal texts, null ids and hot sources spread like any others. Null and empty texts are rows
    like the rest. A bucket holds about `bucket_bytes` of text (a longer single text makes its bucket longer).
    An empty input gives no rows. Input must be re-readable in the same order (files, or a stored table).
    """
    spark = docs.sparkSession
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(text_bytes(text_col) + 64)).first()
    n_buckets = max(1, math.ceil((size or 0) / bucket_bytes))
    place = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    keyed = docs.select(F.struct("*").alias("row"), place.alias("h")).withColumn("bucket", F.pmod("h", F.lit(n_buckets)))
    counts = docs.select(F.pmod(place, F.lit(n_buckets)).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket, not per document
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    parts = max(1, min(n_buckets * 2, int(spark.conf.get("spark.sql.shuffle.partitions")) * max(1, n_buckets // 64)))
    # The arrays are sorted, and rows of a partition too, so that the seeded shuffle repeats itself on a retry.
    held = keyed.repartition(parts, "bucket").groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("h", "row"))).alias("held"))
    mixed = held.join(offsets, "bucket").sortWithinPartitions("bucket").select("first", F.shuffle("held", F.lit(seed)).alias("held"))
    flat = mixed.select("first", F.posexplode("held").alias("pos", "x")).select((F.col("first") + F.col("pos")).alias("g"), F.col("x.row").alias("row"))
    n, s = F.lit(max(rows, 1)), F.lit(n_shards)
    shard = F.floor(F.col("g") * s / n) if rows * n_shards < 1 << 52 else F.floor(F.col("g").cast("decimal(38,0)") * s / n)
    exact = shard.cast("long")
    start = F.expr(f"(shard_long * {max(rows, 1)} + {n_shards - 1}) div {n_shards}")
    out = flat.withColumn("shard_long", exact).select("row", (F.col("g") - start).alias("slot"), F.col("shard_long").cast("int").alias("shard"))
    out.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def shard_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shards = write_shards(docs, 8, scratch(spark, "shards"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return shards.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
