"""Sharding by bytes: contiguous shards of nearly equal size, without a global sort task.

The rows are range-partitioned on ``doc_id`` (only id, size and checksum move, never the
text). Each range partition's byte and row totals give, by a prefix sum over as many rows as
there are partitions, the global offset of its first row; a running sum inside the partition
completes it. A row goes to the shard in which the middle of its bytes falls when the whole
byte range is cut at equal targets, so every shard's size is within one row of the target.

Defined cases: a null text has size 1 and the checksum of empty bytes; rows with a null
``doc_id`` come first; rows with equal ids are ordered by text hash, then by input position;
an empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrosense.llm.common import stored

RANGES_PER_SHUFFLE_PARTITION = 4


def byte_shards(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.monotonically_increasing_id().alias("at"),
    )
    n = RANGES_PER_SHUFFLE_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "h", "at"]
    ranged = stored(rows.repartitionByRange(n, *order)
                    .withColumn("range_no", F.spark_partition_id()), "shard-ranges")

    # One row per range partition, so these windows see n rows whatever the input.
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding,
                                                        Window.unboundedFollowing)
    offsets = (ranged.groupBy("range_no")
               .agg(F.sum("size").alias("range_size"), F.count(F.lit(1)).alias("range_rows"))
               .select("range_no",
                       F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("size_off"),
                       F.coalesce(F.sum("range_rows").over(before), F.lit(0)).alias("row_off"),
                       F.sum("range_size").over(everything).alias("total")))
    inside = Window.partitionBy("range_no").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    placed = (ranged
              .withColumn("in_size", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .withColumn("in_row", F.count(F.lit(1)).over(inside))
              .join(F.broadcast(offsets), "range_no")      # n rows: the range partitions
              .withColumn("start", F.col("size_off") + F.col("in_size"))
              .select("doc_id", "size", "text_crc32",
                      F.expr(f"cast(least({n_shards - 1}, ((2 * start + size) * {n_shards}) "
                             "div (2 * total)) as int)").alias("shard"),
                      (F.col("row_off") + F.col("in_row")).alias("row_no")))
    placed = stored(placed, "shard-rows")
    first = placed.groupBy("shard").agg(F.min("row_no").alias("first_row"))
    return (placed.join(F.broadcast(first), "shard")       # one row per shard
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("row_no") - F.col("first_row")).alias("slot")))


def write_shards(docs: DataFrame, path: str, n_shards: int = 8) -> None:
    """Write the rows of ``docs`` with their ``shard`` and ``slot``, one folder per shard.
    Rows with equal id and text are interchangeable, so a rank among them pairs them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(*[c for c in docs.columns if c not in ("shard", "slot")])
    keyed = docs.withColumns({"__size": F.octet_length(text) + F.lit(1),
                              "__crc": F.crc32(text.cast("binary"))})
    twins = Window.partitionBy("doc_id", "__size", "__crc").orderBy(F.xxhash64(text))
    placed = byte_shards(docs, n_shards).select(
        F.col("doc_id").alias("__id"), F.col("size").alias("__s"), F.col("text_crc32").alias("__c"),
        "shard", "slot")
    same = Window.partitionBy("__id", "__s", "__c").orderBy("slot")
    placed = placed.withColumn("__r", F.row_number().over(same))
    keyed = keyed.withColumn("__n", F.row_number().over(twins))
    out = keyed.join(placed, F.col("doc_id").eqNullSafe(F.col("__id"))
                     & (F.col("__size") == F.col("__s")) & (F.col("__crc") == F.col("__c"))
                     & (F.col("__n") == F.col("__r")))
    out.select(*docs.columns, "shard", "slot").write.partitionBy("shard").parquet(path)
