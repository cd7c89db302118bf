"""Contiguous shards of nearly equal size (native: DataFrame functions only).

Rows are range-partitioned by id and stored, each partition reports its bytes and rows, and prefix sums over these
few totals give every partition the bytes and rows before it. A running sum inside the partition then places each
row on the global byte axis, which is cut at equal targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carepanel.llm.shared import stored


def balanced_shards(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with ``shard`` (0 to n_shards - 1, contiguous in ascending id) and ``slot`` (gapless from 0).

    A row's size is the UTF-8 length of its text plus 1; it goes to the shard that holds the middle of its byte range,
    so that a shard differs from the equal target by one row's size at most.
    Returned: id, size, text_crc32 (unsigned, of the UTF-8 bytes), law, shard, slot, grown_shard (null under this law).

    Null or empty text: size 1, crc32 0. Null ids come first. Rows that repeat an id are all kept, in any order among
    themselves, and never have to meet in one task. An empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    ranged = stored(sized.repartitionByRange("id", "tie").withColumn("part", F.spark_partition_id()), "sized")

    # one row per partition: the window and the broadcast are bounded by the number of partitions
    totals = ranged.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0)).alias("bytes_base"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("rows_base"),
        F.sum("part_bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy("id", "tie")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.withColumn("end", F.sum("size").over(running))
        .withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(bases), "part")
        .withColumn("middle", 2 * (F.col("bytes_base") + F.col("end")) - F.col("size"))
        .select(
            "id",
            "size",
            "text_crc32",
            F.expr(f"(middle * {n_shards}) div (2 * all_bytes)").cast("int").alias("shard"),
            (F.col("rows_base") + F.col("place")).alias("row_index"),
        )
    )
    placed = stored(placed, "placed")
    first = placed.groupBy("shard").agg(F.min("row_index").alias("first_row"))  # n_shards rows at most
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row_index") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
