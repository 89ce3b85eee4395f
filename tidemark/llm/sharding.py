"""Shards of equal bytes by sampled splitters, in DataFrame operations only.

Rows are ordered by the hash of their text, so equal texts lie side by side, then by row.
A size-weighted sample of each range gives quantile boundaries that cut it into `FAN` ranges;
a range that still holds more than `RANGE_ROWS` rows is sampled and cut again, so no window
ever sees more rows than that, whatever one text's share is. Exact byte totals of the ranges
then place every row on one line of all bytes, and a row goes to the shard in which its middle
falls: shard sizes differ from the mean by one row at most.

Defined cases: the size of a row is the UTF-8 bytes of its text plus `ROW_BYTES`, so a null or
empty text has a size of `ROW_BYTES`; repeated rows and null ids are ordinary rows; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import drop_aside, materialize, read_aside, write_aside

SHARDS = 24
ROW_BYTES = 8
RANGE_ROWS = 100_000
FAN = 24
#: Expected draws for each boundary.
DRAWS = 64


def _boundaries(rows: DataFrame, sums: DataFrame, level: int) -> DataFrame:
    """(range, bounds): FAN - 1 boundaries of every range, from draws in proportion to size."""
    uniform = F.pmod(F.xxhash64("row", F.lit(level)), F.lit(1 << 32)) / F.lit(float(1 << 32))
    drawn = rows.join(sums.select("range", F.col("bytes").alias("range_bytes")), "range").withColumn(
        "times", F.floor(F.col("size") * FAN * DRAWS / F.col("range_bytes") + uniform).cast("int")
    )
    points = drawn.where("times > 0").select("range", F.explode(F.array_repeat(F.struct("key", "row"), F.col("times"))).alias("point"))
    # about FAN * DRAWS points of a range, whatever its size
    sample = points.groupBy("range").agg(F.array_sort(F.collect_list("point")).alias("points"))
    picks = F.transform(F.sequence(F.lit(1), F.lit(FAN - 1)), lambda i: F.get("points", (i * F.size("points") / FAN).cast("int")))
    return sample.select("range", picks.alias("bounds"))


def _ranged(rows: DataFrame, most: int) -> DataFrame:
    """`rows` with a `range` of at most `most` rows each, ranges in key order; written aside."""
    spark = rows.sparkSession
    rows = rows.withColumn("range", F.lit(0).cast("long"))
    schema = rows.schema
    path, level = write_aside(rows, "ranged"), 0
    while True:
        rows = read_aside(spark, path, schema)
        sums = rows.groupBy("range").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
        overfull = materialize(sums.where((F.col("rows") > most) | F.lit(level == 0)), "overfull")
        if overfull.isEmpty():
            return rows
        cut = rows.join(overfull.select("range"), "range", "left_semi")
        bounds = materialize(_boundaries(cut, overfull, level), "bounds")
        below = F.size(F.filter("bounds", lambda b: b <= F.struct("key", "row")))
        # ranges that are not cut have no bounds and keep their place in the order
        deeper = F.col("range") * FAN + F.when(F.col("bounds").isNull(), 0).otherwise(below)
        new_path = write_aside(rows.join(bounds, "range", "left").withColumn("range", deeper).select(*schema.names), "ranged")
        drop_aside(spark, path)
        path, level = new_path, level + 1


def assign_shards(docs: DataFrame, shards: int = SHARDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Shard sizes are near equal (law ``bytes``), slots count a shard's rows from 0 in key order.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = _ranged(rows, range_rows)

    # one row per range: about rows / RANGE_ROWS of them, at least FAN
    line = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("range").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    starts = sums.select(
        "range",
        F.coalesce(F.sum("rows").over(line), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("bytes").over(line), F.lit(0)).alias("bytes_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("range").orderBy("key", "row")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.select(
        "*",
        F.row_number().over(inside).alias("number"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("bytes_in"),
    ).join(starts, "range")
    middle = F.col("bytes_before") + F.col("bytes_in") + F.expr("size div 2")
    placed = materialize(
        numbered.select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.floor(middle / F.col("total") * shards), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("number") - 1).alias("place"),
        ),
        "placed",
    )
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
