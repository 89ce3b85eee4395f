"""Tables of a SQL database over JDBC. The driver jar and the server are the user's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INSERT_ROWS = 100_000


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, low, high, partitions: int, **options
) -> DataFrame:
    """Read in parallel over ranges of ``column``; the bounds split the work, they filter nothing."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=low, upperBound=high)
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )


def write_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=INSERT_ROWS, **options).save()
