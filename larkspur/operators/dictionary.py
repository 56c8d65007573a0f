"""Dictionary codes in a plan, for columns of any number of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def coded(df: DataFrame, column: str, code_col: str = "code", parts: int | None = None) -> DataFrame:
    """``df`` with the place of each row's value among the sorted distinct
    values; null has none.

    The distinct values are cut into ranges and numbered within theirs; a
    range's first place is the number of values in the ranges before.  No task
    sees more than a range, and one row holds the ranges' sizes."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(F.col(f"`{column}`").alias("__value")).where("__value IS NOT NULL").distinct()
    ranged = values.repartitionByRange(parts, "__value").withColumn("part", F.spark_partition_id())
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n")).agg(F.collect_list(F.struct("part", "n")).alias("sizes"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("__value")) - 1
    before = F.aggregate(F.filter("sizes", lambda s: s["part"] < F.col("part")), F.lit(0).cast("bigint"), lambda a, s: a + s["n"])
    codes = ranged.withColumn("within", within).crossJoin(F.broadcast(sizes)).select("__value", (before + F.col("within")).alias(code_col))
    return df.join(codes, F.col(f"`{column}`") == F.col("__value"), "left").drop("__value")
