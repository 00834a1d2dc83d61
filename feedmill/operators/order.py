"""Numbers of rows in an order, by ranges: no window holds more than a range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.runtime import cut


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Adds ``out``, the row's place from 0 in the order, by the counts of ranges."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    base = sizes.withColumn("__base", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).select("__part", "__base")
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return dealt.withColumn("__i", inside).join(F.broadcast(base), "__part").withColumn(out, (F.col("__base") + F.col("__i") - 1).cast("long")).drop("__part", "__i", "__base")
