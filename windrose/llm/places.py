"""Places of rows in a total order, for tables of any size and any skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrose.llm.common import materialise


def numbered(df: DataFrame, key: str, order: Sequence[Column], label: str) -> DataFrame:
    """``df`` with ``place`` (0, 1, ... within each key) and ``of`` (rows of the key).

    The table is range-partitioned by key, order and a row number, so a hot key,
    or one row repeated any number of times, spreads over partitions; it is
    written sorted with consecutive row numbers, and a table of one row per
    (key, partition) turns those into places.  Nulls come first; rows that are
    equal in key and order get places in the order they are read.
    """
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    by = [F.col(key).asc_nulls_first(), *order, F.col("_salt").asc()]
    rows = materialise(salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
                       .withColumn("_row", F.monotonically_increasing_id()), label)
    part = F.shiftright("_row", 33).alias("_part")
    # a struct of nulls equals another one, so rows of the null key meet in a plain join
    keyed = F.struct(key).alias("_key")
    pieces = rows.groupBy(keyed, part).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_key", "_part", (F.col("_first") - F.coalesce(F.sum("_n").over(ahead), F.lit(0))).alias("_zero"),
                           F.sum("_n").over(Window.partitionBy("_key")).alias("of"))
    return (rows.withColumns({"_key": keyed, "_part": part}).join(pieces, ["_key", "_part"])
            .withColumn("place", F.col("_row") - F.col("_zero")).drop("_key", "_part", "_row", "_zero"))
