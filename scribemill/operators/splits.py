"""Splits: by ratio, and by groups."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASSES = 4096


def ratio_split(rows: DataFrame, key: str, train: float = 0.8, test: float = 0.1, seed: int = 42) -> DataFrame:
    """Adds split: exact numbers of rows (half to even; validation has the rest), in the order of an md5 of the key.

    Global ranks come from counts of md5 classes; rows are put in order within a class, so no task holds all rows.
    """
    from pyspark.sql import Window

    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    rows = rows.withColumns({"__h": digest, "__class": F.substring(digest, 1, 3)})
    counts = rows.groupBy("__class").agg(F.count("*").alias("__n"))
    upto = F.sum("__n").over(Window.orderBy("__class").rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.select("__class", (upto - F.col("__n")).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias("__all"))
    place = F.row_number().over(Window.partitionBy("__class").orderBy("__h", key))
    out = rows.join(F.broadcast(counts), "__class").withColumn("__place", F.col("__before") + place)
    a, b = F.bround(F.col("__all") * train), F.bround(F.col("__all") * test)
    split = F.when(F.col("__place") <= a, "train").when(F.col("__place") <= a + b, "test").otherwise("validation")
    return out.withColumn("split", split).drop("__h", "__class", "__before", "__all", "__place")


def greedy_group_split(groups: DataFrame, order: str, size: str = "n", validation: float = 0.02, test: float = 0.04) -> DataFrame:
    """Adds split to a table of groups, one row each, in order: a group goes to validation while the rows taken with it
    are under the first share of all rows, else to test while under the second, else to train, which takes none.

    The sum of sizes and the fold are over the groups, not their rows; the table of groups meets in one task.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0

    def fold(batches):
        table = pd.concat(list(batches) or [pd.DataFrame()])
        if not len(table):
            return
        table = table.sort_values(order, kind="stable")
        taken, out = 0, []
        for n in table[size]:
            name = next((x for x, share in (("validation", validation), ("test", test)) if taken + n < share * total), "train")
            taken += n if name != "train" else 0
            out.append(name)
        yield table.assign(split=out)

    from pyspark.sql.types import StringType, StructField, StructType

    return groups.coalesce(1).mapInPandas(fold, StructType([*groups.schema.fields, StructField("split", StringType())]))
