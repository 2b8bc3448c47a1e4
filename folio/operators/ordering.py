"""Global row numbers that stay distributed.

``row_number() over (order by ...)`` without a partition runs in one task. Two ways around it:

* ``radix_row_number`` for a text key within ordered groups: the key is cut into stretches of characters, rows are counted by
  group and stretches, and a row's number is the sum of what comes before its group, before its stretches, and of its place among the
  rows that share them all. Every part is a function of the data alone, so it is a lazy plan that no retry can change,
  and a key of ten characters out of eleven has no window of more than 11**4 rows.
* ``global_row_number`` for any order: range-partition and sort, tag each row with its partition and position
  (``monotonically_increasing_id`` packs both), freeze that with a reliable checkpoint in the shared checkpoint folder
  (so a retry after executor loss sees the same partitions), and add the running offset of the partitions before it. Only
  the per-partition counts (one row per partition, bounded by the partition count) go through a single-task window and a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn") -> DataFrame:
    """Exact 1-based row numbers in ``order`` (which must be a total order)."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    frozen = ranged.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), 33)
    counts = frozen.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    cols = [c for c in df.columns]
    return (frozen.join(F.broadcast(offsets), pid == F.col("_pid"))
            .select(*cols, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)) + 1).alias(name)))


def radix_row_number(df: DataFrame, group: Column, key: str, widths: tuple[int, ...] = (4, 3), name: str = "rn") -> DataFrame:
    """1-based row numbers in the order of ``group`` (ascending, a bounded number of values) and then of the text ``key``.

    ``widths`` are the characters of each stretch; the last stretch is the rest of the key. Equal keys of a group are numbered
    in any order. No job runs until the result is used.
    """
    cuts = ["_r0"]
    marked = df.withColumn("_r0", group)
    at = 1
    for k, width in enumerate(widths, 1):
        marked = marked.withColumn(f"_r{k}", F.coalesce(F.substring(key, at, width), F.lit("")))
        cuts.append(f"_r{k}")
        at += width
    counts = marked.groupBy(*cuts).agg(F.count(F.lit(1)).alias("_n"))
    before = None  # for each level: rows before a stretch among those that share the stretches in front of it
    for k in range(len(cuts)):
        level = counts.groupBy(*cuts[:k + 1]).agg(F.sum("_n").alias("_n"))
        window = Window.partitionBy(*cuts[:k]).orderBy(cuts[k]).rowsBetween(Window.unboundedPreceding, -1)
        level = level.select(*cuts[:k + 1], F.coalesce(F.sum("_n").over(window), F.lit(0)).alias("_here"))
        if before is None:
            before = level.withColumnRenamed("_here", "_before")
        else:
            before = level.join(before, cuts[:k]).select(*cuts[:k + 1], (F.col("_before") + F.col("_here")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*cuts).orderBy(key))
    return (marked.withColumn("_inside", inside).join(before, cuts)
            .select(*df.columns, (F.col("_before") + F.col("_inside")).alias(name)))
