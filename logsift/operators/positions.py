"""Global order positions without a single-partition window.

``with_position`` range-partitions and sorts the rows, checkpoints the
sorted frame to the shared checkpoint folder (so partition ids and the rows
in them are fixed even if executors are lost), counts rows per partition
(one small row per partition reaches the driver), and adds the partition's
offset to the row's index inside its partition.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.session import checkpoint_dir

_ROW_MASK = (1 << 33) - 1


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "pos",
                  num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based position in ``order`` (which must be a total order)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_rin", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))))
    frozen = part.checkpoint(eager=True)
    counts = sorted((r["_pid"], r["c"]) for r in frozen.groupBy("_pid").agg(F.count(F.lit(1)).alias("c")).collect())
    offsets, acc = {}, 0
    for pid, c in counts:
        offsets[pid] = acc
        acc += c
    if not offsets:
        return frozen.drop("_pid", "_rin").withColumn(name, F.lit(None).cast("long"))
    # an array is indexed directly, a map would be searched for every row
    starts = F.array(*[F.lit(offsets.get(p, 0)).cast("long") for p in range(max(offsets) + 1)])
    return (frozen.withColumn(name, (F.get(starts, F.col("_pid")) + F.col("_rin")).cast("long"))
            .drop("_pid", "_rin"))
