"""Keys: first row per key, and dense surrogate ids in a total order.

``dense_ids`` replaces ``ROW_NUMBER() OVER (ORDER BY ...)`` without pulling
every row into one partition:

1. range-partition on the order, sort inside each partition, and tag each row
   with its partition index and its position inside the partition;
2. write that table (the lineage is cut there, so a lost executor re-reads
   files instead of re-running the ranged shuffle with different splits);
3. count rows per partition (one tiny aggregate over one column), turn the
   counts into cumulative offsets (one row per partition — bounded by the
   partition count, so broadcasting them is safe);
4. id = offset of the partition + position + 1.

``registered_ids`` keeps ids over rebuilds: known keys have theirs, new keys are
found by an anti-join and numbered from the greatest known id, in order.

Range partitioning samples the order columns, so a heavy value in one leading
column is still split across partitions as long as the full order is total.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.session import conf_int

PART, SEQ = "_part", "_seq"

# Input bytes (on-disk size of the scans feeding the table) per range
# partition, so the partition count — and the written file count — grows with
# the data instead of staying at the shuffle-partition setting.
RANGE_BYTES_KEY = "encore.range.inputBytesPerPartition"
RANGE_BYTES_DEFAULT = 32 * 1024 * 1024
# Plays per range partition once they are written and so known: columnar input may hold
# several millions in RANGE_BYTES. So many are sorted in memory, without spilling.
RANGE_ROWS = 400_000
# Spark's size of a leaf without an estimate, and what a row of one counts as
UNKNOWN_BYTES = 2 ** 63 - 1
ROW_BYTES = 256


def input_bytes(df: DataFrame) -> int:
    """Sum of the size estimates of the plan's leaves (file scans, local data).

    Join-size estimates without statistics are products of the inputs, so the
    leaves are the meaningful measure of how much data the table comes from.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    if max(sizes, default=0) >= UNKNOWN_BYTES:  # data that Spark can't estimate is counted
        return df.count() * ROW_BYTES
    return sum(sizes)


def cores(spark) -> int:
    return max(int(spark.sparkContext.defaultParallelism), 1)


def range_partitions(df: DataFrame) -> int:
    """ceil(input bytes / target), at least one partition per core."""
    spark = df.sparkSession
    target = max(conf_int(spark, RANGE_BYTES_KEY, RANGE_BYTES_DEFAULT), 1)
    by_size = -(-input_bytes(df) // target)
    return int(max(cores(spark), by_size))


def partitions_of(written: DataFrame, partitions: int) -> int:
    """``partitions``, or more where a written table has over ``RANGE_ROWS`` rows for each."""
    return max(partitions, -(-written.count() // RANGE_ROWS))


@contextmanager
def sized_shuffles(spark, partitions: int):
    """Shuffles inside take at least ``partitions`` (AQE merges small ones, but
    never adds any); the session's own setting is put back after."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), partitions)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _order_exprs(order: list) -> list[Column]:
    return [o if isinstance(o, Column) else F.col(o).asc_nulls_last() for o in order]


def write_ranged(df: DataFrame, order: list, path: str, num_partitions: int | None = None,
                 partition_by: list[str] | None = None, within: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Steps 1-2: write ``df`` range-partitioned and sorted, tagged with position.

    Without an explicit count, one range partition per core (dimensions). With
    ``partition_by`` the files lie in folders by these columns, each in order.
    ``within`` is applied to the ranges before they are sorted: rows equal in ``order``
    share one, so grouping by these columns needs no shuffle of its own."""
    spark = df.sparkSession
    n = num_partitions or cores(spark)
    exprs = _order_exprs(order)
    pid = F.spark_partition_id()
    ranges = df.repartitionByRange(n, *exprs)
    tagged = ((within(ranges) if within else ranges)
                .sortWithinPartitions(*exprs)
                .withColumn(PART, pid)
                .withColumn(SEQ, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)))
    if partition_by:  # as the writer wants it: else it would sort by the folders alone, and lose the order in them
        tagged = tagged.sortWithinPartitions(*partition_by, SEQ)
    tagged.write.mode("overwrite").parquet(path, partitionBy=partition_by, compression="zstd")
    return spark.read.schema(tagged.schema).parquet(path).select(*tagged.columns)


def partition_offsets(ranged: DataFrame) -> DataFrame:
    """Step 3: first id - 1 of each range partition (one row per partition)."""
    counts = ranged.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_base"))


def attach_ids(ranged: DataFrame, id_col: str, offsets: DataFrame | None = None, keep_part: bool = False) -> DataFrame:
    """Step 4: dense 1-based id from the stored partition tag and position."""
    offsets = partition_offsets(ranged) if offsets is None else offsets
    return (ranged.join(F.broadcast(offsets), PART)
                  .withColumn(id_col, F.col("_base") + F.col(SEQ) + F.lit(1))
                  .drop(*([] if keep_part else [PART]), SEQ, "_base"))


def dense_ids(df: DataFrame, order: list, id_col: str, path: str,
              num_partitions: int | None = None) -> DataFrame:
    return attach_ids(write_ranged(df, order, path, num_partitions), id_col)


def registered_ids(df: DataFrame, key: list[str], order: list, id_col: str, path: str, known: DataFrame | None,
                   num_partitions: int | None = None, last: int | None = None) -> DataFrame:
    """``df`` (one row per ``key``, NULLs are a key) with ids that outlast rebuilds.

    ``known`` holds the keys numbered before, with their ids; ``last`` is the greatest
    id ever given where ``known`` may lack it. Without ``known`` the ids are
    ``dense_ids``. Only the new rows are range-partitioned and written."""
    if known is None:
        return dense_ids(df, order, id_col, path, num_partitions)
    names = [c for c in df.columns if c != id_col]
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"k.{c}")) for c in key]
    met = df.alias("d").join(known.select(*key, id_col).alias("k"), same, "left")
    met = met.select(*[F.col(f"d.{c}").alias(c) for c in names], F.col(f"k.{id_col}").alias(id_col))
    greatest = known.agg(F.coalesce(F.max(id_col), F.lit(0).cast("long"))).scalar() if last is None else F.lit(last)
    new = dense_ids(met.where(F.col(id_col).isNull()).drop(id_col), order, id_col, path, num_partitions)
    return met.where(F.col(id_col).isNotNull()).unionByName(new.withColumn(id_col, F.col(id_col) + greatest))


def registry(known: DataFrame | None, ided: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """Every key ever numbered: those known, and the new ones of ``ided``."""
    now = ided.select(*key, id_col)
    if known is None:
        return now
    last = known.agg(F.coalesce(F.max(id_col), F.lit(0).cast("long"))).scalar()
    return known.select(*key, id_col).unionByName(now.where(F.col(id_col) > last))


def first_per_key(df: DataFrame, key: str, order: list[str], carry: list[str]) -> DataFrame:
    """One row per ``key``: the smallest by ``order`` (NULLs last), total by ``carry``.

    The distinct rows come first (a hash aggregate that collapses a key's repeats
    map-side); only those meet the ``min`` over a struct, which Spark sorts for.
    """
    fields = []
    for c in order + [c for c in carry if c not in order]:
        fields += [F.col(c).isNull().alias(f"_null_{c}"), F.col(c).alias(c)]
    best = F.min(F.struct(*fields)).alias("_best")
    keep = order + [c for c in carry if c not in order]
    return (df.select(key, *keep).distinct().groupBy(key).agg(best)
              .select(key, *[F.col(f"_best.{c}").alias(c) for c in keep]))
