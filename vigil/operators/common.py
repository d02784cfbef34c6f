"""Shared building blocks: size-checked broadcast, top-k, skew-safe numbering."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import checkpoint_dir

# Largest estimated size of a table that may still be broadcast.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def _type_size(t: T.DataType) -> int:
    # the same per-type defaults Catalyst uses when it has no statistics
    if isinstance(t, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(t, (T.ShortType,)):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    if isinstance(t, T.StructType):
        return sum(_type_size(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _type_size(t.elementType)
    if isinstance(t, T.MapType):
        return _type_size(t.keyType) + _type_size(t.valueType)
    return 20   # strings, binary


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row (default size per type plus a row header)."""
    return 16 + sum(_type_size(f.dataType) for f in df.schema.fields)


def _has_variable_part(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_has_variable_part(f.dataType) for f in t.fields)
    return isinstance(t, (T.StringType, T.BinaryType, T.ArrayType, T.MapType))


def _measured_size(c: Column, t: T.DataType) -> Column:
    """Bytes of one value: lengths of strings and binaries, and what arrays,
    maps and structs hold; nulls count as empty."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        size = F.octet_length(c).cast("long")
    elif isinstance(t, T.ArrayType):
        if _has_variable_part(t.elementType):
            size = F.aggregate(c, F.lit(0).cast("long"),
                               lambda acc, x: acc + F.lit(8) + _measured_size(x, t.elementType))
        else:
            size = F.size(c).cast("long") * _type_size(t.elementType)
    elif isinstance(t, T.MapType):
        size = (_measured_size(F.map_keys(c), T.ArrayType(t.keyType))
                + _measured_size(F.map_values(c), T.ArrayType(t.valueType)))
    elif isinstance(t, T.StructType):
        size = F.lit(0).cast("long")
        for f in t.fields:
            size = size + _measured_size(c.getField(f.name), f.dataType)
    else:
        return F.lit(_type_size(t)).cast("long")
    return F.greatest(F.coalesce(size, F.lit(0).cast("long")), F.lit(0).cast("long"))


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if it measures at most ``max_bytes``.

    At most ``max_bytes`` / estimated row width rows, plus one, are read (a
    limit pushed into the scan).  Where columns vary in width (strings,
    arrays, maps), the bytes of those rows are summed as well; only the sizes
    leave the scan's tasks.  Beyond either bound the frame is returned
    unhinted, so the join falls back to a shuffle join that AQE can still
    split when a key is skewed.
    """
    max_rows = max(1, max_bytes // row_width(df))
    if not any(_has_variable_part(f.dataType) for f in df.schema.fields):
        return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
    columns = df.toDF(*[f"c{i}" for i in range(len(df.columns))])   # names may clash or hold dots
    width = F.lit(16).cast("long")
    for f in columns.schema.fields:
        width = width + _measured_size(F.col(f.name), f.dataType)
    read = (columns.select(width.alias("bytes")).limit(max_rows + 1)
            .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first())
    return F.broadcast(df) if read.n <= max_rows and read.bytes <= max_bytes else df


def unbounded(df: DataFrame) -> DataFrame:
    """Mark a data-sized side of a join: it is never broadcast on a size
    *estimate* (estimates of derived relations can be far too low); the join
    shuffles both sides, and AQE still splits skewed partitions."""
    return df.hint("merge")


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: later
    branches scan its columns instead of computing it again, and a lost
    executor costs the running tasks only.  The table stays until the folder
    is cleared."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a narrow input over the cluster before CPU-heavy per-row work.

    A text table stored as a few large row groups scans as a few tasks, and
    tokenising it would then run on a few cores.  When the scan has fewer
    partitions than the cluster's default parallelism, the rows are spread
    round-robin; a wide input (the normal case for a large table) is left as
    it is, so no shuffle is added at scale.  Only plain scans are looked at: the
    partitions of a frame with a shuffle are Spark's own (and would have to be
    computed to be counted).
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().executedPlan().nodeName() == "AdaptiveSparkPlan":
        return df
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def top_k(df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[Column],
          k: int, rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group under a total order.

    ``row_number() <= k`` lets Catalyst insert a partial window-group limit
    before the shuffle, so each map task sends at most ``k`` rows per group:
    a hot group never moves more than ``k x tasks`` rows to one reducer.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    if rank_col:
        return out.withColumnRenamed("__rn", rank_col).withColumn(rank_col, F.col(rank_col).cast("long"))
    return out.drop("__rn")


def number_rows(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                out_col: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by P order by O)``, skew-safe.

    A plain window sends a whole group to one task; a group holding a third of
    all rows would then sort in one task.  Instead:

    1. range-partition on ``P + O`` (a hot group spans many partitions) and
       sort within partitions;
    2. give each row its position inside its partition
       (``monotonically_increasing_id`` after the sort);
    3. count rows per (partition, group) -- a table of at most
       ``partitions + groups`` rows -- and turn the counts into offsets with a
       window over that small table;
    4. join the offsets back (broadcast, size-checked) and add.

    The partitioned, position-tagged rows are checkpointed once so that steps
    3 and 4 (and any retry) see the same partitions.

    ``P + O`` must be unique (a total order) for the result to be exact.
    """
    keys = list(partition_by) + list(order_by)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("__nr_mid", F.monotonically_increasing_id()))
    # Range bounds come from sampling, and positions from the physical
    # partitions: both must be read identically by the two branches below and
    # by any retry, so the tagged rows are written once to the shared
    # checkpoint folder (a reliable checkpoint, not a local one).
    checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    ranged = (ranged.withColumn("__nr_pid", F.shiftright(F.col("__nr_mid"), 33))
              .withColumn("__nr_pos", F.col("__nr_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = (ranged.groupBy("__nr_pid", *partition_by)
              .agg(F.min("__nr_pos").alias("__nr_first"), F.count(F.lit(1)).alias("__nr_n")))
    w = (Window.partitionBy(*partition_by) if partition_by else Window.partitionBy(F.lit(0))) \
        .orderBy("__nr_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__nr_off", F.coalesce(F.sum("__nr_n").over(w), F.lit(0))) \
        .drop("__nr_n")
    joined = ranged.join(bounded_broadcast(offsets), ["__nr_pid", *partition_by])
    return (joined.withColumn(out_col, (F.col("__nr_off") + F.col("__nr_pos") - F.col("__nr_first") + 1).cast("long"))
            .drop("__nr_mid", "__nr_pid", "__nr_pos", "__nr_first", "__nr_off"))
