"""Row order and row numbers over a whole table, and joins on hot keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from foliant.session import written

#: Parts of a task's even share of rows that make a key hot.
SHARE = 4
#: Share of all rows that makes a key hot in any case; there can be no more hot keys than this.
HOT_KEYS = 50_000
IN_PARTITION = (1 << 33) - 1


def with_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """Number all rows 0, 1, 2, ... in the given total order.

    Range-partitioned and sorted, then written once so that the partition
    numbers cannot change; each partition starts where the ones before it end.
    Only one row per partition is ever brought together.
    """
    ordered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    stored = written(ordered, "ordered").withColumn("__part", F.shiftright("__at", 33))
    sizes = stored.groupBy("__part").agg(F.count("*").alias("__size"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    # One row per partition of the write, so the broadcast is bounded.
    joined = stored.join(F.broadcast(offsets), "__part")
    index = F.col("__offset") + F.col("__at").bitwiseAND(F.lit(IN_PARTITION))
    return joined.withColumn(name, index).drop("__part", "__at", "__offset")


def key_side(keys: DataFrame) -> DataFrame:
    """Distinct row keys, written so that a join with them knows their size.

    A short list is then broadcast from the start and the table joined with it
    is not shuffled at all; adaptive execution would find out only after the
    table's values are on their way. A list beyond the broadcast threshold is
    joined by key.
    """
    return written(keys.select("row_key").distinct(), "keys")


#: Intervals that a list of keys is merged into, at most.
INTERVALS = 32
#: Keys of a sample by which a cut is found, about.
SAMPLE = 1000


def key_intervals(keys: DataFrame) -> Column:
    """A test on row_key that all listed keys meet: at most ``INTERVALS`` ranges, for a file scan to prune by.

    The list is range-partitioned, whatever its size; one row per range reaches the driver.
    """
    parts = keys.select("row_key").repartitionByRange(INTERVALS, "row_key")
    found = parts.groupBy(F.spark_partition_id().alias("part")).agg(F.min("row_key").alias("low"), F.max("row_key").alias("high"))
    test = F.lit(False)
    for r in found.where("low is not null").collect():
        test = test | ((F.col("row_key") >= r["low"]) & (F.col("row_key") <= r["high"]))
    return test


def _smallest(n: int):
    """Each task's n smallest distinct keys."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.array([], pa.string())

        def least(keys: pa.Array) -> pa.Array:
            keys = pc.unique(keys)
            return keys.take(pc.sort_indices(keys))[:n]

        for batch in batches:
            new = pc.unique(batch.column(0))
            if len(held) == n:  # most keys are beyond what is held
                new = new.filter(pc.less(new, held[n - 1]))
            if len(new):
                held = least(pa.concat_arrays([held, new.cast(pa.string())]))
        for at in range(0, len(held), 10_000):
            yield pa.RecordBatch.from_arrays([held[at : at + 10_000]], ["row_key"])

    return smallest


def first_keys(table: DataFrame, n: int) -> DataFrame:
    """The n smallest distinct row keys of a table, written.

    Every task gives its n smallest keys, which is all that moves. The cut is then
    looked for by counts: the rank of a key in a sample of them tells where to count
    first, so that keys beyond it are never sorted. n decides nothing but where that is.
    """
    if n <= 0:
        return written(table.select("row_key").where(F.lit(False)), "keys")
    keys = table.select("row_key").where(F.col("row_key").isNotNull()).mapInArrow(_smallest(n), "row_key string")
    keys = written(keys.distinct(), "smallest")
    total = keys.count()
    if total <= n:
        return keys
    step = -(-total // SAMPLE)
    sample = sorted(r["row_key"].encode() for r in keys.where(F.pmod(F.xxhash64("row_key"), F.lit(step)) == 0).collect())
    at = n // step + n // (8 * step) + 8
    while at < len(sample):
        below = keys.where(F.col("row_key") <= sample[at].decode())
        if below.count() >= n:
            keys = below
            break
        at *= 2
    return written(with_index(keys, ["row_key"]).where(F.col("idx") < n).select("row_key"), "keys")


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner", is_written: bool = False) -> DataFrame:
    """Join on one key of which the left side may hold very many equal rows.

    right has one row per key. A key is hot if its rows would fill more than a
    quarter of a task's even share, or are more than one in ``HOT_KEYS`` of all rows;
    there can be at most four keys of the first kind per shuffle partition, and ``HOT_KEYS``
    of the second, so they and their right rows are broadcast, and the rows
    of hot keys stay where they are. The rest is joined by key. The left side is
    written first, unless it is: it is made once, and read for the counts and the two joins.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"the left side must be kept or filtered, not {how}")
    spark = left.sparkSession
    left = left if is_written else written(left, "left")
    most = max(SHARE * int(spark.conf.get("spark.sql.shuffle.partitions")), HOT_KEYS)
    counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    hot = F.broadcast(written(counts.where(F.col("__n") * most > left.count()).select(key), "hot"))
    # An inner join needs no test whether the key is hot: its right rows are those of hot keys.
    of_hot = left if how in ("inner", "left_semi") else left.join(hot, key, "left_semi")
    few = of_hot.join(F.broadcast(right.join(hot, key, "left_semi")), key, how)
    rest = left.join(hot, key, "left_anti").join(right, key, how)
    return few.unionByName(rest)


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated once per row, however often it is read.

    A generator over one element: the optimizer does not copy its expression
    into every later use, as it may with a plain projection.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def long_result(group: str | Column, counter: str | Column, n: Column) -> list[Column]:
    """The one shape of every counter table: (counter_group, counter, n)."""
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return [
        as_column(group).alias("counter_group"),
        as_column(counter).cast("string").alias("counter"),
        n.cast("bigint").alias("n"),
    ]


def counters(df: DataFrame, group: str, **conditions: Column) -> DataFrame:
    """How many rows meet each condition, one aggregate, as rows."""
    counted = df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    entry = F.explode(
        F.array(*[F.struct(F.lit(n).alias("counter"), F.col(n).alias("n")) for n in conditions])
    )
    return counted.select(entry.alias("e")).select(*long_result(group, F.col("e.counter"), F.col("e.n")))
