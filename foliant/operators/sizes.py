"""Size distributions of rows and cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.operators.rows import long_result
from foliant.operators.scan import column_is, row_sizes

KIB, MIB = 1 << 10, 1 << 20

# Bins by upper bound, first match wins; beyond them "BIG".
UPPER_BINS = (
    [(KIB, "1 K"), (10 * KIB, "10 K")]
    + [(n * KIB, f"{n} K") for n in range(100, 1000, 100)]
    + [(n * MIB, f"{n} M") for n in range(1, 11)]
    + [(100 * MIB, "100 M")]
)


def upper_bin(size: Column) -> Column:
    label = F.lit("BIG")
    for bound, name in reversed(UPPER_BINS):
        label = F.when(size < bound, name).otherwise(label)
    return label


def lower_bin(size: Column) -> Column:
    """0-9 as is, then tens, 100 for all above; of whole KiB."""
    kib = F.shiftright(size, 10)
    return F.least(F.when(kib < 10, kib).otherwise(F.floor(kib / 10) * 10), F.lit(100)).cast("bigint")


def row_size_bins(cells: DataFrame) -> DataFrame:
    """Z1."""
    return row_sizes(cells).groupBy(upper_bin(F.col("n_bytes")).alias("bin")).agg(F.count("*").alias("n"))


def cell_size_bins(cells: DataFrame, family: str) -> DataFrame:
    """Per qualifier of the family."""
    size = F.octet_length("value")
    return (
        cells.where(column_is(family))
        .groupBy("qualifier", upper_bin(size).alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def _distribution(sizes: DataFrame, size: str) -> DataFrame:
    """KB and MB bins and the total from one grouping of the sizes."""
    b = F.col(size)
    binned = sizes.groupBy(lower_bin(b).alias("kb"), lower_bin(F.shiftright(b, 10)).alias("mb")).agg(
        F.count("*").alias("n")
    )
    # At most 20 bins by 20: what follows is small whatever the table.
    entry = F.inline(
        F.array(
            F.struct(F.lit("kb size").alias("g"), F.col("kb").cast("string").alias("c")),
            F.struct(F.lit("mb size").alias("g"), F.col("mb").cast("string").alias("c")),
            F.struct(F.lit("total").alias("g"), F.lit("total rows").alias("c")),
        )
    )
    summed = binned.select("n", entry).groupBy("g", "c").agg(F.sum("n").alias("n"))
    return summed.select(*long_result(F.col("g"), F.col("c"), F.col("n")))


def row_size_distribution(cells: DataFrame) -> DataFrame:
    """Z3."""
    return _distribution(row_sizes(cells), "n_bytes")


def family_size_distribution(cells: DataFrame, family: str) -> DataFrame:
    """Z4."""
    return row_size_distribution(cells.where(column_is(family)))


def column_length_distribution(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Over characters; rows without the column do not count."""
    lengths = cells.where(column_is(family, qualifier)).select(F.length("value").alias("n_chars"))
    return _distribution(lengths, "n_chars")
