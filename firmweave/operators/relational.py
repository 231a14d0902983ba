"""Skew-safe building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows of one key that a join task should see at most. A key with more is salted:
# its rows are spread over several tasks and its lookup row is sent to each.
HOT_KEY_ROWS = 1_000_000


def never_broadcast(side: DataFrame) -> DataFrame:
    """A join side of the size of the input: joined by a shuffle whatever Spark expects of it.

    Spark sizes a table by its compressed file, not by the rows that texts exploded from it have, and would send one through the driver.
    """
    return side.hint("merge")


def lookup(
    big: DataFrame, small: DataFrame, key: str, how: str = "left", hot_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Join ``big`` with ``small`` (unique on ``key``) even if one key fills ``big``.

    ``big`` is read twice (once for the key alone), so it should be a table.
    """
    hot = (
        big.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= hot_rows)
        .select(key, F.ceil(F.col("n") / hot_rows).alias("salts"))
    )
    return salted_join(big, small, hot, key, how)


def salted_join(
    big: DataFrame, small: DataFrame, hot: DataFrame, key: str, how: str = "left"
) -> DataFrame:
    """``lookup`` with the hot keys (key, salts) known: at most rows / hot_rows of them, so broadcast."""
    hot = F.broadcast(hot)
    # the rows of a hot key come from many input partitions
    spread = F.pmod(F.spark_partition_id().cast("bigint"), F.coalesce("salts", F.lit(1)))
    left = big.join(hot, key, "left").withColumn("__salt", spread).drop("salts")
    right = (
        small.join(hot, key, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)) - 1)))
        .drop("salts")
    )
    return left.join(right, [key, "__salt"], how).drop("__salt")


def value_counts(
    df: DataFrame, key: str, fields: Sequence[str], weight: Column | None = None
) -> DataFrame:
    """Long table (key, field, value, n, weight): one row per distinct value of each field.

    Array fields contribute their elements. Counting before the per-key
    aggregation keeps a key that owns most rows from reaching one task.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    kinds = dict(df.dtypes)
    first = fields[0]
    none = F.lit(0).cast("bigint")

    def entry(field: str, value: Column, w: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), value.alias("value"), w.alias("w"))

    def entries(field: str) -> Column:
        if kinds[field].startswith("array"):
            values = F.coalesce(F.col(field), F.array().cast("array<string>"))
            return F.transform(values, lambda v: entry(field, v, none))
        # the first field carries the row weight, so it is counted once per row
        return F.array(entry(field, F.col(field).cast("string"), weight if field == first else none))

    parts = [entries(f) for f in fields]
    return (
        df.select(key, F.explode(F.concat(*parts)).alias("x"))
        .select(key, "x.field", "x.value", "x.w")
        .filter((F.col("field") == first) | F.col("value").isNotNull())
        .groupBy(key, "field", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("weight"))
    )


def mode_of(field: str, kind: str = "string") -> Column:
    """Most frequent value of ``field`` in a ``value_counts`` table, smallest value on ties."""
    value = F.col("value").try_cast(kind)
    best = F.min(
        F.when(
            (F.col("field") == field) & F.col("value").isNotNull(),
            F.struct((-F.col("n")).alias("rank"), value.alias("value")),
        )
    )
    return best["value"]


def values_of(*fields: str) -> Column:
    """Sorted distinct values of ``fields`` in a ``value_counts`` table; NULL when there are none."""
    hit = F.col("field").isin(list(fields)) & F.col("value").isNotNull()
    collect = F.collect_list if len(fields) == 1 else F.collect_set
    found = F.sort_array(collect(F.when(hit, F.col("value"))))
    return F.when(F.size(found) > 0, found)


def dense_number(df: DataFrame, key: str, name: str = "number") -> DataFrame:
    """Number rows 0, 1, 2, ... in the order of the unique ``key`` without a global window.

    Rows are range partitioned and numbered inside each partition; the offsets
    come from a table with one row for each partition.
    """
    from firmweave.storage import cut_lineage

    local = Window.partitionBy("__part").orderBy(key)
    ranged = cut_lineage(
        df.repartitionByRange(F.col(key)).withColumn("__part", F.spark_partition_id())
    )
    sizes = ranged.groupBy("__part").count()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset")
    )
    return (
        ranged.withColumn("__row", F.row_number().over(local) - 1)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__row"))
        .drop("__part", "__row", "__offset")
    )
