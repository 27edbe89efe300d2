"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeworks.session import shared_dir

# Fixed value: the white space that separates words, as a character class and as characters.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"


def columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and nothing else, picked by place.

    Tables may carry further columns whose names differ from these only in case, or repeat.
    """
    place = {}
    for i, name in enumerate(df.columns):
        place.setdefault(name, i)
    plain = numbered(df)
    return plain.select(*[F.col(plain.columns[place[n]]).alias(n) for n in names])


def numbered(df: DataFrame) -> DataFrame:
    """The same columns under names that nothing else uses; ``toDF(*df.columns)`` gives them back."""
    return df.toDF(*[f"column_{i}_of_row" for i in range(len(df.columns))])


def place_of(df: DataFrame, name: str) -> Column:
    """A column of ``numbered(df)`` by its name in ``df``."""
    return F.col(f"column_{df.columns.index(name)}_of_row")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps never compute it again.

    A lost executor costs the reader nothing, since every task writes where all of them read.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(df: DataFrame, name: str) -> DataFrame:
    """``stored``, and Spark removes the shuffle files of the job when the table is written."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(key, before)


def ordered_sums(df: DataFrame, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Adds the sum of ``amount`` over all rows before each row in ``order``.

    Rows are dealt into ranges of the order; sums run inside each range and start at what the
    ranges before it hold. The table of range totals has as many rows as there are partitions.
    """
    keys = [f"order_key_{i}" for i in range(len(order))]
    keyed = df.select("*", *[c.alias(k) for c, k in zip(order, keys)], amount.cast("long").alias("order_amount"))
    ranged = stored(keyed.repartitionByRange(*keys).withColumn("order_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("order_range").agg(F.sum("order_amount").alias("range_total"))
    before = Window.orderBy("order_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("order_range").alias("start_range"), F.coalesce(F.sum("range_total").over(before), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy("order_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    both = ranged.join(starts, F.col("order_range") == F.col("start_range"))
    total = F.col("range_start") + F.coalesce(F.sum("order_amount").over(inside), F.lit(0))
    return both.select(*df.columns, total.alias(name))


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds the place of each row in ``order``, from 0."""
    return ordered_sums(df, order, F.lit(1), name)
