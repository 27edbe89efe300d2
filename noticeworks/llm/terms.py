"""Terms of texts, blocks of a query set and ranks that no single task has to find alone."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.common import columns, ordered_sums
from noticeworks.session import shared_dir

BLOCK_CHARS = 4_000_000   # characters of a query set that go to the tasks at once, about
GROUP = 256               # tasks whose best rows meet first

# Only A-Z are lower-cased; every ASCII character but letters and digits ends a term.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a whole UTF-8 text, with repeats; none for a null."""
    return text.translate(_TERMS).split() if text else []


def texts_of(batch, name: str = "text") -> list[bytes | None]:
    """The texts of an Arrow batch as UTF-8."""
    import pyarrow as pa

    return batch.column(name).cast(pa.binary()).to_pylist()


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """(item_id, terms) of a query set, in blocks of about so many characters; one block at a time is held."""
    own = columns(items, "item_id", "text").select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("item_id"), F.xxhash64("text")]
    placed = ordered_sums(own, order, F.length("text"), "chars_before").select(
        "item_id", "text", F.floor(F.col("chars_before") / block_chars).alias("block"))
    for block in sorted(r.block for r in placed.select("block").distinct().collect()):
        rows = placed.where(F.col("block") == block).orderBy(F.col("item_id").asc_nulls_first(), "text").collect()
        yield [(r.item_id, terms_of(r.text.encode())) for r in rows]


class Parts:
    """A table that is written part by part, one for each block, and read once."""

    def __init__(self, spark, name: str):
        self.spark, self.path, self.schema = spark, shared_dir(spark, name), None

    def add(self, part: DataFrame) -> None:
        part.write.mode("append").parquet(self.path)
        self.schema = part.schema

    def read(self, schema: str) -> DataFrame:
        if self.schema is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(self.schema).parquet(self.path)


def best(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key with their rank from 1; ``rows`` has the column ``task``.

    Every task hands on its own first rows. They meet in groups of tasks, then all together, so a
    key's rows never reach one task unreduced.
    """
    groups = Window.partitionBy(*keys, "task_group").orderBy(*order)
    first = rows.withColumn("task_group", F.floor(F.col("task") / GROUP)).withColumn(
        "rank", F.row_number().over(groups)).where(F.col("rank") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= k).drop("task", "task_group")
