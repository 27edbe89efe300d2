"""Line dedup by site-relative frequency.

A line is boilerplate of its host when more than ``percent`` percent of the host's pages contain
it, and at least ``min_pages`` of them. Every page is one row of the table. Lines are compared
without surrounding white space; blank lines are neither counted nor dropped.

Defined results: a null text stays null and an empty one empty, both count as pages; a null host
is a host of its own; repeated rows are pages of their own; a page whose lines all go keeps an
empty text; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.functions.text import once
from noticeworks.llm.common import SPACES, columns, numbered, place_of, stored

PERCENT = 10    # of a host's pages; a line on a larger share is dropped
MIN_PAGES = 5   # pages that hold it at least


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _key(line: Column) -> Column:
    """128 bits of hash in place of the line; blank lines have no key."""
    bare = _bare(line)
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("line"), bare).alias("b")))


def boilerplate(pages: DataFrame, percent: int = PERCENT, min_pages: int = MIN_PAGES) -> DataFrame:
    """host_of_lines and the keys of its boilerplate lines, for hosts that have any.

    Counts are summed before the shuffle, so a line on every page of a large host arrives as one
    row per task. A host has at most (lines of its mean page) * 100 / percent such lines, which
    bounds the array whatever the size of the host.
    """
    keys = F.array_compact(F.array_distinct(F.transform(F.split("text", "\n"), _key)))
    lines = pages.select("host", F.explode(keys).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("holding"))
    totals = pages.groupBy(F.col("host").alias("host_of_lines")).agg(F.count("*").alias("all_pages"))
    often = counts.where(F.col("holding") >= min_pages).join(
        totals, F.col("host").eqNullSafe(F.col("host_of_lines")))
    found = often.where(100 * F.col("holding") > percent * F.col("all_pages"))
    return found.groupBy("host_of_lines").agg(F.collect_list("line").alias("boilerplate"))


def _cleaned(pages: DataFrame, *keep: str, percent: int, min_pages: int) -> DataFrame:
    """``pages`` has host, text and ``keep``; adds n_lines, n_dropped and new_text."""
    table = stored(boilerplate(pages, percent, min_pages), "boilerplate")
    both = pages.join(table, F.col("host").eqNullSafe(F.col("host_of_lines")), "left")
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), _key(x).alias("k")))
    # Hosts without boilerplate keep their texts as they are; no line of theirs is hashed again.
    marked = F.when(F.col("boilerplate").isNotNull(), F.filter(
        lines, lambda x: ~F.coalesce(F.array_contains("boilerplate", x["k"]), F.lit(False))))
    cut = both.select(*keep, "text", once(marked.alias("left")))
    worded = F.size(F.filter(F.split("text", "\n"), lambda x: _bare(x) != ""))
    n_all = F.coalesce(F.when(F.col("text").isNotNull(), worded), F.lit(0)).cast("long")
    new_text = F.when(F.col("left").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform("left", lambda x: x["line"]), "\n"))
    n_left = F.size(F.filter("left", lambda x: x["k"].isNotNull()))
    n_dropped = F.when(F.col("left").isNull() | F.col("text").isNull(), F.lit(0).cast("long")).otherwise(n_all - n_left)
    return cut.select(*keep, n_all.alias("n_lines"), n_dropped.alias("n_dropped"), new_text.alias("new_text"))


def line_dedup(
    docs: DataFrame, host: Column | None = None, percent: int = PERCENT, min_pages: int = MIN_PAGES
) -> DataFrame:
    """One row per page: doc_id, n_lines, n_dropped and the text without boilerplate lines.

    ``host`` is an expression over doc_id, source and text, by default the source.
    """
    own = columns(docs, "doc_id", "source", "text")
    pages = own.select("doc_id", (F.col("source") if host is None else host).alias("host"), "text")
    done = _cleaned(pages, "doc_id", percent=percent, min_pages=min_pages)
    return done.withColumnRenamed("new_text", "text")


def drop_boilerplate(docs: DataFrame, percent: int = PERCENT, min_pages: int = MIN_PAGES) -> DataFrame:
    """The documents with boilerplate lines cut from their texts; n_chars follows the text."""
    plain = numbered(docs)
    pages = plain.select(
        F.struct(*plain.columns).alias("row_of_document"), place_of(docs, "source").alias("host"),
        place_of(docs, "text").alias("text"))
    done = _cleaned(pages, "row_of_document", percent=percent, min_pages=min_pages)
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    out = []
    for i, name in enumerate(docs.columns):
        first = docs.columns.index(name) == i
        old = F.col(f"row_of_document.{plain.columns[i]}")
        out.append((new[name] if name in new and first else old).alias(plain.columns[i]))
    return done.select(*out).toDF(*docs.columns)
