"""Columns specific to listing rows: title split and row validity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from noticeworks import model as M
from noticeworks.functions import text as X


def row_order(source_rank: int, page_no, page_id, row_ord, seen_at=None, run=None) -> Column:
    """The order of a row among all rows of all sources; what is not known is null and comes first."""
    values = (F.lit(source_rank), seen_at, run, page_no, page_id, row_ord)
    kinds = ("int", "timestamp_ntz", "string", "bigint", "bigint", "int")
    names = ("source_rank", "seen_at", "run", "page_no", "page_id", "row_ord")
    return F.struct(*[
        (F.lit(None) if v is None else v).cast(k).alias(n) for v, k, n in zip(values, kinds, names)]).alias("ingest_ord")


def split_title_ref(c: Column) -> tuple[Column, Column]:
    """``[title][ref][id]`` to (title, ref); anything with fewer brackets is all title.

    The bracket is removed before the blanks, so a blank shields a bracket.
    """
    parts = F.split(c, r"\]")
    bracketed = F.size(parts) >= 3

    def part(i):
        return X.strip(F.ltrim(F.get(parts, F.lit(i)), F.lit("[")))

    return (
        F.when(bracketed, part(0)).otherwise(X.strip(c)),
        F.when(bracketed, part(1)).otherwise(F.lit("")),
    )


def is_notice(title, closing_date, opening_date, published_date, organisation) -> Column:
    """Whether a listing row is a real notice rather than a header or filler row."""
    lowered = F.lower(title)
    given = {
        "closing_date": closing_date,
        "opening_date": opening_date,
        "published_date": published_date,
        "organisation": organisation,
    }
    header_cell = X.any_of(
        [F.lower(given[name]).isin(values) for name, values in M.HEADER_FIELD_VALUES.items()]
    )
    words = F.size(F.split(X.strip(title), f"[{X.WS}]+"))
    return (
        ~X.contains_any(lowered, M.TITLE_REJECT_WORDS)
        & ~header_cell
        & (F.char_length(title) > 20)
        & title.rlike(r"\p{L}")
        & (X.contains_any(lowered, M.TITLE_KEYWORDS) | (words > 5))
    )
