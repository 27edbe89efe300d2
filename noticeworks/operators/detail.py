"""Detail pages to detail records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from noticeworks import model as M
from noticeworks.functions import text as X
from noticeworks.operators import tokenise as K


def caption_pairs(rows: Column) -> Column:
    """(caption, value) pairs of a page in document order.

    The value is the cleaned text of the next cell in the caption's row; the last cell of a row
    has none.
    """

    def of_row(cells):
        captions = F.filter(K.with_next(cells), lambda p: K.is_caption(p["c"]))
        return F.coalesce(
            F.transform(
                captions,
                lambda p: F.struct(
                    F.lower(K.cell_node_text(p["c"])).alias("caption"),
                    X.clean(K.cell_node_text(p["n"])).alias("value"),
                ),
            ),
            F.array().cast("array<struct<caption:string,value:string>>"),
        )

    # Cells first, in a pass of their own: a lambda body would split a row at every mention.
    return F.flatten(F.transform(F.transform(rows, K.row_cells), of_row))


def _value_of(pairs: Column, label: str) -> Column:
    """Value of the first caption that contains the label, even if that value is null."""
    hits = F.filter(pairs, lambda p: F.contains(p["caption"], F.lit(label.lower().strip())))
    return F.get(hits, F.lit(0))["value"]


def detail_columns(pairs: Column) -> list[Column]:
    out = []
    for name in M.DETAIL_FIELDS:
        value = _value_of(pairs, M.CAPTIONS[name])
        if name in M.AMOUNT_FIELDS:
            value = X.amount(value)
        elif name in M.DAY_FIELDS:
            value = X.first_int(value)
        out.append(value.alias(name))
    return out


def detail_pairs(pages: DataFrame, strict: bool = True) -> DataFrame:
    """Pages with their (caption, value) pairs in place of the body."""
    rows = K.with_rows(pages, "detail", strict)
    return rows.withColumn("pairs", caption_pairs(F.col("rows"))).drop("rows")


def extract_detail(pages: DataFrame, strict: bool = True) -> DataFrame:
    """Detail pages to the 16 detail fields, one row per page, without any shuffle.

    A page is one row, so all of its captions are looked up inside the row; there is nothing to
    explode, join or group.
    """
    keys = [c for c in pages.columns if c != "html"]
    return detail_pairs(pages, strict).select(*keys, X.once(*detail_columns(F.col("pairs"))))
