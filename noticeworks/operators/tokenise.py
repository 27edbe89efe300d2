"""Stored HTML to table rows and cells.

Well-formed flat tables are tokenised with built-in expressions: one pass finds the candidate
tables, one split gives the rows, one split per row gives the cells. Tables that those
expressions cannot read safely (nested tables, comments, scripts, unusual entities, ``>`` inside
attributes) are rewritten by a small parser into flat row fragments first. Only such tables are
sent to Python; every other row of the batch sends a null.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from noticeworks.functions import text as X
from noticeworks.operators.flatrows import INNER_MARK, flatten_tables

TAG = r"<(?:/?[A-Za-z]|[!?])[^>]*>"
_BEFORE_FIRST_TAG_END = r"^[^>]*>"
# What is left of a row piece: from its first tag's end up to a closing tag. Possessive, so one step per tag.
_ROW_BODY = r"^(?:[^>]*+>)?+([^<]*+(?:<(?!/(?i:tr|tbody|thead|tfoot|table)\b)[^<]*+)*+)"
# The look-ahead spares most characters the list of tags.
_CELL_EDGES = rf"(?s){_BEFORE_FIRST_TAG_END}|</(?i:t[dh])\b.*"
_CELL_MARKUP = rf"(?s){_BEFORE_FIRST_TAG_END}|(?=<)(?:</(?i:t[dh])\b.*|{TAG})"


def _has_class(name: str) -> str:
    return (
        rf"""\s(?i:class)\s*=\s*(?:"(?:[^">]*\s)?{name}(?:\s[^">]*)?"|'(?:[^'>]*\s)?{name}"""
        rf"""(?:\s[^'>]*)?'|{name}(?=[\s>]))"""
    )


_HAS_ID = r"""\s(?i:id)\s*=\s*(?:"table"|'table'|table(?=[\s>]))"""
# Result tables of a listing page, in order of preference.
_BY_ID = rf"^<(?i:table)\b[^>]*?{_HAS_ID}"
_BY_LIST_TABLE = rf"^<(?i:table)\b[^>]*?{_has_class('list_table')}"
_BY_LIST = rf"^<(?i:table)\b[^>]*?{_has_class('list')}"
_LISTING_OPEN = rf"<(?i:table)\b[^>]*?(?:{_HAS_ID}|{_has_class('(?:list|list_table)')})[^>]*>"
_DETAIL_OPEN = rf"<(?i:table)\b[^>]*?{_has_class('tablebg')}[^>]*>"
_CAPTION_CELL = rf"^(?i:td)\b[^>]*?{_has_class('td_caption')}"

# What the built-in expressions cannot tokenise: checked on the table blocks only.
_UNSAFE = (
    r"(?i)(?=[<&=])(?:<(?:(?<!^<)table\b|(?:script|style|textarea|title|noscript|template|iframe|xmp)\b|!)"
    r"|&(?!(?:amp|nbsp|lt|gt|quot|apos|#39|#8377);)[a-z#][a-z0-9][^<>]*(?:<|$)"
    r"""|=\s*(?:"[^"<]*>[^"<]*"|'[^'<]*>[^'<]*'))"""
)


def _blocks(html: Column, opening: str) -> Column:
    # Possessive up to the closing tag: one step per tag, not one per character.
    return F.regexp_extract_all(html, F.lit(rf"(?s){opening}[^<]*+(?:<(?!/(?i:table)\s*>)[^<]*+)*+"), 0)


def _rest(pieces: Column) -> Column:
    """All pieces after the first; a fixed length, since size() would split a second time."""
    return F.slice(pieces, 2, 1 << 30)


def _without_comments(html: Column) -> Column:
    """Comments become an empty tag, so that they still separate two text nodes."""
    bare = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "<br>")
    return F.when(F.contains(html, F.lit("<!--")), bare).otherwise(html)


def _split_rows(block: Column) -> Column:
    """Row fragments of one table block, without the row tags."""
    pieces = F.split(block, r"<(?i:tr)(?=[\s>/])")
    return F.transform(
        _rest(pieces), lambda r: F.regexp_extract(r, _ROW_BODY, 1)
    )


def _drop_head_and_foot(block: Column) -> Column:
    return F.regexp_replace(
        block, r"(?s)<(?i:thead|tfoot)\b.*?(?=</(?i:thead|tfoot)\b|<(?i:tbody)\b|\z)", ""
    )


def _rows_of(blocks: Column, kind: str | None = None, body_only: bool = False) -> Column:
    chosen = F.filter(blocks, lambda b: b.rlike(kind)) if kind else blocks
    return F.flatten(
        F.transform(chosen, lambda b: _split_rows(_drop_head_and_foot(b) if body_only else b))
    )


def _listing_rows(blocks: Column) -> Column:
    """Rows of the first selector that finds any row."""

    def found(kind):
        return F.exists(blocks, lambda b: b.rlike(kind) & b.rlike(r"<(?i:tr)[\s>/]"))

    return (
        F.when(found(_BY_ID), _rows_of(blocks, _BY_ID))
        .when(found(_BY_LIST_TABLE), _rows_of(blocks, _BY_LIST_TABLE))
        .otherwise(_rows_of(blocks, _BY_LIST, body_only=True))
    )


def _strict(kind: str):
    @F.pandas_udf("array<string>")
    def strict_rows(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: flatten_tables(h, kind) if isinstance(h, str) else None)

    return strict_rows


# --- Operators -----------------------------------------------------------------------------


def with_rows(pages: DataFrame, kind: str = "listing", strict: bool = True) -> DataFrame:
    """Replace ``html`` by ``rows``: the row fragments of the result (or detail) tables.

    Narrow: one task reads a page, tokenises it and drops its body. With ``strict=False`` the
    caller states that all tables are flat, and no Python worker is used.
    """
    opening = _LISTING_OPEN if kind == "listing" else _DETAIL_OPEN
    found = pages.withColumn("_blocks", _blocks(_without_comments(F.col("html")), opening))
    native = _listing_rows(F.col("_blocks")) if kind == "listing" else _rows_of(F.col("_blocks"))
    if not strict:
        return found.withColumn("rows", native).drop("html", "_blocks")
    unsafe = F.exists("_blocks", lambda b: b.rlike(_UNSAFE))
    sent = found.withColumn("_unsafe", unsafe)
    # Bodies of safe pages end here: the Python stage sees nulls for them.
    sent = sent.withColumn("_blocks", F.when(~F.col("_unsafe"), F.col("_blocks"))).withColumn(
        "html", F.when(F.col("_unsafe"), F.col("html"))
    )
    parsed = sent.withColumn("_strict", _strict(kind)("html")).drop("html")
    return parsed.withColumn("rows", F.coalesce("_strict", native)).drop(
        "_blocks", "_unsafe", "_strict"
    )


def row_text(row: Column) -> Column:
    """All text of a row, concatenated, then stripped."""
    inner = F.regexp_replace(row, rf"(?s)<t[dh] {INNER_MARK}>.*?</t[dh]>", "")
    own = F.when(F.contains(row, F.lit(f" {INNER_MARK}>")), inner).otherwise(row)
    return X.strip(X.unescape(F.regexp_replace(own, TAG, ""), row))


def row_cells(row: Column) -> Column:
    """Cell fragments (``td`` only) of a row fragment."""
    pieces = F.split(row, r"<(?=(?i:t[dh])[\s>/])")
    return F.filter(
        _rest(pieces), lambda c: c.rlike(r"^(?i:td)")
    )


def with_next(cells_of_row: Column) -> Column:
    """Pairs (c, n) of every cell and the one after it."""
    paired = F.arrays_zip(cells_of_row.alias("c"), _after(cells_of_row).alias("n"))
    return F.when(F.size(cells_of_row) > 0, paired)


def _after(values: Column) -> Column:
    """What follows each value of an array, null after the last."""
    return F.concat(_rest(values), F.array(F.lit(None).cast("string")))


def cell_text(cell: Column) -> Column:
    """Text of a cell, concatenated, then stripped (listing pages)."""
    return X.strip(X.unescape(F.regexp_replace(cell, _CELL_MARKUP, ""), cell))


def cell_node_text(cell: Column) -> Column:
    """Text of a cell with every text node stripped on its own (detail pages)."""
    return _joined_nodes(_inside(cell))


def _inside(cell: Column) -> Column:
    """What a cell holds between its own tags."""
    return F.regexp_replace(cell, _CELL_EDGES, "")


def _joined_nodes(inside: Column) -> Column:
    return F.array_join(F.transform(F.split(inside, TAG), lambda n: X.strip(X.unescape(n))), "")


def cell_href(cell: Column) -> Column:
    """href of the first link of a cell; empty when there is none."""
    link = F.regexp_extract(cell, r"<((?i:a)(?:\s[^>]*)?)>", 1)
    value = F.regexp_extract(
        link, r"""\s(?i:href)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1
    )
    return X.unescape(F.btrim(value, F.lit("\"'")), cell)


def cell_class(cell: Column) -> Column:
    tag = F.regexp_extract(cell, r"^([^>]*)>", 1)
    value = F.regexp_extract(tag, r"""\s(?i:class)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.btrim(value, F.lit("\"'"))


def is_caption(cell: Column) -> Column:
    return cell.rlike(_CAPTION_CELL)


def cells(pages: DataFrame, kind: str = "listing", strict: bool = True) -> DataFrame:
    """The cells table: one row per cell with its text, class, link and the next cell's value.

    The neighbour is paired inside the row's array, so no window and no shuffle is needed.
    """
    keys = [c for c in pages.columns if c != "html"]
    rows = with_rows(pages, kind, strict).select(
        *keys, F.posexplode_outer("rows").alias("row_ord", "_row")
    )
    split = rows.select(*keys, "row_ord", row_cells(F.col("_row")).alias("_cells"))
    inner = split.select("*", F.transform("_cells", _inside).alias("_inside"))
    # Once per cell, for itself and for the cell before it. Most cells hold one text node and no tag.
    texts = inner.select("*", F.transform("_inside", lambda i: F.when(
        F.contains(i, F.lit("<")), _joined_nodes(i)).otherwise(X.strip(X.unescape(i)))).alias("_nodes"))
    parts = F.arrays_zip(
        F.col("_cells").alias("c"), F.col("_inside").alias("i"), F.col("_nodes").alias("t"), _after(F.col("_nodes")).alias("n"))
    flat = texts.select(
        *keys, "row_ord", F.posexplode_outer(F.when(F.size("_cells") > 0, parts)).alias("cell_ord", "_part")
    )
    c = F.col("_part.c")
    return flat.where(c.isNotNull()).select(
        *keys, "row_ord", "cell_ord",
        cell_class(c).alias("cls"),
        F.when(F.contains("_part.i", F.lit("<")), cell_text(c)).otherwise(F.col("_part.t")).alias("text"),
        F.col("_part.t").alias("node_text"),
        F.nullif(cell_href(c), F.lit("")).alias("href"),
        X.clean(F.col("_part.n")).alias("next_text"),
    )
