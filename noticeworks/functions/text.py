"""Scalar text, number and date functions (all JVM-side)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from noticeworks import model as M

# Everything a Unicode-aware strip removes; SQL trim() removes blanks only.
WHITESPACE = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# The same set as a regex class body.
WS = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NBSP = "\u00a0"

# Entities decoded natively; pages with any other entity take the strict tokenizer.
ENTITIES = [
    ("&nbsp;", NBSP),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&#8377;", "₹"),
    ("&amp;", "&"),  # last, so that "&amp;lt;" decodes once
]


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def contains_any(c: Column, words) -> Column:
    """Whether a text holds any of some plain words. The text is mentioned, and so computed, once."""
    first = "".join(sorted({re.escape(w[0]) for w in words}))
    return c.rlike(f"(?=[{first}])(?:{'|'.join(map(re.escape, words))})")


def whole(condition: Column) -> Column:
    """A filter condition that stays in one piece, null counting as false.

    Split or null-checked conditions would be pushed below the projection that computes their
    inputs, and the parsing behind those inputs would run twice.
    """
    return F.coalesce(condition, F.lit(False))


def once(*named: Column) -> Column:
    """Columns computed exactly once, however often and wherever later steps mention them.

    Use it in ``select``: the optimizer copies plain expressions into filters and other
    projections, but not through a generator.
    """
    return F.inline(F.array(F.struct(*named)))


def strip(c: Column) -> Column:
    """Strip Unicode whitespace from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """Strip; an empty result becomes null."""
    s = strip(c)
    return F.when(s != "", s)


def key_or_missing(c: Column) -> Column:
    """Strip; a blank or null key becomes the missing-key marker."""
    return F.coalesce(blank_to_null(c), F.lit(M.MISSING_KEY))


def unescape(c: Column, raw: Column | None = None) -> Column:
    """Entities to characters; ``raw`` is a stored column with an ampersand wherever the text has one."""
    decoded = reduce(lambda acc, e: F.replace(acc, F.lit(e[0]), F.lit(e[1])), ENTITIES, c)
    return F.when(F.contains(c if raw is None else raw, F.lit("&")), decoded).otherwise(c)


def clean(c: Column) -> Column:
    """Detail value: blanks, NA words, script leaks and over-long values become null."""
    s = strip(F.replace(c, F.lit(NBSP), F.lit(" ")))
    bad = (
        (s == "") | s.isin(M.NULL_WORDS) | contains_any(s, M.SCRIPT_MARKS)
        | (F.char_length(s) > M.MAX_VALUE_CHARS)
    )
    return F.when(~bad, s)


def amount(c: Column) -> Column:
    """Money text to double: drops the rupee sign, commas and whitespace."""
    bare = F.regexp_replace(c, "[₹," + WS + "]", "")
    number = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
    return F.when(bare.rlike(number), bare.try_cast("double"))


def first_int(c: Column) -> Column:
    """The first run of digits as a bigint, null beyond its range."""
    digits = F.regexp_extract(c, r"(\d+)", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


_DATE_SHAPE = (
    r"^\d{1,2}-[A-Za-z]{3}-\d{4}(?:\s+\d{1,2}:\d{1,2}(?:\s+[AaPp][Mm])?)?$"
    r"|^\d{1,2}/\d{1,2}/\d{4}$"
)


def notice_date(c: Column) -> Column:
    """Listing date to a zone-less timestamp, null where no known form fits.

    The forms are day-Mon-year with 12-hour time, with 24-hour time or without time, and
    day/month/year. One shape test, one search and plain arithmetic: no parser exceptions.
    """
    s = strip(c)

    def stamp(p):
        def num(i):
            return F.get(p, F.lit(i)).try_cast("int")

        by_name = F.array_position(F.array(*[F.lit(m) for m in M.MONTHS]), F.lower(F.get(p, F.lit(1)))).cast("int")
        month = F.coalesce(F.nullif(by_name, F.lit(0)), num(1))  # a cast of a month's letters costs an exception
        half = F.lower(F.get(p, F.lit(5)))
        hour = (
            F.when(half.isNull(), F.coalesce(num(3), F.lit(0)))
            .when(num(3).between(1, 12), num(3) % 12 + F.when(half == "pm", 12).otherwise(0))
        )
        made = F.try_make_timestamp_ntz(
            num(2), month, num(0), hour, F.coalesce(num(4), F.lit(0)), F.lit(0).cast("decimal(16,6)")
        )
        return F.when((num(2) > 0) & (month > 0), made)

    # In a text of a known shape these are the pieces of a split, whose pattern is compiled for every text.
    # The lambda mentions them without finding them again, and keeps the generated code short.
    pieces = F.regexp_extract_all(s, F.lit(r"[^-/:\s]+"), 0)
    return F.when(s.rlike(_DATE_SHAPE), F.get(F.transform(F.array(pieces), stamp), F.lit(0)))


def absolute_url(path: Column) -> Column:
    """Host-prefix a path unless it already starts with ``http``; no slash is added."""
    return F.when(path.startswith("http"), path).otherwise(F.concat(F.lit(M.NOTICE_HOST), path))


def link_url(href: Column) -> Column:
    """Absolute URL of a link; missing or empty href gives null."""
    return F.when(href != "", absolute_url(href))


def truthy(c: Column, kind: str) -> Column:
    """Non-null and neither empty nor zero."""
    return F.coalesce(c != (F.lit("") if kind == "string" else F.lit(0)), F.lit(False))


def has_detail() -> Column:
    """Whether a merged notice row carries any of the four marker detail fields."""
    marks = ["tender_type", "product_category", "work_description", "tender_value"]
    return any_of([truthy(F.col(f), M.detail_type(f)) for f in marks])
