"""Text prepared for embedding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from noticeworks import model as M
from noticeworks.functions import text as X


def _labelled(label: str, value: Column) -> Column:
    return F.when(value != "", F.concat(F.lit(label), value))


def notice_text() -> Column:
    """Labelled notice fields joined in fixed order; empty fields are skipped, blank is null."""
    joined = F.concat_ws(". ", *[_labelled(lab, F.col(f)) for f, lab in M.NOTICE_TEXT_PARTS])
    return F.when(X.strip(joined) != "", joined)


def preference_text() -> Column:
    """Labelled user preferences; lists are joined by a comma and empty ones skipped."""
    parts = []
    for name, label in M.PREFERENCE_TEXT_PARTS:
        c = F.col(name)
        if name in M.LIST_PREFERENCES:
            parts.append(F.when(F.size(c) > 0, F.concat(F.lit(label), F.array_join(c, ", "))))
        else:
            parts.append(_labelled(label, c))
    joined = F.concat_ws(". ", *parts)
    return F.when(joined != "", joined)


def embed_input(c: Column) -> Column:
    """The leading part of a text that is sent to the embedding model."""
    return F.substring(c, 1, M.MAX_EMBED_CHARS)
