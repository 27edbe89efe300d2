"""Outcome classes for crawl jobs and fetches, and page-level flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from noticeworks import model as M
from noticeworks.functions import text as X


def job_class(status: Column) -> Column:
    """``done``, ``failed`` or ``running``; an unknown or missing status still runs."""
    return (
        F.when(status.isin(M.DONE_STATUSES), "done")
        .when(status.isin(M.FAILED_STATUSES), "failed")
        .otherwise("running")
    )


def submit_class(http_status: Column) -> Column:
    """``ok``, ``retryable`` (rate limit, server error) or ``permanent``."""
    return (
        F.when(http_status == 200, "ok")
        .when((http_status == 429) | (http_status >= 500), "retryable")
        .otherwise("permanent")
    )


def poll_class(http_status: Column) -> Column:
    """``ok``, ``gone`` (job unknown) or ``retryable`` (anything else)."""
    return F.when(http_status == 200, "ok").when(http_status == 404, "gone").otherwise("retryable")


def session_expired(html: Column) -> Column:
    return X.contains_any(F.lower(html), M.SESSION_PHRASES)


def _attr_with(name: str, word: str) -> str:
    return rf"""{name}\s*=\s*(?:"[^"]*{word}[^"]*"|'[^']*{word}[^']*'|[^\s>"']*{word}[^\s>]*)"""


_CHALLENGE = (
    r"<(?i:img)\b[^>]*?\s(?:(?i:" + _attr_with("src", r"(?-i:captcha)") + ")|(?i:"
    + _attr_with("(?:alt|id|title)", "captcha") + "))"
    r"""|<[A-Za-z][^>]*?\s(?i:id)\s*=\s*["']?captchaImage(?=["'\s>])"""
)


def challenge_page(html: Column) -> Column:
    """Whether a stored page is a challenge page. Visibility is not known for stored HTML."""
    # Every form has this word: the pages without it, nearly all, are not searched tag by tag.
    return html.rlike("(?i)captcha") & html.rlike(_CHALLENGE)


def anchor_texts(html: Column) -> Column:
    inner = F.regexp_extract_all(html, F.lit(r"(?s)<(?i:a)(?=[\s>])[^>]*>(.*?)</(?i:a)\s*>"), 1)
    return F.transform(
        inner, lambda a: X.strip(X.unescape(F.regexp_replace(a, r"</?[A-Za-z][^>]*>", ""), a))
    )


def has_next_page(html: Column) -> Column:
    """An anchor whose text is exactly ``>``."""
    return F.exists(anchor_texts(html), lambda t: t == ">")
