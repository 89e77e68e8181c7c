"""From archive records to clean text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.constants import MIN_TEXT_LENGTH
from pagemill.functions.html import text_extractor


def is_html(
    rec_type: str = "rec_type", content_type: str = "content_type", headers: str | None = None
) -> Column:
    """Response or resource whose content type contains 'html' (case counts)."""
    keep = F.col(rec_type).isin("response", "resource") & F.coalesce(
        F.col(content_type), F.lit("")
    ).contains("html")
    return keep & F.col(headers).isNotNull() if headers else keep


def html_records(records: DataFrame, headers: str | None = None) -> DataFrame:
    return records.where(is_html(headers=headers))


def clean_pages(
    pages: DataFrame,
    payload: str = "payload",
    min_len: int = MIN_TEXT_LENGTH,
    extractor: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Replace the payload by text, route and n_segments; drop text shorter than min_len.

    `extractor` may be any column function with the result type of the default.
    Pages it fails on (route 'error' in extract_pages) have no text and drop out.
    Put cheap filters before this: none moves below the extraction.
    """
    return extract_pages(pages, payload, min_len, extractor).where(F.length("text") >= min_len)


def extract_pages(
    pages: DataFrame,
    payload: str = "payload",
    min_len: int = MIN_TEXT_LENGTH,
    extractor: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """As clean_pages, without the length filter."""
    extract = extractor or text_extractor(min_len)
    others = [c for c in pages.columns if c != payload]
    return pages.select(*others, extract(F.col(payload)).alias("_t")).select(*others, "_t.*")
