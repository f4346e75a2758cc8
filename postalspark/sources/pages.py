"""Crawled pages (S3): pages that failed to load (no HTML) drop out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_pages(pages: DataFrame) -> DataFrame:
    """S3: (page_id, url, html) of every page that has HTML."""
    return pages.where(F.col("html").isNotNull()).select("page_id", "url", "html")
