"""Operators over crawled pages: codes per page, crawl links, set logic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalspark.functions import html as H
from postalspark.functions.links import is_area_link, resolve_url, resolves_to_host
from postalspark.schemas import DEFAULT_BASE_URL


def _explode_codes(pages: DataFrame, codes_col, distinct: bool) -> DataFrame:
    return pages.select("page_id", F.explode(F.array_distinct(codes_col) if distinct else codes_col).alias("cep"))


def extracted_codes(pages: DataFrame) -> DataFrame:
    """C1 over page text: (page_id, cep) for every match, repeats kept."""
    from postalspark.functions.codes import extract_codes
    return _explode_codes(pages, extract_codes("html"), distinct=False)


def table_codes(pages: DataFrame) -> DataFrame:
    """(page_id, cep) from the code table of each page, distinct per page."""
    return _explode_codes(pages, H.table_codes("html"), distinct=True)


def link_codes(pages: DataFrame) -> DataFrame:
    """(page_id, cep) from ``/cep/NNNNN-NNN/`` link targets, distinct per page."""
    return _explode_codes(pages, H.link_codes("html"), distinct=True)


def text_codes(pages: DataFrame) -> DataFrame:
    """(page_id, cep) from visible text, distinct per page."""
    return _explode_codes(pages, H.text_codes("html"), distinct=True)


def page_codes(pages: DataFrame) -> DataFrame:
    """Per page, table and link codes; text codes only when those are empty.

    The primary codes are projected first and read twice from that column, so the
    regex stages run once per page.
    """
    primary = pages.select("page_id", "html", H.primary_codes("html").alias("_p"))
    chosen = F.when(F.size("_p") > 0, F.col("_p")).otherwise(F.array_distinct(H.text_codes("html")))
    return primary.select("page_id", F.explode(chosen).alias("cep"))


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, href) for every link, page order not kept."""
    return pages.select("page_id", F.explode(H.page_links("html")).alias("href"))


def area_links(pages: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """Per page, distinct absolute links that pass C11 and C13.

    Links of the ``ul#ul_list`` list are a subset of all links, so one pass over
    all links gives the union. Repeats within a page go before the links become rows, so nothing is shuffled.
    """
    kept = F.filter("_links", lambda h: is_area_link(h) & resolves_to_host(h, base_url))
    urls = F.array_distinct(F.transform(kept, lambda h: resolve_url(h, base_url)))
    return pages.select("page_id", H.page_links("html").alias("_links")).select("page_id", F.explode(urls).alias("url"))


def merge_collections(*collections: DataFrame, col: str = "cep") -> DataFrame:
    """Union of code collections, distinct."""
    return reduce(lambda a, b: a.unionByName(b), [c.select(col) for c in collections]).dropDuplicates([col])


def new_codes(found: DataFrame, collected: DataFrame, col: str = "cep") -> DataFrame:
    """Distinct found codes not collected yet (left anti join)."""
    return found.select(col).dropDuplicates([col]).join(collected.select(col), col, "left_anti")
