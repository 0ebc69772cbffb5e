"""Row filters on URLs and pages (inventory F1-F5).  All are deterministic
column predicates: Catalyst pushes them below projections and, where the
column comes straight from the files, into the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, strip_boundary

# fixed values: URL parts that mark non-article pages.  The first list keeps
# the original entry "/video/," (with its stray comma, so video pages pass);
# the default list has the corrected "/video/".
NON_ARTICLE_AS_PUBLISHED = ["/video/,", ".jpg", ".jpeg", ".png", ".gif", "/bilder/", "/photo/"]
NON_ARTICLE = ["/video/", ".jpg", ".jpeg", ".png", ".gif", "/bilder/", "/photo/"]
NON_ARTICLE_V2_EXTRA = ["/live/"]


def is_article_url_suffix(url, non_article=NON_ARTICLE) -> Column:
    """F1 URL ends with 'html' and contains none of the non-article parts."""
    u = F.col(url) if isinstance(url, str) else url
    return u.endswith("html") & ~contains_any(u, non_article)


def is_article_url_prefix(url, prefix: str, non_article=NON_ARTICLE + NON_ARTICLE_V2_EXTRA) -> Column:
    """F2 URL starts with the site prefix and contains none of the parts."""
    u = F.col(url) if isinstance(url, str) else url
    return u.startswith(prefix) & ~contains_any(u, non_article)


def filter_article_urls_suffix(df: DataFrame, url: str = "url", non_article=NON_ARTICLE) -> DataFrame:
    return df.where(is_article_url_suffix(url, non_article))


def filter_article_urls_prefix(df: DataFrame, prefix: str, url: str = "url") -> DataFrame:
    return df.where(is_article_url_prefix(url, prefix))


def filter_min_paragraphs(df: DataFrame, count_col: str = "paragraphs", minimum: int = 5) -> DataFrame:
    """F3 keep pages with at least ``minimum`` paragraphs."""
    return df.where(F.col(count_col) >= minimum)


def filter_non_empty_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """F4 keep rows whose stripped text is not empty."""
    return df.where(strip_boundary(text_col) != "")


def filter_content_type(df: DataFrame, col: str = "content_type", wanted: str = "text/html") -> DataFrame:
    """F5 keep responses whose content type contains ``wanted`` (missing drops)."""
    return df.where(F.coalesce(F.col(col), F.lit("")).contains(wanted))
