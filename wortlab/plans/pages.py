"""H13 article builder: crawl table (page_id, url, content_type, html) ->
article rows.  One select over the pages; the cheap filters run first and
the HTML is dropped right after parsing, so it never reaches a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import word_count
from ..operators import filters as FL

ARTICLE_V2_COLUMNS = ["url", "source_site", "domain", "date", "year", "text", "headline", "word_count", "paragraphs"]


def parse_pages(pages: DataFrame, url_prefix: str = "http", min_paragraphs: int = 5,
                keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``url_prefix`` is the site of the crawl; media, video and live pages never are articles."""
    df = FL.filter_article_urls_prefix(pages, url_prefix)            # F2 before any parsing
    if "content_type" in df.columns:
        df = FL.filter_content_type(df)                              # F5
    # Derived fields are produced by generators (one row per page): each is
    # computed once, and the filters on them cannot be pushed under a
    # preceding repartition into the scan task.
    df = df.select(*keep, "url", "html", F.explode(F.array(H.paragraphs("html"))).alias("_ps"))
    df = FL.filter_min_paragraphs(df.withColumn("paragraphs", F.size("_ps")), "paragraphs", min_paragraphs)  # F3
    fields = F.struct(H.paragraph_text(F.col("_ps")).alias("text"), H.article_date("html", "url").alias("date"),
                      H.headline("html").alias("headline"))
    df = df.select(*keep, "url", "paragraphs", F.inline(F.array(fields)))
    df = FL.filter_non_empty_text(df, "text")                        # F4
    auth = H.url_authority("url")
    out = df.select(*keep, "url", H.source_site(auth).alias("source_site"), H.domain_label(auth).alias("domain"),
                    "date", H.year_of("date").alias("year"), "text", "headline",
                    word_count("text").alias("word_count"), "paragraphs")
    # H9: a date whose leading part is not a number loses the article
    out = out.where(F.col("date").isNull() | (F.col("date") == "") | F.col("year").isNotNull())
    return out.select(*keep, *ARTICLE_V2_COLUMNS)
