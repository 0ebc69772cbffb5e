"""Sitemap readers (inventory S6-S8): XML text column -> URL rows.

Each sitemap document is one row; ``xpath`` returns its ``<loc>`` values
(entities decoded, default namespace ignored by the local-name match), and
``posexplode`` turns them into rows.  A sitemap is bounded by the protocol
(50,000 URLs), so no step holds more than one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOC_XPATH = "//*[local-name()='loc']/text()"


def sitemap_locs(sitemaps: DataFrame, xml_col: str = "xml", key: str = "sitemap_url") -> DataFrame:
    """S7 every <loc> of every sitemap -> (sitemap_url, pos, url)."""
    return sitemaps.select(key, F.posexplode(F.xpath(F.col(xml_col), F.lit(LOC_XPATH))).alias("pos", "url"))


def sitemap_index_urls(index: DataFrame, marker: str = "post-sitemap", xml_col: str = "xml") -> DataFrame:
    """S6 sitemap URLs of an index that contain ``marker`` -> (index_url, pos, sitemap_url)."""
    locs = index.select(F.col("sitemap_url").alias("index_url"),
                        F.posexplode(F.xpath(F.col(xml_col), F.lit(LOC_XPATH))).alias("pos", "sitemap_url"))
    return locs.where(F.col("sitemap_url").contains(marker))


def crawl_frontier(index: DataFrame, sitemaps: DataFrame, marker: str = "post-sitemap",
                   stop_at_empty: bool = False) -> DataFrame:
    """S8 / U2 URLs of every selected sitemap, duplicates kept ->
    (index_url, pos, sitemap_url, url).  With ``stop_at_empty`` the sitemaps
    after the first one without URLs are left out (the original loop
    returned there); the window runs over one index (bounded)."""
    sel = sitemap_index_urls(index, marker)
    counts = sitemap_locs(sitemaps).groupBy("sitemap_url").agg(F.count(F.lit(1)).alias("n_urls"))
    sel = sel.join(counts, "sitemap_url", "left").withColumn("n_urls", F.coalesce("n_urls", F.lit(0)))
    if stop_at_empty:
        w = Window.partitionBy("index_url")
        sel = sel.withColumn("_first_empty", F.min(F.when(F.col("n_urls") == 0, F.col("pos"))).over(w))
        sel = sel.where(F.col("_first_empty").isNull() | (F.col("pos") < F.col("_first_empty")))
    urls = sitemap_locs(sitemaps).select("sitemap_url", F.col("url"))
    return sel.select("index_url", "pos", "sitemap_url").join(urls, "sitemap_url", "inner")
