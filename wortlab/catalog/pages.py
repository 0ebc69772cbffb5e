"""Registered queries over crawled pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..operators import filters as FL
from ..plans.pages import parse_pages
from ..sources import sitemaps as SM
from ..sources.tables import decorated_pages, load, sitemap_name, sitemap_tables, spread
from . import query
from .sqlparts import (DPAGES, PARSED, _q, authority_sql, date_sql, headline_sql, jsonld_date_sql, meta_date_sql,
                       paragraphs_sql, strip_sql, text_sql, url_year_sql)


def _pages(spark, sf_dir):
    return spread(decorated_pages(spark, sf_dir), "page_id")


def _w(body: str) -> str:
    return f"WITH {DPAGES}\n{body}"


def _wp(body: str) -> str:
    return f"WITH {DPAGES},\n{PARSED}\n{body}"


@query("pages_source", "SELECT page_id, url, length(html) AS html_chars FROM pages")
def pages_source(spark, sf_dir):
    """S9 raw HTML per URL as parser input (the fetch itself is not built)."""
    return load(spark, sf_dir, "pages").select("page_id", "url", F.length("html").alias("html_chars"))


@query("html_paragraphs", _w(f"""SELECT page_id, pos, p AS paragraph FROM (
  SELECT page_id, generate_subscripts(ps, 1) - 1 AS pos, unnest(ps) AS p FROM (SELECT page_id, {paragraphs_sql('html')} AS ps FROM dpages))"""))
def html_paragraphs(spark, sf_dir):
    """H1 every <p> element in document order -> (page_id, pos, paragraph)."""
    return _pages(spark, sf_dir).select("page_id", F.posexplode(H.paragraphs("html")).alias("pos", "paragraph"))


@query("html_paragraph_count", _w(f"SELECT page_id, CAST(len({paragraphs_sql('html')}) AS INTEGER) AS paragraphs FROM dpages"))
def html_paragraph_count(spark, sf_dir):
    """H2 number of paragraphs per page."""
    return _pages(spark, sf_dir).select("page_id", H.paragraph_count("html").alias("paragraphs"))


@query("html_text", _w(f"SELECT page_id, {text_sql(paragraphs_sql('html'))} AS text FROM dpages"))
def html_text(spark, sf_dir):
    """H3 paragraph texts, tags stripped, entities decoded, joined by a space."""
    return _pages(spark, sf_dir).select("page_id", H.paragraph_text(H.paragraphs("html")).alias("text"))


def _field(name, doc, spark_expr, sql_expr):
    @query(name, _w(f"SELECT page_id, {sql_expr} AS {name} FROM dpages"))
    def fn(spark, sf_dir):
        return _pages(spark, sf_dir).select("page_id", spark_expr().alias(name))
    fn.__doc__ = doc
    fn.__name__ = name
    return fn


_field("html_meta_date", "H4 article:published_time date", lambda: H.meta_date("html"), meta_date_sql("html"))
_field("html_jsonld_date", "H5 JSON-LD datePublished", lambda: H.jsonld_date("html"), jsonld_date_sql("html"))
_field("url_year", "H6 /20dd/ in the URL", lambda: H.url_year("url"), url_year_sql("url"))
_field("html_headline", "H7 og:title, title, h1", lambda: H.headline("html"), headline_sql("html"))
_field("article_date", "H8 date fallback chain", lambda: H.article_date("html", "url"), date_sql("html", "url"))
_field("article_year", "H9 leading number of the date", lambda: H.year_of(H.article_date("html", "url")),
       f"TRY_CAST(split_part({date_sql('html', 'url')}, '-', 1) AS INTEGER)")
_field("url_authority", "H10 URL network location", lambda: H.url_authority("url"), authority_sql("url"))
_field("source_site", "H11 authority without www.", lambda: H.source_site(H.url_authority("url")),
       f"replace({authority_sql('url')}, 'www.', '')")
_field("domain_label", "H12 first label of the authority", lambda: H.domain_label(H.url_authority("url")),
       f"split_part({authority_sql('url')}, '.', 1)")


def _contains_any_sql(col, parts):
    return " OR ".join(f"contains({col}, {_q(p)})" for p in parts)


@query("filter_article_urls_suffix", _w(f"""SELECT page_id, url FROM dpages
WHERE ends_with(url, 'html') AND NOT ({_contains_any_sql('url', FL.NON_ARTICLE)})"""))
def filter_article_urls_suffix(spark, sf_dir):
    """F1 URL ends with html and is no media / video page."""
    return FL.filter_article_urls_suffix(decorated_pages(spark, sf_dir).select("page_id", "url"))


@query("filter_article_urls_prefix", _w(f"""SELECT page_id, url FROM dpages
WHERE starts_with(url, 'https://www.example.com/') AND NOT ({_contains_any_sql('url', FL.NON_ARTICLE + FL.NON_ARTICLE_V2_EXTRA)})"""))
def filter_article_urls_prefix(spark, sf_dir):
    """F2 URL starts with the site prefix (a parameter) and is no media page."""
    return FL.filter_article_urls_prefix(decorated_pages(spark, sf_dir).select("page_id", "url"),
                                         "https://www.example.com/")


@query("filter_content_type", _w("SELECT page_id FROM dpages WHERE contains(coalesce(content_type, ''), 'text/html')"))
def filter_content_type(spark, sf_dir):
    """F5 only HTML responses."""
    return FL.filter_content_type(decorated_pages(spark, sf_dir)).select("page_id")


@query("filter_min_paragraphs", _w(f"SELECT page_id FROM dpages WHERE len({paragraphs_sql('html')}) >= 5"))
def filter_min_paragraphs(spark, sf_dir):
    """F3 at least 5 paragraphs."""
    p = _pages(spark, sf_dir).select("page_id", H.paragraph_count("html").alias("paragraphs"))
    return FL.filter_min_paragraphs(p).select("page_id")


@query("filter_non_empty_text", _w(f"SELECT page_id FROM dpages WHERE {strip_sql(text_sql(paragraphs_sql('html')))} <> ''"))
def filter_non_empty_text(spark, sf_dir):
    """F4 non-empty paragraph text."""
    p = _pages(spark, sf_dir).select("page_id", H.paragraph_text(H.paragraphs("html")).alias("text"))
    return FL.filter_non_empty_text(p).select("page_id")


@query("build_articles", _wp("SELECT * FROM built_articles"))
def build_articles(spark, sf_dir):
    """H13 the 9-column article table from crawled pages (plus page_id)."""
    return parse_pages(_pages(spark, sf_dir))


# ---------------------------------------------------------------- sitemaps

def _sm_name_sql(s: str) -> str:
    return (f"CASE WHEN {s} % 3 = 2 THEN 'https://www.example.com/page-sitemap' || CAST({s} AS VARCHAR) || '.xml' "
            f"ELSE 'https://www.example.com/post-sitemap' || CAST({s} AS VARCHAR) || '.xml' END")


_SM = f"sm AS (SELECT page_id, url, CAST(floor(page_id / 50) AS BIGINT) AS s FROM pages)"


@query("sitemap_article_urls", f"WITH {_SM} SELECT {_sm_name_sql('s')} AS sitemap_url, url FROM sm")
def sitemap_article_urls(spark, sf_dir):
    """S7 every <loc> of every sitemap."""
    _, sms = sitemap_tables(spark, sf_dir)
    return SM.sitemap_locs(sms).select("sitemap_url", "url")


@query("sitemap_index_urls", f"""WITH {_SM} SELECT DISTINCT 'https://www.example.com/sitemap_index' || CAST(CAST(floor(s / 50) AS BIGINT) AS VARCHAR) || '.xml' AS index_url,
  {_sm_name_sql('s')} AS sitemap_url FROM sm WHERE s % 3 <> 2""")
def sitemap_index_urls(spark, sf_dir):
    """S6 sitemaps of the index whose URL contains post-sitemap."""
    idx, _ = sitemap_tables(spark, sf_dir)
    return SM.sitemap_index_urls(idx).select("index_url", "sitemap_url")


@query("crawl_frontier", f"WITH {_SM} SELECT {_sm_name_sql('s')} AS sitemap_url, url FROM sm WHERE s % 3 <> 2")
def crawl_frontier(spark, sf_dir):
    """S8 / U2 URLs of the selected sitemaps, concatenated (duplicates kept)."""
    idx, sms = sitemap_tables(spark, sf_dir)
    return SM.crawl_frontier(idx, sms, stop_at_empty=True).select("sitemap_url", "url")
