"""Registered source / sink and resume queries (S1-S5, S11, S12, J2, J3,
U1, U4, T6, W1, W2, C1).  Round trips write into a fresh folder under the
session's shared checkpoint folder and read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incremental as I
from ..operators import stats as S
from ..operators.order_stats import batch_number, row_ids
from ..plans.articles import loanword_articles
from ..plans.crawl import crawl_resume, fresh_dir
from ..plans.pages import parse_pages
from ..session import ensure_checkpoint_dir
from ..sources import files as FS
from ..sources.tables import decorated_pages, documents_base, load, spread
from . import finish, query
from .sqlparts import DPAGES, PARSED, r, with_articles


def _scratch(spark, name):
    return fresh_dir(ensure_checkpoint_dir(spark), name)


_ART_SCHEMA = ("page_id BIGINT, url STRING, source_site STRING, domain STRING, date STRING, year INT, text STRING, "
               "headline STRING, word_count INT, paragraphs INT")


def _built(spark, sf_dir):
    return parse_pages(spread(decorated_pages(spark, sf_dir), "page_id"))


@query("read_articles_csv", f"WITH {DPAGES},\n{PARSED}\nSELECT * FROM built_articles")
def read_articles_csv(spark, sf_dir):
    """S1 article table through an own CSV (quotes, line ends escaped) and
    back under an explicit schema."""
    path = _scratch(spark, "articles-csv")
    FS.write_articles_csv(_built(spark, sf_dir), path)
    return FS.read_articles_csv(spark, path, _ART_SCHEMA)


@query("read_foreign_csv", f"WITH {DPAGES},\n{PARSED}\nSELECT * FROM built_articles")
def read_foreign_csv(spark, sf_dir):
    """S1 the article table as another program writes it (line ends inside
    quoted cells), taken to Parquet once."""
    path, table = _scratch(spark, "foreign-csv"), _scratch(spark, "foreign-parquet")
    FS.write_chart_csv(_built(spark, sf_dir), path, single_file=False)
    return FS.foreign_csv_to_parquet(spark, path, _ART_SCHEMA, table)


@query("write_chart_csv", with_articles(f"""
SELECT year, {r('avg(loanword_density)', 'loanword_density')} FROM articles WHERE year IS NOT NULL GROUP BY year"""))
def write_chart_csv(spark, sf_dir):
    """S2 a chart table written as one CSV with header, read back."""
    path = _scratch(spark, "chart-csv")
    FS.write_chart_csv(finish(S.group_mean(loanword_articles(spark, sf_dir), "year", "loanword_density")), path)
    return FS.read_foreign_csv(spark, path, "year INT, loanword_density DOUBLE")


@query("append_results", f"WITH {DPAGES},\n{PARSED}\nSELECT * FROM built_articles")
def append_results(spark, sf_dir):
    """S3 two appends to one result table = their union."""
    path = _scratch(spark, "append")
    b = _built(spark, sf_dir)
    FS.append_results(b.where(F.col("page_id") % 2 == 0), path)
    FS.append_results(b.where(F.col("page_id") % 2 == 1), path)
    return FS.read_results(spark, path, _ART_SCHEMA)


@query("read_url_list", "SELECT url FROM pages")
def read_url_list(spark, sf_dir):
    """S4 URL text with padding and blank lines -> trimmed URLs."""
    path = _scratch(spark, "urls-txt")
    p = load(spark, sf_dir, "pages")
    lines = p.select(F.explode(F.array(F.concat(F.lit("  "), F.col("url"), F.lit("\t ")), F.lit(""))).alias("value"))
    lines.write.text(path)
    return FS.read_url_list(spark, path)


@query("write_url_list", "SELECT url FROM pages WHERE CAST(floor(page_id / 50) AS BIGINT) % 3 <> 2")
def write_url_list(spark, sf_dir):
    """S5 append the frontier URLs of each sitemap to a text folder."""
    from ..sources import sitemaps as SM
    from ..sources.tables import sitemap_tables
    path = _scratch(spark, "frontier-txt")
    idx, sms = sitemap_tables(spark, sf_dir)
    front = SM.crawl_frontier(idx, sms)
    FS.write_url_list(front.where(F.col("pos") % 2 == 0), path)
    FS.write_url_list(front.where(F.col("pos") % 2 == 1), path)
    return FS.read_url_list(spark, path)


@query("load_progress", with_articles("""
SELECT article_id, coalesce(array_to_string(list(word ORDER BY pos), ' '), '') AS refined_loanwords
FROM articles LEFT JOIN loantok USING (article_id) GROUP BY article_id"""))
def load_progress(spark, sf_dir):
    """S11 a progress CSV with list columns written as JSON text, decoded."""
    path = _scratch(spark, "progress-csv")
    a = loanword_articles(spark, sf_dir, with_lists=True)
    prog = a.select("article_id", F.array().cast("array<string>").alias("excluded_loanwords"),
                    F.col("loanwords").alias("refined_loanwords"))
    FS.write_articles_csv(prog, path)
    back = FS.load_progress(spark, path)
    return back.select(F.col("article_id").cast("bigint").alias("article_id"),
                       F.array_join("refined_loanwords", " ").alias("refined_loanwords"))


# fixed values: chart colours per sentiment (a literal lookup table)
SENTIMENT_COLOURS = [("negative", "#d62728"), ("neutral", "#7f7f7f"), ("positive", "#2ca02c")]


@query("literal_table", with_articles(f"""
SELECT sentiment, {r('avg(loanword_density)', 'loanword_density')}, colour
FROM articles JOIN (VALUES {', '.join(f"('{s}', '{c}')" for s, c in SENTIMENT_COLOURS)}) t(sentiment, colour) USING (sentiment)
GROUP BY sentiment, colour"""))
def literal_table(spark, sf_dir):
    """S12 a literal lookup table (sentiment -> colour) joined to the means."""
    lit = spark.createDataFrame(SENTIMENT_COLOURS, "sentiment string, colour string")
    means = S.group_mean(loanword_articles(spark, sf_dir), "sentiment", "loanword_density")
    return finish(means.join(F.broadcast(lit), "sentiment"))   # 3 literal rows


_URLS_SQL = "urls AS (SELECT url FROM pages UNION ALL SELECT url FROM pages WHERE page_id % 7 = 0)"


def _urls(spark, sf_dir):
    p = load(spark, sf_dir, "pages")
    return p.select("url").unionByName(p.where(F.col("page_id") % 7 == 0).select("url"))


def _done_pages(spark, sf_dir):
    p = load(spark, sf_dir, "pages").where(F.col("page_id") % 3 == 0).select("url")
    return p.unionByName(p)          # a done key listed twice must not duplicate anything


@query("skip_done_urls", f"WITH {_URLS_SQL} SELECT url FROM urls WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def skip_done_urls(spark, sf_dir):
    """J2 input URLs (with duplicates) minus the done URLs."""
    return I.skip_done_urls(_urls(spark, sf_dir), _done_pages(spark, sf_dir))


@query("skip_done_bucketed", f"WITH {_URLS_SQL} SELECT url FROM urls WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def skip_done_bucketed(spark, sf_dir):
    """J2 / U4 the same against a kept table of done URLs, bucketed by the
    URL and appended to twice: the resume has no exchange of the done side."""
    path = _scratch(spark, "done-urls")
    keys = I.DoneKeys(spark, "wortlab_" + path.rsplit("/", 1)[-1].replace("-", "_"), path, "url", "string")
    done = _done_pages(spark, sf_dir)
    keys.append(done.where(F.crc32("url") % 2 == 0))
    keys.append(done.where(F.crc32("url") % 2 == 1))
    return I.skip_done_urls(_urls(spark, sf_dir), keys.read())


@query("distinct_keys", "SELECT DISTINCT url FROM pages WHERE page_id % 3 = 0")
def distinct_keys(spark, sf_dir):
    """U4 set of processed keys."""
    return I.distinct_keys(_done_pages(spark, sf_dir), "url")


@query("skip_done_ids", """SELECT doc_id AS article_id, source AS topic FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 4 = 1)""")
def skip_done_ids(spark, sf_dir):
    """J3 articles whose id is not processed (null-safe anti join)."""
    docs = documents_base(spark, sf_dir).select("article_id", "topic")
    done = docs.where(F.col("article_id") % 4 == 1).select("article_id")
    return I.skip_done_ids(docs, done, "article_id")


@query("limit_work", """SELECT doc_id AS article_id FROM documents WHERE doc_id % 4 <> 1 ORDER BY doc_id LIMIT 5""")
def limit_work(spark, sf_dir):
    """T6 the first 5 unprocessed articles by id."""
    docs = documents_base(spark, sf_dir).select("article_id")
    todo = I.skip_done_ids(docs, docs.where(F.col("article_id") % 4 == 1), "article_id")
    return I.limit_work(todo, "article_id", 5)


@query("merge_progress", """SELECT doc_id AS article_id, source AS topic, NULL::VARCHAR AS lang FROM documents WHERE doc_id % 4 = 1
UNION ALL SELECT doc_id AS article_id, NULL::VARCHAR AS topic, lang FROM documents WHERE doc_id % 4 <> 1""")
def merge_progress(spark, sf_dir):
    """U1 earlier progress + new rows, by name, missing columns null."""
    docs = documents_base(spark, sf_dir)
    old = docs.where(F.col("article_id") % 4 == 1).select("article_id", "topic")
    new = docs.where(F.col("article_id") % 4 != 1).select("article_id", "lang")
    return I.merge_progress(old, new)


@query("add_row_id", """SELECT doc_id AS article_id, source AS topic, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents""")
def add_row_id(spark, sf_dir):
    """W1 dense 0-based ids in id order, without a one-task window."""
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"), F.col("source").alias("topic"), "n_chars")
    return row_ids(docs, ["article_id"], "row_id")


@query("batch_slices", """SELECT doc_id AS article_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 50) AS BIGINT) AS batch
FROM documents""")
def batch_slices(spark, sf_dir):
    """W2 consecutive batches of 50 rows."""
    docs = documents_base(spark, sf_dir).select("article_id")
    return row_ids(docs, ["article_id"], "row_id").select("article_id", batch_number("row_id", 50).alias("batch"))


@query("crawl_resume", f"WITH {DPAGES},\n{PARSED}\nSELECT url, headline, word_count FROM built_articles")
def crawl_resume_q(spark, sf_dir):
    """C1 crawl in two runs: the first dies after a third of the URLs, the
    second resumes; the result equals one complete run."""
    path = _scratch(spark, "crawl")
    pages = spread(decorated_pages(spark, sf_dir), "page_id")
    urls = pages.select("url")
    crawl_resume(spark, urls.where(F.crc32("url") % 3 == 0), pages, path)     # interrupted first run
    crawl_resume(spark, urls, pages, path)                                     # resumed run
    return spark.read.parquet(path).select("url", "headline", "word_count")


@query("collect_urls", "SELECT url FROM pages WHERE CAST(floor(page_id / 50) AS BIGINT) % 3 <> 2")
def collect_urls(spark, sf_dir):
    """U2 URL lists of the selected sitemaps concatenated (union all)."""
    from functools import reduce
    from ..sources import sitemaps as SM
    from ..sources.tables import sitemap_tables
    idx, sms = sitemap_tables(spark, sf_dir)
    locs = SM.sitemap_locs(sms)
    chosen = SM.sitemap_index_urls(idx).select("sitemap_url")
    parts = [locs.where(F.col("pos") % 2 == k).join(chosen, "sitemap_url", "left_semi").select("url") for k in (0, 1)]
    return reduce(lambda a, b: a.unionAll(b), parts)
