"""Driver tables and the derived stand-in views the operators run on.

The reference works on crawled German news articles; the driver gives
``documents`` / ``labels`` / ``pages`` instead.  The views here derive an
article-shaped table from them with plain column expressions, so every
query's work grows with the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_LOADED: dict[tuple, DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table.  The DataFrame (schema and file listing) is
    reused within a session, so composite queries plan without re-reading
    footers; input tables are treated as immutable."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _LOADED:
        _LOADED[key] = spark.read.parquet(path)
    return _LOADED[key]


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` as it is, unless ``spark.wortlab.spreadPartitions`` asks for
    that many hash partitions of it (off by default: it shuffles the text;
    of use only for a few files of one row group each)."""
    n = int(df.sparkSession.conf.get("spark.wortlab.spreadPartitions", "0"))
    return df.repartition(n, key) if n else df


def documents_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as articles: article_id = doc_id, year = 2011 + doc_id % 15,
    topic = source (plus lang, text)."""
    docs = spread(load(spark, sf_dir, "documents"), "doc_id")
    return docs.select(F.col("doc_id").alias("article_id"),
                       (F.lit(2011) + F.col("doc_id") % 15).cast("int").alias("year"),
                       F.col("source").alias("topic"), "lang", "text")


def sentiment_label(toxic, quality):
    return (F.when(toxic == 1, "negative").when(quality == 1, "positive")
             .when(toxic.isNotNull(), "neutral"))


def label_columns(df: DataFrame, spark: SparkSession, sf_dir: str, id_col: str = "article_id") -> DataFrame:
    """Attach quality, toxic and the derived sentiment from ``labels``
    (at most one label row per document: the left join keeps the count).
    sentiment = negative (toxic), positive (quality), neutral (labelled,
    neither), null (unlabelled - real nulls for the profiling operators)."""
    labels = load(spark, sf_dir, "labels").select(F.col("doc_id").alias(id_col), "quality", "toxic")
    return (df.join(labels, id_col, "left")
              .withColumn("sentiment", sentiment_label(F.col("toxic"), F.col("quality"))))


def documents_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article stand-in with every column: ``documents`` left join ``labels``."""
    return label_columns(documents_base(spark, sf_dir), spark, sf_dir)


# fixed values: what the parser meets on German pages - an apostrophe in a
# quoted title, entities of every kind, white space around a title
OG_TITLE = """<meta property="og:title" content=" So geht's &amp; mehr: M&uuml;nchen ">"""
TITLE_START = "<title>\n  "
ARTICLE_START = "<article><p>M&uuml;nchen &#252;ber &ndash; Stra&szlig;e&nbsp;1 &#x2014; &amp;lt; &unbekannt; &euro; <a title=\"a>b\">x</a> &#150; &lsqb; &notit; a < b &amp</p>"


def decorated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the metadata the parser looks for (FIXTURES.md section 4).

    y = 2016 + page_id % 8; page_id % 4 = 0 -> meta published_time,
    1 -> JSON-LD datePublished, 2 -> url with /y/ and .html, 3 -> nothing;
    page_id % 5 = 0 -> og:title; content_type pdf when page_id % 10 = 7.
    """
    p = load(spark, sf_dir, "pages")
    y = (F.lit(2016) + F.col("page_id") % 8).cast("string")
    k = F.col("page_id") % 4
    meta = F.when(k == 0, F.concat(F.lit('<meta property="article:published_time" content="'),
                                   y, F.lit('-05-03T08:00:00">'))).otherwise(F.lit(""))
    ld = F.when(k == 1, F.concat(F.lit('<script type="application/ld+json">{"datePublished":"'),
                                 y, F.lit('-06-01T00:00:00"}</script>'))).otherwise(F.lit(""))
    og = F.when(F.col("page_id") % 5 == 0, F.lit(OG_TITLE)).otherwise(F.lit(""))
    head = F.concat(F.lit("<head>"), meta, ld, og)
    url = F.when(k == 2, F.concat(F.lit("https://www.example.com/"), y, F.lit("/a"),
                                  F.col("page_id").cast("string"), F.lit(".html"))).otherwise(F.col("url"))
    url = F.when(F.col("page_id") % 11 == 3, F.concat(url, F.lit("/bilder/1.jpg"))).otherwise(url)
    ctype = F.when(F.col("page_id") % 10 == 7, F.lit("application/pdf")) \
             .otherwise(F.lit("text/html; charset=utf-8"))
    return p.select("page_id", url.alias("url"), ctype.alias("content_type"),
                    F.replace(F.replace(F.replace(F.col("html"), F.lit("<head>"), head), F.lit("<title>"), F.lit(TITLE_START)),
                              F.lit("<article>"), F.lit(ARTICLE_START)).alias("html"))


SITEMAP_URLS = 50      # URLs per sitemap (the protocol allows 50,000; kept small here)
SITEMAPS_PER_INDEX = 50


def sitemap_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sitemap XML built from ``pages.url``.

    Sitemap s = page_id div 50 holds at most 50 URLs; it is a ``post-sitemap``
    unless s % 3 = 2 (then ``page-sitemap``).  Index i = s div 50 lists at most
    50 sitemaps.  Every XML text is aggregated over a group of bounded size, so
    no group grows with the data.  Returns (indexes, sitemaps), both with
    columns (sitemap_url, xml).
    """
    p = load(spark, sf_dir, "pages").select("page_id", "url")
    s = F.floor(F.col("page_id") / SITEMAP_URLS)
    loc = F.concat(F.lit("<url><loc>"), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")),
                   F.lit("</loc></url>"))
    sm = (p.select(s.alias("s"), F.struct("page_id", loc.alias("loc")).alias("e"))
          .groupBy("s")
          .agg(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>'
                              '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
                        F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda x: x["loc"]), ""),
                        F.lit("</urlset>")).alias("xml"))
          .select("s", sitemap_name(F.col("s")).alias("sitemap_url"), "xml"))
    idx = (sm.groupBy(F.floor(F.col("s") / SITEMAPS_PER_INDEX).alias("i"))
           .agg(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>'
                               '<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
                         F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "sitemap_url"))),
                                                  lambda u: F.concat(F.lit("<sitemap><loc>"), u["sitemap_url"],
                                                                     F.lit("</loc></sitemap>"))), ""),
                         F.lit("</sitemapindex>")).alias("xml"))
           .select(F.format_string("https://www.example.com/sitemap_index%d.xml", F.col("i").cast("int"))
                   .alias("sitemap_url"), "xml"))
    return idx, sm.drop("s")


def sitemap_name(s):
    s = s.cast("int")
    return F.when(s % 3 == 2, F.format_string("https://www.example.com/page-sitemap%d.xml", s)) \
            .otherwise(F.format_string("https://www.example.com/post-sitemap%d.xml", s))
