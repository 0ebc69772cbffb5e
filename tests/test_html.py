from wortlab.functions import html as H
from wortlab.operators import filters as FL


def test_paragraphs_and_text(spark):
    df = spark.createDataFrame([('<p>a<p>b <b>c</b></p><script>"</p><p>"</script><p>d &amp;lt; e',)], "html string")
    r = df.select(H.paragraph_count("html").alias("n"), H.paragraph_text(H.paragraphs("html")).alias("t")).first()
    assert r.n == 3 and r.t == "a b c d &lt; e"


def test_meta_and_jsonld_dates(spark):
    rows = [('<meta property="article:published_time" content="2021-03-04T05:06">',),
            ('<meta property="article:published_time">',), ("<p>x",)]
    got = [r.v for r in spark.createDataFrame(rows, "html string").select(H.meta_date("html").alias("v")).collect()]
    assert got == ["2021-03-04", "", None]
    rows = [('<script type="application/ld+json">{"datePublished":"2020-01-02T00:00"}</script>',),
            ('<script type="application/ld+json">{bad</script><script type="application/ld+json">{"datePublished":"2019-01-01"}</script>',),
            ('<script type="application/ld+json">[{"datePublished":"2020-01-02"}]</script>',)]
    got = [r.v for r in spark.createDataFrame(rows, "html string").select(H.jsonld_date("html").alias("v")).collect()]
    assert got == ["2020-01-02", "2019-01-01", None]


def test_url_year_and_authority(spark):
    rows = [("/2019/x",), ("/1999/x",), ("/20190/x",)]
    got = [r.v for r in spark.createDataFrame(rows, "u string").select(H.url_year("u").alias("v")).collect()]
    assert got == ["2019", None, None]
    r = spark.createDataFrame([("https://www.a.de:80/x",)], "u string").select(
        H.url_authority("u").alias("a"), H.source_site(H.url_authority("u")).alias("s"),
        H.domain_label(H.url_authority("u")).alias("d")).first()
    assert (r.a, r.s, r.d) == ("www.a.de:80", "a.de:80", "www")


def test_headline_chain(spark):
    rows = [('<meta property="og:title" content=" OG "><title>T</title>',),
            ('<meta property="og:title" content=""><title>T &amp; U</title>',),
            ("<h1>only <b>h</b></h1>",), ("<p>nothing</p>",)]
    got = [r.v for r in spark.createDataFrame(rows, "html string").select(H.headline("html").alias("v")).collect()]
    assert got == ["OG", "T & U", "only h", None]


def test_year_rule(spark):
    rows = [("2019-05-03",), ("2019",), ("Mai 2019",), (None,)]
    got = [r.v for r in spark.createDataFrame(rows, "d string").select(H.year_of("d").alias("v")).collect()]
    assert got == [2019, 2019, None, None]


def test_url_filters(spark):
    urls = spark.createDataFrame([(u,) for u in ["https://a.de/x.html", "https://a.de/x", "https://a.de/bilder/x.html",
                                                 "https://a.de/x.jpg.html", "https://a.de/video/x.html"]], "url string")
    kept = {r.url for r in FL.filter_article_urls_suffix(urls).collect()}
    assert kept == {"https://a.de/x.html"}
    as_published = {r.url for r in FL.filter_article_urls_suffix(urls, non_article=FL.NON_ARTICLE_AS_PUBLISHED).collect()}
    assert "https://a.de/video/x.html" in as_published
    urls2 = spark.createDataFrame([(u,) for u in ["https://a.de/x", "https://b.de/x", "https://a.de/live/x"]], "url string")
    assert {r.url for r in FL.filter_article_urls_prefix(urls2, "https://a.de/").collect()} == {"https://a.de/x"}


def test_entities_and_quotes(spark):
    rows = [('<meta property="og:title" content="Fahrrad-Trend: So geht\'s richtig">', "Fahrrad-Trend: So geht's richtig"),
            ("<meta property='og:title' content='Sie sagt \"ja\" &amp; geht'>", 'Sie sagt "ja" & geht'),
            ("<title>\n  Neue Wege\n</title>", "Neue Wege"), ("<title>&lt;b&gt; M&uuml;nchen</title>", "<b> München")]
    got = spark.createDataFrame(rows, "html string, want string").select(H.headline("html").alias("v"), "want").collect()
    assert [r.v for r in got] == [r.want for r in got]
    texts = [("M&uuml;nchen &#252;ber &ndash; Stra&szlig;e", "München über – Straße"), ("a&nbsp;b", "a b"), ("&amp;lt; &#x1F600; &unbekannt; & &;", "&lt; 😀 &unbekannt; & &;"),
             ("&#0;&#xD800;&#1114112;", "���"), ("", ""), ("kein", "kein"), (None, None)]
    got = spark.createDataFrame(texts, "t string, want string").select(H.decode_entities("t").alias("v"), "want").collect()
    assert [r.v for r in got] == [r.want for r in got]


def test_blank_text_and_list_items(spark):
    from wortlab.functions.text import split_csv_list

    assert FL.filter_non_empty_text(spark.createDataFrame([("\n\n\t ",), ("x",)], "text string")).count() == 1
    assert spark.createDataFrame([("a,\t,\n b\n,",)], "c string").select(split_csv_list("c").alias("v")).first().v == ["a", "b"]


def test_media_pages_are_no_articles(spark):
    from wortlab.plans.pages import parse_pages

    html = "<p>eins</p>" * 5
    pages = spark.createDataFrame([(1, "https://a.de/x", html), (2, "https://a.de/bilder/x.jpg", html), (3, "https://a.de/video/x", html), (4, "https://b.de/x", html)],
                                  "page_id long, url string, html string")
    assert {r.page_id for r in parse_pages(pages).collect()} == {1, 4}
    assert {r.page_id for r in parse_pages(pages, "https://a.de/").collect()} == {1}


def test_tags_and_references_as_a_parser_reads_them(spark):
    rows = [('<p><a title="a>b">x</a> &#150; &lsqb; &starf; &amp no', "x \u2013 [ \u2605 & no"),
            ("<p class='1>0' id=it's>eins</p><p data-x=\"<p>\">zwei", "eins zwei"),
            ('<p title="offen>drei<b>!</b>', "drei!"), ("<p>a < b > c <!-- x > y --> </3>", "a < b > c  "),
            ("<p>&notin; &notit; &ampx; &lsqb &euro &NotEqualTilde;", "\u2209 \u00acit; &x; &lsqb &euro \u2242\u0338"),
            ("<p>&#x80;&#0000065&#x00041;&#99999999999;&#129;", "\u20acAA\ufffd\x81"), ("<p a = 'x' b==c d=>k<br/>", "k")]
    got = spark.createDataFrame(rows, "h string, want string").select(H.paragraph_text(H.paragraphs("h")).alias("v"), "want").collect()
    assert [r.v for r in got] == [r.want for r in got]


def test_every_name_as_the_standard_library_reads_it(spark):
    import html
    from html.entities import html5

    texts = [(f"a &{n} b",) for n in html5] + [(f"&{n}x;",) for n in html5] + [(f"&{n.rstrip(';')}",) for n in html5]
    got = spark.createDataFrame(texts, "t string").select("t", H.decode_entities("t").alias("v")).collect()
    assert [r.v for r in got] == [html.unescape(r.t) for r in got]


def test_a_long_or_broken_tag_is_scanned_once(spark):
    attributes = " ".join(f'a{i}="{i}"' for i in range(3000))
    rows = [(f"<p><a {attributes}>x</a>", "x"), (f"<p>y<a {attributes}", f"y<a {attributes}")]
    got = spark.createDataFrame(rows, "h string, want string").select(H.paragraph_text(H.paragraphs("h")).alias("v"), "want").collect()
    assert [r.v for r in got] == [r.want for r in got]
