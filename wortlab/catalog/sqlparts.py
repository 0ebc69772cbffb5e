"""DuckDB SQL building blocks shared by the oracle statements.  They spell
out the same rules as the Spark operators, table by table."""

from __future__ import annotations

from ..functions.text import ALPHA_WORD, EDGE_PUNCT, WHITESPACE, spark_stop_words


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP_LIST = ", ".join(_q(w) for w in spark_stop_words("german"))
P = 9  # rounding places, as catalog.PLACES


def r(expr: str, alias: str, places: int = P) -> str:
    return f"round(CAST({expr} AS DOUBLE), {places}) AS {alias}"


DOC = f"""doc AS (
  SELECT d.doc_id AS article_id, CAST(2011 + d.doc_id % 15 AS INTEGER) AS year,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
              WHEN l.toxic IS NOT NULL THEN 'neutral' END AS sentiment,
         d.source AS topic, d.lang, d.text, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

WTOK = f"""wtok AS (
  SELECT article_id, lang, list_filter(regexp_split_to_array(coalesce(text, ''), '{WHITESPACE}'), lambda x: x <> '') AS toks
  FROM doc)"""

CAND = f"""cand AS (
  SELECT article_id, lang, pos, lower(tok) AS word FROM (
    SELECT article_id, lang, generate_subscripts(toks, 1) - 1 AS pos,
           regexp_replace(unnest(toks), '{EDGE_PUNCT}', '', 'g') AS tok FROM wtok)
  WHERE regexp_matches(tok, '{ALPHA_WORD}') AND lower(tok) NOT IN ({STOP_LIST}))"""

LEX = """lex AS (SELECT word FROM cand WHERE lang = 'en' GROUP BY word HAVING count(*) >= 2)"""

LOANTOK = """loantok AS (SELECT c.article_id, c.pos, c.word FROM cand c SEMI JOIN lex USING (word) WHERE c.lang = 'de')"""

ARTICLES = """articles AS (
  SELECT d.article_id, d.year, d.sentiment, d.topic, d.quality, d.toxic,
         CAST(len(w.toks) AS INTEGER) AS word_count,
         CAST(coalesce(lw.n, 0) AS BIGINT) AS loanword_count,
         round(CASE WHEN len(w.toks) = 0 THEN 0.0 ELSE coalesce(lw.n, 0) / len(w.toks) END, 4) AS loanword_density
  FROM doc d JOIN wtok w USING (article_id)
  LEFT JOIN (SELECT article_id, count(*) AS n FROM loantok GROUP BY 1) lw USING (article_id)
  WHERE d.lang = 'de')"""

ARTICLE_CTES = ",\n".join([DOC, WTOK, CAND, LEX, LOANTOK, ARTICLES])


def with_articles(body: str) -> str:
    return f"WITH {ARTICLE_CTES}\n{body}"


# ---------------------------------------------------------------- pages
from ..functions import html as _H  # noqa: E402
from ..operators import filters as _F  # noqa: E402
from ..sources import tables as _T  # noqa: E402


_NAMED = "MAP {" + ", ".join(f"{_q(k)}: {_q(v)}" for k, v in _H.ENTITIES.items()) + "}"


def decode(expr: str) -> str:
    """Character references: the same table and rules as ``functions.html``, spelled out."""
    found, parts = f"regexp_extract_all({expr}, {_q(_H.ENTITY_RE)}, 1)", f"regexp_split_to_array({expr}, {_q(_H.ENTITY_RE)})"
    point = "coalesce(TRY_CAST(CASE WHEN e ILIKE '#x%' THEN '0x' || rtrim(e, ';')[3:] ELSE rtrim(e, ';')[2:] END AS INTEGER), 0)"
    number = (f"CASE WHEN {point} BETWEEN 128 AND 159 THEN {_q(_H.WINDOWS_POINTS)}[{point} - 127] "
              f"WHEN {point} <= 0 OR {point} > 1114111 OR {point} BETWEEN 55296 AND 57343 THEN chr(65533) ELSE chr({point}) END")
    old = f"regexp_extract(e, {_q(_H.OLD_NAME_RE)}, 0)"
    one = (f"CASE WHEN e IS NULL THEN '' WHEN e LIKE '#%' THEN {number} "
           f"ELSE coalesce(CASE WHEN e LIKE '%;' THEN names[rtrim(e, ';')] END, "
           f"CASE WHEN {old} <> '' THEN names[{old}] || e[length({old}) + 1:] END, '&' || e) END")
    pieces = f"list_transform(list_zip({parts}, {found}), lambda z: z[1] || list_transform([z[2]], lambda e: {one})[1])"
    return f"array_to_string({pieces}, '')".replace("names[", f"({_NAMED})[")


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^[\\s\\x{{85}}\\p{{Z}}]+|[\\s\\x{{85}}\\p{{Z}}]+$', '', 'g')"


DPAGES = f"""dpages AS (
  SELECT page_id,
         CASE WHEN page_id % 4 = 2 THEN 'https://www.example.com/' || y || '/a' || CAST(page_id AS VARCHAR) || '.html' ELSE url END
           || CASE WHEN page_id % 11 = 3 THEN '/bilder/1.jpg' ELSE '' END AS url,
         CASE WHEN page_id % 10 = 7 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END AS content_type,
         replace(replace(replace(html, '<head>', '<head>'
           || CASE WHEN page_id % 4 = 0 THEN '<meta property="article:published_time" content="' || y || '-05-03T08:00:00">' ELSE '' END
           || CASE WHEN page_id % 4 = 1 THEN '<script type="application/ld+json">{{"datePublished":"' || y || '-06-01T00:00:00"}}</script>' ELSE '' END
           || CASE WHEN page_id % 5 = 0 THEN {_q(_T.OG_TITLE)} ELSE '' END), '<title>', {_q(_T.TITLE_START)}), '<article>', {_q(_T.ARTICLE_START)}) AS html
  FROM (SELECT *, CAST(2016 + page_id % 8 AS VARCHAR) AS y FROM pages))"""


def _re2(pattern: str) -> str:
    return pattern.replace("*+", "*")


def paragraphs_sql(html: str) -> str:
    clean = f"regexp_replace(coalesce({html}, ''), {_q(_H.DROP_RE)}, '', 'g')"
    return (f"list_transform(regexp_split_to_array({clean}, {_q(_re2(_H.P_OPEN_RE))})[2:], "
            f"lambda p: regexp_replace(p, {_q(_H.P_END_RE)}, ''))")


def strip_tags_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {_q(_re2(_H.TAG_RE))}, '', 'g')"


def text_sql(ps: str) -> str:
    return f"array_to_string(list_transform({ps}, lambda p: {decode(strip_tags_sql('p'))}), ' ')"


def content_sql(tag: str) -> str:
    return f"coalesce(nullif(regexp_extract({tag}, {_q(_H.CONTENT_DOUBLE_RE)}, 1), ''), regexp_extract({tag}, {_q(_H.CONTENT_SINGLE_RE)}, 1))"


def meta_date_sql(html: str) -> str:
    tag = f"regexp_extract({html}, {_q(_H.META_DATE_TAG_RE)}, 0)"
    return f"CASE WHEN {tag} <> '' THEN split_part({content_sql(tag)}, 'T', 1) END"


def jsonld_date_sql(html: str) -> str:
    bodies = f"regexp_extract_all({html}, {_q(_H.JSONLD_RE)}, 1)"
    dates = (f"list_filter(list_transform({bodies}, lambda b: CASE WHEN starts_with(trim(b), '{{') AND json_valid(b) "
             f"THEN json_extract_string(b, '$.datePublished') END), lambda d: d IS NOT NULL)")
    return f"split_part({dates}[1], 'T', 1)"


def url_year_sql(url: str) -> str:
    return f"nullif(regexp_extract({url}, {_q(_H.URL_YEAR_RE)}, 1), '')"


def headline_sql(html: str) -> str:
    og_tag = f"regexp_extract({html}, {_q(_H.OG_TITLE_TAG_RE)}, 0)"
    og_c = content_sql(og_tag)
    strip = lambda e: strip_sql(decode(strip_tags_sql(e)))
    title = f"CASE WHEN regexp_matches({html}, {_q(_H.TITLE_RE)}) THEN {strip(f'regexp_extract({html}, {_q(_H.TITLE_RE)}, 1)')} END"
    h1 = f"CASE WHEN regexp_matches({html}, {_q(_H.H1_RE)}) THEN {strip(f'regexp_extract({html}, {_q(_H.H1_RE)}, 1)')} END"
    return f"coalesce(CASE WHEN {og_c} <> '' THEN {strip_sql(decode(og_c))} END, {title}, {h1})"


def authority_sql(url: str) -> str:
    return f"regexp_extract({url}, {_q(_H.AUTHORITY_RE)}, 1)"


def date_sql(html: str, url: str) -> str:
    return f"coalesce(nullif({meta_date_sql(html)}, ''), nullif({jsonld_date_sql(html)}, ''), {url_year_sql(url)})"


def words_sql(text: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({text}, ''), '{WHITESPACE}'), lambda x: x <> ''))"


PARSED = f"""parsed AS (
  SELECT page_id, url, html, paragraphs AS _ps, len(paragraphs) AS paragraphs FROM (
    SELECT page_id, url, html, {paragraphs_sql('html')} AS paragraphs FROM dpages
    WHERE contains(coalesce(content_type, ''), 'text/html') AND starts_with(url, 'http')
      AND NOT ({' OR '.join(f"contains(url, {_q(x)})" for x in _F.NON_ARTICLE + _F.NON_ARTICLE_V2_EXTRA)}))
  WHERE len(paragraphs) >= 5),
texted AS (SELECT *, {text_sql('_ps')} AS text FROM parsed WHERE {strip_sql(text_sql('_ps'))} <> ''),
built AS (
  SELECT page_id, url, replace({authority_sql('url')}, 'www.', '') AS source_site,
         split_part({authority_sql('url')}, '.', 1) AS domain, {date_sql('html', 'url')} AS date,
         TRY_CAST(split_part({date_sql('html', 'url')}, '-', 1) AS INTEGER) AS year,
         text, {headline_sql('html')} AS headline, CAST({words_sql('text')} AS INTEGER) AS word_count,
         CAST(paragraphs AS INTEGER) AS paragraphs
  FROM texted),
built_articles AS (SELECT * FROM built WHERE date IS NULL OR date = '' OR year IS NOT NULL)"""


# ---------------------------------------------------------------- language profiles
CAND_IDX = """candi AS (SELECT article_id, lang, CAST(row_number() OVER (PARTITION BY article_id ORDER BY pos) - 1 AS INTEGER) AS pos, word FROM cand)"""

WORD_LANG = """per AS (SELECT word, lang, count(*) AS n FROM cand GROUP BY 1, 2),
tot AS (SELECT lang, count(*) AS tot FROM cand GROUP BY 1),
wlang AS (SELECT word, lang FROM (
  SELECT per.word, per.lang, row_number() OVER (PARTITION BY per.word ORDER BY per.n / tot.tot DESC, per.lang ASC) AS rk
  FROM per JOIN tot USING (lang)) WHERE rk = 1)"""


def grams_sql(word: str) -> str:
    p = f"('_' || {word} || '_')"
    parts = [f"list_transform(range(1, length({p}) - {n} + 2), lambda i: substring({p}, i, {n}))" for n in (1, 2, 3)]
    return f"list_concat({', '.join(parts)})"


NGRAM_PROFILE = f"""g AS (SELECT lang, unnest({grams_sql('word')}) AS gram FROM cand),
gc AS (SELECT lang, gram, count(*) AS c FROM g GROUP BY 1, 2),
gt AS (SELECT lang, sum(c) AS tot FROM gc GROUP BY 1),
gv AS (SELECT count(DISTINCT gram) AS v FROM gc),
profile AS (SELECT lang, gram, ln((c + 1) / (tot + v)) AS logp FROM gc JOIN gt USING (lang), gv
            UNION ALL SELECT lang, NULL AS gram, ln(1.0 / (tot + v)) AS logp FROM gt, gv)"""


# ---------------------------------------------------------------- rule back end
from ..operators import enrich as _M  # noqa: E402


def _inlist(words) -> str:
    return ", ".join(_q(w) for w in words)


def rule_tokens_sql(text: str) -> str:
    return f"regexp_extract_all(lower(coalesce({text}, '')), {_q(_M.WORD_RE)})"


def rule_sentiment_sql(text: str, max_chars: int | None = None) -> str:
    t = f"left(coalesce({text}, ''), {max_chars})" if max_chars else f"coalesce({text}, '')"
    toks = rule_tokens_sql(t)
    score = (f"(len(list_filter({toks}, lambda x: x IN ({_inlist(_M.POSITIVE)}))) - "
             f"len(list_filter({toks}, lambda x: x IN ({_inlist(_M.NEGATIVE)}))))")
    return f"CASE WHEN {score} > 0 THEN 'positive' WHEN {score} < 0 THEN 'negative' ELSE 'neutral' END"


def rule_topic_sql(text: str) -> str:
    toks = rule_tokens_sql(text)
    hits = {c: f"len(list_filter({toks}, lambda x: x IN ({_inlist(_M.TOPIC_WORDS[c])})))" for c in _M.TOPICS}
    m = f"greatest({', '.join(hits.values())})"
    return "CASE " + " ".join(f"WHEN {hits[c]} = {m} THEN '{c}'" for c in _M.TOPICS) + " END"


def rule_summary_sql(text: str) -> str:
    sents = f"regexp_extract_all(coalesce({text}, ''), {_q(_M.SENTENCE_RE)})"
    trimmed = f"list_filter(list_transform({sents}, lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '')"
    return f"array_to_string(({trimmed})[1:3], ' ')"


def rule_countries_sql(text: str) -> str:
    padded = f"(' ' || array_to_string({rule_tokens_sql(text)}, ' ') || ' ')"
    return f"list_filter([{_inlist(_M.COUNTRIES)}], lambda c: contains({padded}, ' ' || lower(c) || ' '))"


ENRICH_IN = """enrich_in AS (
  SELECT a.article_id, a.loanword_count, d.text, coalesce(l.lw, []) AS lw, t.top3
  FROM articles a JOIN documents d ON d.doc_id = a.article_id
  LEFT JOIN (SELECT article_id, list(word ORDER BY pos) AS lw FROM loantok GROUP BY article_id) l USING (article_id)
  LEFT JOIN (SELECT article_id, string_agg(word, ', ' ORDER BY rk) AS top3 FROM (
      SELECT article_id, word, row_number() OVER (PARTITION BY article_id ORDER BY count(*) DESC, min(pos)) AS rk
      FROM loantok GROUP BY article_id, word) WHERE rk <= 3 GROUP BY article_id) t USING (article_id))"""
