"""Registered enrichment queries (M1-M12, C2-C5, J6, H14) on the rule back
end; the SQL oracle spells out the same rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich as M
from ..operators import loanwords as L
from ..operators import summary as SU
from ..plans import enrich as PE
from ..plans.crawl import fresh_dir
from ..plans.articles import TARGET_LANG
from ..session import ensure_checkpoint_dir
from ..sources import files as FS
from ..sources.tables import decorated_pages, documents_base, spread
from . import finish, query
from ..functions.text import ALPHA_WORD, EDGE_PUNCT, WHITESPACE
from .sqlparts import (ARTICLE_CTES, DPAGES, ENRICH_IN, PARSED, STOP_LIST, _inlist, _q, r, rule_countries_sql,
                       rule_sentiment_sql, rule_summary_sql, rule_topic_sql)


def _w(body: str, extra: str = "") -> str:
    return f"WITH {ARTICLE_CTES},\n{ENRICH_IN}{extra}\n{body}"


def _target(spark, sf_dir):
    return spread(documents_base(spark, sf_dir), "article_id").where(F.col("lang") == TARGET_LANG) \
        .select("article_id", "text")


def _scratch(spark, name):
    return fresh_dir(ensure_checkpoint_dir(spark), name)


_TARGET_SQL = "tgt AS (SELECT doc_id AS article_id, text FROM documents WHERE lang = 'de')"


@query("sentiment", f"WITH {_TARGET_SQL} SELECT article_id, {rule_sentiment_sql('text', M.SENTIMENT_CHARS)} AS sentiment FROM tgt")
def sentiment_q(spark, sf_dir):
    """M2 label per text (first 516 characters), lower-cased."""
    return M.sentiment(_target(spark, sf_dir), max_chars=M.SENTIMENT_CHARS).select("article_id", "sentiment")


@query("sentiment_rowwise", f"WITH {_TARGET_SQL} SELECT article_id, {rule_sentiment_sql('text')} AS sentiment FROM tgt")
def sentiment_rowwise(spark, sf_dir):
    """M3 the label as a column function (Arrow-batched pandas UDF)."""
    return _target(spark, sf_dir).select("article_id", M.sentiment_rowwise("text").alias("sentiment"))


@query("sentiment_batched", f"WITH {_TARGET_SQL} SELECT article_id, {rule_sentiment_sql('text', None)} AS sentiment FROM tgt")
def sentiment_batched(spark, sf_dir):
    """M4 full-text variant in sub-batches of 32 (a failing batch -> unknown)."""
    return M.sentiment(_target(spark, sf_dir), batch_size=32).select("article_id", "sentiment")


@query("batch_infer", f"""WITH {_TARGET_SQL}
SELECT article_id, 'echo:' || CAST(len(list_filter(regexp_split_to_array('Summarise: ' || text, '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) AS VARCHAR) AS answer FROM tgt""")
def batch_infer(spark, sf_dir):
    """M1 one answer per prompt through the back end (generic task)."""
    prompt = F.concat(F.lit("Summarise: "), F.col("text"))
    return M.infer(_target(spark, sf_dir), {"answer": "echo"}, prompts={"echo": prompt}).select("article_id", "answer")


@query("tone", f"WITH {_TARGET_SQL} SELECT article_id, CASE WHEN contains(text, '!') THEN 'informal' ELSE 'formal' END AS tone FROM tgt")
def tone(spark, sf_dir):
    """M5 formal / informal, answer normalised and validated."""
    raw = M.infer(_target(spark, sf_dir), {"tone_raw": "tone"}, prompts=M.build_prompts("text", None), system=M.SYSTEM)
    return raw.select("article_id", M.validated("tone_raw", M.TONES).alias("tone"))


@query("topic", f"WITH {_TARGET_SQL} SELECT article_id, {rule_topic_sql('text')} AS topic FROM tgt")
def topic(spark, sf_dir):
    """M6 one of five categories."""
    raw = M.infer(_target(spark, sf_dir), {"topic_raw": "topic"}, prompts=M.build_prompts("text", None), system=M.SYSTEM)
    return raw.select("article_id", M.validated("topic_raw", M.TOPICS).alias("topic"))


@query("summary", f"WITH {_TARGET_SQL} SELECT article_id, {rule_summary_sql('text')} AS summary FROM tgt")
def summary(spark, sf_dir):
    """M7 short summary (rule back end: the first three sentences)."""
    return M.infer(_target(spark, sf_dir), {"summary": "summary"}, prompts=M.build_prompts("text", None), system=M.SYSTEM) \
        .select("article_id", "summary")


SUMMARY_K, SUMMARY_PART = 3, 40

# every level ranks the parts of a text and keeps their best sentences, until no more than asked for are left
_RANKED_SQL = f"""WITH RECURSIVE {_TARGET_SQL},
cut AS (SELECT row_number() OVER () AS rid, article_id,
               list_filter(list_transform(regexp_extract_all(coalesce(text, ''), {_q(M.SENTENCE_RE)}),
                                          lambda s: regexp_replace(s, '^[\\s\\x0B\\x{{85}}\\p{{Z}}]+|[\\s\\x0B\\x{{85}}\\p{{Z}}]+$', '', 'g')), lambda s: s <> '') AS s FROM tgt),
lvl AS (
  SELECT rid, article_id, list_transform(s, lambda x, i: {{'pos': i, 's': x}}) AS items FROM cut
  UNION ALL
  SELECT rid, article_id, flatten(list(best ORDER BY start)) FROM (
    SELECT rid, article_id, start, CASE WHEN len(part) <= {SUMMARY_K} THEN part ELSE
             list_sort(list_transform(list_sort(list_transform(part, lambda x, i: {{'r': -round(ranks[i], {SU.PLACES}), 'x': x}}))[1:{SUMMARY_K}], lambda y: y.x)) END AS best
    FROM (SELECT *, list_reduce(list_prepend(list_transform(part, lambda x: CAST(1.0 AS DOUBLE)), list_transform(range({SU.ROUNDS}), lambda x: CAST([] AS DOUBLE[]))),
                                lambda acc, x: list_transform(links, lambda row: {1 - SU.DAMPING} + {SU.DAMPING} * list_dot_product(row, acc))) AS ranks
    FROM (SELECT *, list_transform(w, lambda row: list_transform(row, lambda x, j: CASE WHEN totals[j] > 0 THEN x / totals[j] ELSE CAST(0.0 AS DOUBLE) END)) AS links
    FROM (SELECT *, list_transform(w, lambda row: list_sum(row)) AS totals
    FROM (SELECT *, list_transform(words, lambda a, i: list_transform(words, lambda b, j: CASE WHEN i = j THEN CAST(0.0 AS DOUBLE) ELSE CAST(len(list_intersect(a, b)) AS DOUBLE) END)) AS w
    FROM (SELECT *, list_transform(part, lambda x: list_distinct(list_filter(regexp_extract_all(lower(x.s), {_q(M.WORD_RE)}), lambda v: length(v) >= {SU.MIN_LETTERS}))) AS words
    FROM (SELECT *, items[start + 1:start + {SUMMARY_PART}] AS part
    FROM (SELECT rid, article_id, items, unnest(range(0, len(items), {SUMMARY_PART})) AS start FROM lvl WHERE len(items) > {SUMMARY_K}))))))))
  GROUP BY rid, article_id)
SELECT article_id, array_to_string(list_transform(items, lambda x: x.s), ' ') AS summary FROM lvl WHERE len(items) <= {SUMMARY_K}"""


@query("summary_ranked", _RANKED_SQL)
def summary_ranked(spark, sf_dir):
    """M7 the three sentences that share most words with the others (power iteration)."""
    return SU.ranked_summary(_target(spark, sf_dir), k=SUMMARY_K, part=SUMMARY_PART).select("article_id", "summary")


@query("loanword_context", _w("""
SELECT article_id, CAST(len(lw) AS VARCHAR) || ' English loanwords; most used: ' || coalesce(top3, '') AS loanword_context FROM enrich_in"""))
def loanword_context(spark, sf_dir):
    """M8 why the article uses English words (rule: count and top words)."""
    df = PE.enrichment_input(spark, sf_dir)
    return M.infer(df, {"loanword_context": "loanword_context"}, list_col="loanwords", prompts=M.build_prompts(), system=M.SYSTEM).select("article_id", "loanword_context")


@query("marketing_loanwords", _w(f"""
SELECT article_id, array_to_string(list_sort(list_distinct(list_filter(lw, lambda w: w IN ({_inlist(M.MARKETING)})))), ', ') AS marketing_loanwords
FROM enrich_in"""))
def marketing_loanwords(spark, sf_dir):
    """M10 loanwords used for marketing."""
    df = PE.enrichment_input(spark, sf_dir)
    return M.infer(df, {"marketing_loanwords": "marketing_loanwords"}, list_col="loanwords", prompts=M.build_prompts(), system=M.SYSTEM) \
        .select("article_id", "marketing_loanwords")


@query("country_influence", _w(f"""
SELECT article_id, array_to_string({rule_countries_sql('text')}, '|') AS countries,
       CASE WHEN len({rule_countries_sql('text')}) > 0 THEN 'named in the text' ELSE 'none named' END AS reason FROM enrich_in"""))
def country_influence(spark, sf_dir):
    """M11 JSON answer parsed into countries and reason."""
    raw = M.infer(_target(spark, sf_dir), {"ci_raw": "country_influence"}, prompts=M.build_prompts("text", None), system=M.SYSTEM)
    ci = M.country_struct("ci_raw")
    return raw.select("article_id", F.array_join(ci["countries"], "|").alias("countries"), ci["reason"].alias("reason"))


@query("unwanted_loanwords", _w(f""",
dfreq AS (SELECT word FROM loantok GROUP BY word HAVING count(DISTINCT article_id) > 0.5 * (SELECT count(*) FROM articles))
SELECT article_id, coalesce((SELECT string_agg(w, ' ') FROM (SELECT unnest(lw) AS w) u
         WHERE w IN (SELECT word FROM dfreq) OR w IN ({_inlist(M.BOILERPLATE)})), '') AS excluded_loanwords
FROM enrich_in""").replace(",\n,\ndfreq", ",\ndfreq"))
def unwanted_loanwords(spark, sf_dir):
    """M9 boilerplate words among the loanwords (rule: fixed list plus
    words in more than half of all articles)."""
    from ..plans.articles import loanword_articles
    a = loanword_articles(spark, sf_dir, with_lists=True)
    out = M.unwanted_loanwords(a, "loanwords", "excluded_loanwords")
    return out.select("article_id", F.array_join("excluded_loanwords", " ").alias("excluded_loanwords"))


_PROMPTS = M.PROMPT_PARTS


@query("build_prompts", _w("SELECT article_id, " + ", ".join(
    f"sha256({' || '.join('text' if x == 'text' else 'array_to_string(lw, chr(44) || chr(32))' if x == 'words' else _q(x) for x in parts)}) AS {task}"
    for task, parts in _PROMPTS.items()) + " FROM enrich_in"))
def build_prompts(spark, sf_dir):
    """M12 the prompts of all seven tasks, compared by the hash of their whole text."""
    df = PE.enrichment_input(spark, sf_dir)
    return df.select("article_id", *[F.sha2(p, 256).alias(t) for t, p in M.build_prompts("text", "loanwords").items()])


@query("enrich_articles", _w(f"""
SELECT article_id, CASE WHEN contains(text, '!') THEN 'informal' ELSE 'formal' END AS tone,
       {rule_topic_sql('text')} AS topic_label, {rule_summary_sql('text')} AS summary,
       array_to_string({rule_countries_sql('text')}, '|') AS countries FROM enrich_in"""))
def enrich_articles(spark, sf_dir):
    """C3 + J6: six model columns in one Python stage, attached to their rows."""
    res = PE.enrich_articles(PE.enrichment_input(spark, sf_dir))
    return res.select("article_id", "tone", "topic_label", "summary",
                      F.array_join(F.col("country_influence.countries"), "|").alias("countries"))


@query("attach_predictions", f"WITH {_TARGET_SQL} SELECT article_id, {rule_sentiment_sql('text')} AS sentiment, length(text) AS n_chars FROM tgt")
def attach_predictions(spark, sf_dir):
    """J6 predictions attached to their own rows inside the batch (no
    positional join): other columns stay aligned."""
    t = _target(spark, sf_dir)
    return M.sentiment(t).select("article_id", "sentiment", F.length("text").alias("n_chars"))


_EXCLUDED = f"""
dfreq AS (SELECT word FROM loantok GROUP BY word HAVING count(DISTINCT article_id) > 0.5 * (SELECT count(*) FROM articles)),
exl AS (SELECT list(word) AS exl FROM (SELECT word FROM dfreq UNION SELECT unnest([{_inlist(M.BOILERPLATE)}]) AS word))"""


@query("enrich_resumable", _w(f"""
SELECT article_id, CASE WHEN contains(text, '!') THEN 'informal' ELSE 'formal' END AS tone, {rule_topic_sql('text')} AS topic_label,
       {rule_summary_sql('text')} AS summary, coalesce(array_to_string(list_filter(lw, lambda w: NOT list_contains(exl, w)), ' '), '') AS refined_loanwords
FROM enrich_in, exl""", "," + _EXCLUDED))
def enrich_resumable(spark, sf_dir):
    """C4 two resumed runs of 'next 50 articles' then one without limit:
    every article enriched and refined exactly once."""
    out, err = _scratch(spark, "enriched"), _scratch(spark, "enrich-errors")
    df = PE.enrichment_input(spark, sf_dir).checkpoint(eager=True)
    for limit in (50, 50, None):
        PE.enrich_resumable(spark, df, out, err, limit=limit, refine=True)
    return spark.read.parquet(out).select("article_id", "tone", "topic_label", "summary", F.array_join("refined_loanwords", " ").alias("refined_loanwords"))


@query("clean_loanwords", _w("""
SELECT article_id, coalesce(array_to_string(list_filter(lw, lambda w: NOT list_contains(exl, w)), ' '), '') AS refined_loanwords
FROM enrich_in, exl""", "," + _EXCLUDED))
def clean_loanwords(spark, sf_dir):
    """C5 in batches of 50, 50 and the rest, then once more: the result of one run, no row twice."""
    from ..plans.articles import loanword_articles
    path = _scratch(spark, "loanword-progress")
    a = loanword_articles(spark, sf_dir, with_lists=True).checkpoint(eager=True)
    for limit in (50, 50, None, None):
        back = PE.clean_loanwords(spark, a, path, limit=limit)
    return back.select("article_id", F.array_join("refined_loanwords", " ").alias("refined_loanwords"))


@query("sentiment_job", f"WITH {DPAGES},\n{PARSED}\nSELECT url, {rule_sentiment_sql('text')} AS sentiment FROM built_articles")
def sentiment_job(spark, sf_dir):
    """C2 article CSV in, sentiment column added, CSV out."""
    from ..plans.pages import parse_pages
    src, dst = _scratch(spark, "articles-in"), _scratch(spark, "articles-sentiment")
    FS.write_articles_csv(parse_pages(spread(decorated_pages(spark, sf_dir), "page_id")).select("url", "text"), src)
    out = PE.sentiment_job(spark, src, dst, "url STRING, text STRING")
    return out.select("url", "sentiment")


_H14_SQL = f"""WITH {DPAGES},
{PARSED},
{ARTICLE_CTES},
pwtok AS (SELECT page_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{WHITESPACE}'), lambda x: x <> '') AS toks
          FROM built_articles),
pcand AS (SELECT page_id, pos, lower(tok) AS word FROM (
    SELECT page_id, generate_subscripts(toks, 1) - 1 AS pos, regexp_replace(unnest(toks), '{EDGE_PUNCT}', '', 'g') AS tok
    FROM pwtok)
  WHERE regexp_matches(tok, '{ALPHA_WORD}') AND lower(tok) NOT IN ({STOP_LIST})),
ploan AS (SELECT page_id, pos, word FROM pcand SEMI JOIN lex USING (word)),
pcnt AS (SELECT page_id, count(*) AS n FROM ploan GROUP BY 1),
ptop AS (SELECT page_id, string_agg(word, ' ' ORDER BY rk) AS top3 FROM (
    SELECT page_id, word, row_number() OVER (PARTITION BY page_id ORDER BY count(*) DESC, min(pos)) AS rk
    FROM ploan GROUP BY 1, 2) WHERE rk <= 3 GROUP BY 1)
SELECT b.page_id, b.url, b.year, b.word_count, CAST(coalesce(n, 0) AS INTEGER) AS loanword_count,
       {r("round(CASE WHEN b.word_count = 0 THEN 0.0 ELSE coalesce(n, 0) / b.word_count END, 4)", "loanword_density")},
       coalesce(top3, '') AS top_loanwords, {rule_sentiment_sql('b.text', M.SENTIMENT_CHARS)} AS sentiment
FROM built_articles b LEFT JOIN pcnt USING (page_id) LEFT JOIN ptop USING (page_id)"""


@query("build_articles_full", _H14_SQL)
def build_articles_full(spark, sf_dir):
    """H14 the 15-column article table from pages (compared on its
    numeric / short columns)."""
    out = PE.build_articles_full(spark, spread(decorated_pages(spark, sf_dir), "page_id"), sf_dir)
    return finish(out.select("page_id", "url", "year", "word_count", "loanword_count", "loanword_density",
                             F.array_join("top_loanwords", " ").alias("top_loanwords"), "sentiment"))
