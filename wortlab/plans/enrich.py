"""Enrichment jobs (inventory C2-C5, H14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich as M
from ..operators import incremental as I
from ..operators import loanwords as L
from ..sources import files as FS
from ..sources.tables import documents_base
from .articles import TARGET_LANG, english_lexicon, loanword_articles
from .crawl import _exists
from .pages import parse_pages


def enrichment_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target articles with loanword lists and their text (ids and lists are
    folded first; the text joins back once, on the id)."""
    lists = loanword_articles(spark, sf_dir, with_lists=True)
    text = documents_base(spark, sf_dir).where(F.col("lang") == TARGET_LANG).select("article_id", "text")
    return lists.join(text, "article_id")


def enrich_articles(df: DataFrame, backend: str = "rules", batch_size: int = 50, retries: int = 3,
                    delay: float = 2.0) -> DataFrame:
    """C3 the six model columns for every article in one Python stage; the
    id is kept (the reference's output had no key).  Tone and topic are
    validated against their domains; the country answer is parsed."""
    FS.require_columns(df, ["text", "loanwords"])
    raw = M.infer(df, {f"{k}_raw": v for k, v in M.ENRICH_TASKS.items()}, backend, "text", "loanwords",
                  M.build_prompts("text", "loanwords"), M.SYSTEM, batch_size=batch_size, retries=retries, delay=delay)
    return raw.select("*", M.validated("tone_raw", M.TONES).alias("tone"),
                      M.validated("topic_raw", M.TOPICS).alias("topic_label"),
                      F.col("summary_raw").alias("summary"), F.col("loanword_context_raw").alias("loanword_context"),
                      F.col("marketing_loanwords_raw").alias("marketing_loanwords"),
                      M.country_struct("country_influence_raw").alias("country_influence"))


def enrich_resumable(spark: SparkSession, df: DataFrame, out_path: str, err_path: str, id_col: str = "article_id",
                     limit: int | None = None, backend: str = "rules", refine: bool = False) -> None:
    """C4 skip done ids (J3), take the next ``limit`` (T6; all by default),
    enrich (C3) and append: good rows to the output, rows with an 'error'
    answer to the error table (with the failing task names).  ``refine`` adds
    the unwanted and the refined loanwords (M9, L7); what is unwanted is
    decided over all of ``df``, so it does not depend on the batch."""
    FS.require_columns(df, [id_col, "text", "loanwords"])
    todo = L.refine_loanwords(M.unwanted_loanwords(df, "loanwords", "excluded_loanwords", id_col)) if refine else df
    if _exists(spark, out_path):
        todo = I.skip_done_ids(todo, spark.read.parquet(out_path).select(id_col), id_col)
    todo = I.limit_work(todo, id_col, limit)
    res = enrich_articles(todo, backend)
    raw_cols = [f"{k}_raw" for k in M.ENRICH_TASKS]
    failed = F.filter(F.array(*[F.when(F.col(c) == "error", F.lit(c[:-4])) for c in raw_cols]), lambda x: x.isNotNull())
    res = res.withColumn("_failed", failed)
    # one pass over the results, then two appends (the enriched rows are
    # written to a checkpointed table so the model runs once)
    res = res.checkpoint(eager=True)
    FS.append_results(res.where(F.size("_failed") == 0).drop("_failed", "text"), out_path)
    errs = res.where(F.size("_failed") > 0).select(id_col, F.array_join("_failed", ", ").alias("error"))
    FS.append_results(errs, err_path)


def clean_loanwords(spark: SparkSession, df: DataFrame, progress_path: str, id_col: str = "article_id",
                    limit: int | None = None, backend: str | None = None) -> DataFrame:
    """C5 skip done ids, limit, detect unwanted words (M9), refine (L7),
    append the new progress rows (arrays stay arrays; JSON only at the CSV
    edge).  Returns the merged progress (U1).  The rule counts documents over
    all of ``df``, so batches of any size give the result of one run."""
    todo = df if backend is not None else M.unwanted_loanwords(df, "loanwords", "excluded_loanwords", id_col)
    old = None
    if _exists(spark, progress_path):
        old = spark.read.parquet(progress_path)
        todo = I.skip_done_ids(todo, old.select(id_col), id_col)
    todo = I.limit_work(todo, id_col, limit)
    new = todo if backend is None else M.unwanted_loanwords(todo, "loanwords", "excluded_loanwords", id_col, backend=backend)
    new = L.refine_loanwords(new).select(id_col, "excluded_loanwords", "refined_loanwords")
    FS.append_results(new, progress_path)
    return spark.read.parquet(progress_path)


def sentiment_job(spark: SparkSession, in_path: str, out_path: str, schema: str, backend: str = "rules") -> DataFrame:
    """C2 read an article CSV, add ``sentiment``, write, read back."""
    arts = FS.read_articles_csv(spark, in_path, schema)
    out = M.sentiment(arts, "text", "sentiment", backend).drop("text")
    FS.write_articles_csv(out, out_path)
    return FS.read_articles_csv(spark, out_path, out.schema)


def build_articles_full(spark: SparkSession, pages: DataFrame, sf_dir: str, backend: str = "rules") -> DataFrame:
    """H14 the 15-column article table: parsed pages (H13) + loanword lists,
    count, density, top 3 (L-stage against the English vocabulary) +
    sentiment (M2 on the first 516 characters)."""
    # parse + model once: the scored table is checkpointed (shared folder),
    # both the loanword stage and the output read it from there
    scored = M.sentiment(parse_pages(pages), "text", "sentiment", backend, M.SENTIMENT_CHARS).checkpoint(eager=True)
    lex = english_lexicon(spark, sf_dir)
    lw = L.loanword_table(scored.select("page_id", "text"), lex, id_col="page_id", with_lists=True).drop("word_count")
    return (scored.join(lw, "page_id")
                  .select("page_id", "url", "source_site", "domain", "date", "year", "text", "headline", "word_count",
                          "paragraphs", "loanwords", "all_loanwords", "loanword_count", "loanword_density",
                          "top_loanwords", "sentiment"))
