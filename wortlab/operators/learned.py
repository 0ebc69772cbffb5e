"""Learned back ends of the topic and sentiment answers (M2, M4, M6).

*Topic*: multinomial naive Bayes as aggregations.  The model is a table with
one row per word and one count per class, from which the add-one smoothed log
likelihoods follow; scoring deals the articles to blocks, sends each block the
table's rows of its own words and sums per article inside the block.  The classes are bounded (``MAX_CLASSES``, checked);
words and articles are not.

*Sentiment*: hashed words, inverse document frequencies and multinomial logistic regression with
Spark ML, fitted on all labelled rows and scored on the JVM side.

A null text is scored as the empty one; a text without a known word gets the
class with the greatest prior (ties: the smallest label).  Rows with a null
label are not learned from.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_RE = r"[a-zäöüß]+"      # lower-case letter runs, as the rules read words
MAX_CLASSES = 256


def model_words(text_col: str) -> Column:
    """The words of a text; a null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD_RE), 0)


# ---------------------------------------------------------------- naive Bayes

@dataclass
class BayesModel:
    """``words``: (word, counts) with one count per label, in the order of ``labels``; ``priors``: log class shares;
    ``totals``: add-one smoothed words of a class, so that a word's log likelihood is log((count + 1) / total)."""

    labels: list[str]
    priors: list[float]
    totals: list[float]
    words: DataFrame


def fit_naive_bayes(train: DataFrame, label_col: str, text_col: str = "text", max_classes: int = MAX_CLASSES) -> BayesModel:
    """Counts of words by class, partially aggregated before the one shuffle by word; the word table is checkpointed."""
    known = train.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("string").alias("label"), model_words(text_col).alias("words"))
    classes = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("words")).alias("total")).orderBy("label").limit(max_classes + 1).collect()
    if len(classes) > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    labels, docs = [c["label"] for c in classes], sum(c["n"] for c in classes)
    counts = known.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        *[F.count_if(F.col("label") == x).alias(f"c{i}") for i, x in enumerate(labels)] or [F.lit(0).alias("none")]).checkpoint(eager=True)
    size = counts.count()
    vector = F.array(*[F.col(f"c{i}") for i in range(len(labels))]).cast("array<bigint>")
    return BayesModel(labels, [math.log(c["n"] / docs) for c in classes], [float(c["total"] + size) for c in classes], counts.select("word", vector.alias("counts")))


def naive_bayes(df: DataFrame, model: BayesModel, id_col: str = "article_id", text_col: str = "text", out_col: str = "topic") -> DataFrame:
    """Per row of ``df`` (ids unique): id, label, score (log probability of the label and the words, up to the words' own).

    Articles are dealt by id into as many blocks as there are shuffle
    partitions.  A block asks the model once for each of its words and sums
    its articles in place: no article meets the model word by word, so no
    row of class sums is sent per article and partition."""
    n = len(model.labels)
    if not n:
        return df.select(id_col, F.lit(None).cast("string").alias(out_col), F.lit(None).cast("double").alias("score"))
    blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = (df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.array_join(model_words(text_col), " ").alias("words"))
             .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).repartitionById(blocks, F.col("block")))
    said = texts.select("block", "id", F.explode(F.split("words", " ")).alias("word")).where("word != ''")
    words = said.groupBy("block", "id", "word").agg(F.count(F.lit(1)).alias("n"))
    # the greatest id is never null; reading it keeps the columns of both uses of ``texts`` alike, so that they share one exchange
    asked = said.groupBy("block", "word").agg(F.max("id").alias("last")).where("last IS NOT NULL").select("block", "word")
    ll = F.array(*[F.log((F.get("counts", F.lit(i)) + F.lit(1.0)) / F.lit(t)) for i, t in enumerate(model.totals)])
    told = asked.join(model.words, "word").repartitionById(blocks, F.col("block")).select("word", "block", ll.alias("ll"))     # small counts are sent, not doubles
    sums = words.join(told, ["word", "block"]).groupBy("block", "id").agg(*[F.sum(F.col("n") * F.get("ll", F.lit(i))).alias(f"s{i}") for i in range(n)])

    def best(sums: list[Column]) -> Column:
        return F.array_min(F.array(*[F.struct((-(s + F.lit(p))).alias("cost"), F.lit(x).alias("label")) for s, p, x in zip(sums, model.priors, model.labels)]))

    found = sums.select(F.col("id").alias(id_col), best([F.col(f"s{i}") for i in range(n)]).alias("best"))
    scored = df.select(id_col).join(found, id_col, "left").select(id_col, F.coalesce("best", best([F.lit(0.0)] * n)).alias("best"))
    return scored.select(id_col, F.col("best.label").alias(out_col), (-F.col("best.cost")).alias("score"))


# ------------------------------------------------------- logistic regression

def fit_sentiment(train: DataFrame, label_col: str, text_col: str = "text", features: int = 1 << 14, reg: float = 0.01, iterations: int = 40) -> PipelineModel:
    """Hashed words of a text (once each), weighted by inverse document frequency, and multinomial logistic regression over all labelled rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, IndexToString, StringIndexer

    rows = train.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("string").alias("_lb_label"), _shaped(text_col).alias("_lb_words"))
    index = StringIndexer(inputCol="_lb_label", outputCol="_lb_target", stringOrderType="alphabetAsc").fit(rows)
    steps = [HashingTF(inputCol="_lb_words", outputCol="_lb_tf", numFeatures=features, binary=True), IDF(inputCol="_lb_tf", outputCol="_lb_x", minDocFreq=2),
             LogisticRegression(featuresCol="_lb_x", labelCol="_lb_target", predictionCol="_lb_p", probabilityCol="_lb_prob", rawPredictionCol="_lb_raw",
                                family="multinomial", regParam=reg, maxIter=iterations, aggregationDepth=3),
             IndexToString(inputCol="_lb_p", outputCol="_lb_found", labels=index.labels)]
    return Pipeline(stages=steps).fit(index.transform(rows).select("_lb_words", "_lb_target"))


def _shaped(text_col: str) -> Column:
    """Words, and signs by their kind: what texts are marked by is not letters alone."""
    signs = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\p{L}\p{N}\s]+"), 0)
    return F.concat(model_words(text_col), F.transform(signs, lambda s: F.concat(F.lit("\u0000"), F.substring(s, 1, 2))))


def learned_sentiment(df: DataFrame, model: PipelineModel, text_col: str = "text", out_col: str = "sentiment") -> DataFrame:
    """``df`` with the label; every stage runs in the JVM."""
    scored = model.transform(df.withColumn("_lb_words", _shaped(text_col)))
    return scored.select(*[F.col(f"`{c}`") for c in df.columns if c != out_col], F.col("_lb_found").alias(out_col))
