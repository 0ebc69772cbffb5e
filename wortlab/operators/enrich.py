"""Model-backed enrichment (inventory M1-M12, J6) with pluggable back ends.

The reference sends one blocking request per article and task to a local
model server.  Here the answers come from deterministic rules, written as
column expressions (the default; the SQL oracle spells them out), or from a
registered back end: a ``mapInPandas`` stage in which every task of the job
runs its partitions through a client created once per Python worker, in
sub-batches (32 by default) of each Arrow batch.  Every model task gets its
own prompt and messages.  Failures are isolated: a sub-batch is retried,
then answered row by row, and rows that still fail, or batches with a wrong
number of answers, get the sentinel - the job never dies on one bad row.

A model client registers with ``register_backend(name, factory)``; the
factory runs on the executors.
"""

from __future__ import annotations

import time
from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import lower_trim, split_csv_list, strip_boundary, word_count

# fixed values: answer domains and rule back end word lists
TONES = ("formal", "informal")
TOPICS = ("business", "technology", "lifestyle", "politics", "culture")
COUNTRIES = ("USA", "China", "Russia", "India", "France", "Germany", "UK", "Japan", "Saudi Arabia", "Italy",
             "Canada", "Israel", "Australia", "Spain", "South Korea", "Turkey", "Switzerland", "Iran")
BOILERPLATE = ("footer", "ticker", "tracking", "cookie", "newsletter", "login", "share", "facebook",
               "twitter", "instagram", "youtube", "linkedin")
POSITIVE = ("gut", "good", "great", "erfolg", "success", "stark", "positiv", "positive", "gewinn", "profit")
NEGATIVE = ("schlecht", "bad", "krise", "crisis", "verlust", "loss", "schwach", "negativ", "negative", "problem")
TOPIC_WORDS = {
    "business": ("business", "markt", "market", "firma", "deal", "startup", "manager", "umsatz"),
    "technology": ("software", "tech", "digital", "internet", "computer", "online", "daten", "data"),
    "lifestyle": ("lifestyle", "style", "fashion", "food", "travel", "fitness", "wellness", "design"),
    "politics": ("politik", "regierung", "wahl", "partei", "minister", "government", "policy", "gesetz"),
    "culture": ("kultur", "culture", "musik", "music", "film", "kunst", "art", "theater"),
}
MARKETING = ("deal", "sale", "premium", "brand", "marketing", "shopping", "lifestyle", "performance", "style",
             "business", "design", "team", "service", "online", "event")
WORD_RE = r"[a-zäöüß]+"          # rule tokens: lower-case letter runs
SENTENCE_RE = r"[^.!?]+[.!?]*"   # rule sentences
SENTIMENT_CHARS = 516            # fixed value: prefix scored by the first sentiment variant
RULES = "rules"
SYSTEM = "You read German news articles and answer in the format that is asked for, without any other words."


# ------------------------------------------------------------------ rules

def _top(words: F.Column, k: int = 3) -> F.Column:
    """The k most frequent words of a list, ties by first occurrence."""
    ranked = F.sort_array(F.transform(F.array_distinct(words), lambda w, i: F.struct(
        (-F.size(F.filter(words, lambda x: x == w))).alias("n"), i.alias("i"), w.alias("w"))))
    return F.transform(F.slice(ranked, 1, k), lambda e: e["w"])


def rule_answer(task: str, text: F.Column, words: F.Column, prompt: F.Column) -> F.Column:
    """The deterministic answer of the rules to one task, from built-in functions only."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(WORD_RE), 0)

    def among(values):
        return F.size(F.filter(tokens, lambda t: t.isin(*values)))

    if task == "sentiment":
        score = among(POSITIVE) - among(NEGATIVE)
        return F.when(score > 0, "Positive").when(score < 0, "Negative").otherwise("Neutral")
    if task == "tone":
        return F.when(text.contains("!"), " Informal\n").otherwise("Formal")
    if task == "topic":
        hits = {c: among(TOPIC_WORDS[c]) for c in TOPICS}
        most, out = F.greatest(*hits.values()), F
        for c in TOPICS:
            out = out.when(hits[c] == most, c.capitalize())
        return out
    if task == "summary":
        sentences = F.transform(F.regexp_extract_all(text, F.lit(SENTENCE_RE), 0), strip_boundary)
        return F.array_join(F.slice(F.filter(sentences, lambda x: x != ""), 1, 3), " ")
    if task == "loanword_context":
        return F.concat(F.size(words).cast("string"), F.lit(" English loanwords; most used: "), F.array_join(_top(words), ", "))
    if task == "marketing_loanwords":
        return F.array_join(F.sort_array(F.array_distinct(F.filter(words, lambda w: w.isin(*MARKETING)))), ", ")
    if task == "country_influence":
        padded = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
        found = F.filter(F.array(*map(F.lit, COUNTRIES)), lambda c: padded.contains(F.concat(F.lit(" "), F.lower(c), F.lit(" "))))
        reason = F.when(F.size(found) > 0, "named in the text").otherwise("none named")
        return F.to_json(F.struct(found.alias("countries"), reason.alias("reason")))
    if task == "unwanted_loanwords":
        return F.array_join(F.filter(F.array_distinct(words), lambda w: w.isin(*BOILERPLATE)), ", ")
    return F.concat(F.lit(f"{task}:"), word_count(prompt).cast("string"))


# ------------------------------------------------------------------ back ends

_FACTORIES: dict[str, tuple[int, Callable[[], object]]] = {}
_INSTANCES: dict[str, tuple[int, object]] = {}
_COLUMNS: dict[str, dict[str, Callable[[DataFrame, str, str], DataFrame]]] = {}


def register_backend(name: str, factory: Callable[[], object]) -> None:
    """Register a back end factory: an object with ``answer(task, rows)``,
    one answer per row; ``rows`` has text, loanwords, prompt and messages."""
    if name == RULES:
        raise ValueError("the rules are no back end")
    _FACTORIES[name] = (_FACTORIES.get(name, (0, None))[0] + 1, factory)


def register_column_backend(name: str, answers: dict[str, Callable[[DataFrame, str, str], DataFrame]]) -> None:
    """Register a back end that runs in the JVM: by task, a function of the
    rows, their text column and the answer's column that adds the answer."""
    if name == RULES or name in _FACTORIES:
        raise ValueError(f"{name} is taken")
    _COLUMNS[name] = answers


def get_backend(name: str, registered: tuple[int, Callable[[], object]]):
    """One instance per Python worker and registration.  The factory is
    resolved on the driver and shipped with the task closure, so back ends
    registered in the driver work on every executor."""
    version, factory = registered
    if _INSTANCES.get(name, (None,))[0] != version:
        _INSTANCES[name] = (version, factory())
    return _INSTANCES[name][1]


def call_with_retries(fn: Callable[[], list[str]], retries: int = 3, delay: float = 2.0):
    """M1 retry loop: up to ``retries`` attempts with a fixed delay; the
    last error is raised to the caller."""
    last = None
    for attempt in range(max(1, retries)):
        try:
            return fn()
        except Exception as e:  # noqa: BLE001 - any back end failure is retried
            last = e
            if attempt + 1 < retries and delay:
                time.sleep(delay)
    raise last


def _answer_batch(be, task: str, sub: pd.DataFrame, retries: int, delay: float, sentinel: str,
                  row_fallback: bool) -> list[str]:
    def ask(rows):
        answers = list(be.answer(task, rows))
        if len(answers) != len(rows):
            raise ValueError(f"{len(answers)} answers to {len(rows)} rows")
        return answers

    try:
        return call_with_retries(lambda: ask(sub), retries, delay)
    except Exception:  # noqa: BLE001
        if not row_fallback:
            return [sentinel] * len(sub)
        out = []
        for i in range(len(sub)):
            try:
                out.extend(call_with_retries(lambda: ask(sub.iloc[i:i + 1]), retries, delay))
            except Exception:  # noqa: BLE001
                out.append(sentinel)
        return out


def messages(prompt: str, system: str | None) -> list[dict[str, str]]:
    """The messages of one request: the system message, if any, and the prompt."""
    return [*([{"role": "system", "content": system}] if system else []), {"role": "user", "content": prompt}]


def infer(df: DataFrame, tasks: dict[str, str], backend: str = RULES, text_col: str = "text",
          list_col: str | None = None, prompts: dict[str, F.Column] | None = None, system: str | None = None,
          batch_size: int = 32, retries: int = 3, delay: float = 2.0, sentinel: str = "error",
          row_fallback: bool = True, max_chars: int | None = None) -> DataFrame:
    """M1 / C3 one raw text answer per row and task -> new string columns
    (J6: the answers are attached to their rows inside the same batch).

    ``tasks`` maps output columns to tasks, ``prompts`` tasks to their prompt
    columns.  The rules are column expressions; a registered back end runs
    in ``mapInPandas`` and gets each task's own prompt and messages."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if max_chars:
        text = F.substring(text, 1, max_chars)
    words = F.coalesce(F.col(list_col), F.array().cast("array<string>")) if list_col else F.array().cast("array<string>")
    prompt = {t: (prompts or {}).get(t, F.lit("")) for t in tasks.values()}
    if backend == RULES:
        return df.select("*", *[rule_answer(t, text, words, prompt[t]).alias(c) for c, t in tasks.items()])
    if backend in _COLUMNS:
        out = df.withColumn("_text", text)
        for c, t in tasks.items():
            out = _COLUMNS[backend][t](out, "_text", c)
        return out.select(*df.columns, *tasks)
    out_schema = StructType(df.schema.fields + [StructField(c, StringType(), True) for c in tasks])
    cols, registered, asked = df.columns, _FACTORIES[backend], list(dict.fromkeys(tasks.values()))
    given = df.select("*", text.alias("_text"), words.alias("_words"), *[prompt[t].alias(f"_prompt_{i}") for i, t in enumerate(asked)])

    def run(batches):
        be = get_backend(backend, registered)
        for pdf in batches:
            answers = {t: [] for t in asked}
            for i, task in enumerate(asked):
                view = pd.DataFrame({"text": pdf["_text"], "loanwords": pdf["_words"], "prompt": pdf[f"_prompt_{i}"],
                                     "messages": [messages(p, system) for p in pdf[f"_prompt_{i}"]]})
                for start in range(0, len(pdf), batch_size):
                    answers[task].extend(_answer_batch(be, task, view.iloc[start:start + batch_size], retries, delay, sentinel, row_fallback))
            out = pdf[cols].copy()
            for c, task in tasks.items():
                out[c] = answers[task]
            yield out

    return given.mapInPandas(run, out_schema)


# ------------------------------------------------------------------ operators

def sentiment(df: DataFrame, text_col: str = "text", out_col: str = "sentiment", backend: str = RULES,
              max_chars: int | None = None, batch_size: int = 32) -> DataFrame:
    """M2 / M4 label per text, lower-cased; null text scored as ''; a
    failing batch gives 'unknown' for all its rows.  The whole text is
    scored; M2 and H14 pass ``SENTIMENT_CHARS``."""
    raw = infer(df, {out_col: "sentiment"}, backend, text_col, batch_size=batch_size, retries=1, delay=0.0,
                sentinel="unknown", row_fallback=False, max_chars=max_chars)
    return raw.withColumn(out_col, lower_trim(out_col))


def sentiment_rowwise(text_col: str = "text", backend: str = RULES, max_chars: int | None = None):
    """M3 the same as a column function (an Arrow-batched pandas UDF for a
    registered back end)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if max_chars:
        text = F.substring(text, 1, max_chars)
    if backend == RULES:
        return lower_trim(rule_answer("sentiment", text, F.array().cast("array<string>"), F.lit("")))
    registered = _FACTORIES[backend]

    @F.pandas_udf(StringType())
    def label(texts: pd.Series) -> pd.Series:
        be = get_backend(backend, registered)
        rows = pd.DataFrame({"text": texts, "loanwords": [None] * len(texts), "prompt": [""] * len(texts),
                             "messages": [messages("", None)] * len(texts)})
        return pd.Series([str(x).strip().lower() for x in _answer_batch(be, "sentiment", rows, 1, 0.0, "unknown", False)])
    return label(text)


def validated(raw_col: str, domain: tuple[str, ...]) -> F.Column:
    """M5 / M6 answer normalised (strip, lower) and checked against the
    domain; anything else becomes null (the raw text stays available)."""
    v = lower_trim(raw_col)
    return F.when(v.isin(list(domain)), v)


def country_struct(raw_col: str) -> F.Column:
    """M11 JSON answer -> struct(countries, reason); bad JSON -> null fields."""
    return F.from_json(F.col(raw_col), "countries array<string>, reason string")


def unwanted_loanwords(df: DataFrame, list_col: str = "loanwords", out_col: str = "excluded_loanwords",
                       id_col: str = "article_id", min_doc_share: float = 0.5,
                       backend: str | None = None, text_col: str = "text") -> DataFrame:
    """M9 words of each list that are boilerplate rather than loanwords.

    Rule form (no back end): the fixed boilerplate list plus the words that
    occur in more than ``min_doc_share`` of all articles - a document
    frequency aggregate (partial counts per word) joined back per word, so
    no vocabulary is shipped anywhere whole.  With a back end the model
    answer is split by ``split_csv_list``."""
    if backend is not None:
        raw = infer(df, {"_unwanted": "unwanted_loanwords"}, backend, text_col, list_col, build_prompts(text_col, list_col), SYSTEM)
        return raw.withColumn(out_col, split_csv_list("_unwanted")).drop("_unwanted")
    # the input is read four times below (article count, document frequency,
    # occurrences, the result); when it is derived (a whole text pass) it is
    # written once to the shared checkpoint folder and read from there
    df = df.checkpoint(eager=True)
    n_docs = df.agg(F.count(F.lit(1)).alias("_docs"))
    dfreq = (df.select(id_col, F.explode(F.array_distinct(list_col)).alias("_w"))
               .groupBy("_w").agg(F.count(F.lit(1)).alias("_df"))
               .crossJoin(F.broadcast(n_docs))                      # one row
               .where(F.col("_df") > min_doc_share * F.col("_docs")).select("_w"))
    occ = df.select(id_col, F.posexplode(list_col).alias("_p", "_w"))
    hit = (occ.join(dfreq.withColumn("_f", F.lit(True)), "_w", "left")
              .where(F.col("_f") | F.col("_w").isin(list(BOILERPLATE)))
              .groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("_p", "_w"))).alias("_e")))
    out = df.join(hit, id_col, "left")
    return out.withColumn(out_col, F.coalesce(F.transform("_e", lambda e: e["_w"]),
                                              F.array().cast("array<string>"))).drop("_e")


# ------------------------------------------------------------------ prompts

#: The prompts in own wording: literals, the text and the loanwords, put together in this order.
PROMPT_PARTS = {
    "tone": ("Answer with one word, formal or informal: what is the tone of this article?\n\n", "text"),
    "topic": ("Answer with one word - business, technology, lifestyle, politics or culture: what is this article about?\n\n", "text"),
    "summary": ("Summarise this German article in two or three sentences.\n\n", "text"),
    "loanword_context": ("This German article uses English words. Why, and what does it tell about context and readers?\n\n", "text"),
    "marketing_loanwords": ("Which English words in this German article serve marketing or advertising? Return a list.\n\n", "text"),
    "country_influence": ("Which countries' culture does this German article reflect? Choose from: " + ", ".join(COUNTRIES)
                          + ", or name others. Answer as JSON with \"countries\" (list) and \"reason\" (short text).\n\n", "text"),
    "unwanted_loanwords": ("Loanwords: ", "words", "\nWhich of these are interface or boilerplate terms, brand or platform names rather "
                           "than real loanwords? Return a comma separated list.\n\n", "text"),
}


def build_prompts(text_col: str = "text", list_col: str | None = "loanwords") -> dict[str, F.Column]:
    """M12 the prompt of each task as a column."""
    slots = {"text": F.coalesce(F.col(text_col), F.lit("")),
             "words": F.array_join(F.coalesce(F.col(list_col), F.array().cast("array<string>")), ", ") if list_col else F.lit("")}
    return {task: F.concat(*[slots.get(x, F.lit(x)) for x in parts]) for task, parts in PROMPT_PARTS.items()}


ENRICH_TASKS = {"tone": "tone", "topic": "topic", "summary": "summary", "loanword_context": "loanword_context",
                "marketing_loanwords": "marketing_loanwords", "country_influence": "country_influence"}
