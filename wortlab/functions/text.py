"""Scalar text / list functions (inventory X1-X24) as column expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import GERMAN

# Python's ``str.split()`` whitespace set, written as a regex class that Java
# and RE2 read the same way (tab..CR, \x1c-\x1f, \x85 and the Unicode Z classes).
WS_CLASS = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"
WHITESPACE = f"[{WS_CLASS}]+"
NON_WHITESPACE_RUN = f"[^{WS_CLASS}]+"
# token edges that are not letters or digits (punctuation glued to a word)
EDGE_PUNCT = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
# a candidate loanword: only ASCII letters, at least four of them
ALPHA_WORD = r"^[A-Za-z]{4,}$"
# The three rules above in one pass over the text (Java regex): a whole
# whitespace-delimited token made of optional punctuation edges around 4+
# ASCII letters; group 1 is the trimmed word.
CANDIDATE_TOKEN = (rf"(?<![^{WS_CLASS}])[^\p{{L}}\p{{N}}{WS_CLASS}]*([A-Za-z]{{4,}})"
                   rf"[^\p{{L}}\p{{N}}{WS_CLASS}]*(?![^{WS_CLASS}])")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whitespace_tokens(text) -> Column:
    """``text.split()``: non-empty whitespace separated tokens (null -> [])."""
    return F.filter(F.split(F.coalesce(_c(text), F.lit("")), WHITESPACE), lambda x: x != "")


def word_count(text) -> Column:
    """X1 ``len(text.split())``; empty or null text counts 0 (counts the
    non-whitespace runs without materialising the token array)."""
    return F.coalesce(F.regexp_count(_c(text), F.lit(NON_WHITESPACE_RUN)), F.lit(0)).cast("int")


def lower_trim(c) -> Column:
    """X2 ``.strip().lower()`` (Python strip removes all whitespace)."""
    return F.lower(strip_boundary(c))


def strip_boundary(c) -> Column:
    """X24 ``.strip()``: remove leading / trailing whitespace of any kind."""
    return F.regexp_replace(_c(c), r"^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$", "")


def capitalize(c) -> Column:
    """X3 ``str.capitalize``: first character upper, the rest lower."""
    c = _c(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def prefix_chars(c, n: int = 516) -> Column:
    """X4 ``text[:n]``."""
    return F.substring(_c(c), 1, n)


def split_csv_list(c) -> Column:
    """X5 split on ',', trim, drop empty items."""
    return F.filter(F.transform(F.split(_c(c), ","), strip_boundary), lambda x: x != "")


def join_list(c, sep: str = ", ") -> Column:
    """X6 ``', '.join(list)``."""
    return F.array_join(_c(c), sep)


def alpha_word_match(c) -> Column:
    """X7 whole token matches ``^[A-Za-z]{4,}$``."""
    return _c(c).rlike(ALPHA_WORD)


def parse_list(c) -> Column:
    """Python-literal or JSON list text -> array<string>.

    ``from_json`` accepts single quoted strings, so both forms parse."""
    return F.from_json(_c(c), "array<string>", {"allowSingleQuotes": "true"})


def to_json_list(c) -> Column:
    """X10 list -> compact JSON text."""
    return F.to_json(_c(c))


def json_field(c, field: str) -> Column:
    """X11 value of a top-level JSON key (null when absent or not an object)."""
    return F.get_json_object(_c(c), f"$.{field}")


def date_part_text(c) -> Column:
    """X12 text before the first 'T'."""
    return F.split_part(_c(c), F.lit("T"), F.lit(1))


def safe_ratio(a, b) -> Column:
    """X13 a / b, 0 when b is 0 (or null)."""
    return F.coalesce(F.try_divide(_c(a), _c(b)), F.lit(0.0))


def round_n(c, n: int = 4) -> Column:
    """X14 round to n places: floor(x * 10^n + 0.5) / 10^n in doubles, the one
    rule for ties here and in the oracle SQL (engines differ in their own)."""
    scale = float(10 ** n)
    return F.floor(_c(c) * scale + 0.5) / scale


def bin_label(lo, hi, n: int) -> Column:
    """X17 ``lo - hi`` with n places, rounded by ``round_n``."""
    return F.format_string(f"%.{n}f - %.{n}f", round_n(lo, n), round_n(hi, n))


def fill_empty_text(c) -> Column:
    """X18 null -> '' and cast to string."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def cast_int(c) -> Column:
    """X19 ``int(x)`` that gives null instead of raising."""
    return F.expr(f"try_cast({c} as int)") if isinstance(c, str) else c.try_cast("int")


def contains_any(c, needles) -> Column:
    """X20 any of several literals occurs in the string."""
    c = _c(c)
    return functools.reduce(lambda a, b: a | b, [c.contains(n) for n in needles])


def array_distinct_sorted(c) -> Column:
    """X21 ``list(set(a))`` with a fixed (sorted) order."""
    return F.array_sort(F.array_distinct(_c(c)))


def array_length(c) -> Column:
    """X22 ``len(a)``; null list counts 0."""
    return F.coalesce(F.size(_c(c)), F.lit(0))


def array_difference_keep(a, b) -> Column:
    """U5 ``[w for w in a if w not in b]``: keeps order and repeats
    (``array_except`` would drop the repeats)."""
    b = _c(b)
    return F.filter(_c(a), lambda x: ~F.coalesce(F.array_contains(b, x), F.lit(False)))


def spark_stop_words(language: str = "german") -> tuple[str, ...]:
    """The default stop word list of ``StopWordsRemover``, kept in the package."""
    if language != "german":
        raise ValueError(f"no stop word list for {language!r}")
    return GERMAN


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; an expression that is used
    inside a lambda would be computed again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
