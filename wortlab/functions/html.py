"""HTML / URL field extraction (inventory H1-H12) as column expressions.

Regular expressions stand in for an HTML parser: tags are scanned with their
quoted attribute values, character references by the HTML 5 names and rules
(in attribute values as in text).  Each pattern is written in the subset that
Java regex and RE2 read alike, but for "*+" (see ``ATTRIBUTES``), so the SQL
oracle can use the very same patterns.  Paragraph rules follow an HTML5 parser: an unclosed
``<p>`` ends at the next ``<p>``, at a block-level start tag or at the end
tag of a block container.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_boundary

# fixed values: patterns of the extraction rules
DROP_RE = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
# attributes of a tag: a quote opens a value only after "=", and a ">" inside such a value does not end the tag; "*+"
# keeps Java's matcher off its stack (each character has one way to go, so RE2 reads "*" the same)
ATTRIBUTES = r"""[^>=]*(?:=\s*(?:"[^"]*"[^>=]*|'[^']*'[^>=]*|[^"'\s>=][^>=]*)?)*+"""
# the last alternative is for a quote that is never closed
P_OPEN_RE = rf"(?i)<p(?:[\s/]{ATTRIBUTES})?>|<p\s[^>]*>"
P_END_RE = (r"(?is)(</p\s*>|<(address|article|aside|blockquote|div|dl|fieldset|footer|form|h[1-6]|header|hr|main"
            r"|nav|ol|pre|section|table|ul)[\s/>]|</(address|article|aside|blockquote|body|div|dl|fieldset|footer"
            r"|form|header|html|main|nav|ol|section|table|td|th|li|ul)\s*>).*$")
# a "<" before anything else is text
TAG_RE = rf"</?[A-Za-z]{ATTRIBUTES}>|<[!?/][^>]*>|<[A-Za-z][^>]*>"
META_DATE_TAG_RE = r"""(?i)<meta[^>]*property\s*=\s*["']article:published_time["'][^>]*>"""
OG_TITLE_TAG_RE = r"""(?i)<meta[^>]*property\s*=\s*["']og:title["'][^>]*>"""
# the value ends at the quote that opened it
CONTENT_DOUBLE_RE = r"""(?i)[\s"']content\s*=\s*"([^"]*)\""""
CONTENT_SINGLE_RE = r"""(?i)[\s"']content\s*=\s*'([^']*)'"""
JSONLD_RE = r"""(?is)<script[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
H1_RE = r"(?is)<h1[^>]*>(.*?)</h1>"
URL_YEAR_RE = r"/(20[0-9]{2})/"
AUTHORITY_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
ENTITY_RE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{1,31};?)"
# the characters of the HTML 5 names, from the standard library's table; the old ones also count without ";"
ENTITIES = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
OLD_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
OLD_NAME_RE = "^(?:" + "|".join(OLD_NAMES) + ")"
# what the numbers 128 to 159 stand for: Windows-1252 where that has a character
WINDOWS_POINTS = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """``body`` of the value, which is computed once (a lambda's parts are not shared otherwise)."""
    return F.get(F.transform(F.array(value), body), 0)


def _named(name: Column) -> Column:
    """The characters of a name, else null: a literal map by the first two letters holds short lines of names."""
    lines: dict[str, str] = {}
    for n, chars in ENTITIES.items():
        lines[n[:2]] = lines.get(n[:2], "") + f"\u0001{n}\u0002{chars}"
    table = F.str_to_map(F.lit("\u0003".join(f"{k}\u0004{v}" for k, v in lines.items())), F.lit("\u0003"), F.lit("\u0004"))
    after = F.split_part(F.try_element_at(table, F.substring(name, 1, 2)), F.concat(F.lit("\u0001"), name, F.lit("\u0002")), F.lit(2))
    return F.nullif(F.substring_index(after, "\u0001", 1), F.lit(""))


def _numbered(ref: Column) -> Column:
    """The character of "#8364" or "#x20AC"; a number that is no character gives U+FFFD."""
    def character(point: Column) -> Column:
        valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        return (F.when(point.between(128, 159), F.substring(F.lit(WINDOWS_POINTS), point - 127, F.lit(1)))
                 .when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).otherwise("\ufffd"))

    digits = F.regexp_replace(ref, "^#[xX]?0*", "")
    value = _let(digits, lambda d: F.when(F.length(d) <= 7, F.when(F.lower(ref).startswith("#x"), F.conv(d, 16, 10)).otherwise(d)))
    return _let(value.try_cast("int"), character)


def _character(ref: Column) -> Column:
    """The characters of a reference, given without its "&".  A name without ";" counts where it begins with an old
    name (the longest one; what follows is text); an unknown one stays as it is written."""
    name = F.rtrim(ref, F.lit(";"))
    olds = F.str_to_map(F.lit("\u0001".join(f"{n}\u0002{ENTITIES[n]}" for n in OLD_NAMES)), F.lit("\u0001"), F.lit("\u0002"))
    rest = _let(F.regexp_extract(ref, OLD_NAME_RE, 0),
                lambda old: F.concat(F.try_element_at(olds, old), F.substring(ref, F.length(old) + 1, F.length(ref))))
    return (F.when(ref.startswith("#"), _numbered(name))
             .otherwise(F.coalesce(F.when(ref.endswith(";"), _named(name)), rest, F.concat(F.lit("&"), ref))))


def decode_entities(c) -> Column:
    """Named and numeric character references, each decoded once (``&amp;lt;`` gives ``&lt;``)."""
    text = _c(c)
    found = F.transform(F.regexp_extract_all(text, F.lit(ENTITY_RE), 1), _character)
    pieces = F.zip_with(F.split(text, ENTITY_RE), F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def strip_tags(c) -> Column:
    return F.regexp_replace(_c(c), TAG_RE, "")


def paragraphs(html) -> Column:
    """H1 raw HTML of every paragraph, in document order."""
    clean = F.regexp_replace(F.coalesce(_c(html), F.lit("")), DROP_RE, "")
    parts = F.split(clean, P_OPEN_RE)
    return F.transform(F.slice(parts, 2, 1 << 30), lambda p: F.regexp_replace(p, P_END_RE, ""))


def paragraph_count(html) -> Column:
    """H2 number of paragraphs."""
    return F.size(paragraphs(html))


def paragraph_text(ps) -> Column:
    """H3 tags stripped, entities decoded, paragraphs joined by one space."""
    return F.array_join(F.transform(_c(ps), lambda p: decode_entities(strip_tags(p))), " ")


def _attr_content(tag: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(tag, CONTENT_DOUBLE_RE, 1), F.lit("")), F.regexp_extract(tag, CONTENT_SINGLE_RE, 1))


def meta_date(html) -> Column:
    """H4 article:published_time content up to 'T'; tag without content
    gives ''; no tag gives null."""
    tag = F.regexp_extract(_c(html), META_DATE_TAG_RE, 0)
    return F.when(tag != "", F.split_part(_attr_content(tag), F.lit("T"), F.lit(1)))


def jsonld_date(html) -> Column:
    """H5 datePublished of the first JSON-LD script that is an object having
    it (bad JSON and arrays yield null and are skipped)."""
    bodies = F.regexp_extract_all(_c(html), F.lit(JSONLD_RE), 1)
    dates = F.filter(F.transform(bodies, lambda b: F.when(F.trim(b).startswith("{"),
                                                          F.get_json_object(b, "$.datePublished"))),
                     lambda d: d.isNotNull())
    return F.split_part(F.get(dates, 0), F.lit("T"), F.lit(1))


def url_year(url) -> Column:
    """H6 first /20dd/ of the URL, else null."""
    return F.nullif(F.regexp_extract(_c(url), URL_YEAR_RE, 1), F.lit(""))


def headline(html) -> Column:
    """H7 og:title content (non-empty), else <title> text, else the first <h1>
    text, else null; decoded and stripped.  A present but empty <title> gives ''."""
    h = _c(html)
    og = F.nullif(_attr_content(F.regexp_extract(h, OG_TITLE_TAG_RE, 0)), F.lit(""))
    title = F.when(h.rlike(TITLE_RE), strip_tags(F.regexp_extract(h, TITLE_RE, 1)))
    h1 = F.when(h.rlike(H1_RE), strip_tags(F.regexp_extract(h, H1_RE, 1)))
    return strip_boundary(decode_entities(F.coalesce(og, title, h1)))


def article_date(html, url) -> Column:
    """H8 first non-empty of meta date, JSON-LD date, URL year."""
    return F.coalesce(F.nullif(meta_date(html), F.lit("")), F.nullif(jsonld_date(html), F.lit("")), url_year(url))


def year_of(date) -> Column:
    """H9 text before the first '-' as int (null when not a number)."""
    return F.split_part(_c(date), F.lit("-"), F.lit(1)).try_cast("int")


def url_authority(url) -> Column:
    """H10 network location (user info and port kept), '' when none."""
    return F.regexp_extract(_c(url), AUTHORITY_RE, 1)


def source_site(authority) -> Column:
    """H11 authority with every 'www.' removed."""
    return F.replace(_c(authority), F.lit("www."), F.lit(""))


def domain_label(authority) -> Column:
    """H12 first dot-separated label of the authority."""
    return F.split_part(_c(authority), F.lit("."), F.lit(1))
