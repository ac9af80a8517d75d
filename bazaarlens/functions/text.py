"""Text helpers with the whitespace, case and search rules the extraction relies on."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def rx(pattern: str, ignore_case: bool = True) -> str:
    """Unicode classes, and ``.`` stopping at a newline only, as page text needs."""
    return ("(?idU)" if ignore_case else "(?dU)") + pattern


#: White space of Unicode, as ``\\s`` under ``(?U)`` has it; a trim by characters takes a fraction of the pattern's time on long texts.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def unless(c: Column, nothing: str | float) -> Column:
    """The value, or NULL when it is ``nothing``.

    An element of an array and no ``nullif``: below a CASE, that works the value out once to compare and once more to return it. By a lambda:
    Spark compiles a projection that has one in pieces, one without into a single method, and Java only interprets a method of over 8,000 bytes.
    """
    return F.get(F.filter(F.array(c), lambda one: one != nothing), F.lit(0))


def not_blank(c: Column) -> Column:
    """NULL for the empty string."""
    return unless(c, "")


def present(c: Column) -> Column:
    """The number, or NULL when it is zero: a zero amount counts as not found."""
    return unless(c, 0.0)


def matched(text: Column, pattern: str, group: int = 0) -> Column:
    """What the pattern (or a group of it) matches first; NULL for nothing or an empty match."""
    return not_blank(F.regexp_extract(text, pattern, group))


def search(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    """First capture of the pattern, NULL when it does not match."""
    return matched(text, rx(pattern, ignore_case), 1)


def search_whole(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    return matched(text, rx(pattern, ignore_case))


def first_regex(text: Column, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    """First capture of the first pattern that matches at all."""
    return F.coalesce(*[search(text, p, ignore_case) for p in patterns])


def first_regex_whole(text: Column, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    return F.coalesce(*[search_whole(text, p, ignore_case) for p in patterns])


def capture_of(whole: Column, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    """What ``first_regex`` captures, from what ``first_regex_whole`` found. The patterns look at nothing outside their
    match, so a short text is searched instead of the page again."""
    return first_regex(whole, patterns, ignore_case)


def has_pattern(text: Column, pattern: str) -> Column:
    return text.rlike(rx(pattern))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    hit = text.contains(words[0])
    for w in words[1:]:
        hit = hit | text.contains(w)
    return hit


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def title_from_slug(url: Column) -> Column:
    """The slug after /business-for-sale/ as a title; NULL when there is none."""
    slug = matched(url, r"/business-for-sale/([^/]+)/", 1)
    return title_case(F.replace(slug, F.lit("-"), F.lit(" ")))


def card_title(link_text: Column, url: Column) -> Column:
    """The link text when it is longer than ten characters, else the slug."""
    return F.when(F.length(link_text) > 10, link_text).otherwise(title_from_slug(url))


def truncate(c: Column, n: int) -> Column:
    """D11"""
    return F.substring(c, 1, n)


def collapse_ws(c: Column, n: int = 500) -> Column:
    """Whitespace runs to one space on the first ``n`` characters."""
    return F.regexp_replace(F.substring(c, 1, n), r"(?U)\s+", " ")


def location(text: Column, patterns: Sequence[str]) -> Column:
    """Labelled or ``City, ST`` place, case-sensitive."""
    return strip(first_regex(text, patterns, ignore_case=False))


def city_of(place: Column) -> Column:
    """C9"""
    return F.when(place.contains(","), strip(F.element_at(F.split(place, ","), 1)))


def state_of(place: Column) -> Column:
    """C9"""
    return F.when(place.contains(","), strip(F.element_at(F.split(place, ","), -1)))


def join_city_state(city: Column, state: Column) -> Column:
    """``city, state``, or whichever of the two exists."""
    return not_blank(strip(F.concat_ws(", ", not_blank(city), not_blank(state))))


def absolutise(href: Column, base: Column) -> Column:
    """A leading slash is resolved against the site."""
    return F.when(href.startswith("/"), F.concat(base, href)).otherwise(href)


def absolutise_unless_http(href: Column, base: Column) -> Column:
    """B7, second form: whatever does not start with http is resolved."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, href))


def listing_id(url: Column) -> Column:
    """Stable non-negative 60-bit id of a URL."""
    return F.conv(F.substring(F.md5(url.cast("binary")), 1, 15), 16, 10).cast("bigint")


def iso_timestamp(ts: Column) -> Column:
    """ISO text for sinks that have no timestamp type."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
