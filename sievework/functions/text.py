"""Text functions as Columns: normalising, identities, tags, scrubbing, URLs."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The punctuation that title keys leave out, and the marks that cut titles into chunks.
TITLE_PUNCTUATION = "[·・\\-—_、,，。;；:：!！?？()（）\\[\\]【】\"'`]+"
TITLE_CUTS = "[\\s\\-—_|/·、,，()（）【】\\[\\]]+"
SECRET_KEYS = ("token", "access_token", "secret", "password", "api_key", "sid", "session", "ticket")
DROPPED_PARAMETERS = ("token", "sid", "session", "ticket", "securityId", "lid", "utm_source", "ref")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode compatibility composition, which Spark has no function for."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def blank_to_null(c: Column | str) -> Column:
    """Null where the text is null or blank."""
    return F.when(F.trim(as_col(c)) != "", as_col(c))


def first_filled(*columns: Column | str) -> Column:
    """First value that isn't blank, trimmed."""
    return F.coalesce(*[F.trim(blank_to_null(c)) for c in columns])


#: Fixed value: the characters that Unicode counts as white space, and the separators of ASCII.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once. Neither may hold a Python function."""
    return F.transform(F.array(value), use)[0]


def no_space(c: Column | str) -> Column:
    return F.translate(as_col(c), WHITE_SPACE, "")


def title_key(c: Column | str, unicode: bool = True) -> Column:
    """Grouping key of a title: compatibility form, lower case, without white space and punctuation."""
    c = F.coalesce(as_col(c), F.lit(""))
    return F.regexp_replace(no_space(F.lower(F.trim(nfkc(c) if unicode else c))), TITLE_PUNCTUATION, "")


def body_key(c: Column | str, unicode: bool = True) -> Column:
    """Comparable form of a body: compatibility form, lower case, without white space."""
    c = F.coalesce(as_col(c), F.lit(""))
    return no_space(F.lower(nfkc(c) if unicode else c))


def posting_id(*keys: Column | str) -> Column:
    """First 16 hex digits of the md5 of the first key that isn't empty."""
    return F.substring(F.md5(F.coalesce(*[F.when(as_col(k) != "", as_col(k)) for k in keys], F.lit(""))), 1, 16)


#: Characters of a body that are looked at first for its beginning without white space.
BEGINNING = 1024


def fingerprint(body: Column | str, place: Column | str, head: int = 180, place_head: int = 12, unicode: bool = True) -> Column:
    """Content identity: the body's beginning and the place's; empty without a body. Pay is left out on purpose, as reposts vary it.

    Where the first ``BEGINNING`` characters have enough that aren't white space, the rest of the body is not worked on.
    """
    squeezed = lambda c: F.substring(body_key(c, unicode), 1, head)
    name = lambda b: F.when(b == "", F.lit("")).otherwise(F.concat(b, F.lit("|"), F.substring(title_key(place, unicode), 1, place_head)))
    if unicode:
        return name(squeezed(body))
    near = let(squeezed(F.substring(as_col(body), 1, BEGINNING)), lambda b: F.when(F.length(b) == head, b).otherwise(squeezed(body)))
    return let(near, name)


def group_name(key: Column | str) -> Column:
    return F.concat(F.lit("dup-"), F.substring(F.sha2(as_col(key), 256), 1, 8))


def canonical_id(title: Column | str, company: Column | str, city: Column | str, unicode: bool = True) -> Column:
    """Identity of a position over its repostings; empty if all three parts are."""
    parts = [title_key(c, unicode) for c in (title, company, city)]
    return F.when(F.concat(*parts) == "", F.lit("")).otherwise(F.concat(F.lit("cn-"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)))


def content_hash(canonical: Column | str, print_: Column | str) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", as_col(canonical), as_col(print_)), 256), 1, 32)


def body_hash(body: Column | str, unicode: bool = True) -> Column:
    key = body_key(body, unicode)
    return F.when(key == "", F.lit("")).otherwise(F.substring(F.sha2(key, 256), 1, 32))


def split_tags(c: Column | str) -> Column:
    """Tags between bars, half or full width, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(F.translate(F.coalesce(as_col(c), F.lit("")), "｜", "|"), "\\|"), lambda t: F.trim(t)), lambda t: t != "")


def join_tags(c: Column | str, by: str = " | ") -> Column:
    return F.array_join(as_col(c), by)


def district(location: Column | str) -> Column:
    """Second part of a location such as city·district·street; null without one."""
    return blank_to_null(F.get(F.split(as_col(location), "·"), F.lit(1)))


def contains_any(text: Column, terms: tuple[str, ...]) -> Column:
    """Whether any of the terms stands in the text."""
    out = F.lit(False)
    for t in terms:
        out = out | text.contains(t)
    return out


def found_terms(text: Column, terms: tuple[str, ...]) -> Column:
    """The terms, in their own order, whose lower-case form stands in the text's."""
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(low.contains(t.lower()), F.lit(t)) for t in terms]))


def title_matches_body(title: Column | str, body: Column | str) -> Column:
    """Whether a chunk of the title, or two neighbouring characters of a longer Chinese one, stands in the body; true if either is missing.

    Both are columns in their compatibility form already, as Spark allows no Python function within a lambda.
    """
    text = F.lower(as_col(body))
    chunks = F.filter(F.split(F.lower(F.trim(as_col(title))), TITLE_CUTS), lambda c: F.length(c) >= 2)
    pairs = lambda c: F.exists(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.contains(text, F.substring(c, i, 2)))
    hit = F.exists(chunks, lambda c: F.contains(text, c) | (c.rlike("[\\x{4e00}-\\x{9fff}]") & (F.length(c) > 3) & pairs(c)))
    missing = (F.coalesce(as_col(title), F.lit("")) == "") | (F.coalesce(as_col(body), F.lit("")) == "")
    return missing | F.coalesce(hit, F.lit(False))


def has_word(text: Column | str, term: str) -> Column:
    """Whether a term stands in a text: Latin terms between characters that are neither letters, digits, + nor #; others anywhere."""
    import re

    if term.isascii():
        return F.lower(as_col(text)).rlike(f"(^|[^a-z0-9+#]){re.escape(term.lower())}([^a-z0-9+#]|$)")
    return F.lower(as_col(text)).contains(term.lower())


def scrub_secrets(c: Column | str, keys: tuple[str, ...] = SECRET_KEYS) -> Column:
    """``key=value`` of the named keys, spaces and quotes allowed, with the value masked."""
    return F.regexp_replace(as_col(c), f"(?i)\\b({'|'.join(keys)})\\s*=\\s*\"?[^&\\s\"'<>]+\"?", "$1=***")


def clean_url(c: Column | str, dropped: tuple[str, ...] = DROPPED_PARAMETERS) -> Column:
    """A URL without fragment and without the named parameters."""
    bare = F.split(as_col(c), "#").getItem(0)
    parts = F.split(bare, "\\?", 2)
    kept = F.filter(F.split(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*dropped))
    return F.concat(parts.getItem(0), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def iso_instant(c: Column | str) -> Column:
    """struct(at, zoned) of an ISO date or time, without a zone as UTC; at is null where it is none."""
    s = F.trim(as_col(c))
    iso = s.rlike("^\\d{4}-\\d{2}-\\d{2}([T ]\\d{2}:\\d{2}(:\\d{2}([.]\\d{1,6})?)?(Z|[+-]\\d{2}:\\d{2})?)?$")
    zoned = s.rlike("(Z|[+-]\\d{2}:\\d{2})$") & (F.length(s) > 10)
    s = F.regexp_replace(s, "^(.{10}[T ]\\d{2}:\\d{2})(Z|[+-]|$)", "$1:00$2")
    whole = F.when(zoned, s).when(F.length(s) > 10, F.concat(s, F.lit("Z"))).otherwise(F.concat(s, F.lit("T00:00:00Z")))
    return F.struct(F.when(iso, F.try_to_timestamp(whole)).alias("at"), zoned.alias("zoned"))


def tidy_lines(c: Column | str) -> Column:
    """Lines trimmed at the right, runs of blanks and of empty lines shortened."""
    text = F.regexp_replace(as_col(c), "\\r\\n?", "\n")
    text = F.regexp_replace(text, "[ \\t]+", " ")
    text = F.regexp_replace(text, " *\\n *", "\n")
    return F.trim(F.regexp_replace(text, "\\n{3,}", "\n\n"))


def snake_case(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(as_col(c), "([a-z0-9])([A-Z])", "$1_$2"))
