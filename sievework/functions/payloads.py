"""Payloads without secrets, in Columns: names at any depth, parameters of URLs and of URLs in them, and what is left without them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import as_col, let

# Words that make a name a secret, whole names that are secret or internal, and their beginnings.
SECRET_WORDS = ("cookie", "token", "password", "account", "auth", "secret", "session", "credential", "authorization", "wt2")
SECRET_NAMES = ("zp_stoken", "zp_token", "acw_tc")
INTERNAL_NAMES, INTERNAL_STARTS = ("lid", "security"), ("encrypt_", "security_")
#: Internal names that a stored raw answer keeps, as they stand in public links.
PUBLIC_IDENTITIES = ("encrypt_job_id", "encrypt_brand_id")
#: Names whose values are URLs, whatever they look like.
URL_NAMES = "^(?:url|urls|link|links|href|uri)$|_(?:url|link|uri|href|urls|links)$"
_URL, _VALUE = "^\\s*(?:https?:)?//", "(?i)(cookie|token|password|secret|security_?id)=([^&\\s\"'<>]+)"

#: URLs within URLs' parameters that are cleaned; what lies deeper goes.
URL_DEPTH = 4


def plain_name(name: Column) -> Column:
    """A name in lower case, its words joined by underscores."""
    parted = F.regexp_replace(name, "(?<=[a-z0-9])(?=[A-Z])", "_")
    return F.regexp_replace(F.regexp_replace(F.lower(parted), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def hidden_name(name: Column | str, keep: tuple[str, ...] = ()) -> Column:
    """Whether a name is secret or internal; ``keep`` has internal ones (plain) that may stay."""

    def hidden(k: Column) -> Column:
        secret = k.isin(*SECRET_NAMES) | F.arrays_overlap(F.split(k, "_"), F.array(*map(F.lit, SECRET_WORDS)))
        internal = k.isin(*INTERNAL_NAMES)
        for start in INTERNAL_STARTS:
            internal |= k.startswith(start)
        return secret | (internal & ~k.isin(*keep) if keep else internal)

    return let(plain_name(as_col(name)), hidden)


# ---------------------------------------------------------------- names


def _strings(payload: Column) -> Column:
    """The strings of a JSON text in their order, keys with a colon. Escaped backslashes and quotes are set aside first, so that a string ends at the next quote."""
    aside = F.replace(F.replace(payload, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    found = F.regexp_extract_all(aside, F.lit('"[^"]*"(?:\\s*:)?'), F.lit(0))
    return F.transform(found, lambda s: F.replace(F.replace(s, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\")))


def _read(quoted: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(quoted), "$", "string")


def _decoded(part: Column) -> Column:
    return F.coalesce(F.try_url_decode(part), part)


def _pairs(query: Column) -> Column:
    """array<struct(key, value)> of a query, decoded."""
    parts = F.filter(F.split(query, "&"), lambda p: p != "")
    cut = lambda p: F.when(F.locate("=", p) > 0, F.substr(p, F.locate("=", p) + 1)).otherwise("")
    return F.transform(parts, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("key"), _decoded(cut(p)).alias("value")))


def _query(url: Column) -> Column:
    return F.regexp_extract(url, "(?s)^[^?#]*\\?([^#]*)", 1)


def hidden_parameters(url: Column | str) -> Column:
    """Names of hidden parameters of a URL, of its fragment, and of the URLs that its parameters hold, however deep; none in another text."""
    u = F.trim(as_col(url))
    empty = F.array().cast("array<string>")

    def step(s: Column, _: Column) -> Column:
        own = F.flatten(F.transform(s.todo, lambda x: _pairs(_query(x))))
        marks = F.flatten(F.transform(s.todo, lambda x: _pairs(F.regexp_replace(F.regexp_extract(x, "(?s)#(.*)$", 1), "^\\?", ""))))
        names = lambda pairs: F.transform(F.filter(pairs, lambda p: hidden_name(p.key)), lambda p: p.key)
        nested = F.transform(F.filter(own, lambda p: p.value.rlike("^(?:https?:)?//")), lambda p: p.value)
        return F.struct(nested.alias("todo"), F.concat(s.found, names(own), names(marks)).alias("found"))

    # each URL within another has two slashes of its own, encoded once for each level
    levels = F.size(F.regexp_extract_all(u, F.lit("(?i)(?:/|%(?:25)*2f){2}"), F.lit(0)))
    start = F.struct(F.array(u).alias("todo"), empty.alias("found"))
    return F.when(u.rlike(_URL), F.aggregate(F.sequence(F.lit(1), levels), start, step, lambda s: F.array_distinct(s.found))).otherwise(empty)


def secret_keys(payload: Column | str) -> Column:
    """Keys of a JSON text, at any depth and in its URLs' parameters, that name secrets or internal values; sorted. What is no JSON has none."""
    p, empty = as_col(payload), F.array().cast("array<string>")

    def found(strings: Column) -> Column:
        keys = F.transform(F.filter(strings, lambda s: s.endswith(":")), lambda s: _read(F.regexp_replace(s, "\\s*:$", "")))
        values = F.filter(F.transform(F.filter(strings, lambda s: ~s.endswith(":")), _read), lambda v: v.rlike(_URL))
        return F.array_sort(F.array_distinct(F.concat(F.filter(keys, lambda k: hidden_name(k)), F.flatten(F.transform(values, hidden_parameters)))))

    return F.when(F.try_parse_json(p).isNotNull(), let(_strings(p), found)).otherwise(empty)


# ---------------------------------------------------------------- what is left


def _masked(text: Column) -> Column:
    return F.regexp_replace(text, _VALUE, "$1=***")


def safe_url(url: Column | str, depth: int = URL_DEPTH) -> Column:
    """A URL without hidden parameters, also in URLs that its parameters hold, and without fragment. A value that hides parameters without being a URL goes with its parameter."""

    def one(u: Column, left: int) -> Column:
        is_url = lambda p: p.value.rlike("^(?:https?:)?//")
        hides = lambda p: F.exists(_pairs(p.value), lambda q: hidden_name(q.key))
        kept = F.filter(_pairs(_query(u)), lambda p: ~hidden_name(p.key) & F.when(is_url(p), F.lit(left > 0)).otherwise(~hides(p)))
        value = lambda p: F.when(is_url(p), one(p.value, left - 1)).otherwise(_masked(p.value)) if left else _masked(p.value)
        pairs = F.transform(kept, lambda p: F.concat(F.url_encode(p.key), F.lit("="), F.url_encode(value(p))))
        base = F.regexp_extract(u, "(?s)^([^?#]*)", 1)
        return F.concat(base, let(pairs, lambda x: F.when(F.size(x) > 0, F.concat(F.lit("?"), F.array_join(x, "&"))).otherwise("")))

    return one(as_col(url), depth)


def levels(payload: Column | str) -> Column:
    """How many levels of objects and lists a JSON text has."""
    aside = F.replace(F.replace(as_col(payload), F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    marks = F.split(F.regexp_replace(F.regexp_replace(aside, '"[^"]*"', ""), "[^\\[\\]{}]", ""), "")

    def step(s: Column, c: Column) -> Column:
        at = s.at + F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)
        return F.struct(at.alias("at"), F.greatest(s.most, at).alias("most"))

    return F.aggregate(marks, F.struct(F.lit(0).alias("at"), F.lit(0).alias("most")), step, lambda s: s.most)


def _whole(payload: Column, depth: int) -> Column:
    """The text with each object and list of at most ``depth`` levels between marks of their own height: no such mark stands in what it holds, so a pair is found by its number."""
    for h in range(depth):
        for kind, (a, b) in (("o", "{}"), ("a", "[]")):
            payload = F.regexp_replace(payload, f"\\{a}([^{{}}\\[\\]]*)\\{b}", f"\x03{kind}{h}\x04$1\x05{kind}{h}\x06")
    return payload


def _without(text: Column) -> Column:
    """A text of ``_whole`` without the entries whose keys are marked, and with its objects and lists as they were."""
    entry = '"\x07[^"]*":(?:"[^"]*"|[^,"\x03-\x06]+|\x03([oa]\\d+)\x04(?s:.*?)\x05\\1\x06),?'
    text = F.regexp_replace(F.regexp_replace(text, entry, ""), ",(?=\x05)", "")
    for kind, (a, b) in (("o", "{}"), ("a", "[]")):
        text = F.regexp_replace(F.regexp_replace(text, f"\x03{kind}\\d+\x04", a), f"\x05{kind}\\d+\x06", b)
    return text


#: Brackets within strings are set aside as control characters, which JSON never holds unescaped.
_BRACKETS, _ASIDE = "{}[]", "\x0e\x0f\x10\x11"


def safe_form(payload: Column | str, depth: int, keep: tuple[str, ...] = ()) -> Column:
    """A JSON text of at most ``depth`` levels with sorted keys, without hidden keys at any level, its URLs cleaned and secrets in its texts masked; null where it is no JSON."""
    plain = F.to_json(F.try_parse_json(as_col(payload)))
    aside = lambda x: F.translate(F.replace(F.replace(x, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02")), _BRACKETS, _ASIDE)
    back = lambda x: F.replace(F.replace(F.translate(x, _ASIDE, _BRACKETS), F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    start = F.replace(F.replace(plain, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))

    def value(text: Column, named_url: Column) -> Column:
        return F.when(text.rlike(_URL) | named_url, safe_url(text)).otherwise(_masked(text))

    def token(t: Column, before: Column) -> Column:
        name = lambda x: _read(back(F.regexp_replace(x, ":$", "")))
        key = F.concat(F.when(hidden_name(name(t), keep), '"\x07').otherwise('"'), F.translate(F.substr(t, F.lit(2)), _BRACKETS, _ASIDE))
        named = F.when(before.endswith(":"), plain_name(name(before)).rlike(URL_NAMES)).otherwise(False)
        text = aside(F.to_json(value(_read(back(t)), named).cast("variant")))
        return F.when(~t.startswith('"'), t).when(t.endswith(":"), key).otherwise(text)

    def walked(tokens: Column) -> Column:
        return F.array_join(F.transform(tokens, lambda t, i: token(t, F.coalesce(F.get(tokens, i - 1), F.lit("")))), "")

    found = F.regexp_extract_all(start, F.lit('"[^"]*":?|[^"]+'), F.lit(0))
    return back(_without(_whole(let(found, walked), depth)))


def safe_json(df: DataFrame, payload: str, out: str = "safe", keep: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with a JSON text's safe form as text: sorted keys, nothing hidden; null where it is no JSON.

    Numbers keep their value and not their spelling. A job measures how deep the payloads are, so none is cut off.
    """
    depth = df.agg(F.max(levels(payload))).first()[0] or 0
    return df.withColumn(out, safe_form(payload, depth, keep))
