"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: tags in their places, whole blocks of text, and the words of short blocks.
Tokens of one host that occur equally often on the same pages share an occurrence vector and so a class; the
large and frequent classes are its candidates. A class is valid if its tokens stand in the same order on every
page and if its occurrences nest: those of another class lie within one of its gaps, or the other way round.
The valid classes, nested by their tokens' positions, are the host's template. Its tokens are fixed; what
stands in their gaps are the slots. The article's slots are found by their measures: from the template's outermost
element on inwards, the one that holds most of the host's text and more than one block of it. Names of elements and
classes decide between slots where measures don't, and what is left out within the article's.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, task, written

#: Distinct pages of a host on which a class must occur at the least: so many, and this share of all.
LEAST_PAGES, LEAST_SHARE = 3, 0.5
#: Tokens that a class has at the least.
CLASS_SIZE = 2
#: Words up to which a block's words are tokens of their own.
SHORT_BLOCK = 16
#: Share of an element's text that one within it must hold to be what holds the article.
MAIN_SHARE = 0.6
#: Hashes and templates that a worker keeps.
CACHED_HASHES, CACHED_TEMPLATES = 200_000, 256

# Fixed values of HTML: elements that hold nothing, whose content is no text, that stand in a line, and that are no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea select object canvas math audio video button".split())
# Of those, the ones that browsers read to the page's end where they are not closed.
RAW_TO_END = frozenset("script style iframe textarea".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
ASIDE = frozenset("head title nav footer aside form menu dialog".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Words of class names and ids that mark what is no article; readers' comments, also as articles; headers, outside of an article only.
ASIDE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer related recommended share sharing social popup modal overlay widget toolbar pagination pager login signup copyright masthead skip".split())
COMMENT_WORDS = frozenset("comment comments discussion disqus reply replies".split())
HEADER_WORDS = frozenset(["header", "topbar"])
# Words that may stand beside those in a name; a name with any other word ("with-sidebar", "related-work") marks nothing.
BESIDE_WORDS = frozenset("area bar block body bottom box buttons container content form global group icons inner item items left links list main outer page post posts primary right row section site secondary slot stories text thread top unit wrap wrapper".split())
# Elements in which equal neighbours are entries of a list, not paragraphs.
ENTRIES = frozenset("li td th dd dt option a".split())

#: Kinds of elements for the choice of slots: any, the page's own, and those that say that they hold an article.
ANY, OUTER, ARTICLE = range(3)
KINDS = {"html": OUTER, "body": OUTER, "head": OUTER, "article": ARTICLE, "main": ARTICLE}
HEADINGS = frozenset(("h1", "h2"))
#: What is measured of an element: its role (its place, told apart from equal ones by its number among its siblings) and the role around it, its token, characters of text, blocks and headings in it, and its kind.
MEASURES = ("role", "parent", "token", "chars", "blocks", "heads", "kind")

#: Why a block is no article: not at all, by a name, as a reader's comment, by its element or role.
NO, NAMED, COMMENT, ELEMENT = range(4)

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_RAW_ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dd", ("dl",)), "dd": ("dd", ("dl",)), "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("td", ("tr", "table")), "option": ("option", ("select",))}


class Hashes(dict):
    """64-bit hashes of strings as signed integers, kept up to a bound."""

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHED_HASHES:
            self.clear()
        out = self[token] = int.from_bytes(blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
        return out


def names_of(attributes: str) -> tuple[str, str, list[set[str]]]:
    """(class, role, words of each class name and id)."""
    kind, role, names = "", "", []
    for a in _ATTRIBUTE.finditer(attributes):
        value = (a[2] or a[3] or a[4] or "").lower()
        what = a[1].lower()
        if what == "role":
            role = value
        else:
            names += [set(_WORDS.findall(n)) for n in value.split()]
            kind = value if what == "class" else kind
    return kind, role, names


def marked(names: list[set[str]], marks: frozenset[str]) -> bool:
    """Whether a name holds one of the marks, and neutral words at most beside them."""
    return any(n & marks and n <= marks | ASIDE_WORDS | COMMENT_WORDS | BESIDE_WORDS for n in names)


class Block:
    """A block of text: its element's place, why it is no article by all that encloses it and from the innermost article element on, whether one encloses it, its element's name, and the element around that."""

    __slots__ = ("aside", "around", "element", "inside", "place", "text", "within")

    def __init__(self, place: int, text: str, aside: int, within: int, inside: bool, element: str, around: int):
        self.place, self.text, self.aside, self.within, self.inside, self.element, self.around = place, text, aside, within, inside, element, around


class Page:
    """tokens: hashes of the page's tokens in order, odd for tags and even for texts; blocks: its blocks in order.

    A place is a hash of the elements and class names that lead to an element, so deep pages stay small. A tag's token
    also has its number among equal siblings, its role: else a page's frame and an article of plain elements would be one. Blocks in the
    element of the role ``main``, or else in an article or main element, are inside.
    """

    def __init__(self, html: str, hashes: Hashes, tokens: bool = True, main: int = 0):
        self.tokens: list[int] = []
        self.blocks: list[Block] = []
        self._hashes, self._wanted, self._main = hashes, tokens, main
        # of each element its role, the number of the one around it, its kind, and the text, blocks and headings of its own
        self._measured: list[list[int]] = [[0, 0, OUTER, 0, 0, 0]]
        self._siblings: Counter[tuple[int, int]] = Counter()
        # element, place, aside, aside within the article, inside an article, number
        self._open: list[tuple[str, int, int, int, bool, int]] = [("", 0, NO, NO, False, 0)]
        self._names: Counter[str] = Counter()
        self._text: list[str] = []
        self._skip: list | None = None  # an inline element that is left out: name, open elements, depth
        self._elements = 0
        at, endless = 0, set()
        while m := _TAG.search(html, at):
            if m.start() > at and not self._skip:
                self._text.append(html[at : m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name, end, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
            if name in RAW:
                if end or attributes.endswith("/"):
                    continue
                close = None if name in endless else _RAW_ENDS[name].search(html, at)
                if close:
                    at = close.end()
                elif name in RAW_TO_END:
                    at = len(html)
                else:
                    endless.add(name)
                if not self._skip:
                    self._text.append(" ")
            elif name in INLINE:
                self._inline(name, end, attributes)
            elif end:
                self._end(name)
            else:
                self._begin(name, attributes)
        if not self._skip:
            self._text.append(html[at:])
        self._break()

    def _break(self) -> None:
        """A block ends here."""
        text = " ".join(entities.unescape("".join(self._text)).split()) if self._text else ""
        self._text = []
        if text:
            element, place, aside, within, inside, number = self._open[-1]
            if self._wanted:
                own = self._measured[number]
                own[3] += len(text)
                own[4] += 1
                own[5] += element in HEADINGS
            self.blocks.append(Block(place, text, aside, within, inside, element, self._open[-2][5] if len(self._open) > 1 else 0))
            if self._wanted:
                self.tokens += block_tokens(place, text, self._hashes)

    def _inline(self, name: str, end: str, attributes: str) -> None:
        """Inline elements do not break a block; those that are no article by name or role are left out."""
        if name in VOID:
            if name == "br" and not self._skip:
                self._text.append(" ")
        elif self._skip:
            if name == self._skip[0]:
                self._skip[2] += -1 if end else 1
                if not self._skip[2]:
                    self._skip = None
        elif attributes and not end:
            _, role, names = names_of(attributes)
            if role in ASIDE_ROLES or marked(names, ASIDE_WORDS | COMMENT_WORDS):
                self._skip = [name, len(self._open), 1]

    def _begin(self, name: str, attributes: str) -> None:
        self._break()
        if self._open[-1][0] == "p":
            self._close(len(self._open) - 1)
        if name in _SIBLINGS:
            kin, borders = _SIBLINGS[name]
            if self._names[name] or self._names[kin]:
                for i in range(len(self._open) - 1, 0, -1):
                    if self._open[i][0] in borders:
                        break
                    if self._open[i][0] in (name, kin):
                        self._close(i)
                        break
        _, above, aside, within, inside, _ = self._open[-1]
        kind, aria, names = names_of(attributes) if attributes else ("", "", [])
        place = self._hashes[f"{above:x}/{name}.{kind}"]
        own = NO
        role = 0
        if name not in VOID and (self._wanted or self._main):
            number = self._open[-1][5]
            self._siblings[number, place] += 1
            role = self._hashes[f"{self._measured[number][0]:x}/{place:x}/{self._siblings[number, place]}"]
            self._measured.append([role, number, KINDS.get(name, ANY), 0, 0, 0])
        if role and role == self._main:
            inside, within = True, NO
        elif name in ("article", "main") and not self._main:
            inside, within = True, within if within >= COMMENT else NO
        if aria in ASIDE_ROLES or name in ASIDE or (name == "header" and not inside):
            own = ELEMENT
        elif names and name not in ("body", "html", "main"):
            if marked(names, COMMENT_WORDS):
                own = COMMENT
            elif name != "article" and marked(names, ASIDE_WORDS if inside else ASIDE_WORDS | HEADER_WORDS):
                own = NAMED
        if self._skip:
            own = max(own, NAMED)
        if self._wanted:
            self.tokens.append(self._hashes[f"{role or place:x}<"] | 1)
        if name not in VOID:
            self._elements += 1
            self._names[name] += 1
            self._open.append((name, place, max(aside, own), max(within, own), inside, self._elements))

    def _close(self, i: int) -> None:
        for element in self._open[i:]:
            self._names[element[0]] -= 1
        del self._open[i:]
        if self._skip and len(self._open) < self._skip[1]:
            self._skip = None

    def _end(self, name: str) -> None:
        self._break()
        if self._names[name] > 0:
            i = len(self._open) - 1
            while self._open[i][0] != name:
                i -= 1
            if self._wanted:
                self.tokens.append(self._hashes[f"{self._measured[self._open[i][5]][0]:x}>"] | 1)
            self._close(i)


    def measures(self) -> np.ndarray:
        """A row of ``MEASURES`` for each element with more than one block, which alone can hold an article; the page itself has the role 0."""
        rows = self._measured
        for own in reversed(rows[1:]):
            for i in (3, 4, 5):
                rows[own[1]][i] += own[i]
        some = [(role, rows[around][0], self._hashes[f"{role:x}<"] | 1, chars, blocks, heads, kind) for role, around, kind, chars, blocks, heads in rows if blocks > 1]
        return np.array(some, np.int64).reshape(-1, len(MEASURES))


def block_tokens(place: int, text: str, hashes: Hashes) -> list[int]:
    """Tokens of a block: the whole, and its words if there are a few."""
    words = text.split(" ", SHORT_BLOCK)
    few = words if 1 < len(words) <= SHORT_BLOCK else []
    return [hashes[f"{place:x}\n{text}"] & ~1, *(hashes[f"{place:x}\t{w}"] & ~1 for w in few)]


def extract(page: Page, template: frozenset[int]) -> str:
    """Text of the page's slots that belong to the article, joined by newlines."""
    hashes = page._hashes
    if page._main and (own := [b.text for b in page.blocks if b.inside and not b.within]):
        return "\n".join(own)
    # an article element within something that is left out by its name counts only where no other stands on the page
    if any(b.inside and not b.aside for b in page.blocks):
        return "\n".join(b.text for b in page.blocks if b.inside and not b.aside)
    if any(b.inside and not b.within for b in page.blocks):
        return "\n".join(b.text for b in page.blocks if b.inside and not b.within)
    # names that would leave nothing belong to a wrapper of the page
    blocks = [b for b in page.blocks if not b.aside] or [b for b in page.blocks if b.aside == NAMED]
    if not template:
        return "\n".join(b.text for b in blocks)

    def fixed(b: Block) -> bool:
        """The template has this block, as a whole or by each of its words."""
        whole, *words = block_tokens(b.place, b.text, hashes)
        return whole in template or bool(words) and all(w in template for w in words)

    varies = [not fixed(b) for b in blocks]
    first, last, beside = {}, {}, set()
    for i, (b, slot) in enumerate(zip(blocks, varies, strict=True)):
        if slot:
            first.setdefault(b.around, i)
            last[b.around] = i
            beside.add((b.around, b.place))
    # text that pages share stays where it stands among the slots of one element: between two, or as one more paragraph
    outer = {b.around for b in blocks if b.element in ("", "body", "html")} | {0, 1, 2}
    kept = [slot or first.get(b.around, i) < i < last.get(b.around, i) or (b.around not in outer and b.element not in ENTRIES and (b.around, b.place) in beside) for i, (b, slot) in enumerate(zip(blocks, varies, strict=True))]
    return "\n".join(b.text for b, stays in zip(blocks, kept, strict=True) if stays)


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def token_sequences(pages: DataFrame, html: str, host: str) -> DataFrame:
    """host, salt, tokens, shape: the tokens of each distinct page of a host in order, eight bytes each, a hash of the page, and its elements' measures.

    Copies would count as agreement between pages, so each distinct page counts once. Copies within a batch do
    not move; what moves is the tokens, not the page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for b in batches:
            seen, keep, tokens, shapes = set(), [], [], []
            for i, of in enumerate(zip(b.column("host").to_pylist(), b.column("salt").to_pylist(), strict=True)):
                if of not in seen:
                    seen.add(of)
                    keep.append(i)
                    page = Page(b.column("html")[i].as_py(), hashes)
                    tokens.append(np.array(page.tokens, np.int64).tobytes())
                    shapes.append(page.measures().tobytes())
            some = b.select(["host", "salt"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(tokens, pa.binary()), pa.array(shapes, pa.binary())], names=["host", "salt", "tokens", "shape"])

    rows = pages.where(F.col(html).isNotNull()).select(F.col(host).alias("host"), F.xxhash64(html, host).alias("salt"), F.col(html).alias("html"))
    return rows.mapInArrow(task(run), "host string, salt long, tokens binary, shape binary").dropDuplicates(["host", "salt"])


def occurrence_vectors(sequences: DataFrame) -> DataFrame:
    """host, token, pages, vector: distinct pages on which a token occurs and a hash of its counts by page.

    Counts are gathered within each Arrow batch before they are shuffled, so a host with a third of all pages
    sends a row for each token and batch only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host = b.column("host").dictionary_encode()
            parts = [np.unique(np.frombuffer(t, np.int64), return_counts=True) for t in b.column("tokens").to_pylist()]
            size = [len(t) for t, _ in parts]
            if not sum(size):
                continue
            token, count = (np.concatenate(x) for x in zip(*parts, strict=True))
            salt = np.repeat(b.column("salt").to_numpy().view(np.uint64), size)
            mark = mixed(mixed(count.astype(np.uint64)) ^ salt)
            of = np.repeat(host.indices.to_numpy(), size)
            order = np.lexsort((token, of))
            token, of, mark = token[order], of[order], mark[order]
            start = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (of[1:] != of[:-1])]))
            n = np.diff(np.append(start, len(token)))
            yield pa.RecordBatch.from_arrays([host.dictionary.take(pa.array(of[start])), pa.array(token[start]), pa.array(n.astype(np.int64)), pa.array(np.bitwise_xor.reduceat(mark, start).view(np.int64))], names=["host", "token", "pages", "vector"])

    counts = sequences.mapInArrow(task(run), "host string, token long, pages long, vector long")
    return counts.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"))


def classes(vectors: DataFrame, sizes: DataFrame) -> DataFrame:
    """host, tokens, ends: the host's large and frequent classes with a tag, the most frequent and largest first, as packed tokens and the number of tokens up to each class's end. sizes: host, all (its distinct pages).

    Such a token stands on at least ``LEAST_SHARE`` of the host's pages, so a host has no more of them than
    1 / ``LEAST_SHARE`` times the tokens of its average page, whatever the number of its pages.
    """
    frequent = vectors.where(F.col("pages") >= LEAST_PAGES).join(sizes, "host").where(F.col("pages") >= LEAST_SHARE * F.col("all"))
    made = frequent.groupBy("host", "vector", "pages").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    # a class of texts alone encloses nothing: it is text that pages share
    made = made.where((F.size("tokens") >= CLASS_SIZE) & F.exists("tokens", lambda t: t.bitwiseAND(F.lit(1)) == 1))
    ranked = made.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("pages")).alias("p"), (-F.size("tokens")).alias("n"), "vector", "tokens"))).alias("ranked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [[c["tokens"] for c in ranked] for ranked in b.column("ranked").to_pylist()]
            tokens = [np.array([t for c in of for t in c], np.int64).tobytes() for of in lists]
            ends = [np.cumsum([len(c) for c in of]).astype(np.int64).tobytes() for of in lists]
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(tokens, pa.binary()), pa.array(ends, pa.binary())], names=["host", "tokens", "ends"])

    return ranked.mapInArrow(task(run), "host string, tokens binary, ends binary")


def one_order(at: np.ndarray, tokens: np.ndarray, size: int) -> bool:
    """Whether a class's tokens, at rising places of one page, come in one order over and over."""
    return len(at) % size == 0 and bool((tokens.reshape(-1, size) == tokens[:size]).all()) and len(set(tokens[:size].tolist())) == size


def enclosed(at: np.ndarray, rank: np.ndarray, shapes: dict[int, np.ndarray]) -> np.ndarray:
    """Matrix by (class, class): whether a token of the first stands within an occurrence of the second. at: rising places with their classes; shapes: places by (occurrence, token).

    Two classes overlap if either has a token within the other: else each occurrence of one lies in one gap of the other.
    """
    index = {k: i for i, k in enumerate(shapes)}
    number = np.array([index.get(k, -1) for k in rank.tolist()], np.int64)
    out = np.zeros((len(shapes), len(shapes)), bool)
    for k, shape in shapes.items():
        for lo, hi in zip(np.searchsorted(at, shape[:, 0]).tolist(), np.searchsorted(at, shape[:, -1]).tolist(), strict=True):
            inside = number[lo + 1 : hi]
            out[inside[inside >= 0], index[k]] = True
    return out


def judge(sequence: np.ndarray, tokens: np.ndarray, of: np.ndarray, sizes: np.ndarray) -> tuple[list[int], list[int], list[bool]]:
    """(classes on the page, a hash of each one's order, whether it is out of order or overlaps a class of a better rank).

    sequence: the page's tokens; tokens: the candidates, rising, with their classes.
    """
    hit = np.minimum(np.searchsorted(tokens, sequence), len(tokens) - 1)
    places = np.flatnonzero(tokens[hit] == sequence)
    ranks = of[hit[places]]
    order = np.argsort(ranks, kind="stable")
    at, rank = places[order], ranks[order]
    start = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(rank) else np.zeros(0, np.int64)
    found, orders, shapes = [], [], {}
    for lo, hi in zip(start.tolist(), [*start[1:].tolist(), len(rank)], strict=True):
        k = int(rank[lo])
        size, mine = int(sizes[k]), sequence[at[lo:hi]]
        if one_order(at[lo:hi], mine, size):
            shapes[k] = at[lo:hi].reshape(-1, size)
        found.append(k)
        orders.append(int.from_bytes(blake2b(mine[:size].tobytes(), digest_size=8).digest(), "little", signed=True))
    within = enclosed(places, ranks, shapes)
    overlap, good = within & within.T, np.zeros(len(shapes), bool)
    np.fill_diagonal(overlap, False)
    for i in range(len(shapes)):
        good[i] = not (overlap[i] & good).any()
    fine = {k for k, ok in zip(shapes, good.tolist(), strict=True) if ok}
    return found, orders, [k not in fine for k in found]


def templates(sequences: DataFrame, candidates: DataFrame) -> DataFrame:
    """host, template: the packed tokens of the host's valid classes."""
    named = candidates.select(F.col("host").alias("_host"), F.col("tokens").alias("class_tokens"), "ends")
    joined = sequences.join(named, F.col("host") == F.col("_host")).select("host", "tokens", "class_tokens", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of_host: dict[str, tuple] = {}
            seen: set[tuple[str, bytes]] = set()
            out: dict[tuple[str, int], list] = {}
            for host, page, packed, ends in zip(*(b.column(n).to_pylist() for n in ("host", "tokens", "class_tokens", "ends")), strict=True):
                if host not in of_host:
                    tokens, sizes = np.frombuffer(packed, np.int64), np.diff(np.frombuffer(ends, np.int64), prepend=0)
                    order = np.argsort(tokens)
                    of_host[host] = tokens[order], np.repeat(np.arange(len(sizes)), sizes)[order], sizes
                tokens, of, sizes = of_host[host]
                sequence = np.frombuffer(page, np.int64)
                # pages of one frame differ in their slots only
                sequence = sequence[tokens[np.minimum(np.searchsorted(tokens, sequence), len(tokens) - 1)] == sequence]
                frame = (host, sequence.tobytes())
                if frame in seen:
                    continue
                seen.add(frame)
                for k, order, bad in zip(*judge(sequence, tokens, of, sizes), strict=True):
                    hit = out.setdefault((host, k), [order, order, False])
                    hit[0], hit[1], hit[2] = min(hit[0], order), max(hit[1], order), hit[2] or bad
            columns = [pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.int32()), pa.array([v[0] for v in out.values()], pa.int64()), pa.array([v[1] for v in out.values()], pa.int64()), pa.array([v[2] for v in out.values()], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "rank", "least", "most", "bad"])

    judged = joined.mapInArrow(task(run), "host string, rank int, least long, most long, bad boolean")
    valid = judged.groupBy("host", "rank").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.max("bad").alias("bad")).where("least = most and not bad")
    lists = valid.groupBy("host").agg(F.collect_list("rank").alias("ranks")).join(named, F.col("host") == F.col("_host"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for ranks, packed, ends in zip(*(b.column(n).to_pylist() for n in ("ranks", "class_tokens", "ends")), strict=True):
                tokens, to = np.frombuffer(packed, np.int64), np.frombuffer(ends, np.int64)
                out.append(np.concatenate([tokens[to[k - 1] if k else 0 : to[k]] for k in sorted(ranks)]).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(out, pa.binary())], names=["host", "template"])

    return lists.select("host", "ranks", "class_tokens", "ends").mapInArrow(task(pack), "host string, template binary")


def role_measures(sequences: DataFrame, sizes: DataFrame) -> DataFrame:
    """host and roles: ``MEASURES`` summed over its distinct pages, of the roles that stand on ``LEAST_SHARE`` of them. Measures add up within each batch before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host = b.column("host").dictionary_encode()
            parts = [np.frombuffer(x, np.int64).reshape(-1, len(MEASURES)) for x in b.column("shape").to_pylist()]
            if not sum(map(len, parts)):
                continue
            rows, of = np.concatenate(parts), np.repeat(host.indices.to_numpy(), [len(p) for p in parts])
            order = np.lexsort((rows[:, 0], of))
            rows, of = rows[order], of[order]
            start = np.flatnonzero(np.concatenate([[True], (rows[1:, 0] != rows[:-1, 0]) | (of[1:] != of[:-1])]))
            sums = [np.add.reduceat(rows[:, MEASURES.index(c)], start) for c in ("chars", "heads")]
            columns = [*(rows[start, MEASURES.index(c)] for c in ("role", "parent", "token", "kind")), *sums, np.diff(np.append(start, len(rows)))]
            yield pa.RecordBatch.from_arrays([host.dictionary.take(pa.array(of[start])), *map(pa.array, columns)], names=["host", "role", "parent", "token", "kind", "chars", "heads", "pages"])

    made = sequences.select("host", "shape").mapInArrow(task(run), "host string, role long, parent long, token long, kind long, chars long, heads long, pages long")
    # a role has one parent, token and kind
    made = made.groupBy("host", "role", "parent", "token", "kind").agg(*[F.sum(c).alias(c) for c in ("chars", "heads", "pages")])
    often = made.join(sizes, "host").where((F.col("all") >= LEAST_PAGES) & (F.col("pages") >= LEAST_SHARE * F.col("all")))
    return often.groupBy("host").agg(F.collect_list(F.struct("role", "parent", "token", "kind", "chars", "heads")).alias("roles"))


def main_role(roles: list[dict], template: frozenset[int]) -> int:
    """The role of the template's element whose slots hold the article; 0 if none stands out. roles: those with more than one block.

    Inwards from the page, an element of the template follows if it has ``MAIN_SHARE`` of the text around it. Where none
    has, one that is called an article follows. A heading just outside takes the element around both.
    """
    within: dict[int, list[dict]] = {}
    for r in roles:
        if r["role"]:
            within.setdefault(r["parent"], []).append(r)
    at, path = next((r for r in roles if not r["role"]), None), []
    while at is not None:
        fixed = [r for r in within.get(at["role"], []) if r["kind"] == OUTER or r["token"] in template]
        named = [r for r in fixed if r["kind"] == ARTICLE]
        best = max(fixed, key=lambda r: (r["chars"], r["role"]), default=None)
        if best is None or best["chars"] < MAIN_SHARE * at["chars"]:
            if len(named) != 1:
                break
            best = named[0]
        path.append(at)
        at = best
    while path and path[-1]["kind"] != OUTER and path[-1]["heads"] > at["heads"]:
        at = path.pop()
    return 0 if at is None or at["kind"] == OUTER else at["role"]


def with_main_roles(found: DataFrame, measures: DataFrame) -> DataFrame:
    """host, template: the templates, each with its host's main role before its tokens."""
    joined = found.join(measures.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left").select("host", "template", "roles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for packed, roles in zip(b.column("template").to_pylist(), b.column("roles").to_pylist(), strict=True):
                tokens = np.frombuffer(packed, np.int64)
                out.append(np.concatenate([np.array([main_role(roles or [], frozenset(tokens.tolist()))], np.int64), tokens]).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(out, pa.binary())], names=["host", "template"])

    return joined.mapInArrow(task(run), "host string, template binary")


def page_text(html: str, hashes: Hashes, template: tuple[int, frozenset[int]]) -> str:
    """The main text of a page of a host with a template (main role, tokens); on a page that lacks that role, elements, names and the template's texts decide."""
    main, tokens = template
    page = Page(html, hashes, tokens=False, main=main)
    if main and not any(b.inside and not b.within for b in page.blocks):
        page = Page(html, hashes, tokens=False)
    return extract(page, tokens)


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Every row's key and url with text and n_chars (code points).

    A null or empty html gives an empty text; a null url, or one without a host, belongs to a host of its own
    kind; null keys and repeated rows are kept; ties cannot arise; extra columns are not read; an empty table
    gives an empty result. Equal pages of one host count once for its template; the template's element that holds
    most of the host's text bounds the article (``main_role``). A host with fewer than ``LEAST_PAGES`` distinct
    pages has no template, and where no element stands out there is none to bound the text: then an article or main
    element does, or elements, roles and names decide.

    Jobs run when this is called: the distinct pages' tokens and the templates are written to the shared folder.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html")).withColumn("host", host_of("url"))
    sequences = written(token_sequences(rows, "html", "host"), "page-tokens")
    sizes = sequences.groupBy("host").agg(F.count("*").alias("all"))
    candidates = written(classes(occurrence_vectors(sequences), sizes), "page-classes")
    # written first, so that Spark knows their size before it plans the join: it broadcasts them only if they are small, and splits a hot host's pages otherwise
    framed = with_main_roles(templates(sequences, candidates), role_measures(sequences, sizes))
    found = written(framed, "page-templates").withColumnRenamed("host", "_host")
    joined = rows.join(found, F.col("host") == F.col("_host"), "left").select("key", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = Hashes(), {b"": (0, frozenset())}
        for b in batches:
            texts = []
            for page, packed in zip(b.column("html"), b.column("template"), strict=True):
                packed = packed.as_py() or b""
                if packed not in known:
                    if len(known) > CACHED_TEMPLATES:
                        known.clear()
                    main, *tokens = np.frombuffer(packed, np.int64).tolist()
                    known[packed] = main, frozenset(tokens)
                texts.append(page_text(page.as_py(), hashes, known[packed]) if page.is_valid else "")
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["key", "url", "text", "n_chars"])

    kind = pages.schema[key].dataType.simpleString()
    return joined.mapInArrow(task(run), f"key {kind}, url string, text string, n_chars long").toDF(key, url, "text", "n_chars")
