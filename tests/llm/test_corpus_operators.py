"""Operators that compare texts, pages and the pipeline, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from sievework.llm import repeats, similarity, templates


def brute_repeats(rows, window):
    first = {}
    for k, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - window + 1) if k is not None else ():
            first[b[p : p + window]] = min(k, first.get(b[p : p + window], k))
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1) if k is not None else ():
            if first[b[p : p + window]] < k:
                gone[p : p + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("heavy", [10_000, 2])
def test_repeats_match_brute_force(spark, heavy, monkeypatch):
    monkeypatch.setattr(repeats, "HEAVY", heavy)
    rnd = random.Random(3)
    parts = ["".join(rnd.choice("abcé \n") for _ in range(rnd.randint(40, 300))) for _ in range(8)]
    rows = [(None, "x" * 100), (5, None), (6, ""), (7, "a" * 3000), (9, "a" * 70), (9, "a" * 70), (10, "b" + "a" * 49), (11, "b" + "a" * 50 + "c"), (12, parts[0]), (12, parts[1])]
    for k in range(20, 90):
        text = ""
        for _ in range(rnd.randint(1, 5)):
            q = rnd.choice(parts)
            a = rnd.randint(0, len(q))
            text += q[a : rnd.randint(a, len(q))] if rnd.random() < 0.7 else "".join(rnd.choice("abcdefé ") for _ in range(rnd.randint(1, 90)))
        rows.append((k, text))
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, k string, h int").repartition(5)
    got = repeats.remove_repeats(df, keep=("k",)).drop("k").collect()
    assert Counter(map(tuple, got)) == Counter(brute_repeats(rows, 50))
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_repeats_in_long_texts_match_brute_force(spark, monkeypatch):
    """Texts that the kernels take in pieces, equal texts of one key, and a whole text that an earlier one holds."""
    monkeypatch.setattr(repeats, "KERNEL_BYTES", 4_096)
    rnd = random.Random(9)
    long = "".join(rnd.choice("abcdé \n") for _ in range(30_000))
    rows = [(1, long), (2, long[10_000:22_000] + "new end " * 9), (3, "".join(rnd.choice("abc") for _ in range(9_000)) + long[:3_000]), (4, long), (5, long[500:900]), (5, long[500:900]), (6, long[500:900]), (7, "z" * 20_000), (8, "z" * 12_000)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_repeats(rows, 50))


@pytest.mark.parametrize("heavy, chunk", [(10_000, 1 << 17), (10_000, 300), (2, 300)])
def test_shared_strings_travel_packed(spark, heavy, chunk, monkeypatch):
    """A batch sends a row for each slice, not one for each string; slices are settled in parts, and windows dealt out one by one in turns."""
    monkeypatch.setattr(repeats, "HEAVY", heavy)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    sent, real = [], repeats.neighbourhoods
    monkeypatch.setattr(repeats, "neighbourhoods", lambda *args: sent.append(real(*args)) or sent[-1])
    rnd = random.Random(21)
    parts = ["".join(rnd.choice("abcdé \n") for _ in range(400)) for _ in range(12)]
    rows = [(k, "".join(q[(a := rnd.randint(0, 200)) : a + rnd.randint(60, 200)] + f"<{k}>" for q in rnd.sample(parts, 4))) for k in range(60)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_repeats(rows, 50))
    # four slices, each with an Arrow batch: a row a slice and turn, and one for what is settled
    turns = 64 if heavy == 2 else 1
    assert 0 < sent[0].count() <= 4 * (4 * turns + 1)


def test_longest_previous_factor():
    import numpy as np

    rnd = random.Random(5)
    for _ in range(50):
        n = rnd.randint(1, 40)
        values, lcp = np.array([rnd.randint(0, 9) for _ in range(n)]), np.array([0] + [rnd.randint(0, 20) for _ in range(n - 1)])
        want = [max([min(lcp[min(i, j) + 1 : max(i, j) + 1]) for j in range(n) if values[j] < values[i]], default=0) for i in range(n)]
        assert repeats.longest_previous(values, lcp).tolist() == want


def brute_links(rows):
    first = {}
    for k, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(t or "", k)
    grams = {}
    for t, k in first.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        grams[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    near, group = defaultdict(set), {k: k for k in grams}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in grams:
        for b in grams:
            if a < b and (c := len(grams[a] & grams[b])) and 9 * c >= 4 * (len(grams[a]) + len(grams[b])):
                near[a].add(b)
                near[b].add(a)
                x, y = sorted((root(a), root(b)))
                group[y] = x
    copies = Counter(t or "" for _, t in rows)
    return Counter((k, first.get(t or ""), root(first[t or ""]) if (t or "") in first else None, copies[t or ""] - 1, len(near[first[t or ""]]) if (t or "") in first else 0) for k, t in rows)


@pytest.mark.parametrize("block", [512, 3])
def test_similarity_matches_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_TEXTS", block)
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(4))
    rows = [(None, "only nulls have this"), (1, None), (2, ""), (3, "a b"), (4, "A b"), (5, " ")]
    for g in range(8):
        base = [word() for _ in range(60)]
        for _ in range(6):
            w = list(base)
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(60)] = word()
            rows.append((10 + len(rows), " ".join(w)))
        rows.append((10 + len(rows), rows[-1][1]))
        rows.append((None, rows[-1][1]))
    rows.append(rows[20])
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, u string").repartition(4)
    got = similarity.similar_texts(df)
    want = brute_links(rows)
    assert Counter((r.doc_id, r.text_id, r.group_id, r.n_copies, r.n_links) for r in got.collect()) == want
    stay = similarity.one_of_each(df)
    groups = {r[2] for r in want if r[2] is not None}
    assert sorted(r.doc_id for r in stay.where("doc_id is not null").collect()) == sorted(groups) and stay.columns == df.columns
    assert similarity.similar_texts(df.limit(0)).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    rnd = random.Random(13)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 260)] + [(x, x % 20 + 300) for x in range(300, 320)] + [(rnd.randint(400, 480), rnd.randint(400, 480)) for _ in range(60)] + [(500, 500)]
    group = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            group[b] = a
    got = similarity.components(spark.createDataFrame(edges, "u long, v long").repartition(3), "test-edges").collect()
    assert len(got) == len(group) and {r.u: r.label for r in got} == {x: root(x) for x in group}
    assert similarity.components(spark.createDataFrame([], "u long, v long"), "test-edges").count() == 0


def test_few_long_near_copies_have_more_blocks_than_texts(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_GRAMS", 100)
    rows = []
    for g in range(3):
        base = [f"w{g}x{i}" for i in range(300)]
        rows += [(10 * g, " ".join(base)), (10 * g + 1, " ".join([*base[:-1], "other"]))]
    got = similarity.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text_id, r.group_id, r.n_copies, r.n_links) for r in got) == brute_links(rows)
    assert all(r.n_links == 1 for r in got)


def page(i, body, extra=""):
    return f"<!DOCTYPE html><html><head><title>T{i}</title><script>var t='</p>';</script></head><body><nav><ul><li><a href=/x>Home</a></ul></nav><div class='side-bar promo'>Buy now</div>{body}<div id=comments><p>first!</p></div><div>Please read our policy</div>{extra}<footer>&copy; site</footer>"


def test_pages_keep_their_article_only(spark):
    html = [page(i, f"<article><h1>Title {i}</h1><p>One &amp; two {i}<br>three<p>  more\n text {i * 7}</p><aside>see also</aside></article>") for i in range(6)]
    html += [page(i, f"<div class=content><p>Body number {i} stands &lt;here&gt;</p></div>") for i in range(6, 12)]
    rows = [(i, f"http://h.example/{i}", h, 1) for i, h in enumerate(html)] + [(None, None, None, 1), (99, "nohost", "", 1), (98, "http://one.example/", "<p>just text<script>x", 1)]
    got = {r.page_id: r for r in templates.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, token int")).collect()}
    assert len(got) == len(rows)
    for i in range(6):
        assert got[i].text == f"Title {i}\nOne & two {i} three\nmore text {i * 7}" and got[i].n_chars == len(got[i].text)
    for i in range(6, 12):
        assert got[i].text == f"Body number {i} stands <here>"
    assert got[None].text == got[99].text == "" and got[98].text == "just text"
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert templates.main_text(empty).count() == 0


@pytest.mark.parametrize("wrap", ["<div class='layout with-sidebar'><article>{}</article></div>", "<div class=sidebar><main>{}</main></div>", "<div id=page class=has-menu>{}</div>", "<div class='content share-enabled'>{}</div>", "<div class='post cookie-ok'>{}</div>", "<article><section id=related-work>{}</section></article>", "<div class=widget>{}</div>"])
def test_wrappers_with_an_aside_word_keep_the_article(wrap):
    html = "<nav>Home</nav>" + wrap.format("<p>Body</p>") + "<footer>end</footer>"
    assert text_of(html) == "Body"


def text_of(html):
    return templates.extract(templates.Page(html, templates.Hashes()), frozenset())


@pytest.mark.parametrize(
    "html, text",
    [
        ("<div class=content><p>Body</p></div><div class='cookie-banner'>x</div><div id=comment-list-2>y</div><div class='site-footer'>z</div>", "Body"),
        ("<div class='layout has-sidebar'><article><p>Body</p></article></div>", "Body"),
        ("<article><p>a</p><section class='reply-to-critics'><p>b</p></section></article>", "a\nb"),
        ("<p>a <svg class='i'/> b</p><p>c</p>", "a b\nc"),
        ("<p>a<object data=x>b</p><video>c<select><p>d</p>", "a b\nc\nd"),
        ("<p>a</p><script>if (1 < 2) {<p>x</p>", "a"),
        ("<article><p>one <span class=advert>buy <span>now</span></span> two</p></article>", "one two"),
        ("<article><p>one <span class=ad>buy</p><p>two</p></article>", "one\ntwo"),
        ("<article><p>A</p></article><section id=comments><article class=comment><p>no</p></article></section>", "A"),
        ("<section class=related><article>teaser</article></section><article>real</article>", "real"),
        ("<p>x<button>go</button>y &lt;b&gt; &nbsp;z</p>", "x y <b> z"),
        ('<p title="a>b">t</p><p title="open>u</p>', "t\nu"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\nb\n1\n2\n3"),
        ("<div>" * 20_000 + "deep", "deep"),
        ("", ""),
    ],
)
def test_elements_of_one_page(html, text):
    assert text_of(html) == text


def brute_classes(pages):
    """Valid classes of one host's distinct pages, by comparing whole occurrence vectors and all places."""
    vector = {t: tuple(p.count(t) for p in pages) for p in pages for t in p}
    groups = defaultdict(list)
    for t, v in vector.items():
        if sum(map(bool, v)) >= max(templates.LEAST_PAGES, templates.LEAST_SHARE * len(pages)):
            groups[v].append(t)
    ranked = sorted((g for g in groups.values() if len(g) >= templates.CLASS_SIZE and any(t & 1 for t in g)), key=lambda g: (-sum(map(bool, vector[g[0]])), -len(g)))
    orders, bad = defaultdict(set), set()
    for p in pages:
        good = []
        for n, g in enumerate(ranked):
            at = [i for i, t in enumerate(p) if t in g]
            if not at:
                continue
            size, mine = len(g), [p[i] for i in at]
            orders[n].add(tuple(mine[:size]))
            places = [at[i : i + size] for i in range(0, len(at), size)]

            def one_gap(x, y):
                return all(len({sum(i > q for o in y for q in o) for i in occurrence}) == 1 for occurrence in x)

            if mine != mine[:size] * len(places) or len(set(mine[:size])) < size or not all(one_gap(o, places) or one_gap(places, o) for o in good):
                bad.add(n)
            else:
                good.append(places)
    return {t for n, g in enumerate(ranked) if n not in bad and len(orders[n]) == 1 for t in g}


def test_classes_match_brute_force(spark):
    """Classes by exact vectors; ranks are told apart by pages and size, so the pages here hold no two equal in both that overlap."""
    rnd = random.Random(11)
    rows = []
    for h in range(6):
        for i in range(9):
            items = "".join(f"<li><a>Entry {rnd.randint(0, 3)}</a></li>" for _ in range(rnd.randint(0, 3)))
            mid = ["<div class=a><p>Shared words here</p></div>", "<div class=b><h2>Other shared</h2></div>", f"<section><p>Story {rnd.random()}</p></section>"]
            if h % 2:
                rnd.shuffle(mid)  # classes out of order
            rows.append((len(rows), f"http://h{h}.example/{i}", f"<body><ul>{items}</ul>{''.join(mid)}<div class=end>The end of it</div></body>"))
    pages = spark.createDataFrame(rows + rows[:7], "page_id long, url string, html string").repartition(4).withColumn("host", templates.host_of("url"))
    sequences = templates.token_sequences(pages, "html", "host").cache()
    candidates = templates.classes(templates.occurrence_vectors(sequences), sequences.groupBy("host").count().withColumnRenamed("count", "all"))
    got = {r.host: set(memoryview(r.template).cast("q")) for r in templates.templates(sequences, candidates).collect()}
    by_host = defaultdict(list)
    for r in sequences.collect():
        by_host[r.host].append(list(memoryview(r.tokens).cast("q")))
    assert len(by_host) == 6 and all(len(p) == 9 for p in by_host.values())
    assert got == {h: w for h, p in by_host.items() if (w := brute_classes(p))}
    assert all(len(got[f"h{h}.example"]) > len(got[f"h{h + 1}.example"]) for h in (0, 2, 4))


def test_text_that_pages_share_stays_among_slots(spark):
    """Without an article element: fixed blocks go, but not those between an element's slots; equal pages alone have no template."""
    html = [f"<body><div><a>Home</a></div><div class=content><p>Tale {i}</p><p>He said yes.</p><p>End of {i * 3}</p></div><div>Please read our policy</div></body>" for i in range(6)]
    rows = [(i, f"http://h.example/{i}", h) for i, h in enumerate(html)] + [(10 + i, "http://same.example/", html[0]) for i in range(5)]
    df = spark.createDataFrame(rows + rows[:2], "page_id long, url string, html string").repartition(3)
    got = Counter((r.page_id, r.text) for r in templates.main_text(df).collect())
    want = [(i, f"Tale {i}\nHe said yes.\nEnd of {i * 3}") for i in range(6)] + [(10 + i, "Home\nTale 0\nHe said yes.\nEnd of 0\nPlease read our policy") for i in range(5)]
    assert got == Counter(want + want[:2])


RENAMED = ((r"<(/?)article\b", r"<\1div"), (r"<(/?)nav\b", r"<\1div"), (r"<(/?)footer\b", r"<\1div"), (' class="ad"', ' class="q"'))


def test_slots_are_chosen_without_names(spark):
    """Pages whose article, menu, footer and advert are plain elements give the same texts, wherever a host has three distinct pages."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html", templates.host_of("url").alias("host"))
    plain = pages.collect()
    want = {r.page_id: text_of(r.html) for r in plain}
    assert {r.page_id: r.text for r in templates.main_text(pages).collect()} == want
    bare = spark.createDataFrame([(r.page_id, r.url, re.sub(*RENAMED[3], re.sub(*RENAMED[2], re.sub(*RENAMED[1], re.sub(*RENAMED[0], r.html))))) for r in plain], "page_id long, url string, html string")
    several = Counter(h for h, _ in {(r.host, r.html) for r in plain})
    some = {r.page_id for r in plain if several[r.host] >= templates.LEAST_PAGES}
    got = {r.page_id: r.text for r in templates.main_text(bare).collect()}
    assert len(some) > 200 and {k: got[k] for k in some} == {k: want[k] for k in some}


def test_main_role():
    """Inwards by text; a name decides where text does not; a heading beside the text comes along; what is no part of the template is passed by."""
    row = lambda role, parent, chars, heads=0, kind=templates.ANY: {"role": role, "parent": parent, "token": role * 10, "kind": kind, "chars": chars, "heads": heads}
    body = [row(0, 0, 1000, 1, templates.OUTER), row(1, 0, 1000, 1, templates.OUTER)]
    every = frozenset(range(0, 1000, 10))
    assert templates.main_role([*body, row(2, 1, 100), row(3, 1, 800, 1), row(4, 3, 700)], every) == 3
    assert templates.main_role([*body, row(2, 1, 100), row(3, 1, 800, 1), row(4, 3, 700, 1)], every) == 4
    assert templates.main_role([*body, row(2, 1, 400), row(3, 1, 500)], every) == 0
    assert templates.main_role([*body, row(2, 1, 400, kind=templates.ARTICLE), row(3, 1, 500)], every) == 2
    assert templates.main_role([*body, row(3, 1, 800)], every - {30}) == 0
    assert templates.main_role([], every) == 0


def test_pages_without_the_main_element_fall_back_to_names(spark):
    html = [f"<body><div class=m><a>Home {i}</a></div><div><p>First of {i}</p><p>Then a longer second of {i}</p></div><div class=f>Legal {i}</div></body>" for i in range(8)]
    html[7] = "<body><nav>Home</nav><p>Alone</p></body>"
    rows = [(i, "http://h.example/", h) for i, h in enumerate(html)]
    got = {r.page_id: r.text for r in templates.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"First of {i}\nThen a longer second of {i}" for i in range(7)} | {7: "Alone"}


def test_copies_of_a_page_keep_their_article(spark):
    html = [page(i, f"<article><h1>Title {i}</h1><p>Story number {i} is told</p></article>") for i in range(6)]
    rows = [(i, f"http://h.example/{i}", html[min(i, 5)]) for i in range(25)]
    got = {r.page_id: r.text for r in templates.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {i: f"Title {min(i, 5)}\nStory number {min(i, 5)} is told" for i in range(25)}


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    calm = cp.STAGES[0][1](spark, docs, sf).cache()
    rejected = set(given) - {r.doc_id for r in calm.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert calm.columns == list(cp.COLUMNS) and sum(labels.get(d, 0) for d in rejected) >= 0.5 * len(rejected)
    single = cp.STAGES[1][1](spark, calm, sf).cache()
    rows = [(r.doc_id, r.text) for r in calm.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted({r[2] for r in brute_links(rows)})
    cut = cp.STAGES[2][1](spark, single, sf).cache()
    want = {k: d for k, _, _, _, d in brute_repeats([(r.doc_id, r.text) for r in single.collect()], 50)}
    assert {r.doc_id for r in cut.collect()} == set(want) and cut.columns == list(cp.COLUMNS)
    whole = [r for r in cut.collect() if hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id]]
    assert len(whole) >= 0.9 * len(want) and all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = cp.STAGES[3][1](spark, cut, sf).cache()
    assert {r.doc_id for r in mixed.collect()} == set(want) and mixed.columns == list(cp.COLUMNS)
    done = cp.STAGES[4][1](spark, mixed, sf)
    assert done.count() == mixed.count() and done.where("not parity or not round_trip").count() == 0
    assert len(cp.STAGES) == 5
