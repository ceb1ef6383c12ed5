"""N-gram Jaccard join by MinHash banding.

Band and row counts follow from the recall asked for. Texts that share a band meet on the band's hash; groups
of such texts are cut into blocks, and each pair of blocks is verified on the full n-gram sets by counting
common n-grams as matrix products, so links are counted without a row for each pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, mixed, prefix_hash, rolling, signed, slices_of, span_hash, task, utf8, written

#: Words of an n-gram; least similarity, as a fraction; share of the pairs at that similarity which must meet; rows of a band.
WORDS, SIMILAR, RECALL, ROWS = 5, (4, 5), 0.99999, 5
#: Texts and n-grams that a block holds on average at most.
BLOCK_TEXTS, BLOCK_GRAMS = 512, 1 << 18
#: n-grams counted in one matrix product, and texts a side.
COLUMNS, SIDE = 4096, 512

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def bands(similar: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` values that let a pair of that similarity meet with that probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similar**rows))


def _factors(n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def gram_sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, last text + 1, sorted distinct n-gram hashes of these texts, offsets): lower-case words between white space; a text of fewer words has its words as its one n-gram, one without words none."""
    data, off = utf8(pc.utf8_lower(pc.fill_null(column, "")))
    for i, j in groups(off):
        part, edges = data[off[i] : off[j]], off[i : j + 1] - off[i]
        n = j - i
        word = ~_WHITE[part]
        border = np.zeros(len(part) + 1, bool)
        border[edges] = True
        start = np.flatnonzero(word & (~np.concatenate([[False], word[:-1]]) | border[:-1]))
        end = np.flatnonzero(word & (~np.concatenate([word[1:], [False]]) | border[1:])) + 1
        h = span_hash(prefix_hash(part)[0], start, end)
        first = np.searchsorted(start, edges)
        count = np.diff(first)
        owner = np.repeat(np.arange(n), count)
        grams = rolling(h, words)
        inside = owner[: len(grams)] == owner[words - 1 :] if len(grams) else np.zeros(0, bool)
        short = np.flatnonzero((count > 0) & (count < words))
        few = np.array([int(rolling(h[first[k] : first[k + 1]], int(count[k]))[0]) for k in short], np.uint64)
        g, o = np.concatenate([grams[inside], few]), np.concatenate([owner[: len(grams)][inside], short])
        order = np.lexsort((g, o))
        g, o = g[order], o[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
        g, o = g[new], o[new]
        yield i, j, g, np.searchsorted(o, np.arange(n + 1))


def signatures(docs: DataFrame, words: int, n_bands: int, rows: int) -> DataFrame:
    """k, text_hash, grams (size of the set), bands (hash of each band, the band's number in it; null without words) of every row. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(n_bands * rows)
        salt = mixed(np.arange(n_bands, dtype=np.uint64) + np.uint64(77))
        for b in batches:
            for i, j, g, off in gram_sets(b.column("t"), words):
                size = np.diff(off)
                full, at = size > 0, off[:-1][size > 0]
                least = np.empty((len(at), len(factors)), np.uint64)
                for c, f in enumerate(factors):
                    if len(at):
                        least[:, c] = np.minimum.reduceat(g * f, at)
                least = mixed(least).reshape(len(at), n_bands, rows)
                h = np.repeat(salt[None, :], len(at), 0)
                for r in range(rows):
                    h = mixed(h ^ least[:, :, r])
                ends = np.concatenate([[0], np.cumsum(full) * n_bands]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(h.ravel())))
                yield pa.RecordBatch.from_arrays([b.column("k")[i:j], b.column("x")[i:j], pa.array(size.astype(np.int64)), lists], names=["k", "text_hash", "grams", "bands"])

    return docs.select("k", "x", "t").mapInArrow(task(run), "k long, text_hash string, grams long, bands array<long>")


def components(edges: DataFrame, what: str) -> DataFrame:
    """u, label: the least node of each node's component, for nodes with an edge (u, v), by large-star and small-star rounds.

    A round ends when every node either has one edge, to a smaller node, or only edges to larger ones: then all
    point to their least. Each round is two tables in the shared folder; the driver sees counts only. What
    nodes know is a table before edges meet it, so that Spark can split the edges of a node with very many.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), what)
    while True:
        ends = edges.select(F.col("u").alias("node"), F.col("v").alias("other"), F.lit(1).alias("down")).union(edges.select("v", "u", F.lit(0)))
        nodes = written(ends.groupBy("node").agg(F.least("node", F.min("other")).alias("m"), F.sum("down").alias("down"), F.count("*").alias("all")), what).hint("merge")
        if not nodes.where("down > 1 or (down > 0 and down < all)").count():
            return edges.select("u", F.col("v").alias("label")).union(edges.select(F.col("v").alias("u"), F.col("v").alias("label")).distinct())
        # large star: a node's larger neighbours move to its least one
        large = edges.join(nodes, F.col("v") == F.col("node")).select("u", F.col("m").alias("v")).where("u <> v")
        # small star: a node and its smaller neighbours move to the least of them; a node has few smaller neighbours, one for each band at most to begin with
        least = F.min("v").over(Window.partitionBy("u"))
        moved = large.withColumn("m", least).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = written(moved.where("u <> v").distinct(), what)


def links_between(a: list[np.ndarray], b: list[np.ndarray], similar: tuple[int, int]) -> np.ndarray:
    """Boolean matrix of the pairs of sets that are similar enough."""
    over, under = similar
    flat = [np.concatenate(x) if len(x) else np.zeros(0, np.uint64) for x in (a, b)]
    # n-grams that one side lacks are common to no pair
    both = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    place = []
    for sets, all_ in zip((a, b), flat, strict=True):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        col = np.searchsorted(both, all_)
        hit = both[np.minimum(col, len(both) - 1)] == all_ if len(both) else np.zeros(len(all_), bool)
        row, col = row[hit], col[hit]
        order = np.argsort(col, kind="stable")
        place.append((row[order], col[order]))
    common = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, len(both), COLUMNS):
        parts = []
        for (row, col), sets in zip(place, (a, b), strict=True):
            i, j = np.searchsorted(col, [at, at + COLUMNS])
            m = np.zeros((len(sets), min(COLUMNS, len(both) - at)), np.float32)
            m[row[i:j], col[i:j] - at] = 1
            parts.append(m)
        common += parts[0] @ parts[1].T
    size = [np.array([len(s) for s in x], np.float64) for x in (a, b)]
    return (common > 0) & (common.astype(np.float64) * (over + under) >= over * (size[0][:, None] + size[1][None, :]))


def block_pair(ids: np.ndarray, second: np.ndarray, sets: list[np.ndarray], similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(links, label) of each text. second: in the pair's second block; if there is none, the block meets itself. label: least id linked, step by step, within the pair."""
    n = len(ids)
    left, right = (np.flatnonzero(~second), np.flatnonzero(second)) if second.any() else (np.arange(n), np.arange(n))
    links, label, found = np.zeros(n, np.int64), ids.copy(), []
    for i in range(0, len(left), SIDE):
        for j in range(0, len(right), SIDE):
            if left is not right and not second.any() and j < i:
                continue
            x, y = left[i : i + SIDE], right[j : j + SIDE]
            m = links_between([sets[k] for k in x], [sets[k] for k in y], similar)
            same = not second.any()
            if same:
                m &= x[:, None] < y[None, :]  # each pair once, none with itself
            r, c = np.nonzero(m)
            links += np.bincount(x[r], minlength=n) + np.bincount(y[c], minlength=n)
            found.append((x[r].astype(np.int32), y[c].astype(np.int32)))
    u, v = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    while len(u):
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        if (new == label).all():
            break
        label = new
    return links, label


def in_blocks(members: DataFrame, signed_: DataFrame) -> DataFrame:
    """u, comp, own (its block), others (the blocks that its block is compared with), parted. members: u, comp, n (blocks of the component on average).

    Texts that share their first band stand in one block, or in several where they are many. Two blocks are
    compared if a band stands in both, so a long chain of chance collisions costs its links, not its square.
    """
    single = members.where("n = 1").select("u", "comp", F.lit(0).cast("long").alias("own"), F.array(F.lit(0).cast("long")).alias("others"), F.lit(False).alias("parted"))
    if not members.where("n > 1").limit(1).count():
        return single
    bands_ = signed_.where("k is not null and bands is not null").groupBy(F.col("k").alias("_k")).agg(F.first("bands").alias("bands"))
    large = written(members.where("n > 1").join(bands_, F.col("u") == F.col("_k")).select("u", "comp", "n", "bands"), "similarity-large")
    first = F.col("bands")[0]
    many = written(large.groupBy("comp", first.alias("first")).count().where(F.col("count") > BLOCK_TEXTS // 2), "similarity-firsts").withColumnRenamed("comp", "_comp").hint("merge")
    placed = large.join(many, (F.col("comp") == F.col("_comp")) & (first == F.col("first")), "left")
    own = F.when(F.col("count").isNull(), F.pmod(F.xxhash64(first), F.col("n").cast("long"))).otherwise(F.xxhash64(first, F.pmod(F.xxhash64("u"), F.ceil(F.col("count") / BLOCK_TEXTS))))
    placed = written(placed.select("u", "comp", own.alias("own"), "bands"), "similarity-placed")
    held = written(placed.select("comp", "own", F.explode("bands").alias("band")).distinct(), "similarity-held").hint("merge")
    met = held.join(held.withColumnRenamed("own", "other"), ["comp", "band"]).select(F.col("comp").alias("_comp"), F.col("own").alias("_own"), "other").distinct()
    # a row a block
    met = written(met.groupBy("_comp", "_own").agg(F.collect_list("other").alias("others")), "similarity-met").hint("merge")
    split = placed.join(met, (F.col("comp") == F.col("_comp")) & (F.col("own") == F.col("_own"))).select("u", "comp", "own", "others", F.lit(True).alias("parted"))
    return single.union(split)


def verified(members: DataFrame, words: int, similar: tuple[int, int], slices: int) -> DataFrame:
    """u, links, label by text and pair of blocks. members: u, t, comp, own, others, parted."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, g, off in gram_sets(b.column("t"), words):
                raw = g.tobytes()
                part = b.slice(i, j - i).drop_columns(["t"])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([raw[8 * p : 8 * q] for p, q in zip(off, off[1:])], pa.binary())], names=[*part.schema.names, "grams"])

    rows = members.select("u", "comp", "own", "others", "parted", "t").mapInArrow(task(sets), "u long, comp long, own long, others array<long>, parted boolean, grams binary")
    rows = rows.withColumn("other", F.explode("others"))
    rows = rows.select("u", "comp", "grams", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"), "parted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle() -> pa.RecordBatch:
            if here[1] != here[2] and (all(second) or not any(second)):
                links, label = np.zeros(len(ids), np.int64), np.array(ids, np.int64)  # the other block is empty
            else:
                links, label = block_pair(np.array(ids, np.int64), np.array(second, bool), grams, similar)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links), pa.array(label), pa.array([here[3]] * len(ids))], names=["u", "links", "label", "parted"])

        here, ids, second, grams = None, [], [], []
        for b in batches:
            for u, comp, i, j, n, s, g in zip(*[b.column(c).to_pylist() for c in ("u", "comp", "i", "j", "parted", "second")], b.column("grams"), strict=True):
                if here is None or (comp, i, j) != here[:3]:
                    if ids:
                        yield settle()
                    here, ids, second, grams = (comp, i, j, n), [], [], []
                ids.append(u)
                second.append(s)
                grams.append(np.frombuffer(g.as_buffer(), np.uint64))
        if ids:
            yield settle()

    dealt = rows.repartition(slices, "comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    return dealt.mapInArrow(task(run), "u long, links long, label long, parted boolean")


def similar_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similar: tuple[int, int] = SIMILAR, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """Every row's key with text_hash, text_id, group_id, n_copies and n_links.

    text_id: least key of the rows with the same text. group_id: least key that links reach, step by step.
    n_copies: other rows with the same text. n_links: different texts whose n-gram sets have a Jaccard
    similarity of at least ``similar`` (a fraction) with this one's. A null text counts as empty; texts
    without words have no links, but are copies of each other if equal. A row with a null key belongs to its
    text; a text that only such rows have takes no part: its ids are null and its links 0. Repeated rows count
    as copies; extra columns are not read; an empty table gives an empty result. Jobs run when this is called,
    and their tables are written to the shared folder.
    """
    n_bands = bands(similar[0] / similar[1], recall, rows)
    slices = slices_of(docs, text)
    base = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("x", F.md5("t"))
    signed_ = written(signatures(base, words, n_bands, rows), "similarity-signatures")
    # what a join meets is a table of its own, so that Spark sees how large each part of either side is, and splits a hot one;
    # none of these has a proven bound, so none is broadcast, however small it is
    per_text = written(signed_.groupBy(F.col("text_hash").alias("_x")).agg(F.min("k").alias("text_id"), F.count("*").alias("rows")), "similarity-texts").hint("merge")
    # equal texts have equal bands: those of the row with the least key stand for all
    reps = signed_.where("k is not null and bands is not null").join(per_text, (F.col("text_hash") == F.col("_x")) & (F.col("k") == F.col("text_id")))
    met = written(reps.select(F.col("k").alias("u"), F.explode("bands").alias("band")), "similarity-bands")
    lead = written(met.groupBy("band").agg(F.min("u").alias("v"), F.max("u").alias("w")).where("v < w").drop("w"), "similarity-lead").hint("merge")
    coarse = written(components(met.join(lead, "band").select("u", "v"), "similarity-meeting"), "similarity-comps")
    sized = coarse.hint("merge").join(signed_.select(F.col("k").alias("u"), "grams").groupBy("u").agg(F.max("grams").alias("grams")), "u")
    blocks = written(sized.groupBy(F.col("label").alias("comp")).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("grams") / BLOCK_GRAMS)).cast("int").alias("n")), "similarity-blocks").hint("merge")
    members = in_blocks(coarse.withColumnRenamed("label", "comp").join(blocks, "comp"), signed_).hint("merge")
    # a key that stands on different texts is one document of several: its first text by hash is compared
    texts = base.where("k is not null").join(members, F.col("k") == F.col("u")).select("u", "comp", "own", "others", "parted", "t", "x")
    rep_hash = per_text.where("text_id is not null").select(F.col("text_id").alias("_u"), F.col("_x").alias("_h")).groupBy("_u").agg(F.min("_h").alias("_h"))
    texts = texts.join(rep_hash, (F.col("u") == F.col("_u")) & (F.col("x") == F.col("_h"))).drop("_u", "_h", "x").dropDuplicates(["u"]) if _repeats(signed_) else texts
    found = written(verified(texts, words, similar, slices), "similarity-links")
    n_links = found.groupBy("u").agg(F.sum("links").alias("n_links"))
    stars = found.where("label <> u").select("u", F.col("label").alias("v"), "parted").distinct()
    if stars.where("parted").limit(1).count():
        final = components(stars.select("u", "v"), "similarity-groups")
    else:
        final = stars.select("u", F.col("v").alias("label"))
    final = final.withColumnRenamed("u", "_g").join(n_links.withColumnRenamed("u", "_g").hint("merge"), "_g", "full").hint("merge")
    classes = per_text.join(final, F.col("text_id") == F.col("_g"), "left").select("_x", "text_id", F.coalesce("label", "text_id").alias("group_id"), (F.col("rows") - 1).alias("n_copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return signed_.select("k", "text_hash").join(classes.hint("merge"), F.col("text_hash") == F.col("_x")).select(F.col("k").cast(docs.schema[key].dataType).alias(key), "text_hash", "text_id", "group_id", "n_copies", "n_links")


def _repeats(rows: DataFrame) -> bool:
    """Whether a key stands on several rows."""
    return bool(rows.where("k is not null").groupBy("k").count().where("count > 1").limit(1).count())


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` but for near and exact copies: of each group the row with the least key stays; rows whose text only null keys have all stay."""
    found = similar_texts(docs, key, text)
    stay = found.where(F.col("group_id").isNull() | F.col(key).eqNullSafe(F.col("group_id"))).select(F.col(key).alias("_k"), F.col("text_hash").alias("_x")).distinct()
    rows = docs.withColumn("_hash", F.md5(F.coalesce(F.col(text), F.lit(""))))
    kept = rows.join(stay.hint("merge"), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_x")), "left_semi")
    repeated = found.where(F.col(key).isNotNull()).groupBy(key, "text_hash").count().where("count > 1").limit(1).count()
    return (kept.dropDuplicates([key, "_hash"]) if repeated else kept).drop("_hash")
