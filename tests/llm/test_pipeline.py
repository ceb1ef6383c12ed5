"""run() of the corpus pipeline against a plain version of its five stages, on a small table with planted cases."""

import random
import re
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.llm import mixing

from .test_corpus_operators import brute_links, brute_repeats

P = pytest.importorskip("public_tokenizers")


def plain_mix(spark, docs, block):
    """(doc_id, ...) in the order of the mix: earliest deadline first, slot by slot, by exact fractions. docs: doc_id, text, source."""
    turn = {(r.k, r.t): r.h for r in spark.createDataFrame([(k, t) for k, t, _ in docs], "k long, t string").select("k", "t", F.xxhash64("k", "t").alias("h")).collect()}
    size = lambda t: max(1, len((t or "").encode()))
    sources = sorted({s for _, _, s in docs})
    total = {s: sum(size(t) for _, t, q in docs if q == s) for s in sources}
    weight = {s: Fraction(total[s] ** mixing.TEMPER) for s in sources}
    share = {s: weight[s] / sum(weight.values()) for s in sources}
    blocks = {s: -(-total[s] // block) for s in sources}
    horizon = max(-(-total[s] // (share[s] * block)) for s in sources)
    served, slot_of = dict.fromkeys(sources, 0), {}
    for slot in range(int(horizon)):
        ready = [(-(-(served[s] + 1) // share[s]), s) for s in sources if served[s] // share[s] <= slot]
        s = min(ready)[1]
        slot_of[s, served[s]] = slot
        served[s] += 1
    out = []
    for s in sources:
        assert served[s] >= blocks[s]  # no short last block that is due after the end
        at = 0
        for h, k, t in sorted((turn[k, t], k, t) for k, t, q in docs if q == s):
            out += [(slot_of[s, n], h, k) for n in range(at // block, served[s], blocks[s])]
            at += size(t)
    return [k for _, _, k in sorted(out)]


def test_run_matches_a_plain_version(spark, tmp_path, monkeypatch):
    import sentencepiece

    import corpus_pipeline as cp

    monkeypatch.setattr(mixing, "BLOCK_BYTES", 1_000)
    rnd = random.Random(21)
    vocabulary = ["".join(rnd.choice("abcdefghiklmnoprstu") for _ in range(rnd.randint(3, 9))) for _ in range(4_000)]
    words = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passage = " ".join(words(60))
    rows, toxic = [], set()
    for i in range(240):
        w = words(rnd.randint(30, 120))
        if i % 9 == 4 and i % 20 != 7:
            w[3::5] = ["you grumdolt"] * len(w[3::5])
            toxic.add(i)
        if i % 20 == 7:
            w[10:10] = [passage]
        rows.append((i, " ".join(w), "en", "abbbc"[i % 5]))
    for i in range(240, 260):  # copies and near copies
        old = rows[rnd.randrange(200)]
        w = old[1].split(" ")
        if i % 2:
            w[-1] = "changed"
        toxic |= {i} if old[0] in toxic else set()
        rows.append((i, " ".join(w), "en", "c"))
    rows += [(300, "", "en", "a"), (301, "short é text", None, "b")]
    documents = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int(r[0] in toxic)) for r in rows if r[0] < 240], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs = [(k, t, s) for k, t, _, s in rows if k not in toxic]
    keep = {r[2] for r in brute_links([(k, t) for k, t, _ in docs])}
    docs = [d for d in docs if d[0] in keep]
    source = {k: s for k, _, s in docs}
    cut = {}
    for (k, t, _), want in zip(docs, brute_repeats([(k, t) for k, t, _ in docs], 50)):
        cut[k] = want
    # texts without the bytes that an earlier document covers
    texts, seen = {}, {}
    for k, t, _ in docs:
        b = t.encode()
        for p in range(len(b) - 49):
            seen[b[p : p + 50]] = min(k, seen.get(b[p : p + 50], k))
    for k, t, _ in docs:
        b, gone = t.encode(), set()
        for p in range(len(b) - 49):
            if seen[b[p : p + 50]] < k:
                gone.update(range(p, p + 50))
        texts[k] = bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore")
    assert sum(w[2] > 0 for w in cut.values()) >= 5  # the passage goes
    order = plain_mix(spark, [(k, texts[k], source[k]) for k in texts], 1_000)
    lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = sorted(cp.run(spark, str(tmp_path)).collect(), key=lambda r: (r.part, r.row))
    assert {r.doc_id for r in got} == set(texts)
    assert [r.doc_id for r in got] == order
    assert all(r.ids == lib.encode(texts[r.doc_id]) and r.source == source[r.doc_id] and r.parity and r.round_trip for r in got)


def test_stages_take_empty_and_odd_tables(spark, tmp_path):
    import corpus_pipeline as cp

    schema = "doc_id long, text string, lang string, source string, n_chars long, k string, part string, row int, epoch int"
    odd = [(None, "nobody's text", None, None, None), (1, None, None, "s", 0), (2, "", "en", None, 0), (3, "w " * 20_000, "en", "s", 1), (4, "same", "en", "s", 4), (4, "same", "en", "s", 4)]
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in ([], [(*r, "clash", "x", 1, 2) for r in odd]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in cp.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == list(cp.COLUMNS)
        done = cp.STAGES[-1][1](spark, docs.cache(), str(tmp_path)).collect()
        assert {r.doc_id for r in done} == {r[0] for r in rows} - {2}  # null and empty texts are copies
        assert all(r.parity and re.fullmatch(r"\d+", str(r.row)) for r in done)


def test_texts_go_to_workers_in_batches_of_bounded_bytes(spark, monkeypatch):
    import corpus_pipeline as cp

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    monkeypatch.setattr(cp, "BATCH_BYTES", 100_000)
    docs = spark.range(300).selectExpr("id as doc_id", "repeat('some text ', 500) as text", "'en' as lang", "'s' as source", "5000L as n_chars").coalesce(1)
    before = spark.conf.get(cp.BATCH_SETTING, None)
    try:
        spark.conf.unset(cp.BATCH_SETTING)
        cp.STAGES[0][1](spark, docs, "/root/testdata/sf0.001")
        assert max(r.n for r in docs.select("text").mapInArrow(sizes, "n long").collect()) < 110_000
        spark.conf.set(cp.BATCH_SETTING, "7m")
        cp.STAGES[0][1](spark, docs, "/root/testdata/sf0.001")
        assert spark.conf.get(cp.BATCH_SETTING) == "7m"  # what a user has set stays
    finally:
        spark.conf.unset(cp.BATCH_SETTING)
        if before is not None:
            spark.conf.set(cp.BATCH_SETTING, before)
