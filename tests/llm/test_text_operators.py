"""Operators that look at one text at a time, against plain versions of them."""

import hashlib
import math
import random
import re
import subprocess
import sys
from collections import Counter
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.llm import language, mixing, phrases, pieces, quality, token_counts, toxicity
from sievework.llm.common import held_out

P = pytest.importorskip("public_tokenizers")

ODD = [None, "", " ", "a", "a<|endoftext|>b", "  x\n\n y ", "ſß İ 日本語 😀", "x" * 3000, "\t\x1c 　z", "it's we'll 12 ²³ ٣", "a▁b", "<s>hi</s>"]


def frame(spark, texts, **more):
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, None if i % 3 else "s", "clash") for i, t in enumerate(texts)]
    rows.append(rows[-1])  # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, t string")


def some_texts(n=200, seed=1):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice(["the ", "Aé", "b-", "\n", "123 ", "ing ", "!! ", "  "]) for _ in range(rnd.randint(1, 60))) for _ in range(n)]


def test_token_counts_match_the_library(spark):
    from tokenizers import Tokenizer

    texts = some_texts()
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [len(lib.encode(t or "", add_special_tokens=False).ids) for t in texts]
    got = token_counts.count_tokens(frame(spark, texts), P.path("byte_bpe_50k.json"), keep=("doc_id", "t"), text="text").collect()
    assert len(got) == len(texts) + 1 and [r.n_tokens for r in got] == [*want, want[-1]]
    assert [r.n_bytes for r in got][:4] == [0, 0, 1, 1] and all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert token_counts.count_tokens(frame(spark, texts).limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_pieces_match_sentencepiece_and_come_back(spark):
    import sentencepiece

    texts, model = some_texts(), P.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=model)
    got = pieces.encode(frame(spark, texts), model).collect()
    assert [r.ids for r in got[:-1]] == [lib.encode(t or "") for t in texts]
    assert all(r.parity for r in got) and all(r.round_trip == ("▁" not in (t or "")) for r, t in zip(got, texts))
    assert [r.n_tokens for r in got[:2]] == [0, 0]
    back = pieces.decode(pieces.encode(frame(spark, texts), model), model).collect()
    assert [r.text for r in back[:-1]] == [(t or "").replace("▁", " ") for t in texts]
    assert pieces.encode(frame(spark, texts).limit(0), model).count() == 0


def tiny_model(kind, pieces_, squeeze=False, prefix=True, fallback=True):
    """A sentencepiece model's bytes. pieces_: (piece, score, kind)."""
    import struct

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(number, value):
        return varint(number << 3 | 2) + varint(len(value)) + value if isinstance(value, bytes) else varint(number << 3) + varint(value)

    body = b"".join(field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", score) + field(3, k)) for p, score, k in pieces_)
    trainer = field(3, kind) + field(4, len(pieces_)) + field(35, int(fallback)) + field(40, 0) + field(41, 1) + field(42, 2) + field(43, 2**64 - 1)
    return body + field(2, trainer) + field(3, field(1, b"identity") + field(3, int(prefix)) + field(4, int(squeeze)) + field(5, 1))


@pytest.mark.parametrize("kind, squeeze, prefix, fallback", [(1, False, True, True), (1, True, True, True), (1, False, False, True), (1, False, True, False), (2, False, True, True), (2, True, True, True), (2, False, False, True)])
def test_models_of_either_kind_agree_with_sentencepiece(spark, tmp_path, kind, squeeze, prefix, fallback):
    import sentencepiece

    rnd = random.Random(kind)
    words = sorted({"".join(rnd.choice("abcé") for _ in range(rnd.randint(2, 5))) for _ in range(40)})
    parts = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256) if fallback]
    parts += [(p, -float(i) - (kind == 2) * 0.5, 1) for i, p in enumerate([*("▁" + w[:2] for w in words[:9:2]), *words, *"▁abcé"]) if p not in dict.fromkeys(q[0] for q in parts)]
    data = tiny_model(kind, list({p[0]: p for p in parts}.values()), squeeze, prefix, fallback)
    (tmp_path / "tiny.model").write_bytes(data)
    lib = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = [None, "", " ", "a", "abc  cab", " a ", "日本 abc", "\t", "<s>", "aé\nb"] + [" ".join("".join(rnd.choice("abcéx") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(1, 30))) for _ in range(60)]
    got = pieces.encode(frame(spark, texts), str(tmp_path / "tiny.model")).collect()
    assert [r.ids for r in got[:-1]] == [lib.encode(t or "") for t in texts] and all(r.parity for r in got)
    back = pieces.decode(pieces.encode(frame(spark, texts), str(tmp_path / "tiny.model")), str(tmp_path / "tiny.model")).collect()
    assert [r.round_trip for r in got[:-1]] == [b.text == (t or "") for b, t in zip(back, texts)]
    if fallback and not squeeze:
        assert all(r.round_trip for r in got)


def test_fast_decoding_equals_the_library():
    from tokenizers import Tokenizer  # noqa: F401

    data = open(P.path("piece_bpe_32k.model"), "rb").read()
    codec, rnd = pieces.Codec(data), random.Random(3)
    ids = [[rnd.randrange(len(codec.bytes)) for _ in range(rnd.randint(0, 30))] for _ in range(50)] + codec.encode([t or "" for t in some_texts()])
    at = [i for i in ids if not any(codec.model["pieces"][k][2] == pieces.BYTE for k in i)]  # loose bytes make no character
    assert codec.plain and codec.decode(at) == codec.whole.decode_batch(at, skip_special_tokens=False)
    assert codec.encode([t or "" for t in some_texts()]) == [e.ids for e in codec.whole.encode_batch([t or "" for t in some_texts()], add_special_tokens=False)]


def test_distinct_words_are_encoded_once(monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_BYTES", 3000)
    codec, rnd = pieces.Codec(open(P.path("piece_bpe_32k.model"), "rb").read()), random.Random(7)
    odd = [None, "", " ", "▁", "a ", " a", "a  b", "▁▁ x▁y", "<s> </s>", "日本 語", "😀 😀", "\t\n"]
    odd += ["".join(rnd.choice([" ", "  ", "▁", "a", "the", "é", "\n", "<s>", "😀", "x y"]) for _ in range(rnd.randrange(30))) for _ in range(300)]
    got = [ids for part in codec.encode_column(pa.array(odd)) for ids in part]
    assert got == codec.encode([t or "" for t in odd]) == codec.theirs.encode([t or "" for t in odd])
    seen, plain = [], codec._encode
    monkeypatch.setattr(codec, "_encode", lambda texts: seen.extend(texts) or plain(texts))
    texts = ["every word of this text stands in all others"] * 50
    assert [ids for part in codec.encode_column(pa.array(texts)) for ids in part] == codec.theirs.encode(texts)
    assert sum(map(len, seen)) == len(texts[0]) + 1


def base_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams, covered = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_verdicts(spark):
    rnd = random.Random(2)
    clean = [" ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "of"]) + str(rnd.randint(0, 99)) for _ in range(60)) for _ in range(300)]
    junk = [t.replace(" ", "### ") for t in clean[:9]]
    texts = some_texts(60) + clean + junk + ["word " * 40]
    got = quality.apply_rules(frame(spark, texts)).collect()
    assert Counter(tuple(r[c] for c in quality.COUNTS) for r in got) == Counter(base_counts(t) for t in [*texts, texts[-1]])
    n = len(some_texts(60))
    by = {r.doc_id: r for r in got}
    assert all(by[i].kept for i in range(n, n + 300)) and not any(by[i].kept for i in range(n + 300, len(texts)))
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in got)
    assert quality.apply_rules(frame(spark, texts).limit(0)).count() == 0


def test_quality_fences_follow_each_group(spark):
    def row(i, source, length, symbols, repeated=0):
        return (i, "en", source, 1000, round(1000 * length), symbols, 0, repeated)

    rows = [row(i, "a", 5 + i % 21 / 50, 0, i % 40 * (i % 40 > 30)) for i in range(400)] + [row(1000 + i, "b", 8 + i % 21 / 50, i % 500) for i in range(400)]
    junk = [row(2000 + i, "a", 5.2, 300 + 20 * i) for i in range(30)] + [row(3000 + i, "a", 8.2, 0) for i in range(9)]
    names = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    fence = {r.source: r for r in quality.thresholds(spark.createDataFrame(rows + junk, names)).collect()}
    bad = [i for i, _, s, n, c, y, _, p in rows + junk if not fence[s].word_length_low <= c / n <= fence[s].word_length_high or y / n > fence[s].symbols_per_word_high or p / n > fence[s].repeat_share_high]
    assert bad == [r[0] for r in junk]


def plain_fences(rows):
    """(low, high) for each measure of one group's rows (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), by sorting bucket values."""
    gamma, out = (1 + quality.ERROR) / (1 - quality.ERROR), {}
    for k, (m, (_, least, _)) in enumerate(quality.MEASURES.items()):
        raw = [r[k + 1] / r[0] for r in rows]
        values = sorted(0.0 if v < quality.LEAST else 2 * gamma ** math.ceil(math.log(v) / math.log(gamma)) / (gamma + 1) for v in raw)
        q1, q2, q3 = (values[math.ceil(len(values) * p) - 1] for p in (0.25, 0.5, 0.75))
        width = 2 * quality.ERROR * q2
        down, up = quality.FENCE * max(width, q2 - q1), max(least, quality.FENCE * max(width, q3 - q2))
        beyond = [sum(v > q2 + up * 2**i for v in values) for i in range(quality.STEPS + 1)]
        step = next((i for i in range(quality.STEPS) if quality.GAP * (beyond[i] - beyond[i + 1]) < beyond[i]), quality.STEPS)
        out[m] = (max(0.0, q2 - down), q2 + up * 2**step)
    return out


def test_quality_thresholds_match_a_plain_version(spark):
    """Own sketches where a group has the rows, else its language's, else all; nulls are groups of their own."""
    rnd = random.Random(17)
    rows = []
    for lang, source, n in (("en", "a", 400), ("en", "b", 150), (None, "a", 250), ("de", None, 90), ("fr", "c", 3)):
        for _ in range(n):
            w = rnd.randint(20, 300)
            rows.append((len(rows), lang, source, w, w * rnd.randint(3, 7), rnd.choice([0, 0, rnd.randint(0, w)]), rnd.randint(0, 3) * (rnd.random() < 0.1), rnd.randint(0, w // 4) * (rnd.random() < 0.4)))
    names = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    got = {(r.lang, r.source): r for r in quality.thresholds(spark.createDataFrame(rows, names).repartition(5)).collect()}
    assert set(got) == {(r[1], r[2]) for r in rows}
    for (lang, source), r in got.items():
        own, mid = [x[3:] for x in rows if (x[1], x[2]) == (lang, source)], [x[3:] for x in rows if x[1] == lang]
        use = own if len(own) >= quality.MIN_ROWS else mid if len(mid) >= quality.MIN_ROWS else [x[3:] for x in rows]
        for m, (low, high) in plain_fences(use).items():
            assert abs(r[f"{m}_low"] - low) < 1e-9 and abs(r[f"{m}_high"] - high) < 1e-9, (lang, source, m)


def test_quality_keeps_good_and_drops_bad_texts(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.apply_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").toPandas()
    assert got.kept[got.quality == 1].mean() > 0.98 and got.kept[got.quality == 0].mean() < 0.1


def test_sketch_quantiles_are_within_the_error(spark):
    rows = spark.range(1, 2001).select(F.lit("x").alias("g"), F.col("id").alias("word_chars"), *[F.lit(1).alias(c) for c in ("n_words", "n_symbols", "n_dup_lines", "n_repeat_words")])
    q = quality.quartiles(quality.sketch(rows, ["g"]), ["g"]).where("measure = 'word_length'").first()
    assert q.rows == 2000 and all(abs(got / want - 1) <= quality.ERROR + 1e-3 for got, want in ((q.q1, 500), (q.q2, 1000), (q.q3, 1500)))


def fewest_phrases(sample, text):
    """Greedy parsing by substring search; a letter that the sample lacks is a phrase."""
    n = at = 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at : at + k + 1] in sample:
            k += 1
        n, at = n + 1, at + k
    return n


def plain_symbols(text):
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


@pytest.mark.parametrize("part", [3, 16, 512])
def test_automaton_counts_greedy_phrases(part):
    rnd = random.Random(4)
    for letters in ("abc ", "ab", "aé日я ", "".join(chr(0x4E00 + i) for i in range(300))):
        sample = " ".join(plain_symbols("".join(rnd.choice(letters) for _ in range(300))))
        alphabet = language.Alphabet(sorted({ord(c) for c in sample if c.isalpha()}))
        automaton = language.Automaton(alphabet.symbols([sample])[0], len(alphabet.letters) + 2)
        texts = ["", "a", "ab" * 400, sample, sample[7:90] * 3, "a" * 500] + ["".join(rnd.choice(letters + "xΩ!") for _ in range(rnd.randint(1, 700))) for _ in range(40)]
        sym, off = alphabet.symbols(texts)
        plain = [" ".join(plain_symbols(t)) for t in texts]
        assert (off[1:] - off[:-1]).tolist() == [len(t) for t in plain]
        assert automaton.phrases(sym, off, part).tolist() == [fewest_phrases(sample, t) for t in plain]


def test_language_query_matches_plain_cross_parsing(spark):
    """Sample, phrases, bits and score of the whole query against string search."""
    rnd = random.Random(12)
    scripts = {"aa": "abcde  ", "bb": "abcxyz  ", "cc": "日本語中文字 ", "dd": "привет  "}
    rows = [(i, "".join(rnd.choice(scripts[s]) for _ in range(rnd.randint(20, 1500))), s) for i, s in enumerate(rnd.choices(list(scripts), k=120))]
    rows += [(500, None, "aa"), (501, "", "aa"), (502, "1 2 !", None), (503, "日本", None), (504, "abc", None)] + rows[:2]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("l", F.lit(1))
    parser = language.train(df.where(~held_out()))
    hashes = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    taught = {r.doc_id for r in df.where(~held_out()).collect()}
    samples = {}
    for s in scripts:
        left, took = language.TRAIN_CHARS, []
        for k, t, _ in sorted((r for r in rows if r[2] == s and r[0] in taught and r[1] is not None), key=lambda r: (hashes[r[0]], r[1]))[: language.TRAIN_ROWS]:
            if len(t) <= left:
                took.append(t)
                left -= len(t)
        samples[s] = " ".join(plain_symbols(" ".join(took)))
    got = language.identify(df, parser).collect()
    for r, (k, t, _) in zip(sorted(got, key=lambda r: r.doc_id), sorted(rows, key=lambda r: r[0])):
        text = " ".join(plain_symbols(t or ""))
        if not text:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        bits = sorted((fewest_phrases(sample, text) * math.log2(len(sample) + 1) / len(text), s) for s, sample in samples.items())
        assert r.lang_pred == bits[0][1] and abs(r.score - bits[1][0] / (bits[0][0] + bits[1][0])) < 1e-9


def test_training_rows_are_whole_and_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "TRAIN_CHARS", 100)
    df = spark.createDataFrame([(i, "ab" * 20, "x") for i in range(9)] + [(20, "c" * 500, "y"), (21, "d" * 400, "y")] + [(30, "e" * 90, "z"), (31, "f" * 300, "z")], "doc_id long, text string, lang string")
    parser = language.train(df)
    assert parser.languages == ["x", "y", "z"] and [round(2**b) - 1 for b in parser.bits] == [81, 400, 90]


def test_languages_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    parser = language.train(docs.where(~held_out()))
    got = language.identify(docs.where(held_out()), parser, keep=("doc_id", "lang")).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()
    odd = language.identify(frame(spark, [None, "", "12 !", "the and thing"]), parser).collect()
    assert [r.lang_pred for r in odd[:3]] == ["und"] * 3 and odd[3].lang_pred == "en"
    assert {r.lang_pred for r in language.identify(frame(spark, ["abc"]), language.CrossParser({})).collect()} == {"und"}
    assert language.identify(docs.limit(0), parser).count() == 0 and language.train(docs.limit(0)).languages == []


def test_toxic_texts_score_high(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs.where(~held_out()), labels.where(~held_out()))
    got = toxicity.score(docs.where(held_out()), model).join(labels, "doc_id").toPandas()
    assert ((got.predicted == 1) == (got.toxic == 1)).mean() > 0.9
    odd = toxicity.score(frame(spark, ODD), model).collect()
    assert len(odd) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in odd)
    none = toxicity.train(docs.limit(0), labels.limit(0))
    assert toxicity.score(docs.limit(2), none).first().score == 0


def test_workers_do_not_import_spark_ml():
    code = "import sys, sievework.llm.toxicity; assert not {'pyspark.ml', 'pandas'} & set(sys.modules)"
    subprocess.run([sys.executable, "-c", code], check=True)


def plain_features(text, words, stems):
    """The features by loops over words and characters."""
    found = toxicity._WORD.findall(text)
    n, size = max(1, len(found)), max(1, len(text.encode()))
    bad, stem, you, veiled, mixed_, shouted = [], [], [], 0, 0, 0
    for i, w in enumerate(found):
        low = w.lower()
        hit = low in words
        if re.search(r"[^\W\d_][\d@$!|*][^\W\d_]", w):
            mixed_ += 1
            plain = low.translate(toxicity.VEILS)
            if plain in words or "".join(c for c in plain if c.isalnum()) in words:
                veiled += 1
                hit = True
        if hit:
            bad.append(i)
        if any(low[:k] in stems for k in toxicity.STEMS if len(low) > k):
            stem.append(i)
        if low in toxicity.SECOND_PERSON:
            you.append(i)
        shouted += len(w) > 1 and w.isupper()
    near = sum(any(abs(i - j) <= toxicity.NEAR for j in you) for i in {*bad, *stem})
    marks = sum(33 <= ord(c) < 127 and not c.isalnum() for c in text)
    row = {"hit_rate": 100 * len(bad) / n, "hits": math.log1p(len(bad)), "stem_rate": 100 * len(stem) / n, "stem_hits": math.log1p(len(stem)), "near_rate": 100 * near / n, "near_hits": math.log1p(near), "veiled_hits": math.log1p(veiled)}
    return row | {"capitals": 100 * sum("A" <= c <= "Z" for c in text) / size, "shouted": 100 * shouted / n, "exclamations": 100 * text.count("!") / size, "punctuation": 100 * marks / size, "obfuscated": 100 * mixed_ / n, "words": math.log1p(len(found))}


def test_toxicity_features_match_a_plain_version(spark):
    rnd = random.Random(16)
    words, stems = frozenset({"grum", "idiot", "blöd"}), frozenset({"idio", "grumm"})
    bits = ["grum", "GRUM!", "id1ot", "i-d-i-o-t", "idiotic", "you", "Du", "blöd", "fine", "WORD", "gr*m", "a", "!!", "$5", "grummel", "é"]
    texts = some_texts(40) + [" ".join(rnd.choice(bits) for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    got = toxicity.featured(frame(spark, texts), words, stems, "text", ("doc_id",)).collect()
    for r, t in zip(got, texts):
        want = plain_features(t or "", words, stems)
        assert all(abs(r[f] - want[f]) < 1e-9 for f in toxicity.FEATURES), (t, r, want)


def test_toxicity_learns_from_few_rows_and_odd_labels(spark):
    rows = [(i, ("you grum blarg " if i % 3 == 0 else "a fine calm day ") * 9 + str(i)) for i in range(60)] + [(None, "x"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("y", F.lit("clash"))
    labels = [(i, 5 if i % 3 == 0 else -1) for i in range(60)] + [(0, None), (None, 1), (3, 0)] + [(1000 + i, 1) for i in range(200)]
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.trees is not None and abs(model.rate - 1 / 3) < 1e-9
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].predicted == (i % 3 == 0) for i in range(60) if i != 7) and len(got) == 61
    assert toxicity.score(docs.limit(0), model).count() == 0
    two = spark.createDataFrame(labels[:5], "doc_id long, toxic int")  # too few of a class: their share
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, two)).collect()} == {0.4}


def test_fingerprints_are_local_and_edits_exact(spark):
    rnd = random.Random(9)
    texts = some_texts(80) + ["".join(rnd.choice("abcdefgh ") for _ in range(900)) for _ in range(6)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(len(texts), texts[-1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, k string").repartition(5)
    got = {r.doc_id: r for r in phrases.compare_with_next(df, slices=3).collect()}
    assert len(got) == len(rows)
    for i, (k, t, _) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        h = len(t) // 2
        assert got[k].edited_sha256 == hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest() and got[k].n_chars == len(t)
        assert got[k].fingerprint == phrases.fingerprints([t])[0]
    long = [got[k] for k, t, _ in rows[-7:-2]]
    assert all(r.near_edited > r.near_next for r in long)
    assert got[len(rows) - 2].near_next == 1.0  # the next one is its copy
    shifted = phrases.likeness(*phrases.fingerprints([texts[-2], "zz " + texts[-2]]))
    assert shifted > 0.8
    assert phrases.compare_with_next(df.limit(0)).count() == 0


@pytest.mark.parametrize("slices", [1, 2, 7, 30])
def test_rows_of_one_key_fill_several_slices(spark, slices):
    """Null, repeated and single keys: each row is compared with the next one in the order of key and text's hash."""
    rnd = random.Random(14)
    rows = [(rnd.choice([None, 7, 7, 7, i]), "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 60)))) for i in range(300)] + [(7, "same"), (7, "same"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ordered = [(r.doc_id, r.text or "") for r in df.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()]
    want = Counter()
    for (k, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1]):
        want[k, hashlib.sha256(phrases.edited(t, n).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in phrases.compare_with_next(df, slices=slices).collect()) == want


def plain_parse(names):
    """One level for one text, symbol by symbol: runs become one, labels by four rounds of coin tossing, phrases begin at peaks."""
    M = (1 << 64) - 1

    def mix(h):
        h ^= h >> 30
        h = h * 0xBF58476D1CE4E5B9 & M
        h ^= h >> 27
        h = h * 0x94D049BB133111EB & M
        return h ^ h >> 31

    def name(part):
        h = sum(mix(x) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, x in enumerate(part))
        return mix((h + len(part) * 0xD6E8FEB86659FD93) & M)

    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1].append(x)
        else:
            runs.append([x])
    names = [name(r) for r in runs]
    label = list(names)
    for _ in range(4):
        new = []
        for i, x in enumerate(label):
            if i == 0:
                new.append(x & 1)
            elif x == label[i - 1]:
                new.append(x & 1)
            else:
                k = ((x ^ label[i - 1]) & -(x ^ label[i - 1])).bit_length() - 1
                new.append(2 * k + (x >> k & 1))
        label = new
    n = len(names)
    begins = [i for i in range(n) if i == 0 or (1 < i < n - 1 and label[i] > label[i - 1] and label[i] >= label[i + 1])]
    return [name(names[a:b]) for a, b in zip(begins, [*begins[1:], n])]


def test_parse_matches_a_plain_version():
    import numpy as np

    rnd = random.Random(15)
    for text in [t or "" for t in some_texts(30)] + ["".join(rnd.choice("abcdef gh") for _ in range(500)), "ab" * 300, "a" * 100]:
        names = [ord(c) for c in text]
        points, off = np.array(names, np.uint64), np.array([0, len(text)])
        for _ in range(3):
            points, off = phrases.parse(points, off)
            names = plain_parse(names)
            assert points.tolist() == names and off.tolist() == [0, len(names)]
        sketch = phrases.sketch(points, off, phrases._FACTORS[2])[0]
        for value, f in zip(sketch.tolist(), phrases._FACTORS[2].tolist()):
            h = min((x * f & (1 << 64) - 1 for x in names), default=None)
            assert value == (0 if h is None else int(phrases.mixed(np.array([h], np.uint64))[0]) & 0xFFFF)


def test_schedule_stays_within_a_block_of_the_targets():
    rnd = random.Random(6)
    for _ in range(40):
        parts = [rnd.randint(1, 60) for _ in range(rnd.randint(1, 12))]
        slots, period = mixing.schedule(parts), sum(parts)
        assert sorted(s for x in slots for s in x) == list(range(period))
        for a, own in zip(parts, slots):
            served = 0
            taken = set(own)
            for t in range(period):
                served += t in taken
                assert abs(served - a * (t + 1) / period) < 1


def test_mix_places_every_document(spark):
    rnd = random.Random(8)
    rows = [(i, "w" * rnd.randint(0, 400), rnd.choice(["a", "a", "a", "b", None]), 1) for i in range(400)] + [(None, None, "c", 1), (5, "w", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, slot int")
    mix = mixing.plan(df, block_bytes=2_000)
    got = mixing.place(df, mix).collect()
    first = [r for r in got if r.epoch == 0]
    assert Counter((r.doc_id, r.source) for r in first) == Counter((r[0], r[2]) for r in rows)
    assert all(r.release <= r.slot < r.deadline and r.slot < mix.horizon for r in got)
    assert mixing.mixed_documents(df).columns == df.columns
    assert mixing.place(df.limit(0), mixing.plan(df.limit(0))).count() == 0


def test_mix_keeps_the_exact_weights_over_its_whole_length(spark):
    weights = {"a": 1 / 3, "b": 0.61803, "c": 0.04866, "d": 1e-5}
    rows = [(i, "w" * 100, s) for s, n in (("a", 2000), ("b", 300), ("c", 40), ("d", 1)) for i in range(n)] + [(9999, "w" * 7, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.plan(df, weights={**weights, "d": 2e-4}, block_bytes=100)
    exact = {**weights, "d": 2e-4}
    total = sum(map(Fraction, exact.values()))
    got = mixing.place(df, mix).collect()
    assert mix.horizon > 5000 and Counter((r.doc_id, r.source) for r in got if r.epoch == 0) == Counter((r[0], r[2]) for r in rows)
    for r in got:
        w = Fraction(exact[r.source]) / total
        assert math.floor(r.block / w) <= r.slot < math.ceil((r.block + 1) / w)
    for s, w in exact.items():
        blocks = len({r.block for r in got if r.source == s})
        assert abs(blocks - Fraction(w) / total * mix.horizon) < 1 + (s == "d")


def test_two_weights_far_apart_stay_within_a_block():
    weights = [0.9995, 0.0005]
    total, served = sum(map(Fraction, weights)), [0, 0]
    for n, (i, *_) in enumerate(mixing.slots(mixing.exact(weights), 50_000), 1):
        served[i] += 1
        assert all(abs(k - Fraction(w) / total * n) < 1 for k, w in zip(served, weights))
    assert served[1] in (25, 26)


def test_any_weights_end(spark):
    """A weight of one part in a billion: the mix ends, keeps its targets to its end, and what is left follows in a tail."""
    rows = [(i, "w" * 100, "ab"[i < 40]) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.plan(df, weights={"a": 1.0, "b": 1e-9}, block_bytes=100)
    got = mixing.place(df, mix).collect()
    assert mix.tail and mix.horizon == mixing.MOST_EPOCHS * 100
    assert Counter(r.doc_id for r in got if r.epoch == 0) == Counter(range(100))
    total, served = Fraction(1.0) + Fraction(1e-9), Counter()
    by_slot = {r.slot: r.source for r in got}
    assert sorted(by_slot) == list(range(max(by_slot) + 1))
    for t in range(mix.horizon):
        served[by_slot[t]] += 1
        assert all(abs(served[s] - Fraction(w) / total * (t + 1)) < 1 for s, w in (("a", 1.0), ("b", 1e-9)))
    assert {by_slot[t] for t in range(mix.horizon, max(by_slot) + 1)} == {"b"}


def test_blocks_grow_where_a_mix_has_too_many(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 10)
    df = spark.createDataFrame([(i, "w" * 3_000, "ab"[i % 2]) for i in range(600)], "doc_id long, text string, source string")
    mix = mixing.plan(df)
    assert mix.block_bytes == 180_000 and mix.horizon == 10
    assert Counter(r.doc_id for r in mixing.place(df, mix).collect()) == Counter(range(600))


def test_a_written_mix_keeps_its_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_BYTES", 500)
    rnd = random.Random(4)
    rows = [(i, "w" * rnd.randint(0, 300), rnd.choice("aab")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    placed = sorted(mixing.place(df, mixing.plan(df)).collect(), key=lambda r: (r.slot, r.turn, r.doc_id))
    mixed = mixing.mixed_documents(df)
    mixed.write.parquet(f"{tmp_path}/mix")
    for docs in (spark.read.parquet(f"{tmp_path}/mix"), mixed.cache()):
        got = sorted(mixing.with_position(docs).collect(), key=lambda r: (r.part, r.row))
        assert [r.doc_id for r in got] == [r.doc_id for r in placed]


def test_mix_of_a_tiny_source_is_no_longer_than_the_others_need(spark):
    df = spark.createDataFrame([(i, "w" * 100, "a") for i in range(3000)] + [(9999, "w", "b")], "doc_id long, text string, source string")
    mix = mixing.plan(df, weights={"a": 1.0, "b": 1e-5}, block_bytes=100)
    got = mixing.place(df, mix).collect()
    assert mix.horizon <= 3002 and Counter(r.doc_id for r in got)[9999] == 1 and all(r.release <= r.slot < min(r.deadline, mix.horizon) for r in got)
