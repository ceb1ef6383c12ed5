"""SentencePiece encoding and decoding through the tokenizers library.

The model's protobuf is parsed here; its normaliser, metaspace marker, scores and byte fallback are rebuilt
as a ``tokenizers.Tokenizer``, the library encodes each distinct word of some megabytes of texts once, and the
identifiers of every whole text are verified against the sentencepiece library. BPE models get their merges from the scores (the pair whose
piece has the best score merges first); unigram models get the scores themselves.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, offsets, task, utf8

# Fixed values of the model format: piece kinds, model kinds, field numbers.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"

#: Threads a worker's library may use; texts encoded at once.
THREADS, TEXTS_AT_ONCE = 2, 64
#: Bytes of texts whose distinct words are encoded once; bytes of words that stand in one string for the library.
WORDS_BYTES, STRING_BYTES = 4 << 20, 1 << 12


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        i += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, i


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        if (wire := key & 7) == 0:
            value, i = _varint(data, i)
        else:
            if wire == 2:
                size, i = _varint(data, i)
            else:
                size = {1: 8, 5: 4}[wire]
            value, i = data[i : i + size], i + size
        yield key >> 3, value


def parse_model(data: bytes) -> dict:
    """Pieces with scores and kinds, the model's kind, byte fallback, and the normaliser's settings."""
    out = {"pieces": [], "kind": UNIGRAM, "byte_fallback": False, "unk_id": 0, "charsmap": b"", "dummy_prefix": True, "squeeze": True, "escape": True}
    for number, value in _fields(data):
        if number == 1:
            piece = {1: b"", 2: struct.pack("<f", 0), 3: NORMAL} | dict(_fields(value))
            out["pieces"].append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            spec = dict(_fields(value))
            out |= {"kind": spec.get(3, UNIGRAM), "byte_fallback": bool(spec.get(35, 0))}
        elif number == 3:
            spec = dict(_fields(value))
            out |= {"charsmap": spec.get(2, b""), "dummy_prefix": bool(spec.get(3, 1)), "squeeze": bool(spec.get(4, 1)), "escape": bool(spec.get(5, 1))}
    out["unk_id"] = next((i for i, p in enumerate(out["pieces"]) if p[2] == UNKNOWN), 0)
    return out


def _merges(vocab: dict[str, int], scores: dict[str, float]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first; of one piece's splits, the order does not matter to the result."""
    found = []
    for piece, i in vocab.items():
        if piece in scores:
            found += [(-scores[piece], i, vocab[piece[:k]], piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in vocab and piece[k:] in vocab]
    return [(a, b) for _, _, _, a, b in sorted(found)]


def build(data: bytes, bare: bool = False):
    """The tokenizer that a model's bytes describe; ``bare``: for texts that are normalised and marked already."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    m = parse_model(data)
    if not m["escape"]:
        raise ValueError("a model that keeps white space unescaped is not handled")
    vocab = {p: i for i, (p, _, _) in enumerate(m["pieces"])}
    if m["kind"] == UNIGRAM:
        # only what texts may hold can be met: marked texts have no space, so no text holds the other names
        model = models.Unigram([(p if kind in (NORMAL, USER_DEFINED) else f" {p}", s) for p, s, kind in m["pieces"]], unk_id=m["unk_id"])
    elif m["kind"] == BPE:
        scores = {p: s for p, s, kind in m["pieces"] if kind in (NORMAL, UNUSED)}
        model = models.BPE(vocab, _merges(vocab, scores), unk_token=m["pieces"][m["unk_id"]][0], fuse_unk=True, byte_fallback=m["byte_fallback"])
    else:
        raise ValueError("only unigram and BPE models are handled")
    out = Tokenizer(model)
    steps = [normalizers.Precompiled(m["charsmap"])] if m["charsmap"] else []
    if m["squeeze"]:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(MARK)] * m["dummy_prefix"] + [normalizers.Replace(" ", MARK)]
    if not bare:
        out.normalizer = normalizers.Sequence(steps)
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] * (m["dummy_prefix"] and not bare))])
    out.add_tokens([AddedToken(p, normalized=False) for p, _, kind in m["pieces"] if kind == USER_DEFINED])
    out.encode_special_tokens = True
    return out


def _markers(data: np.ndarray) -> np.ndarray:
    """For each byte, whether a marker begins there."""
    out = np.zeros(len(data), bool)
    a, b, c = MARK.encode()
    out[:-2] = (data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)
    return out


def _word_bounds(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where words begin, and the end: at the texts' borders and at each marker that no marker stands before."""
    at = np.flatnonzero(_markers(data))
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = np.diff(at, prepend=-len(MARK.encode()) - 1) > len(MARK.encode())
    edge[off] = True
    return np.flatnonzero(edge)


class Codec:
    """Encodes and decodes whole texts, and compares them with the sentencepiece library."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = parse_model(data)
        self.data, self.theirs = data, sentencepiece.SentencePieceProcessor(model_proto=data)
        # where the normaliser only marks spaces, a text is marked before the library sees it, which then tracks no changes
        self.plain = not (self.model["charsmap"] or self.model["squeeze"] or any(kind == USER_DEFINED for _, _, kind in self.model["pieces"]))
        self.bare = build(data, bare=True)
        self.lead = MARK if self.model["dummy_prefix"] else ""
        #: identifiers of the bytes, where they stand for what a unigram model lacks
        self.of_byte = [i for i, (_, _, kind) in enumerate(self.model["pieces"]) if kind == BYTE] if self.model["byte_fallback"] and self.model["kind"] == UNIGRAM else []
        # where no piece has a marker behind another character, no merge goes on from one word into the next
        met = [p for p, _, kind in self.model["pieces"] if kind in (NORMAL, UNUSED)]
        self.by_words = self.model["kind"] == BPE and MARK in met and not any(MARK in p.lstrip(MARK) for p in met) and not any(kind == USER_DEFINED for _, _, kind in self.model["pieces"])
        #: identifiers that a word begins with
        self.begins = np.array([p.startswith(MARK) for p, _, _ in self.model["pieces"]])
        #: what each identifier stands for in a text
        self.bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in self.model["pieces"]]

    @cached_property
    def whole(self):
        """The tokenizer with its normaliser, built only where that is needed."""
        return build(self.data)

    def marked(self, text: str) -> str:
        """The text as the model's normaliser gives it."""
        if self.plain:
            return self.lead + text.replace(" ", MARK) if text else ""
        return self.whole.normalizer.normalize_str(text)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Identifiers of each text by the rebuilt tokenizer."""
        return self._encode([self.marked(t) for t in texts])

    def encode_column(self, column: pa.Array) -> Iterator[list[list[int]]]:
        """Identifiers of each text of a column, ``TEXTS_AT_ONCE`` texts at a time; as ``encode`` gives them, null counts as empty."""
        if not self.by_words:
            for at in range(0, len(column), TEXTS_AT_ONCE):
                yield self.encode(pc.fill_null(column.slice(at, TEXTS_AT_ONCE), "").to_pylist())
            return
        for i, j in groups(offsets(column), WORDS_BYTES):
            data, off = utf8(self._marked_column(pc.fill_null(column.slice(i, j - i), "")))
            bounds = _word_bounds(data, off)
            words = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
            which, (flat, start, size) = words.indices.to_numpy(), self._encode_words(words.dictionary)
            ends = np.concatenate([[0], np.cumsum(size[which])])
            of_text = np.searchsorted(bounds, off)
            for at in range(0, j - i, TEXTS_AT_ONCE):
                own = of_text[at : at + TEXTS_AT_ONCE + 1]
                w = which[own[0] : own[-1]]
                shift = start[w] - (ends[own[0] : own[-1]] - ends[own[0]])
                ids = flat[np.repeat(shift, size[w]) + np.arange(ends[own[-1]] - ends[own[0]])].tolist()
                cut = (ends[own] - ends[own[0]]).tolist()
                yield [ids[a:b] for a, b in pairwise(cut)]

    def _marked_column(self, column: pa.Array) -> pa.Array:
        if not self.plain:
            return pa.array([self.marked(t) for t in column.to_pylist()], pa.large_string())
        column = column.cast(pa.large_string())
        marked = pc.replace_substring(column, " ", MARK)
        lead, nothing = (pa.scalar(x, pa.large_string()) for x in (self.lead, ""))
        return pc.if_else(pc.equal(pc.binary_length(column), 0), column, pc.binary_join_element_wise(lead, marked, nothing))

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(identifiers, where each word's begin, how many it has) of distinct words."""
        data, off = utf8(words)
        marked = _markers(data)
        marks = np.searchsorted(np.flatnonzero(marked), off)
        # such words can be told apart again when they stand in one string: only their first piece has a marker
        alone = (np.diff(marks) == 1) & marked[off[:-1]] & (np.diff(off) > len(MARK.encode()))
        data, off = utf8(words.filter(pa.array(alone)))
        strings = [data[off[i] : off[j]].tobytes().decode() for i, j in groups(off, STRING_BYTES)]
        joined = [np.zeros(0, np.int32), *(np.array(ids, np.int32) for ids in self._in_parts(strings))]
        other = [np.array(ids, np.int32) for ids in self._in_parts(words.filter(pa.array(~alone)).to_pylist())]
        joined = np.concatenate(joined)
        begin = np.flatnonzero(self.begins[joined])
        start, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        start[alone], size[alone] = begin, np.diff(np.append(begin, len(joined)))
        size[~alone] = [*map(len, other)]
        start[~alone] = len(joined) + np.cumsum(size[~alone]) - size[~alone]
        return np.concatenate([joined, *other]), start, size

    def _in_parts(self, marked: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(marked), TEXTS_AT_ONCE):
            yield from self._encode(marked[at : at + TEXTS_AT_ONCE])

    def _encode(self, texts: list[str]) -> list[list[int]]:
        """Identifiers of texts as the normaliser gives them."""
        out = [e.ids for e in self.bare.encode_batch_fast(texts, add_special_tokens=False)]
        if self.of_byte:
            unknown = self.model["unk_id"]
            odd = [i for i, ids in enumerate(out) if unknown in ids]
            for i, e in zip(odd, self.bare.encode_batch([texts[i] for i in odd], add_special_tokens=False), strict=True):
                out[i] = list(chain.from_iterable([k] if k != unknown else (self.of_byte[b] for b in texts[i][p:q].encode()) for k, (p, q) in zip(e.ids, e.offsets, strict=True)))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of identifiers; bytes that make no character become replacement characters."""
        out = [b"".join(map(self.bytes.__getitem__, i)).decode("utf-8", "replace") for i in ids]
        return [t[1:] if t[:1] == " " else t for t in out] if self.lead else out

    def verified(self, texts: list[str], ids: list[list[int]]) -> tuple[list[bool], list[bool]]:
        """For each text, whether decoding its identifiers gives it again, and whether sentencepiece has the same identifiers for it."""
        return [a == b for a, b in zip(texts, self.decode(ids), strict=True)], [a == b for a, b in zip(ids, self.theirs.encode(texts, num_threads=1), strict=True)]


def encode(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = True) -> DataFrame:
    """``keep`` columns of every row with ids (array, if asked for), n_tokens, n_bytes, n_fallback, round_trip, parity.

    Every whole text is encoded by the rebuilt tokenizer, decoded again and encoded by the sentencepiece library
    as well. round_trip: decoding its identifiers gave the text again (a text with marker characters of its own
    comes back with spaces for them). parity: sentencepiece gives the same identifiers. n_fallback counts byte
    tokens. The driver reads the model once and sends its bytes. A null or empty text gives no tokens and holds both checks; null
    keys, repeated rows, ties and extra columns are left as they are. Map-only: no shuffle.
    """
    spark = docs.sparkSession
    with open(model, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))
    made = (["ids"] if ids else []) + ["n_tokens", "n_bytes", "n_fallback", "round_trip", "parity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        codec = None
        for whole in batches:
            if codec is None:
                codec = Codec(sent.value)
                is_byte = np.array([kind == BYTE for _, _, kind in codec.model["pieces"]])
            at = 0
            for got in codec.encode_column(whole.column("t")):
                b, at = whole.slice(at, len(got)), at + len(got)
                column = pc.fill_null(b.column("t"), "")
                texts = column.to_pylist()
                back, same = codec.verified(texts, got)
                size = np.array([0, *map(len, got)], np.int64)
                flat = np.fromiter(chain.from_iterable(got), np.int32, int(size.sum()))
                bytes_before = np.concatenate([[0], np.cumsum(is_byte[flat])])
                ends = np.cumsum(size)
                cols = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))] * ids
                cols += [pa.array(size[1:]), pc.cast(pc.binary_length(column), pa.int64()), pa.array(np.diff(bytes_before[ends]).astype(np.int64)), pa.array(back, pa.bool_()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], names=[*b.schema.names[:-1], *made])

    kinds = {"ids": "array<int>", "round_trip": "boolean", "parity": "boolean"}
    schema = ", ".join([*(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)), *(f"{c} {kinds.get(c, 'long')}" for c in made)])
    return rows.mapInArrow(task(run), schema).toDF(*keep, *made)


def decode(encoded: DataFrame, model: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with text, decoded from the identifiers; null identifiers give a null text, none an empty one."""
    with open(model, "rb") as f:
        sent = encoded.sparkSession.sparkContext.broadcast(f.read())
    rows = encoded.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(ids).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for b in batches:
            codec = codec or Codec(sent.value)
            lists = b.column("t").to_pylist()
            text = codec.decode([x or [] for x in lists])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([None if x is None else t for x, t in zip(lists, text, strict=True)], pa.string())], names=[*b.schema.names[:-1], "text"])

    kinds = ", ".join(f"k{i} {encoded.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    return rows.mapInArrow(task(run), f"{kinds}, text string").toDF(*keep, "text")
