"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut by the vocabulary's pattern; each piece's bytes form a doubly linked list, and a heap of
adjacent pairs yields the lowest rank again and again. The count is the initial symbols minus the merges;
identifiers are never emitted. Work is map-only: no shuffle, no state beyond a bounded cache of pieces.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import task

#: Pieces whose counts a worker keeps, and their greatest length; longer pieces are counted anew each time.
CACHED_PIECES, CACHED_LENGTH = 500_000, 64

# The byte-level alphabet of such vocabularies maps printable bytes to themselves, the others from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in a byte-level vocabulary."""
    rest = [b for b in range(256) if b not in set(_PLAIN)]
    return {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Counts(dict):
    """Counts of pieces met before; a bounded cache that starts afresh when full."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece.encode())
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = n
        return n


class PairMerger:
    """Counts what a byte-level BPE vocabulary makes of a text."""

    def __init__(self, spec: dict):
        import regex

        pre, model = spec["pre_tokenizer"], spec["model"]
        if pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a plain byte-level vocabulary is needed")
        if model["type"] != "BPE" or model["ignore_merges"] or model["byte_fallback"]:
            raise ValueError("a plain BPE model is needed")
        alphabet = byte_alphabet()
        ids: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        spell = lambda s: bytes(alphabet[c] for c in s)
        pairs = [(spell(a), spell(b)) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        for a, b in pairs:
            ids.setdefault(a + b, len(ids))
        #: (left, right) -> (rank, merged symbol)
        self.rank = {(ids[a], ids[b]): (r, ids[a + b]) for r, (a, b) in enumerate(pairs)}
        white = r"\p{White_Space}"
        self.pattern = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{white}\p{{L}}\p{{N}}]+|{white}+(?!\P{{White_Space}})|{white}+")
        # of these characters both engines think alike, and the standard one is twice as fast
        self.common = re.compile("[\x00-\x1b\x20-\x7eÀ-ÖØ-öø-ɏ]*")
        self.common_pattern = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
        added = [t["content"] for t in spec.get("added_tokens", [])]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that take their surroundings are not handled")
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.special_strings = added
        self.cache = _Counts(self.merged)

    def merged(self, piece: bytes) -> int:
        """Symbols left of one piece."""
        n = len(piece)
        if n < 2:
            return n
        symbol, after, before = list(piece), [*range(1, n), -1], [*range(-1, n - 1)]
        rank, heap, left = self.rank, [], n
        for i in range(n - 1):
            if hit := rank.get((symbol[i], symbol[i + 1])):
                heap.append((hit[0], i, symbol[i], symbol[i + 1], hit[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i] if symbol[i] == a else -1
            if j < 0 or symbol[j] != b:
                continue  # one of the two has been merged meanwhile
            symbol[i], symbol[j], left = made, -1, left - 1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if hit := rank.get((made, symbol[k])):
                    heapq.heappush(heap, (hit[0], i, made, symbol[k], hit[1]))
            if (h := before[i]) >= 0 and (hit := rank.get((symbol[h], made))):
                heapq.heappush(heap, (hit[0], h, symbol[h], made, hit[1]))
        return left

    def plain(self, text: str) -> int:
        """Tokens of a text in which special strings have no meaning."""
        pattern = self.common_pattern if self.common.fullmatch(text) else self.pattern
        return sum(map(self.cache.__getitem__, pattern.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of a text; a special string is one token, as by the library's default."""
        if self.special is None or not any(s in text for s in self.special_strings):
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    ``vocabulary`` is a path to a tokenizer's .json; the driver reads it once and sends its text (a few MB,
    whatever the data's size). A null or empty text has 0 bytes and 0 tokens; rows with a null key, repeated
    rows and ties stay as they are; extra columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = None
        for b in batches:
            merger = merger or PairMerger(json.loads(spec.value))
            texts = pc.fill_null(b.column("t"), "")
            n = [merger.count(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[*b.schema.names[:-1], "n_bytes", "n_tokens", "over_limit"],
            )

    kinds = ", ".join(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = rows.mapInArrow(task(run), f"{kinds}, n_bytes long, n_tokens long, over_limit boolean")
    return out.toDF(*keep, "n_bytes", "n_tokens", "over_limit")
