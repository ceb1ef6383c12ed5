"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language reads a text and cuts it into phrases, each the longest
that occurs in that language's sample. Phrases times log2 of the sample's length, over the characters read,
estimates the cross entropy; the language that needs least wins. Symbols are code points: every letter of
every script counts as itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import task

#: The classifier's bounded sample: whole rows a language, and their characters in all. A row that does not fit is passed over; if none does, the shortest is taken.
TRAIN_ROWS, TRAIN_CHARS = 64, 40_000
#: Characters of a part; parts are read side by side and then joined, which does not change the phrases.
PART = 512
#: Characters that are read at once, or one text.
CHARS = 1 << 20
UNKNOWN = "und"

_SPACE = 0


@lru_cache(1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Alphabet:
    """Numbers of letters: space 0, the letters from 1 on, all other letters the last number."""

    def __init__(self, letters: list[int]):
        self.letters = letters
        self.codes = np.where(_letters(), len(letters) + 1, _SPACE).astype(np.int32)
        self.codes[letters] = np.arange(1, len(letters) + 1)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all texts, offsets): lower case, runs of non-letters as one space, none at a text's ends."""
        texts = [t.lower() for t in texts]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.codes[points]
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        letter = sym != _SPACE
        # a space stays where a letter of its text stands before the run, and another behind it: at the run's last place
        before = np.concatenate([[0], np.cumsum(letter)])
        size = np.diff(off)
        owner_first, owner_all = np.repeat(before[off[:-1]], size), np.repeat(before[off[1:]], size)
        follows = np.append(letter[1:], False)
        keep = letter | (follows & (before[:-1] > owner_first) & (before[:-1] < owner_all))
        return sym[keep], np.concatenate([[0], np.cumsum(keep)])[off]


class Automaton:
    """Suffix automaton of a sample. Steps lie in one array, each state's at its own shift, so its size is that of the sample whatever the alphabet.

    The last state is the one after a symbol that the sample lacks, where any symbol begins a phrase.
    """

    def __init__(self, text: np.ndarray, n_symbols: int):
        after: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text.tolist():
            cur = len(after)
            after.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in after[p]:
                after[p][c] = cur
                p = link[p]
            if p >= 0:
                q = after[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(after)
                    after.append(dict(after[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and after[p].get(c) == q:
                        after[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self._lay_out(after, n_symbols)

    def _lay_out(self, after: list[dict[int, int]], n_symbols: int) -> None:
        n = len(after)
        owner, to = {}, {}  # by place
        shift = np.full(n + 1, 0, np.int32)
        free, end = n_symbols, n_symbols
        for state in sorted(range(n), key=lambda s: (-len(after[s]), s)):
            steps = after[state]
            if not steps:
                continue
            while free in owner:
                free += 1
            least = min(steps)
            if len(steps) == 1:
                at = free - least
            else:
                # the first of some shifts from the first free place on that fits, else one behind all others
                at = next((b for b in range(free - least, free - least + 32) if not any(b + c in owner for c in steps)), end - least)
            shift[state] = at
            for c, s in steps.items():
                owner[at + c], to[at + c] = state, s
            end = max(end, at + max(steps) + 1)
        # any state with any symbol stays within the arrays
        size = end + n_symbols + 1
        self.shift, self.owner, self.to = shift, np.full(size, -1, np.int32), np.zeros(size, np.int32)
        places = np.fromiter(owner, np.int64, len(owner))
        self.owner[places], self.to[places] = np.fromiter(owner.values(), np.int32, len(owner)), np.fromiter(to.values(), np.int32, len(to))
        self.begin = np.array([after[0].get(c, n) for c in range(n_symbols)], np.int32)
        self.start = n

    def step(self, state: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(states, whether a phrase begins) after a symbol."""
        at = self.shift[state] + sym
        goes_on = self.owner[at] == state
        return np.where(goes_on, self.to[at], self.begin[sym]), ~goes_on

    def phrases(self, sym: np.ndarray, off: np.ndarray, part: int = PART) -> np.ndarray:
        """Phrases of each text.

        All parts of all texts are read side by side as if a phrase began with each. Then each part is read again
        from the state in which the part before it really ends, until its states are those of the first reading;
        where they stay different to its end, the next part is read once more.
        """
        size = np.diff(off)
        parts = -(-size // part)
        owner = np.repeat(np.arange(len(size)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = off[:-1][owner] + nth * part
        length = np.minimum(off[1:][owner] - start, part)
        order = np.argsort(-length, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))  # of each part, in order of length
        start, length = start[order], length[order]
        count = np.zeros(len(order), np.int64)
        if not len(order):
            return np.zeros(len(size), np.int64)
        steps = int(length[0])
        active = np.searchsorted(-length, -np.arange(steps), side="left")
        states, begins = np.zeros((steps, len(order)), np.int32), np.zeros((steps, len(order)), bool)
        state = np.full(len(order), self.start, np.int32)
        for t, k in enumerate(active.tolist()):
            state[:k], begins[t, :k] = self.step(state[:k], sym[start[:k] + t])
            states[t, :k] = state[:k]
        count += begins.sum(0)
        todo = np.flatnonzero(nth > 0)
        while len(todo):
            mine, before = place[todo], place[todo - 1]
            now = states[length[before] - 1, before]
            t = 0
            while True:
                on = np.flatnonzero(length[mine] > t)
                if not len(on):
                    break
                lanes, cur = mine[on], now[on]
                new, begun = self.step(cur, sym[start[lanes] + t])
                count[lanes] += begun.astype(np.int64) - begins[t, lanes]
                differ = new != states[t, lanes]
                states[t, lanes], begins[t, lanes] = new, begun
                # those that agree are done; those at their end go on in the next part
                now[on] = new
                left = np.ones(len(mine), bool)
                left[on] = differ
                mine, now, todo = mine[left], now[left], todo[left]
                t += 1
            # what is left differed to its part's end
            todo = todo[np.append(nth, 0)[todo + 1] > 0] + 1
        return np.bincount(owner, count[place], len(size)).astype(np.int64)


class CrossParser:
    """Languages' automata over one alphabet."""

    def __init__(self, samples: dict[str, list[str]]):
        self.alphabet = Alphabet(sorted({ord(c) for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()}))
        self.languages, self.automata, self.bits = [], [], []
        for language in sorted(samples):
            sym, _ = self.alphabet.symbols([" ".join(samples[language])])
            if len(sym):
                self.languages.append(language)
                self.automata.append(Automaton(sym, len(self.alphabet.letters) + 2))
                self.bits.append(float(np.log2(len(sym) + 1)))

    def entropy(self, texts: list[str]) -> np.ndarray:
        """Estimated bits a character by (text, language); infinite for a text without a letter."""
        sym, off = self.alphabet.symbols(texts)
        size = np.diff(off)
        out = np.full((len(texts), len(self.languages)), np.inf)
        read = size > 0
        for i, (automaton, bits) in enumerate(zip(self.automata, self.bits, strict=True)):
            out[read, i] = automaton.phrases(sym, off)[read] * bits / size[read]
        return out


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> CrossParser:
    """Automata from a bounded sample of the labelled rows: per language, whole rows in the order of a hash of the key, ``TRAIN_ROWS`` and ``TRAIN_CHARS`` at most."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("l"), F.col(text).alias("t"), F.xxhash64(key).alias("h"), F.length(text).alias("n"))
    # rows that fit come first, by the hash, then the shortest of the others
    order = Window.partitionBy("l").orderBy(F.greatest("n", F.lit(TRAIN_CHARS)), "h", "t")
    rows = rows.withColumn("r", F.row_number().over(order)).where((F.col("r") <= TRAIN_ROWS) & ((F.col("n") <= TRAIN_CHARS) | (F.col("r") == 1)))
    samples: dict[str, list[str]] = {}
    left: dict[str, int] = {}
    for r in sorted(rows.drop("h").collect(), key=lambda r: (r.l, r.r)):  # TRAIN_ROWS rows a language at most, none over TRAIN_CHARS but where all are
        if r.l not in samples or r.n <= left[r.l]:
            samples.setdefault(r.l, []).append(r.t)
            left[r.l] = left.get(r.l, TRAIN_CHARS) - r.n
    return CrossParser(samples)


def identify(docs: DataFrame, parser: CrossParser, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score.

    Every whole text is read. score is the runner-up's bits over the sum of the best two: 0.5 for a tie, 1 if
    there is no other language. A null text, or one without a letter, gives ``und`` and 0, as does a parser
    that has learned no language. Of equal languages the first by name wins. Map-only: no shuffle; the
    automata (a size fixed by the sample's bound) are broadcast. Extra columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast((parser.alphabet.letters, parser.languages, parser.automata, parser.bits))
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = CrossParser({})
        letters, p.languages, p.automata, p.bits = sent.value
        p.alphabet = Alphabet(letters)
        for whole in batches:
            at = 0
            while at < whole.num_rows:
                texts, size = [], 0
                for t in whole.column("t")[at:]:
                    texts.append(t.as_py() or "")
                    size += len(texts[-1])
                    if size > CHARS:
                        break
                b, at = whole.slice(at, len(texts)), at + len(texts)
                bits = p.entropy(texts)
                if p.languages:
                    best = bits.argmin(1)
                    found = np.isfinite(bits[:, 0])
                    first = np.where(found, bits.min(1), 1.0)
                    second = np.where(found, np.partition(bits, 1, axis=1)[:, 1], 1.0) if len(p.languages) > 1 else np.full(len(texts), np.inf)
                    score = np.where(found, np.where(np.isinf(second), 1.0, second / np.maximum(first + second, 1e-300)), 0.0)
                    name = [p.languages[i] if ok else UNKNOWN for i, ok in zip(best, found, strict=True)]
                else:
                    name, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(name, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names[:-1], "lang_pred", "score"])

    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    return rows.mapInArrow(task(run), f"{kinds}lang_pred string, score double").toDF(*keep, "lang_pred", "score")
