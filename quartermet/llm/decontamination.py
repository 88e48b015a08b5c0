"""Benchmark decontamination with a generalised suffix automaton.

The items' words become one automaton of all their substrings.  A document's
words are streamed through it while the longest match that ends at each word is
tracked; a word is hit if a match of ``WINDOW`` words covers it, or an occurrence
of a whole item of fewer words.  Spans of hit words can be removed, and documents
of which they cover too much.

Words are runs of ASCII digits, letters (A-Z as a-z) and everything beyond ASCII.
NULL and empty texts have no words; items without words have no windows; items
with a NULL id hit words but are not named; rows that repeat an item's id are one item.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import joined, kept, map_rows, small, steps, stored, with_text, word_hashes

WINDOW = 10
#: Bytes of item texts that one automaton holds; more items take further passes over the documents.
ITEM_BYTES = 16 << 20
#: Bytes that belong to no word.
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
MADE = (
    T.StructType()
    .add("n_words", "long")
    .add("n_hit", "long")
    .add("longest", "long")
    .add("items", T.ArrayType(T.StringType()))
    .add("spans", T.ArrayType(T.LongType()))
)


def item_words(text: str | None) -> list[bytes]:
    blob, _ = joined([(text or "").encode()])
    starts, ends, _ = word_hashes(blob, True, BETWEEN)
    raw = blob.tobytes().lower()
    return [raw[a:b] for a, b in zip(starts, ends, strict=True)]


@dataclass
class Automaton:
    """All substrings of the items added; ``length`` and ``link`` by state, 0 is the start."""

    window: int
    words: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    #: By state: the items with its substrings of ``window`` words and more.
    found: dict[int, set] = field(default_factory=dict)
    #: By state: length and name of the short items that end there.
    short: dict[int, list[tuple[int, str | None]]] = field(default_factory=dict)
    pairs: set[tuple[int, int]] = field(default_factory=set)
    least: int = 1 << 30

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A state for the part of ``q`` that continues ``p``."""
        clone = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, word: int) -> int:
        if (q := self.step[last].get(word)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def build(self, items: list[tuple[str | None, list[bytes]]]) -> Automaton:
        coded = [(name, [self.words.setdefault(w, len(self.words)) for w in words]) for name, words in items if words]
        for _, words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
            self.pairs.update(zip(words[:-1], words[1:], strict=True))
            self.least = min(self.least, len(words), self.window)
        for name, words in coded:
            state = 0
            for word in words:
                state = self.step[state][word]
                up = state
                while up > 0 and self.length[up] >= self.window:
                    named = self.found.setdefault(up, set())
                    if name in named:
                        break
                    named.add(name)
                    up = self.link[up]
            if len(words) < self.window:
                self.short.setdefault(state, []).append((len(words), name))
        # What ends with a short item's words ends with the item: hand it down the links.
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            if above := self.short.get(self.link[state]):
                self.short[state] = above + self.short.get(state, [])
        return self

    def matches(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """State and length of the longest match that ends at each word."""
        state = length = 0
        for i, word in enumerate(words):
            while state and word not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.step[state]:
                state = self.step[state][word]
                length += 1
            yield i, state, length

    def holders(self, state: int, length: int) -> set:
        """Items with the last ``window`` words of a match."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return self.found[state]


class Stream:
    """One automaton, ready to mark the words of documents."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.auto = auto = Automaton(window).build([(name, item_words(text)) for name, text in items])
        words = sorted(auto.words, key=auto.words.__getitem__)
        blob, _ = joined(words)
        hashes = word_hashes(blob, True, BETWEEN)[2] if words else np.zeros(0, np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        pairs = np.array(sorted(auto.pairs), np.int64).reshape(-1, 2)
        self.pairs = np.sort(pairs[:, 0] * len(words) + pairs[:, 1])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The automaton's number of each word, -1 for words of no item."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def mark(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, set, list[int]]]:
        """Words, hit words, longest match, items and hit byte ranges of each text."""
        blob, begins = joined(texts)
        starts, ends, hashes = word_hashes(blob, True, BETWEEN)
        numbers = self.numbers(hashes)
        first = np.searchsorted(starts, begins)  # of each document
        new = np.zeros(len(numbers) + 1, bool)
        new[first] = True
        # Matches stay within stretches in which each pair of words follows in some item.
        follows = np.zeros(len(numbers) + 1, bool)
        both = np.flatnonzero((numbers[:-1] >= 0) & (numbers[1:] >= 0) & ~new[1:-1])
        if len(both) and len(self.pairs):
            code = numbers[both] * len(self.auto.words) + numbers[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            follows[both[self.pairs[at] == code] + 1] = True
        begin = np.flatnonzero((numbers >= 0) & ~follows[:-1])
        stop = np.flatnonzero((numbers >= 0) & ~follows[1:]) + 1
        long = stop - begin >= self.auto.least
        hit = np.zeros(len(numbers) + 1, np.int64)
        items: dict[int, set] = {}
        longest: dict[int, int] = {}
        auto = self.auto
        for a, b in zip(begin[long].tolist(), stop[long].tolist(), strict=True):
            doc = int(np.searchsorted(first, a, side="right")) - 1
            for i, state, length in auto.matches(numbers[a:b].tolist()):
                sizes = []
                if length >= auto.window:
                    sizes.append(auto.window)
                    items.setdefault(doc, set()).update(auto.holders(state, length))
                for size, name in auto.short.get(state, ()):
                    if size <= length:
                        sizes.append(size)
                        items.setdefault(doc, set()).add(name)
                if sizes:
                    hit[a + i + 1 - max(sizes)] += 1
                    hit[a + i + 1] -= 1
                    longest[doc] = max(longest.get(doc, 0), length)
        covered = np.cumsum(hit[:-1]) > 0
        edge = np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8))
        for doc in range(len(texts)):
            a, b = int(first[doc]), int(first[doc + 1])
            if doc not in items:
                yield b - a, 0, 0, set(), []
                continue
            rise, fall = np.flatnonzero(edge[a:b] == 1) + a, np.flatnonzero(edge[a + 1 : b + 1] == -1) + a
            spans = np.stack([starts[rise], ends[fall]], 1) - begins[doc]
            yield b - a, int(covered[a:b].sum()), longest[doc], items[doc], spans.reshape(-1).tolist()


def mark(docs: DataFrame, items: DataFrame, window: int = WINDOW, item_id: str = "item_id") -> DataFrame:
    """Rows of ``docs`` as ``row`` with n_words, n_hit, longest, items (names, sorted) and spans.

    ``spans`` holds start and end of each run of hit words, in bytes of the UTF-8
    text.  Items are read block by block, none of more than ``ITEM_BYTES``
    (unless one item is longer); each block is one pass over the documents.
    """
    named = items.select(F.col(f"`{item_id}`").cast("string").alias("name"), F.col("text").cast("string"))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES) or 1
    done = None
    for k in range(blocks):
        part = named.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k) if blocks > 1 else named
        block = [tuple(x) for x in part.collect()]
        passed = map_rows(docs, _marker(block, window), MADE) if done is None else _again(done, block, window)
        done = stored(passed, "decontamination") if blocks > k + 1 else passed
    return done.select("row", *MADE.names)


def _marker(block: list, window: int):
    key = hash((window, *block))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams = kept("decontamination")
        if key not in streams:
            streams.clear()
            streams[key] = (block, Stream(block, window))
        stream = streams[key][1]
        for batch in small(batches):
            texts = batch.column("text").to_pylist()
            out = [x for a, b in steps(texts) for x in stream.mark(texts[a:b])]
            names = [sorted({y for y in x[3] if y is not None}) for x in out]
            made = [[x[0] for x in out], [x[1] for x in out], [x[2] for x in out], names, [x[4] for x in out]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(m, k) for m, k in zip(made, kinds, strict=True))],
                names=["row", *MADE.names],
            )

    return work


def _again(done: DataFrame, block: list, window: int) -> DataFrame:
    """A further block of items over rows marked by those before."""
    both = map_rows(done.select("*", F.col("row.text").alias("text")), _marker(block, window), MADE)
    old = {c: F.col(f"row.{c}") for c in MADE.names}
    merged = _merge(F.struct(*[old[c].alias(c) for c in MADE.names]), F.struct(*MADE.names), F.col("row.text"))
    return both.select(F.col("row.row").alias("row"), merged.alias("m")).select("row", "m.*")


def _merge(one, two, text):
    """Marks of two blocks over one text, united."""
    @F.pandas_udf(MADE)
    def unite(a: pd.DataFrame, b: pd.DataFrame, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for x, y, t in zip(a.to_dict("records"), b.to_dict("records"), texts, strict=True):
            blob, _ = joined([(t or "").encode()])
            starts, ends, _ = word_hashes(blob, True, BETWEEN)
            hit = np.zeros(len(starts) + 1, np.int64)
            for spans in (x["spans"], y["spans"]):
                for p, q in np.array(spans, np.int64).reshape(-1, 2):
                    hit[np.searchsorted(starts, p)] += 1
                    hit[np.searchsorted(ends, q) + 1] -= 1
            covered = np.cumsum(hit[:-1]) > 0
            edge = np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8))
            spans = np.stack([starts[edge[:-1] == 1], ends[np.flatnonzero(edge == -1) - 1]], 1).reshape(-1)
            items = sorted({*x["items"], *y["items"]})
            rows.append((x["n_words"], int(covered.sum()), max(x["longest"], y["longest"]), items, spans.tolist()))
        return pd.DataFrame(rows, columns=MADE.names)

    return unite(one, two, text)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = 0.5) -> DataFrame:
    """``docs`` without hit spans, and without documents of which more than ``coverage`` of the words is hit."""
    marked = mark(docs, items, window)
    kept = marked.where(F.col("n_hit") <= coverage * F.col("n_words"))
    return with_text(kept, docs.columns, "text", cut(F.col("row.text"), F.col("spans")))


@F.pandas_udf(T.StringType())
def _without(texts, spans):
    out = []
    for text, cuts in zip(texts, spans, strict=True):
        if text is None or cuts is None or not len(cuts):
            out.append(text)
            continue
        raw, at, kept = text.encode(), 0, []
        for a, b in np.array(cuts, np.int64).reshape(-1, 2):
            kept.append(raw[at:a])
            at = b
        out.append(b"".join([*kept, raw[at:]]).decode())
    return pd.Series(out, dtype=object)


def cut(text, spans):
    """``text`` without the byte ranges ``spans``; most texts have none and skip Python."""
    return F.when(F.size(spans) > 0, _without(F.when(F.size(spans) > 0, text), spans)).otherwise(text)
