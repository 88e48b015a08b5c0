"""Exact substring dedup over a sparse suffix array, sorted deep and shallow.

Each window of 50 bytes is represented by one anchor in it, the 16 bytes with the
smallest hash (equal windows choose alike), so some 6 of 100 suffixes stand for
all windows.  Anchors whose 16 bytes occur once are dropped by asking buckets
(see ``chunks``); the others are sent with the bytes around them that their
windows reach.  Each bucket sorts the suffixes from the anchors on and, read
backwards, the bytes before them: first by 8-byte words to a shallow depth, as
multikey quicksort splits groups; groups that still share their prefix are
ordered by a blind trie.  The longest common prefixes of neighbours tell which
windows are equal, and so which start in a document with a smaller id.

NULL ids are the smallest; NULL and empty texts have no bytes; rows that repeat an
id do not remove each other's bytes; matches never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import ASKED, Chunk, Chunks, answer, ask, bucket_of, by_bucket
from .common import batch_of, joined, lowest_places, mix, steps

WINDOW, ANCHOR = 50, 16
#: Most bytes of a window before its anchor.
BEFORE = WINDOW - ANCHOR
#: Bytes that the shallow phase compares.
SHALLOW = 24
#: Anchors that one bucket sorts, about.
SORTED_ROWS = 250_000
AROUND = "bucket long, chunk long, n int, level int, rows binary"
FOUND = "chunk long, bucket long, level int, bits binary"
KEPT = "doc_id long, text binary, n_bytes long, n_removed long, n_spans long"


def _compress(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(raw)


def _expand(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(raw)


# --------------------------------------------------------------- sorting


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """Order of distinct strings of one length, by a blind trie.

    Inner nodes hold the place at which their strings first differ and a child
    for each byte there; the bytes before are not kept.  A string walks down
    blindly, is compared with the leaf it meets, and is put in where they differ.
    """
    root: int | tuple[int, dict] = 0  # a leaf is the number of its string
    for number in range(1, len(strings)):
        own = strings[number]
        node = root
        while type(node) is tuple:
            place, children = node
            node = children.get(own[place])
            if node is None:
                node = next(iter(children.values()))
        other = strings[node] if type(node) is int else strings[_leaf(node)]
        differ = next(i for i, (a, b) in enumerate(zip(own, other, strict=True)) if a != b)
        above, node = None, root
        while type(node) is tuple and node[0] < differ:
            above, node = node, node[1].get(own[node[0]])
        if type(node) is tuple and node[0] == differ:
            node[1][own[differ]] = number
            continue
        new = (differ, {own[differ]: number, other[differ]: node})
        if above is None:
            root = new
        else:
            above[1][own[above[0]]] = new
    order: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if type(node) is tuple:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        else:
            order.append(node)
    return order


def _leaf(node) -> int:
    while type(node) is tuple:
        node = next(iter(node[1].values()))
    return node


def deep_shallow(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row of bytes among the distinct ones, and the common prefix of each rank with the one before."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # of each row in order; rows of a group agree so far
    shallow = SHALLOW // 8
    for k in range(words.shape[1]):
        if k == shallow:
            break
        part = words[order, k]
        again = np.lexsort((part, group))
        order, part, group = order[again], part[again], group[again]
        split = np.ones(n, bool)
        split[1:] = (group[1:] != group[:-1]) | (part[1:] != part[:-1])
        group = np.cumsum(split) - 1
    # Equal rows count once.
    rest = np.zeros(n, np.uint64)
    for k in range(shallow, words.shape[1]):
        rest = mix(rest + words[order, k])
    again = np.lexsort((rest, group))
    order, group, rest = order[again], group[again], rest[again]
    new = np.ones(n, bool)
    new[1:] = (group[1:] != group[:-1]) | (rest[1:] != rest[:-1])
    distinct = np.flatnonzero(new)
    of_row = np.cumsum(new) - 1
    # The deep phase: groups of several distinct rows.
    group = group[distinct]
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    ends = np.append(starts[1:], len(group))
    place = np.arange(len(distinct))
    raw = padded[order[distinct]]
    for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
        strings = [x.tobytes() for x in raw[a:b, SHALLOW:]]
        place[a:b] = a + np.array(blind_trie_order(strings))
    rank = np.empty(len(distinct), np.int64)
    rank[place] = np.arange(len(distinct))
    ranked = raw[place][:, :width]
    common = np.zeros(len(distinct), np.int64)
    differ = ranked[1:] != ranked[:-1]
    common[1:] = np.where(differ.any(1), differ.argmax(1), width)
    out = np.empty(n, np.int64)
    out[order] = rank[of_row]
    return out, common


def repeated_windows(around: np.ndarray, before: np.ndarray, after: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each anchor a bit for each number of bytes before it: that window starts in a document of smaller id."""
    right, common_right = deep_shallow(around[:, BEFORE:])
    left, common_left = deep_shallow(np.ascontiguousarray(around[:, BEFORE - 1 :: -1]))
    bits = np.zeros(len(ids), np.uint64)
    for k in range(BEFORE + 1):
        own = np.flatnonzero((before >= k) & (after >= WINDOW - k))
        if not len(own):
            continue
        one = np.cumsum(common_right < WINDOW - k)[right[own]]
        two = np.cumsum(common_left < k)[left[own]] if k else np.zeros(len(own), np.int64)
        key = one << 32 | two
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.diff(key[order], prepend=-1))
        least = np.repeat(np.minimum.reduceat(ids[own][order], new), np.diff(np.append(new, len(own))))
        later = own[order[ids[own][order] > least]]
        bits[later] |= np.uint64(1 << k)
    return bits


# ------------------------------------------------------------------ jobs


class Anchors:
    """Anchors of a chunk's windows: place, hash and bytes reached, by step."""

    def __init__(self, chunk: Chunk):
        self.chunk = chunk
        self.steps = []
        for a, b in steps(chunk.texts):
            blob, begins = joined(chunk.texts[a:b])
            n = len(blob) - WINDOW + 1
            if n <= 0:
                continue
            eight = np.ndarray(len(blob) - 7, "<u8", blob.data, 0, (1,))
            first, last = eight[:-8], eight[8:]
            hashes = mix(first * np.uint64(0x9E3779B97F4A7C15) + mix(last * np.uint64(0xC2B2AE3D27D4EB4F)))
            place = lowest_places(hashes, BEFORE + 1)
            inside = np.ones(n, bool)
            for end in begins[1:].tolist():  # windows that reach the byte after a document
                inside[max(0, end - WINDOW) : end] = False
            window = np.flatnonzero(inside)
            place = place[window]
            # Windows of one anchor follow each other.
            new = np.flatnonzero(np.diff(place, prepend=-1))
            end = np.append(new[1:], len(place)) - 1
            self.steps.append((a, blob, begins, place[new], window[new], window[end], hashes[place[new]]))
        self.hashes = np.concatenate([s[6] for s in self.steps] or [np.zeros(0, np.uint64)])

    def distinct(self) -> np.ndarray:
        return np.unique(self.hashes)

    def contexts(self, asked: int, buckets: int) -> Contexts:
        """The anchors whose bytes occur again, with the bytes around them."""
        distinct, at, places = np.unique(self.hashes, return_inverse=True, return_counts=True)
        again = (self.chunk.bits(0, bucket_of(distinct, asked)) | (places > 1))[at]
        doc, first, last, place, rows, hashes = [], [], [], [], [], []
        done = 0
        for step in self.steps:
            a, blob, begins, where, low, high, own = step
            live = again[done : done + len(where)]
            done += len(where)
            where, low, high = where[live].astype(np.int64), low[live], high[live]
            span = np.concatenate([np.zeros(BEFORE, np.uint8), blob, np.zeros(WINDOW, np.uint8)])
            got = span[where[:, None] + np.arange(BEFORE + WINDOW)]
            column = np.arange(BEFORE + WINDOW) - BEFORE
            got[(column < (low - where)[:, None]) | (column >= (high + WINDOW - where)[:, None])] = 0
            number = np.searchsorted(begins, where, side="right") - 1
            doc.append(a + number)
            place.append(where - begins[number])
            first.append(where - low)
            last.append(high + WINDOW - where)
            rows.append(got)
            hashes.append(own[live])
        return Contexts(self.chunk, *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (doc, place, first, last)),
                        np.concatenate(rows) if rows else np.zeros((0, BEFORE + WINDOW), np.uint8),
                        np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), buckets)


class Contexts:
    """Anchors with the bytes around them; equal ones are sent once, with the smallest id."""

    def __init__(self, chunk, doc, place, before, after, rows, hashes, buckets):
        self.doc, self.place, self.before, self.after = doc, place, before, after
        self.ids = chunk.ids[doc.astype(np.int64)] if len(doc) else np.zeros(0, np.int64)
        words = np.zeros((len(rows), 88), np.uint8)
        words[:, : rows.shape[1]] = rows
        words[:, 84], words[:, 85] = before, after
        key = np.zeros(len(rows), np.uint64)
        for k in range(11):
            key = mix(key + words.view("<u8")[:, k])
        # Documents are in order of their ids: the first of equal ones has the smallest.
        _, self.first, self.of_row = np.unique(key, return_index=True, return_inverse=True)
        self.rows = words[self.first]
        self.parts = list(by_bucket(bucket_of(hashes[self.first], buckets)))


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """Columns doc_id, text (the bytes kept), n_bytes, n_removed, n_spans."""
    chunks = Chunks(docs)
    asked, buckets = chunks.buckets(0.06), int(chunks.bytes * 0.02) // SORTED_ROWS + 1

    def first(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        yield from ask(chunk, Anchors(chunk).distinct(), 0, asked)

    def send(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        found = Anchors(chunk).contexts(asked, buckets)
        for bucket, at in found.parts:
            raw = found.rows[at].tobytes() + found.ids[found.first[at]].astype("<i8").tobytes()
            yield batch_of(AROUND, [[bucket], [chunk.number], [len(at)], [1], [_compress(raw)]])

    def sort(rows: pa.Table) -> pa.Table:
        counts = rows.column("n").to_pylist()
        around, ids = [], []
        for n, raw in zip(counts, map(_expand, rows.column("rows").to_pylist()), strict=True):
            around.append(np.frombuffer(raw, np.uint8, n * 88).reshape(n, 88))
            ids.append(np.frombuffer(raw, "<i8", n, n * 88))
        every = np.concatenate(around)
        bits = repeated_windows(every[:, : BEFORE + WINDOW], every[:, 84], every[:, 85], np.concatenate(ids))
        parts = [x.astype("<u8").tobytes() for x in np.split(bits, np.cumsum(counts)[:-1])]
        made = [rows.column("chunk").to_pylist(), rows.column("bucket").to_pylist(), [1] * len(parts), parts]
        return pa.Table.from_batches([batch_of(FOUND, made)])

    def keep(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        found = Anchors(chunk).contexts(asked, buckets)
        own = {r["bucket"]: r["bits"] for r in chunk.answers if r["level"] == 1}
        bits = np.zeros(len(found.rows), np.uint64)
        for bucket, at in found.parts:
            bits[at] = np.frombuffer(own[bucket], "<u8")
        sizes = np.fromiter(map(len, chunk.texts), np.int64, len(chunk.texts))
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        covered = np.zeros(int(begins[-1]) + WINDOW + 1, np.int32)
        later = found.ids > found.ids[found.first][found.of_row] if len(found.ids) else np.zeros(0, bool)
        mine = bits[found.of_row] if len(found.ids) else bits
        place = begins[found.doc.astype(np.int64)] + found.place if len(found.ids) else np.zeros(0, np.int64)
        for k in range(BEFORE + 1):
            valid = (found.before >= k) & (found.after >= WINDOW - k)
            gone = place[valid & (later | (mine >> np.uint64(k) & np.uint64(1)).astype(bool))].astype(np.int64) - k
            covered[gone] += 1  # a window has one anchor: no place comes twice
            covered[gone + WINDOW] -= 1
        away = np.cumsum(covered) > 0
        texts, removed, spans = [], [], []
        for text, begin in zip(chunk.texts, begins[:-1].tolist(), strict=True):
            flags = away[begin : begin + len(text)]
            removed.append(int(flags.sum()))
            spans.append(int(np.count_nonzero(np.diff(flags.astype(np.int8), prepend=0) == 1)))
            texts.append(np.frombuffer(text, np.uint8)[~flags].tobytes() if removed[-1] else text)
        yield batch_of(KEPT, [chunk.null_ids(chunk.ids), texts, sizes, removed, spans])

    answers = answer(chunks.each(first, ASKED))
    sent = chunks.each_with(answers, send, AROUND)
    answers = answers.union(sent.groupBy("bucket").applyInArrow(sort, FOUND))
    return chunks.each_with(answers, keep, KEPT)
