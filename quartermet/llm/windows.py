"""Substring dedup by level-wise doubling of word windows.

A window of 20 words can repeat only if its windows of 5 and of 10 words do.  So
at level 5 each window of 20 is represented by one of its windows of 5, that with
the smallest hash (equal windows choose alike); windows whose representative
occurs once in the whole corpus are dropped.  What survives is asked again with
windows of 10, and at last with the windows of 20 themselves, by 64-bit hashes
and with the document in which each occurs first.

White space is space and \\t to \\r.  NULL and empty texts have no words, texts of
fewer words than a window keep all.  A window is removed if the same words start
in a document with a smaller id (NULL is the smallest) or earlier in the same
row; rows that repeat an id do not remove each other's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import NO_ID, Chunk, Chunks, answer, ask, bucket_of, by_bucket
from .common import batch_of, joined, lowest_places, steps, windows_hash, word_hashes

WINDOW = 20
#: Lengths below the window that are asked first, each twice the one before.
LEVELS = (5, 10)
FIRSTS = "bucket long, chunk long, hashes binary, ids binary, counts binary"
FOUND = "chunk long, bucket long, level int, bits binary"
KEPT = "doc_id long, text binary, n_words long, n_removed long"


class Words:
    """Word hashes of a chunk's documents, and the windows of 20 that still may repeat."""

    def __init__(self, chunk: Chunk):
        self.chunk = chunk
        sizes, parts = [], []
        for a, b in steps(chunk.texts):
            blob, begins = joined(chunk.texts[a:b])
            starts, _, hashes = word_hashes(blob, False)
            sizes.append(np.diff(np.searchsorted(starts, begins)))
            parts.append(hashes)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.ends = np.cumsum(self.sizes)
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        start = np.arange(len(self.hashes))
        # Windows that lie within a document.
        self.alive = start[start + WINDOW <= self.ends[doc]] if len(start) else start
        self.doc = doc

    def chosen(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the representatives, one for each place; the number of each live window's one."""
        hashes = windows_hash(self.hashes, length)
        place = lowest_places(hashes, WINDOW - length + 1)[self.alive]
        # Places rise with the windows: equal ones are neighbours.
        new = np.diff(place, prepend=-1) != 0
        return hashes[place[new]], np.cumsum(new) - 1

    def narrow(self, level: int, buckets: int, length: int) -> None:
        """Keep the windows whose representative occurs again, here or in other chunks."""
        mine, of_window = self.chosen(length)
        distinct, at, places = np.unique(mine, return_inverse=True, return_counts=True)
        again = self.chunk.bits(level, bucket_of(distinct, buckets)) | (places > 1)
        self.alive = self.alive[again[at][of_window]]

    def whole(self) -> np.ndarray:
        """Hash of each live window."""
        return windows_hash(self.hashes, WINDOW)[self.alive]


def _asked(chunks: Chunks, level: int, answers: DataFrame | None, buckets: int) -> DataFrame:
    from .chunks import ASKED

    def work(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        words = Words(chunk)
        for before in range(level):
            words.narrow(before, buckets, LEVELS[before])
        yield from ask(chunk, np.unique(words.chosen(LEVELS[level])[0]), level, buckets)

    return chunks.each(work, ASKED) if answers is None else chunks.each_with(answers, work, ASKED)


def _first_places(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of the live windows, the place of each first one, and each window's number among them."""
    return np.unique(words.whole(), return_index=True, return_inverse=True)


def _sent(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Distinct windows, ids of their first documents, and for each bucket the order in which they go."""
    distinct, first, _ = _first_places(words)
    docs = words.doc[words.alive[first]]
    parts = []
    for bucket, at in by_bucket(bucket_of(distinct, buckets)):
        parts.append((bucket, at[np.argsort(docs[at], kind="stable")]))
    return distinct, words.chunk.ids[docs] if len(docs) else np.zeros(0, np.int64), parts


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Columns doc_id, text (UTF-8 bytes of the kept words, one space between), n_words, n_removed."""
    chunks = Chunks(docs)
    buckets = chunks.buckets(0.03)
    answers = None
    for level in range(len(LEVELS)):
        found = answer(_asked(chunks, level, answers, buckets))
        answers = found if answers is None else answers.union(found)

    def live(chunk: Chunk) -> Words:
        words = Words(chunk)
        for level, length in enumerate(LEVELS):
            words.narrow(level, buckets, length)
        return words

    def firsts(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        distinct, ids, parts = _sent(live(chunk), buckets)
        for bucket, at in parts:
            own = ids[at]
            cuts = np.flatnonzero(np.diff(own, prepend=own[0] - 1 if own[0] > NO_ID else 0))
            counts = np.diff(np.append(cuts, len(own))).astype("<u4")
            yield batch_of(
                FIRSTS,
                [[bucket], [chunk.number], [distinct[at].astype("<u8").tobytes()],
                 [own[cuts].astype("<i8").tobytes()], [counts.tobytes()]],
            )

    def earliest(rows: pa.Table) -> pa.Table:
        """One bit for each window sent: another chunk has it in a document of smaller id."""
        hashes = [np.frombuffer(x, "<u8") for x in rows.column("hashes").to_pylist()]
        ids = [
            np.repeat(np.frombuffer(x, "<i8"), np.frombuffer(n, "<u4"))
            for x, n in zip(rows.column("ids").to_pylist(), rows.column("counts").to_pylist(), strict=True)
        ]
        every, own = np.concatenate(hashes), np.concatenate(ids)
        order = np.argsort(every, kind="stable")
        new = np.flatnonzero(np.diff(every[order], prepend=every[order][0] - np.uint64(1)))
        least = np.minimum.reduceat(own[order], new)
        later = np.empty(len(every), bool)
        later[order] = own[order] > np.repeat(least, np.diff(np.append(new, len(every))))
        cuts = np.cumsum([len(x) for x in hashes])[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(later, cuts)]
        made = [rows.column("chunk").to_pylist(), rows.column("bucket").to_pylist(), [len(LEVELS)] * len(bits), bits]
        return pa.Table.from_batches([batch_of(FOUND, made)])

    sent = chunks.each_with(answers, firsts, FIRSTS)
    answers = answers.union(sent.groupBy("bucket").applyInArrow(earliest, FOUND))

    def keep(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        words = live(chunk)
        distinct, first, number = _first_places(words)
        later = np.zeros(len(distinct), bool)
        own = {r["bucket"]: r["bits"] for r in chunk.answers if r["level"] == len(LEVELS)}
        for bucket, at in _sent(words, buckets)[2]:
            later[at] = np.unpackbits(np.frombuffer(own[bucket], np.uint8), count=len(at)).astype(bool)
        covered = np.zeros(len(words.hashes) + 1, np.int64)
        if len(words.alive):
            docs = words.doc[words.alive]
            # Live windows come in order: the first of a row's equal windows is the first in the pair's run.
            pair = number * len(words.sizes) + docs
            opens = np.zeros(len(pair), bool)
            opens[np.unique(pair, return_index=True)[1]] = True
            ids = chunk.ids[docs]
            gone = words.alive[later[number] | (ids > ids[first][number]) | ~opens]
            np.add.at(covered, gone, 1)
            np.add.at(covered, gone + WINDOW, -1)
        kept = np.cumsum(covered[:-1]) == 0
        begin = 0
        texts, gone = [], []
        for text, end in zip(chunk.texts, words.ends.tolist(), strict=True):
            own = text.split()
            flags = kept[begin:end]
            gone.append(int(len(own) - flags.sum()))
            if gone[-1]:
                own = [w for w, k in zip(own, flags.tolist(), strict=True) if k]
            texts.append(b" ".join(own))
            begin = end
        yield batch_of(KEPT, [chunk.null_ids(chunk.ids), texts, words.sizes, gone])

    return chunks.each_with(answers, keep, KEPT)
