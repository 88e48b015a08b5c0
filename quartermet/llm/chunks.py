"""Documents in chunks, and the question which hashes several chunks hold.

A chunk is a set of whole documents of some megabytes, told by a hash of id and
text.  All passes over chunks read one shuffle of the texts (Spark reuses an
exchange within a plan), and exchange compact blobs: a chunk sends each bucket
its distinct hashes, the bucket answers with one bit for each.  So a hash that a
third of all documents hold costs one entry for each chunk, whatever its count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, batch_of, id_and_text

#: Entries that one bucket receives at most, about.
BUCKET_ROWS = 3_000_000
ASKED = "bucket long, chunk long, level int, hashes binary"
ANSWERS = "chunk long, bucket long, level int, bits binary"
#: Stands for a NULL document id: before all others.
NO_ID = -(1 << 63)


class Chunks:
    """The chunks of a table; ``rows`` has the columns chunk, doc_id, text (UTF-8)."""

    def __init__(self, docs: DataFrame):
        rows = id_and_text(docs)
        self.bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.count = -(-self.bytes // CHUNK_BYTES) or 1
        chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(self.count)).alias("chunk")
        self.rows = rows.select(chunk, "doc_id", "text")

    def buckets(self, per_byte: float) -> int:
        """Buckets for so many entries for each byte of text."""
        return int(self.bytes * per_byte) // BUCKET_ROWS + 1

    def each(self, work: Callable[[Chunk], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        def run(rows: pa.Table) -> pa.Table:
            return table_of(work(Chunk(rows, [])), schema)

        return self.rows.groupBy("chunk").applyInArrow(run, schema)

    def each_with(
        self, answers: DataFrame, work: Callable[[Chunk], Iterator[pa.RecordBatch]], schema: str
    ) -> DataFrame:
        """Like ``each``; the chunk also has its rows of ``answers`` (column chunk)."""

        def run(rows: pa.Table, own: pa.Table) -> pa.Table:
            return table_of(work(Chunk(rows, own.to_pylist())), schema)

        return self.rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def table_of(batches: Iterator[pa.RecordBatch], schema: str) -> pa.Table:
    from .common import schema_of

    return pa.Table.from_batches(list(batches), schema=schema_of(schema))


class Chunk:
    """Documents of one chunk, ordered by id (NULL first), then text."""

    def __init__(self, rows: pa.Table, answers: list[dict]):
        ids = [NO_ID if x is None else x for x in rows.column("doc_id").to_pylist()]
        texts = rows.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]
        self.number = rows.column("chunk")[0].as_py() if len(ids) else None
        self.answers = answers

    def null_ids(self, ids: np.ndarray) -> list[int | None]:
        return [None if x == NO_ID else x for x in ids.tolist()]

    def bits(self, level: int, buckets: np.ndarray) -> np.ndarray:
        """The answers to the entries sent at a level, in their order; ``buckets`` says where each went."""
        out = np.zeros(len(buckets), bool)
        order = np.argsort(buckets, kind="stable")
        bounds = np.searchsorted(buckets[order], np.unique(buckets), side="left")
        at = dict(zip(np.unique(buckets).tolist(), bounds.tolist(), strict=True))
        for row in self.answers:
            if row["level"] == level:
                first = at[row["bucket"]]
                end = np.searchsorted(buckets[order], row["bucket"], side="right")
                found = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=end - first)
                out[order[first:end]] = found.astype(bool)
        return out


def by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its entries, in their order."""
    if not len(buckets):
        return
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, cuts):
        yield int(buckets[part[0]]), part


def ask(chunk: Chunk, hashes: np.ndarray, level: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Send distinct, sorted hashes (64 bits) to their buckets, 32 bits of each."""
    short = (hashes >> np.uint64(32)).astype("<u4")
    parts = list(by_bucket(bucket_of(hashes, buckets)))
    if parts:
        yield batch_of(
            ASKED,
            [[b for b, _ in parts], [chunk.number] * len(parts), [level] * len(parts),
             [short[at].tobytes() for _, at in parts]],
        )


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)


def answer(asked: DataFrame) -> DataFrame:
    """For each entry, whether another chunk sent the same one (up to 32 bits within a bucket: rarely too often)."""

    def run(rows: pa.Table) -> pa.Table:
        blobs = rows.column("hashes").to_pylist()
        every = np.concatenate([np.frombuffer(b, "<u4") for b in blobs])
        ordered = np.sort(every)
        several = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        bits = []
        for blob in blobs:
            own = np.frombuffer(blob, "<u4")
            if len(several):
                at = np.minimum(np.searchsorted(several, own), len(several) - 1)
                bits.append(np.packbits(several[at] == own).tobytes())
            else:
                bits.append(np.packbits(np.zeros(len(own), bool)).tobytes())
        made = [rows.column("chunk").to_pylist(), rows.column("bucket").to_pylist(), rows.column("level").to_pylist(), bits]
        return pa.Table.from_batches([batch_of(ANSWERS, made)])

    return asked.groupBy("bucket").applyInArrow(run, ANSWERS)
