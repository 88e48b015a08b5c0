"""Token-id files: canonical, length-limited Huffman codes in independent blocks.

The files are a Parquet table of blocks, below a folder ``part=N`` for each
range of documents; folders, files and rows run in ascending document id.  A
block holds the ids of consecutive documents (at most ``BLOCK`` ids, so a long
document takes several), coded most significant bit first, and the bit offset of
every ``STRIDE``-th id, from where decoding can start.  The code is canonical:
the length of each id's code is all that a reader needs.

NULL document ids come first; NULL and empty texts hold the end id alone; rows
that repeat a document id are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import batch_of, id_and_text, schema_of, small
from .tokens import encoder

#: Longest code in bits; decoding tables have 2 ** LIMIT entries.
LIMIT = 18
BLOCK = 1 << 16
STRIDE = 128
#: Bits that hold the length of a code.
SIZE = 5
#: Blocks that are decoded side by side.
ABREAST = 8
IDS = "part int, doc_id long, start long, n int, ids binary, counts binary"
BLOCKS = (
    "part int, first long, n_ids int, doc_ids array<long>, doc_starts array<long>, at array<int>, "
    "payload binary, checkpoints binary"
)
PIECES = "doc_id long, start long, first long, n int, ids binary"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Length of each id's code, 0 where it never occurs, by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < len(leaves))
        both = both[rank]
        both = both[: len(both) // 2 * 2]
        packages = both[::2] + both[1::2]
    take, taken = 2 * (len(order) - 1), np.zeros(len(order) + 1, np.int64)
    for leaf in reversed(levels):
        n = int(leaf[:take].sum())
        taken[0] += 1
        taken[n] -= 1
        take = 2 * (take - n)
    lengths[order] = np.cumsum(taken)[:-1]
    return lengths


@dataclass(frozen=True)
class Code:
    """Canonical code: within a length codes rise with the id."""

    lengths: np.ndarray

    def codes(self) -> np.ndarray:
        order = self.order()
        lengths = self.lengths[order].astype(np.int64)
        # The k-th code is the sum of 2 ** -length of those before it.
        steps_ = np.int64(1) << (62 - lengths)
        before = np.concatenate([[0], np.cumsum(steps_)[:-1]])
        out = np.zeros(len(self.lengths), np.uint64)
        out[order] = (before >> (62 - lengths)).astype(np.uint64)
        return out

    def order(self) -> np.ndarray:
        used = np.flatnonzero(self.lengths)
        return used[np.argsort(self.lengths[used], kind="stable")]

    def entries(self) -> np.ndarray:
        """For each id its code and, in the last ``SIZE`` bits, the code's length."""
        return (self.codes() << np.uint64(SIZE) | self.lengths).astype(np.uint32)

    def table(self) -> tuple[int, np.ndarray]:
        """Longest length; for each run of that many bits the id, and in the last ``SIZE`` bits its code's length."""
        order = self.order()
        longest = int(self.lengths.max(initial=1))
        repeat = np.int64(1) << (longest - self.lengths[order].astype(np.int64))
        entries = np.repeat(order << SIZE | self.lengths[order], repeat)
        return longest, np.pad(entries, (0, (1 << longest) - len(entries)), constant_values=1).astype(np.uint32)


def pack_bits(entries: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ``Code.entries`` after each other; the bit offset of every ``STRIDE``-th."""
    mask = np.uint32((1 << SIZE) - 1)
    if len(entries) % 2:
        entries = np.append(entries, np.uint32(0))
    # Two neighbours are laid down as one code, of at most 2 * LIMIT bits.
    second = entries[1::2]
    size = second & mask
    code = (entries[::2] >> np.uint32(SIZE)).astype(np.uint64) << size.astype(np.uint64)
    code |= second >> np.uint32(SIZE)
    size += entries[::2] & mask
    ends = np.cumsum(size, dtype=np.int64)
    at = ends - size
    word, end = at >> 6, (at & 63) + size
    first = np.flatnonzero(np.diff(word, prepend=-1))
    # Shifts by 64 and more give 0, and so do negative ones, seen as unsigned.
    place = (code << (64 - end).astype(np.uint64)) | (code >> (end - 64).astype(np.uint64))
    words = np.zeros(int(ends[-1] >> 6) + 2, np.uint64)
    words[word[first]] = np.bitwise_or.reduceat(place, first)
    # Only the last code of a word can reach into the next.
    last = np.append(first[1:], len(at)) - 1
    words[word[last] + 1] |= np.where(end[last] > 64, code[last] << (128 - end[last]).astype(np.uint64), np.uint64(0))
    return words.astype(">u8").tobytes()[: int(ends[-1] + 7) // 8], at[:: STRIDE // 2]


def unpack_bits(payload: bytes, starts: np.ndarray, table: tuple[int, np.ndarray]) -> np.ndarray:
    """``STRIDE`` ids from each bit offset on, as rows; all offsets advance together."""
    longest, entries = table
    raw = np.frombuffer(payload + bytes(STRIDE * 4 + 8), np.uint8).astype(np.uint32)
    four = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.empty((STRIDE, len(starts)), np.uint32)
    at, mask, shift = starts.astype(np.uint32), np.uint32((1 << SIZE) - 1), np.uint32(32 - longest)
    for i in range(STRIDE):
        seen = four[at >> 3]
        seen <<= at & 7
        seen >>= shift
        out[i] = entries[seen]
        at += out[i] & mask
    out >>= np.uint32(SIZE)
    return np.ascontiguousarray(out.T)


# ------------------------------------------------------------------ jobs


def token_ids(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """Ids of each document in ascending document id, of two or four bytes each; ``start`` counts within ``part``.

    Each part's last row is no document: it has how often each id occurs in the
    part, as little-endian 64-bit integers in ``counts``.  Ranges are cut by document id and then by text, so that equal ids spread too.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, total = encoder(tokenizer), TaskContext.get().partitionId(), 0
        counts = np.zeros(0, np.int64)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in small(batches):
            n = batch.num_rows
            texts = [t.decode() for t in batch.column("text").to_pylist()]
            ids = [np.concatenate([x, end]) for x in enc.encode(texts)]
            sizes = np.fromiter(map(len, ids), np.int64, n)
            starts = total + np.cumsum(sizes) - sizes
            total += int(sizes.sum())
            found = np.bincount(np.concatenate(ids))
            counts = np.pad(counts, (0, max(0, len(found) - len(counts))))
            counts[: len(found)] += found
            # Two bytes for an id where all of the batch fit.
            made = [x.astype(np.uint16 if len(found) <= 1 << 16 else np.uint32).tobytes() for x in ids]
            yield batch_of(IDS, [[part] * n, batch.column("doc_id").to_pylist(), starts, sizes, made, [None] * n])
        if total:
            yield batch_of(IDS, [[part], [None], [total], [0], [None], [counts.tobytes()]])

    rows = id_and_text(docs).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return rows.select("doc_id", "text").mapInArrow(encode, IDS)


def id_counts(ids: DataFrame) -> DataFrame:
    """How often each id occurs, from the parts' own counts: columns id, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                found = np.frombuffer(cell.as_buffer(), np.int64)
                total = np.pad(total, (0, max(0, len(found) - len(total))))
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield batch_of("id long, n long", [used, total[used]])

    parts = ids.where("counts IS NOT NULL").select("counts")
    return parts.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def encode_blocks(ids: DataFrame, lengths: np.ndarray, bases: dict[int, int]) -> DataFrame:
    """Blocks of coded ids; ``bases`` gives the ids before each part."""
    code = Code(lengths)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = code.entries()
        held: list[tuple] = []  # part, doc_id, start of document, ids, first id
        count = 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate([x[3] for x in held])
            at = np.cumsum([0, *(len(x[3]) for x in held[:-1])])
            payload, offsets = pack_bits(entries[ids])
            row = [held[0][0], held[0][4], len(ids), [x[1] for x in held], [x[2] for x in held], at, payload]
            return batch_of(BLOCKS, [[x] for x in [*row, offsets.astype(np.uint32).tobytes()]])

        for batch in batches:
            for part, key, start, n, cell in zip(
                *(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True
            ):
                raw = cell.as_buffer()
                own = np.frombuffer(raw, np.uint16 if raw.size == 2 * n else np.uint32)
                start += bases[part]
                end = held[-1][4] + len(held[-1][3]) if held else start
                if held and (held[0][0] != part or end != start or count + len(own) > BLOCK):
                    yield block()
                    held, count = [], 0
                for a in range(0, len(own), BLOCK):
                    if count + len(own[a : a + BLOCK]) > BLOCK:
                        yield block()
                        held, count = [], 0
                    # A copy: the batch's memory may go before the block is full.
                    held.append((part, key, start, own[a : a + BLOCK].copy(), start + a))
                    count += len(held[-1][3])
        if held:
            yield block()

    return ids.where("counts IS NULL").select("part", "doc_id", "start", "n", "ids").mapInArrow(encode, BLOCKS)


_tables: dict[bytes, tuple[int, np.ndarray]] = {}


def decode_blocks(blocks: DataFrame, lengths: np.ndarray) -> DataFrame:
    """Pieces of documents with their ids, as little-endian unsigned 32-bit integers.

    Columns doc_id, start (ids of all documents before), first (of the piece),
    n, ids.  Any subset of the blocks can be decoded.
    """
    key = lengths.tobytes()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _tables:
            _tables.clear()
            _tables[key] = Code(lengths).table()
        for batch in batches:
            for low in range(0, batch.num_rows, ABREAST):
                some = batch.slice(low, ABREAST)
                payloads = some.column("payload").to_pylist()
                marks = [np.frombuffer(x, np.uint32) for x in some.column("checkpoints").to_pylist()]
                begin = np.cumsum([0, *map(len, payloads)])
                lanes = np.concatenate([m + (b << 3) for m, b in zip(marks, begin[:-1], strict=True)])
                ids = unpack_bits(b"".join(payloads), lanes, _tables[key])
                rows = np.cumsum([0, *map(len, marks)])
                for k, row in enumerate(some.drop_columns(["payload", "checkpoints"]).to_pylist()):
                    own = ids[rows[k] : rows[k + 1]].reshape(-1)[: row["n_ids"]]
                    bounds = [*row["at"], len(own)]
                    yield batch_of(
                        PIECES,
                        [row["doc_ids"], row["doc_starts"], [row["first"] + a for a in row["at"]], np.diff(bounds),
                         [own[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]],
                    )

    return blocks.select(*(f.name for f in schema_of(BLOCKS))).mapInArrow(decode, PIECES)


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = 0) -> None:
    """Encode whole texts and write ``folder``/blocks and ``folder``/lengths.

    With no document at all there are no blocks.
    """
    spark = docs.sparkSession
    work = shared_folder(spark, "token-ids")
    token_ids(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(work)
    ids = spark.read.parquet(work)
    # One row for each id of the vocabulary, one for each range of documents.
    counted = id_counts(ids).toPandas()
    totals = ids.where("counts IS NOT NULL").select("part", "start").orderBy("part").collect()
    bases, total = {}, 0
    for part, n in totals:
        bases[part] = total
        total += n
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"]
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    table = spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id long, length int")
    table.coalesce(1).write.parquet(f"{folder}/lengths")
    encode_blocks(ids, lengths, bases).write.partitionBy("part").option("compression", "uncompressed").parquet(
        f"{folder}/blocks"
    )


def read_ids(spark, folder: str) -> DataFrame:
    """The pieces of ``write_ids``' files, see ``decode_blocks``."""
    found = spark.read.parquet(f"{folder}/lengths").toPandas()
    lengths = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, np.uint8)
    lengths[found["id"].to_numpy(np.int64)] = found["length"]
    blocks = spark.read.schema(BLOCKS).option("basePath", f"{folder}/blocks").parquet(f"{folder}/blocks")
    return decode_blocks(blocks, lengths)
