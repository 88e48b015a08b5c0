"""Packing of documents into sequences by best fit and a swap-based local search.

A document's ids are cut only if they are longer than a sequence; then the first
piece takes the rest and may be shorter.  Pieces of full length are sequences of
their own.  The others are dealt into groups of bounded size by a hash; in each
group best-fit decreasing fills bins, and a local search then moves pieces,
exchanges one for one, or two for one between underfull bins whenever the sum of
squared fills rises, so that the emptiest bins run empty.  Bins that stay far
from full are opened again and packed with those of other groups, in fewer
groups each round, until one group holds them all or a round saves nothing.

NULL and empty texts hold the end id alone; repeated rows are packed like any
others; a table without rows gives none.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, small, stored
from .tokens import encoder

LENGTH = 1024
#: Pieces that one task packs at once.
GROUP = 60_000
#: Bins filled less than this are opened again in the next round.
REOPEN = 0.97
PIECES = "uid long, doc_id long, piece int, start long, length int, ids binary"
PLACES = "uid long, bin long, offset int, fill int"


def pieces(docs: DataFrame, tokenizer: str, end_id: int | None, length: int = LENGTH) -> DataFrame:
    """Pieces of at most ``length`` ids with a number of their own, ``uid``.

    Ids are little-endian unsigned 32-bit integers.  The numbers follow the
    partitions: write the result before it is used twice.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, uid = encoder(tokenizer), TaskContext.get().partitionId() << 36
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in small(batches, most=2 << 20):
            keys = batch.column("doc_id").to_pylist()
            texts = [t.decode() for t in batch.column("text").to_pylist()]
            rows: list[tuple] = []
            for key, ids in zip(keys, enc.encode(texts), strict=True):
                ids = np.concatenate([ids, end])
                first = (len(ids) - 1) % length + 1 if len(ids) else 0
                bounds = [0, *range(first, len(ids) + 1, length)] if len(ids) else [0, 0]
                for k, (x, y) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    rows.append((uid, key, k, x, y - x, ids[x:y].tobytes()))
                    uid += 1
            yield batch_of(PIECES, list(zip(*rows, strict=True)))

    return id_and_text(docs).mapInArrow(cut, PIECES)


class Bins:
    """Bins of one group; sizes are at most ``length``."""

    def __init__(self, sizes: list[int], length: int):
        self.sizes, self.length = sizes, length
        self.items: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Largest first, each into the bin that it fills best."""
        room: dict[int, list[int]] = defaultdict(list)
        present = 0  # bit r: there is a bin with room r
        for i in np.argsort(-np.array(self.sizes), kind="stable").tolist():
            size = self.sizes[i]
            fits = present >> size
            if fits:
                left = size + (fits & -fits).bit_length() - 1
                b = room[left].pop()
                if not room[left]:
                    present &= ~(1 << left)
                self.items[b].append(i)
            else:
                left, b = self.length, len(self.items)
                self.items.append([i])
                self.fill.append(0)
            self.fill[b] += size
            if left > size:
                room[left - size].append(b)
                present |= 1 << (left - size)

    def search(self, passes: int = 30) -> None:
        """Improve underfull bins until a pass changes none, ``passes`` at most."""
        for _ in range(passes):
            if not self.improve():
                return

    def improve(self) -> int:
        where: dict[int, int] = {}
        pool: dict[int, list[int]] = defaultdict(list)  # size -> pieces, those of the emptiest bins last
        under = sorted((b for b, f in enumerate(self.fill) if 0 < f < self.length), key=self.fill.__getitem__)
        for b in reversed(under):
            for i in self.items[b]:
                where[i] = b
                pool[self.sizes[i]].append(i)
        present = 0
        for size in pool:
            present |= 1 << size
        changed = 0

        def take(size: int, into: int, gain: int) -> int | None:
            """A piece of that size from a bin which, less ``gain``, ends below the other's new fill."""
            for i in reversed(pool[size][-8:]):
                b = where[i]
                if b != into and self.fill[b] < self.fill[into] + gain:
                    return i
            return None

        def move(i: int, to: int) -> None:
            b, size = where[i], self.sizes[i]
            self.items[b].remove(i)
            self.items[to].append(i)
            self.fill[b] -= size
            self.fill[to] += size
            where[i] = to

        for a in reversed(under):
            room = self.length - self.fill[a]
            if not room or not self.fill[a]:
                continue
            done = False
            # A move: the largest piece that fits.
            fits = present & ((1 << (room + 1)) - 1)
            if fits:
                i = take(fits.bit_length() - 1, a, fits.bit_length() - 1)
                if i is not None:
                    move(i, a)
                    changed += 1
                    continue
            for x in sorted(self.items[a], key=self.sizes.__getitem__):
                own = self.sizes[x]
                # One for one: the largest piece that fits in place of x.
                fits = present & ((1 << (own + room + 1)) - 1)
                size = fits.bit_length() - 1
                if size > own:
                    y = take(size, a, size - own)
                    if y is not None:
                        b = where[y]
                        move(y, a)
                        move(x, b)
                        done = True
                        break
                # Two for one: two pieces of one bin that fill this one to the brim.
                want = own + room
                for size in (want // 2, want // 3, want - 1, want - 2, want - 3, want - 5, want - 8):
                    if 0 < size < want and present >> size & 1 and present >> (want - size) & 1:
                        y = take(size, a, room)
                        if y is None:
                            continue
                        b = where[y]
                        z = next((z for z in self.items[b] if z != y and self.sizes[z] == want - size), None)
                        if z is not None:
                            move(y, a)
                            move(z, a)
                            move(x, b)
                            done = True
                            break
                if done:
                    break
            changed += done
        return changed


def pack_group(sizes: list[int], length: int) -> list[list[int]]:
    """Positions of ``sizes`` by bin."""
    bins = Bins(sizes, length)
    bins.best_fit()
    bins.search()
    return [x for x in bins.items if x]


def pack(items: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Place pieces (columns uid, length) into bins: columns uid, bin, offset.

    ``items`` should be a written table, it is read twice.
    """
    whole = items.where(F.col("length") >= length).select(
        "uid", F.col("uid").alias("bin"), F.lit(0).alias("offset")
    )
    rest = items.where(F.col("length") < length).select("uid", F.col("length").cast("int").alias("length"))
    count = rest.count()
    placed = [whole]
    while count:
        groups = -(-count // group)

        def place(rows: pa.Table) -> pa.Table:
            uids, sizes = rows.column("uid").to_numpy(), rows.column("length").to_numpy()
            order = np.argsort(uids, kind="stable")
            uids, sizes = uids[order], sizes[order]
            out: list[tuple] = []
            for members in pack_group(sizes.tolist(), length):
                at, fill = 0, int(sizes[members].sum())
                for i in members:
                    out.append((uids[i], uids[members[0]], at, fill))
                    at += int(sizes[i])
            return pa.Table.from_batches([batch_of(PLACES, list(zip(*out, strict=True)))])

        keyed = rest.withColumn("g", F.pmod(F.xxhash64("uid", F.lit(count)), F.lit(groups)))
        done = stored(keyed.groupBy("g").applyInArrow(place, PLACES), "packing")
        worst = F.col("fill") < int(REOPEN * length)
        open_bins = done.where(worst)
        again = open_bins.select("uid").count() if groups > 1 else 0
        if again in (0, count):
            placed.append(done.select("uid", "bin", "offset"))
            break
        placed.append(done.where(~worst).select("uid", "bin", "offset"))
        rest = stored(open_bins.select("uid").join(rest, "uid"), "packing")
        count = again
    out = placed[0]
    for more in placed[1:]:
        out = out.union(more)
    return out
