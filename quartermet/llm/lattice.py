"""Near-duplicate embeddings by lattice hashing.

In each of ``TABLES`` tables a random projection takes a unit vector to eight
dimensions, where it is decoded to the nearest point of the E8 lattice and, for
probing, to the nearest point of E8's other half (E8 is D8 and D8 shifted by one
half).  A vector is filed under both cells, so it meets the vectors of its own and
of neighbouring cells; the cosine of all that meet is computed in double
precision.  Equal vectors are one class and compared once.  A pair that meets in
several cells counts in the first.  The classes of a cell of more than ``CELL`` are
dealt by chance into blocks, and each pair of blocks is a task group of its own: no
task holds more than two blocks, at the cost of a row for each class and block.

With ``SCALE`` 1 and 20 tables a pair at cosine 0.95 meets with probability 0.999
(any dimension: the projection only sees the distance); unrelated vectors share a
cell with 0.0001.  For tables of many millions lower ``scale`` and add tables.

Vectors that are NULL, zero, or hold NULL or non-finite components link with
nothing; so do vectors of different lengths.  Rows that repeat an id are vectors
of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, components, mix, stored

TABLES, SCALE = 20, 1.0
#: Most classes of a cell that are compared in one piece, and about the most of two blocks.
CELL = 4096
PART = ["cell", "x", "y"]
SIMILAR = 0.95
PARSED = "uid long, vec_id long, k binary, vec binary"
FILED = "rep long, cells binary"
LINKS = "a long, b long, n long"


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    point = np.rint(x)
    error = x - point
    odd = np.flatnonzero(point.sum(1).astype(np.int64) & 1)
    worst = np.abs(error[odd]).argmax(1)
    point[odd, worst] += np.where(error[odd, worst] >= 0, 1.0, -1.0)
    return point


def decode_e8(x: np.ndarray) -> np.ndarray:
    """For each row its nearest point of either half of E8, doubled to whole numbers: (rows, 2, 8)."""
    return np.stack([nearest_d8(x) * 2, (nearest_d8(x - 0.5) + 0.5) * 2], 1).astype(np.int64)


def cells(unit: np.ndarray, tables: int, scale: float) -> np.ndarray:
    """The hashed cells of each vector, two for each table."""
    out = np.empty((len(unit), tables, 2), np.uint64)
    for t in range(tables):
        rng = np.random.default_rng([unit.shape[1], t])
        projection = rng.normal(size=(unit.shape[1], 8)) / scale
        points = decode_e8(unit @ projection + rng.uniform(0, 2, 8))
        key = np.full(points.shape[:2], t + 1, np.uint64)
        for i in range(8):
            key = mix(key + points[:, :, i].astype(np.uint64))
        out[:, t] = key
    return out.reshape(len(unit), -1)


def parsed(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Columns uid, vec_id, k (None if the vector links with nothing), vec (doubles).

    ``uid`` follows the partitions: write the result before it is used twice.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            raw: list[bytes | None] = []
            for cell in batch.column(1).to_pylist():
                own = None if not cell or None in cell else np.array(cell, np.float64)
                fit = own is not None and np.isfinite(own).all() and own.any()
                # -0.0 and 0.0 are one number.
                raw.append((own + 0.0).tobytes() if fit else None)
            keys = [None if x is None else hashlib.md5(x).digest() for x in raw]
            yield batch_of(PARSED, [np.arange(uid, uid + len(raw)), batch.column(0).to_pylist(), keys, raw])
            uid += len(raw)

    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e")
    )
    return rows.mapInArrow(parse, PARSED)


def norm(x: np.ndarray) -> np.ndarray:
    """Lengths of rows; scaled first, so that no square overflows or vanishes."""
    most = np.abs(x).max(1)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(1))


def filed(found: DataFrame, tables: int, scale: float) -> DataFrame:
    """Columns rep, cells (unsigned 64-bit integers)."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep = batch.column(0).to_numpy()
            raw = batch.column(1).to_pylist()
            sizes = np.array([len(x) for x in raw])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                vec = np.frombuffer(b"".join(raw[i] for i in at)).reshape(len(at), -1)
                unit = vec / norm(vec)[:, None]
                own = cells(unit, tables, scale)
                yield batch_of(FILED, [rep[at], [x.tobytes() for x in own]])

    return found.select("rep", "vec").mapInArrow(file, FILED)


def _one_cell(rows: pa.Table, similar: float) -> pa.RecordBatch | None:
    """Links of a cell or of two of its blocks: each class with its root there and how many vectors it links.

    Links that a cell before counts are left out of the number.
    """
    key = np.uint64(rows.column("cell")[0].as_py() & (1 << 64) - 1)
    order = np.argsort(rows.column("rep").to_numpy())
    reps, copies = rows.column("rep").to_numpy()[order], rows.column("copies").to_numpy()[order]
    side = rows.column("block").to_numpy()[order]
    # The classes of two blocks meet their own kind where a block meets itself.
    across = rows.column("x")[0].as_py() != rows.column("y")[0].as_py()
    raw, own = (rows.column(c).to_pylist() for c in ("vec", "cells"))
    vec = np.frombuffer(b"".join(raw[i] for i in order)).reshape(len(reps), -1)
    filed_in = np.frombuffer(b"".join(own[i] for i in order), np.uint64).reshape(len(reps), -1)
    unit = vec / norm(vec)[:, None]
    here = int(np.flatnonzero((filed_in == key).any(0))[0]) // 2  # the table of this cell
    counted = np.zeros(len(reps), np.int64)
    root = np.arange(len(reps))
    block = max(1, (1 << 21) // len(reps))
    for a in range(0, len(reps), block):
        i, j = np.nonzero(unit[a : a + block] @ unit.T >= similar)
        i += a
        new = (i < j) & (side[i] != side[j]) if across else i < j
        i, j = i[new], j[new]
        met = np.zeros(len(i), bool)
        for t in range(here):
            one, two = filed_in[i, 2 * t : 2 * t + 2], filed_in[j, 2 * t : 2 * t + 2]
            met |= (one[:, :, None] == two[:, None, :]).any((1, 2))
        # Two classes may share both cells of a table: the smaller cell counts.
        one, two = filed_in[i, 2 * here : 2 * here + 2], filed_in[j, 2 * here : 2 * here + 2]
        shared = np.where((one[:, :, None] == two[:, None, :]).any(2), one, np.uint64(2**64 - 1))
        met |= shared.min(1) != key
        np.add.at(counted, i[~met], copies[j[~met]])
        np.add.at(counted, j[~met], copies[i[~met]])
        # Pairs that are joined already bring nothing.
        while (root[root] != root).any():
            root = root[root]
        edges = np.unique(np.stack([root[i], root[j]], 1)[root[i] != root[j]], axis=0)
        for x, y in edges.tolist():
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            while root[y] != y:
                root[y] = root[root[y]]
                y = root[y]
            root[max(x, y)] = min(x, y)
    while (root[root] != root).any():
        root = root[root]
    live = np.flatnonzero((counted > 0) | (root != np.arange(len(root))))
    return batch_of(LINKS, [reps[live], reps[root[live]], counted[live]]) if len(live) else None


def links_by_cell(rows: DataFrame, similar: float) -> DataFrame:
    """Columns a, b (an edge to the root of its part), n; of rows cell, c (its classes), rep, copies, vec, cells."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last: list[int] = []

        def done() -> Iterator[pa.RecordBatch]:
            if sum(x.num_rows for x in held) > 1:
                whole = pa.Table.from_batches(held)
                sizes = np.array([len(x) for x in whole.column("vec").to_pylist()])
                for size in np.unique(sizes):
                    some = whole.filter(pa.array(sizes == size))
                    if some.num_rows > 1 and (made := _one_cell(some, similar)):
                        yield made

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in PART], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b and last != keys[a].tolist():
                    yield from done()
                    held, last = [], keys[a].tolist()
                held.append(batch.slice(a, b - a))
        yield from done()

    blocks = F.when(F.col("c") > CELL, F.ceil(F.col("c") * 2 / CELL)).otherwise(1)
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep", "cell"), "blocks"))
    met = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.withColumn("met", met).select(
        "cell", F.least("block", "met").alias("x"), F.greatest("block", "met").alias("y"), "block",
        "rep", "copies", "vec", "cells",
    )
    return rows.repartition(*PART).sortWithinPartitions(*PART).mapInArrow(compare, LINKS)


def near_vectors(
    vectors: DataFrame, similar: float = SIMILAR, tables: int = TABLES, scale: float = SCALE
) -> DataFrame:
    """Each vector with n_links (others linked directly) and component_id (smallest id reachable)."""
    rows = stored(parsed(vectors), "vectors")
    found = stored(
        rows.where("k IS NOT NULL").groupBy("k").agg(
            F.min("uid").alias("rep"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"),
            F.any_value("vec").alias("vec"),
        ),
        "vector-classes",
    )
    own = stored(filed(found, tables, scale), "cells")
    cell = _unpacked(own)
    shared = cell.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    met = cell.join(shared, "cell")
    rest = found.select("rep", "copies", "vec").join(own, "rep")
    links = stored(links_by_cell(met.join(rest, "rep"), similar), "vector-links")
    named = found.select("k", "rep", "least", "copies")
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    named = named.join(counts, "rep", "left")
    joins = components(links.select("a", "b"), "vector-components")
    named = named.join(joins, named["rep"] == joins["node"], "left").withColumn("root", F.coalesce("component", "rep"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(
        "k", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return rows.select("vec_id", "k").join(named, "k", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _unpacked(own: DataFrame) -> DataFrame:
    """A row rep, cell for each cell of a vector."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            found = np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), -1)
            yield batch_of("rep long, cell long", [np.repeat(batch.column(0).to_numpy(), found.shape[1]), found.reshape(-1)])

    return own.mapInArrow(unpack, "rep long, cell long")
