"""Helpers shared by the operators: tables, text batches, hashes, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder

#: Bytes of text that one numpy step handles; working arrays take some 40 times as much.
STEP_BYTES = 1 << 20
#: Bytes of text that one chunk of documents holds, unless a document is longer.
CHUNK_BYTES = 6 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, whatever else the table holds.

    The text comes as UTF-8 bytes, NULL as no bytes.
    """
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def steps(texts: list[bytes], most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``most`` bytes each."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def small(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``most`` bytes of a binary column: Python objects of few rows at a time."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes + 1)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(int(np.searchsorted(ends, before + most)), start + 1)
            yield batch.slice(start, end - start)
            start = end


def batch_of(schema: T.StructType | str, columns: list) -> pa.RecordBatch:
    """A record batch of Spark's schema from lists or arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema_of(schema), strict=True)],
        schema=schema_of(schema),
    )


_SCHEMAS: dict[str, pa.Schema] = {}

_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def schema_of(ddl: str) -> pa.Schema:
    """Arrow's form of a flat schema such as ``doc_id long, text string``."""
    if ddl not in _SCHEMAS:
        fields = [f.split(None, 1) for f in ddl.split(",")]
        _SCHEMAS[ddl] = pa.schema([(name, _TYPES[kind.strip()]) for name, kind in fields])
    return _SCHEMAS[ddl]


_KEPT: dict[str, dict] = {}


def trim() -> None:
    """Return freed memory to the system; the C library keeps freed blocks for later until it is told to."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def kept(operator: str) -> dict:
    """What an operator keeps in a worker process from task to task; what others kept there is let go first.

    Workers serve one stage after the other: without this they would hold the
    memory of all operators they have ever run.
    """
    if operator not in _KEPT:
        _KEPT.clear()
        _powers.clear()
        gc.collect()
        trim()
        _KEPT[operator] = {}
    return _KEPT[operator]


# ---------------------------------------------------------------- hashes

_MASK = (1 << 64) - 1
#: White space as the word patterns of these operators see it: space, \t to \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over each other (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240521).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** n`` modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, STEP_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[: n + 1]


def word_hashes(
    blob: np.ndarray, lower: bool, between: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each word of a byte array; ``between`` marks the bytes of no word."""
    inside = np.zeros(len(blob) + 2, np.int8)
    inside[1:-1] = ~between[blob]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(blob) + 1, np.uint64)
    np.cumsum(_VALUES[lower][blob] * powers(_ODD, len(blob))[:-1], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers(_INVERSE, len(blob))[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64))


def windows_hash(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive hashes."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = np.random.default_rng(length).integers(1, 1 << 63, length, dtype=np.uint64) | np.uint64(1)
    total = np.zeros(n, np.uint64)
    for i in range(length):
        total += hashes[i : i + n] * factors[i]
    return mix(total)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one byte array, each followed by a line end; where each starts."""
    blob = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return blob, np.concatenate([[0], np.cumsum(sizes)])


def lowest_places(values: np.ndarray, run: int) -> np.ndarray:
    """Place of the smallest of each ``run`` consecutive values, the first of equal ones, by doubling."""
    if len(values) < run:
        return np.zeros(0, np.int32)
    low, place, width = values, np.arange(len(values), dtype=np.int32), 1
    while width < run:
        shift = min(width, run - width)
        later = low[shift:] < low[:-shift]
        place = np.where(later, place[shift:], place[:-shift])
        low = np.minimum(low[shift:], low[:-shift])
        width += shift
    return place


# ------------------------------------------------------------ components


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Smallest node reachable from each node: columns node, component.

    ``edges`` has the long columns a, b.  Alternates large and small stars: each
    node hands its larger neighbours, then its smaller ones, to the smallest
    node it knows, until nothing changes.  The rounds grow with the logarithm of
    the longest path; each is written to the shared folder.  NULLs and loops are
    dropped.  Nodes without an edge are not returned.
    """
    spark = edges.sparkSession

    def arcs(df: DataFrame) -> DataFrame:
        return (
            df.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct()
        )

    have = stored(arcs(edges), purpose)
    seen = None
    while True:
        both = have.union(have.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        # Large star: neighbours above u go to the smallest node u knows.
        large = arcs(
            both.join(low, both["a"] == low["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small_low = small_low.select(F.col("a").alias("u"), "m")
        # Small star: neighbours below u go to the smallest of them, and u too.
        small = large.join(small_low, large["a"] == small_low["u"]).select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")
        )
        have = stored(arcs(small.select("e.a", "e.b")), purpose)
        state = have.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    del spark
    nodes = have.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = have.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return nodes.union(roots)


# ------------------------------------------------------------- whole rows


def map_rows(docs: DataFrame, work, made: T.StructType, text: str = "text", keep: bool = True) -> DataFrame:
    """Run ``work`` over Arrow batches of two columns: ``row`` (all of ``docs``), ``text`` (UTF-8, NULL as none).

    ``work`` yields batches of ``row`` and the columns ``made``.  The table's
    own columns stay apart in ``row``, so no name can clash.  The text travels once:
    within ``row``, from which it is read, and back only if ``keep`` asks for it.
    """
    at = docs.columns.index(text)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    back = whole if keep else F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def apart() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row = batch.column("row")
                fields = row.flatten()
                raw = fields[at].cast(pa.string()).cast(pa.binary()).fill_null(b"")
                if not keep:
                    names = [f.name for f in row.type]
                    others = [k for k in range(len(names)) if k != at]
                    row = pa.StructArray.from_arrays([fields[k] for k in others], names=[names[k] for k in others])
                yield pa.RecordBatch.from_arrays([row, raw], names=["row", "text"])

        return work(apart())

    schema = docs.select(back.alias("row")).schema["row"]
    return docs.select(whole.alias("row")).mapInArrow(run, T.StructType([schema, *made.fields]))


def with_text(rows: DataFrame, columns: list[str], text: str, new) -> DataFrame:
    """The columns of ``row`` with another text; ``n_chars``, if there is one, follows it."""
    made = {text: new, "n_chars": F.char_length(new).cast("long")}
    return rows.select(*[(made[c] if c in made else F.col(f"row.`{c}`")).alias(c) for c in columns])
