"""Parquet tables of many small partitions, written and read by tasks through Arrow.

Spark's own writer and reader spend several milliseconds on a file, and its driver
lists and holds all of them.  Here tasks write the files of their partitions and put
them in place, and tasks list folders and open what they find.  The layout is
Spark's (``column=value`` folders), so its reader finds the same rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import opened

#: Rows that a task holds of one file before it writes, or of some files before it passes them on.
CHUNK_ROWS = 65_536

#: A file of fewer rows is written for size, without dictionaries and statistics: hours of a station
#: and year take 3.5 KB instead of 6, so most stay within one block of a disk.
FEW_ROWS = 4_096

#: Folder value of NULL and of empty strings, as Spark has it.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

_WHOLE = (pa.int8(), pa.int16(), pa.int32(), pa.int64(), pa.date32())
_ESCAPED = re.compile(r"""["#%'*/:=?\\\x7f{\[\]^\x01-\x1f]""")

#: Types of partition columns.
_KEYS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)

#: Types of other columns.
_CELLS = (*_KEYS, T.BooleanType, T.FloatType, T.DoubleType, T.DecimalType, T.BinaryType, T.TimestampType, T.TimestampNTZType)


def within_reach(path: str, schema: T.StructType, partition_by: Sequence[str]) -> bool:
    """Whether Arrow knows the store and the types; others are left to Spark's writer and reader."""
    if "%" in path:  # a sign of its own in Arrow's addresses, not in Hadoop's
        return False
    try:
        opened(path)
    except (pa.ArrowException, OSError):
        return False
    # A table needs a column besides those of its folders.
    known = all(isinstance(f.dataType, _KEYS if f.name in partition_by else _CELLS) for f in schema)
    return known and any(f.name not in partition_by for f in schema)


def _escaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", text)


def folder(partition_by: Sequence[str], values: Sequence[object]) -> str:
    """Folder of a partition below its table."""
    cells = ["" if v is None else _escaped(str(v)) for v in values]
    return "/".join(f"{_escaped(c)}={v or NO_VALUE}" for c, v in zip(partition_by, cells, strict=True))


def partition_values(file: str, partition_by: Sequence[str]) -> list[str | None]:
    """Values in the folders of a file, in the order of the columns."""
    found = dict(map(unquote, part.split("=", 1)) for part in file.split("/")[:-1] if "=" in part)
    absent = [c for c in partition_by if c not in found]
    if absent:
        raise ValueError(f"{file!r} has no folder for {absent}")
    return [None if found[c] == NO_VALUE else found[c] for c in partition_by]


class _Files:
    """Files of one task, a partition after the other."""

    def __init__(self, store: fs.FileSystem, root: str, name: str, footer: dict[str, str], most: int) -> None:
        self.store, self.root, self.name, self.footer, self.most = store, root, name, footer, most
        self.held: list[pa.RecordBatch] = []
        self.held_rows = self.rows = self.files = self.bytes = 0
        self.writer: pq.ParquetWriter | None = None

    def add(self, where: str, batch: pa.RecordBatch) -> None:
        """Add rows to the open file, which must be closed before another folder's."""
        while batch.num_rows:
            some = batch.slice(0, self.most - self.rows)
            batch = batch.slice(some.num_rows)
            self.where = where
            self.held.append(some)
            self.held_rows += some.num_rows
            self.rows += some.num_rows
            if self.rows == self.most:
                self.close()
            elif self.held_rows >= CHUNK_ROWS:
                self._write()

    def _write(self) -> None:
        schema = self.held[0].schema
        if self.writer is None:
            folder = f"{self.root}/{self.where}"
            self.store.create_dir(folder, recursive=True)
            # Readers skip names that start with an underscore.
            self.draft = f"{folder}/_{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.draft)
            options = {}
            if self.held_rows < FEW_ROWS:
                whole = [f.name for f in schema if f.type in _WHOLE or pa.types.is_timestamp(f.type)]
                packed = dict.fromkeys(whole, "DELTA_BINARY_PACKED")
                options = {"use_dictionary": False, "write_statistics": False, "column_encoding": packed or None}
            self.writer = pq.ParquetWriter(self.out, schema, compression="snappy", store_schema=False, **options)
        self.writer.write_table(pa.Table.from_batches(self.held, schema))
        self.held, self.held_rows = [], 0

    def close(self) -> None:
        if not self.rows:
            return
        if self.held:
            self._write()
        self.writer.add_key_value_metadata(self.footer)
        self.writer.close()
        self.bytes += self.out.tell()
        self.out.close()
        # A task that is repeated gives its files the same names.
        self.store.move(self.draft, f"{self.root}/{self.where}/{self.name}-c{self.files:03d}.snappy.parquet")
        self.files += 1
        self.writer, self.rows = None, 0


def write_partitions(rows: DataFrame, path: str, partition_by: Sequence[str], rows_per_file: int) -> dict[str, int]:
    """Add rows to a table and return how many files were written, and their bytes.

    Rows must come sorted by the partition columns in each task.  A run that fails leaves files.
    """
    spark = rows.sparkSession
    data = [f for f in rows.schema if f.name not in partition_by]
    footer = {"org.apache.spark.version": spark.version}
    if any(f.metadata for f in data):
        # All else of the schema follows from Parquet's types.
        footer["org.apache.spark.sql.parquet.row.metadata"] = T.StructType(data).json()
    job, levels = uuid.uuid4().hex, len(partition_by)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(path)
        made = _Files(store, root, f"part-{TaskContext.get().partitionId():05d}-{job}", footer, rows_per_file)
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.columns[:levels]
            own = batch.select(batch.schema.names[levels:])
            ends = np.unique(np.concatenate([pc.run_end_encode(c).run_ends.to_numpy() for c in keys]))
            starts = np.concatenate([[0], ends[:-1]])
            values = zip(*(c.take(pa.array(starts)).to_pylist() for c in keys), strict=True)
            for start, end, value in zip(starts.tolist(), ends.tolist(), values, strict=True):
                if value != last:
                    made.close()
                    last, where = value, folder(partition_by, value)
                made.add(where, own.slice(start, end - start))
        made.close()
        yield pa.RecordBatch.from_pydict({"files": [made.files], "bytes": [made.bytes]})

    store, root = opened(path)
    store.create_dir(root, recursive=True)
    wrote = rows.select(*partition_by, *[f.name for f in data]).mapInArrow(work, "files long, bytes long")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("files", "bytes")]
    done = wrote.agg(*sums).first().asDict()
    store.open_output_stream(f"{root}/_SUCCESS").close()
    return done


def read_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    tasks: int,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a table (``columns``, all of the schema by default), and the file of each below the table as ``_file``.

    ``tasks`` share the folders of the first level, then all files found in them,
    so that the driver holds no file names.  A column that a file lacks is NULL there.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = T.StructType([schema[c] for c in columns or schema.names])
    made = to_arrow_schema(wanted)
    inside = [f for f in made if f.name not in partition_by]
    places = {f.name: (list(partition_by).index(f.name), f.type) for f in made if f.name in partition_by}

    def found(below: str, recursive: bool) -> list[fs.FileInfo]:
        store, root = opened(path)
        return store.get_file_info(fs.FileSelector(f"{root}/{below}".rstrip("/"), recursive=recursive))

    def name(info: fs.FileInfo) -> str:
        return info.path[len(opened(path)[1].rstrip("/")) + 1 :]

    def seen(file: str) -> bool:
        return not any(part.startswith((".", "_")) and "=" not in part for part in file.split("/"))

    def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            infos = [i for i in found("", False) if seen(name(i))]
            if loose := [i.path for i in infos if i.type != fs.FileType.Directory]:
                raise ValueError(f"{loose[0]!r} is in no partition's folder")
            yield pa.RecordBatch.from_pydict({"path": pa.array([name(i) for i in infos], pa.string())})

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for below in batch.column(0).to_pylist():
                names = [name(i) for i in found(below, True) if i.type == fs.FileType.File]
                yield pa.RecordBatch.from_pydict({"path": pa.array([n for n in names if seen(n)], pa.string())})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(path)
        names: list[str] = []
        counts: list[int] = []
        cells: dict[str, list[pa.Array]] = {f.name: [] for f in inside}

        def together() -> pa.RecordBatch:
            which = pa.array(np.repeat(np.arange(len(names)), counts))
            values = [partition_values(n, partition_by) for n in names]
            arrays = []
            for f in made:
                if f.name in places:
                    place, kind = places[f.name]
                    arrays.append(pa.array([v[place] for v in values], pa.string()).cast(kind).take(which))
                else:
                    arrays.append(pa.concat_arrays(cells[f.name]))
                    cells[f.name].clear()
            arrays.append(pa.array(names, pa.string()).take(which))
            names.clear()
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, [*made.names, "_file"])

        held = 0
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with store.open_input_file(f"{root}/{file}") as source:
                    stored = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
                    has = set(stored.schema_arrow.names)
                    own = [f.name for f in inside if f.name in has]
                    few = own and stored.metadata.num_rows <= CHUNK_ROWS
                    for some in stored.read(own, False).to_batches() if few else stored.iter_batches(CHUNK_ROWS, columns=own, use_threads=False):
                        names.append(file)
                        counts.append(some.num_rows)
                        held += some.num_rows
                        for f in inside:
                            column = some.column(f.name) if f.name in has else pa.nulls(some.num_rows, f.type)
                            cells[f.name].append(column if column.type == f.type else column.cast(f.type))
                        if held >= CHUNK_ROWS:
                            yield together()
                            held = 0
        if names:
            yield together()

    top = spark.range(1, numPartitions=1).mapInArrow(first_level, "path string")
    listed = top.repartition(tasks, "path").mapInArrow(files, "path string").repartition(tasks, "path")
    return listed.mapInArrow(rows, T.StructType([*wanted, T.StructField("_file", T.StringType(), False)]))
