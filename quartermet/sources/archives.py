"""Zip archives and checksums.

Archives are read by Spark's ``binaryFile`` source, one row each; tasks share
the archives and unpack theirs as a stream of line batches, so a task holds one
archive (a few MB) and one batch of lines at a time.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import STATION
from .observations import parse_lines

LINES_PER_BATCH = 20_000


def read_files(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
    )


def _member_lines(content: bytes) -> Iterator[tuple[str, list[str]]]:
    """Line batches of the members that hold observations (known by header)."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for name in archive.namelist():
            with archive.open(name) as member:
                text = io.TextIOWrapper(member, encoding="ISO-8859-1")
                if not text.readline().lstrip().startswith(STATION):
                    continue
                batch: list[str] = []
                for line in text:
                    batch.append(line.rstrip("\r\n"))
                    if len(batch) == LINES_PER_BATCH:
                        yield name, batch
                        batch = []
                if batch:
                    yield name, batch


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            for member, lines in _member_lines(content):
                yield pd.DataFrame({"path": path, "member": member, "value": lines})


def expand_archives(files: DataFrame) -> DataFrame:
    """Archives (path, content) to observation lines (path, member, value)."""
    return files.select("path", "content").mapInPandas(
        _expand, "path string, member string, value string"
    )


def read_archives(spark: SparkSession, path: str, product: str) -> DataFrame:
    """Observations of all archives below a folder."""
    lines = expand_archives(read_files(spark, path))
    return parse_lines(lines, product, "path").withColumnRenamed("path", "_source_file")


# ----------------------------------------------- lines and digests in one pass

UNPACKED = "path string, member string, lines array<string>, sha256 string, md5 string, problem string"
_BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError)


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["path", "member", "lines", "sha256", "md5", "problem"]
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            problem = None
            try:
                for member, lines in _member_lines(content):
                    rows.append((path, member, lines, None, None, None))
                    held += len(lines)
                    if held >= LINES_PER_BATCH:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
            except _BROKEN as error:
                problem = str(error) or type(error).__name__
            digests = hashlib.sha256(content).hexdigest(), hashlib.md5(content).hexdigest()
            rows.append((path, None, None, *digests, problem))
            held += 1
    if rows:
        yield pd.DataFrame(rows, columns=names)


def unpack_archives(files: DataFrame, path: str) -> None:
    """Write what one pass over archives (path, content) yields, as parquet.

    A batch of lines is a row with its member; an archive ends with a row without
    one, which holds both digests and what kept it from being read whole.  No
    archive is read again for its checksum, and none crosses a shuffle.
    """
    files.select("path", "content").mapInPandas(_unpack, UNPACKED).write.parquet(path)


def unpacked_digests(unpacked: DataFrame) -> DataFrame:
    """One row per archive: path, sha256, md5, problem (NULL if it was read whole)."""
    return unpacked.where(F.col("member").isNull()).select("path", "sha256", "md5", "problem")


def unpacked_lines(unpacked: DataFrame, sides: DataFrame | None = None) -> DataFrame:
    """Lines (path, member, value) of the archives that were read whole.

    With side files, archives that differ from theirs give no lines either; those
    without a side file do.  Only paths of refused archives are joined.
    """
    digests = unpacked_digests(unpacked)
    refused = digests.where(F.col("problem").isNotNull()).select("path")
    if sides is not None:
        refused = refused.union(differing(digests, sides).select("path"))
    lines = unpacked.where(F.col("member").isNotNull()).join(refused, "path", "left_anti")
    return lines.select("path", "member", F.explode("lines").alias("value"))


# -------------------------------------------------------------- checksums

def file_checksums(files: DataFrame) -> DataFrame:
    return files.select(
        "path", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5")
    )


def side_files(files: DataFrame) -> DataFrame:
    """Checksum files ("hash name" or the hash alone) with the file they speak of."""
    text = F.trim(F.decode("content", "UTF-8"))
    return files.select(
        F.regexp_replace("path", r"\.(sha256|md5)$", "").alias("path"),
        F.lower(F.regexp_extract(text, r"^(\S+)", 1)).alias("expected"),
    )


def checksum_mismatches(files: DataFrame, sides: DataFrame) -> DataFrame:
    """Files that differ from their side file; files without one are not listed."""
    return differing(file_checksums(files), sides)


def differing(digests: DataFrame, sides: DataFrame) -> DataFrame:
    """The same from digests (path, sha256, md5) taken before."""
    known = digests.join(side_files(sides), "path")
    actual = F.when(F.length("expected") == 32, F.col("md5")).otherwise(F.col("sha256"))
    return known.where(actual != F.col("expected")).select("path", "expected", actual.alias("actual"))
