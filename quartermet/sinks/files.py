"""Whole files written by tasks, for formats Spark has no sink for."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    # Hadoop writes local paths as file:/x, Arrow wants file:///x.
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))


def write_files(files: DataFrame, folder: str, listed: str | None = None) -> dict[str, int]:
    """Write files (path below the folder, content) and return how many, and their bytes.

    ``listed`` keeps a table of them (path, size), by which ``read_listed`` finds them again.

    A file is written under a name of its own and then renamed, so a task that
    is repeated, or runs twice, leaves one whole file.  The folder must be one
    that all executors see: a path, or an address Arrow's file systems know.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = opened(folder)
        made = None
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                if path.startswith("/") or ".." in path.split("/"):
                    raise ValueError(f"{path!r} is not below the folder")
                where, _, name = f"{root}/{path}".rpartition("/")
                if where != made:
                    store.create_dir(where, recursive=True)
                    made = where
                # Readers skip names that start with an underscore.
                draft = f"{where}/_{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as out:
                    out.write(content)
                store.move(draft, f"{where}/{name}")
            yield pd.DataFrame({"path": batch["path"], "size": batch["content"].map(len).astype("int64")})

    sizes = files.select("path", "content").mapInPandas(work, "path string, size long")
    if listed:
        sizes.write.parquet(listed)
        sizes = files.sparkSession.read.parquet(listed)
    done = sizes.agg(F.count("size").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    return done.first().asDict()


#: Bytes of files that a task holds at once, unless a single one is larger.
BATCH_BYTES = 8 * 1024 * 1024


def read_listed(listed: DataFrame, folder: str, suffix: str = "") -> DataFrame:
    """Files below a folder (path, content) by a table of their paths, as ``write_files`` keeps it.

    Tasks share the table and open what it names.  No folder is listed, so that
    the driver holds no file names, however many files there are.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = opened(folder)
        paths: list[str] = []
        contents: list[bytes] = []
        held = 0
        for batch in batches:
            for path in batch["path"]:
                with store.open_input_file(f"{root}/{path}") as file:
                    contents.append(file.read())
                paths.append(f"{folder}/{path}")
                held += len(contents[-1])
                if held >= BATCH_BYTES or len(paths) >= 4096:
                    yield pd.DataFrame({"path": paths, "content": contents})
                    paths, contents, held = [], [], 0
        if paths:
            yield pd.DataFrame({"path": paths, "content": contents})

    wanted = listed.where(F.endswith("path", F.lit(suffix))) if suffix else listed
    return wanted.select("path").mapInPandas(work, "path string, content binary")
