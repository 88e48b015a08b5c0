"""Registered queries of the numbered operators, over whole tables."""

from __future__ import annotations

import os
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.registry import Query
from ..session import shared_folder
from . import (
    alignment, decontamination, html_text, huffman, lattice, lsh_forest, merkle, packing, pii, secret_scan, sql, suffixes, toxicity, windows,
)
from .common import stored, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {"op11_merkle_witnesses": sql.MERKLE}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def tokenizer_path() -> str:
    """The byte-level vocabulary; the package lies on every machine."""
    import public_tokenizers

    return os.path.abspath(public_tokenizers.path("byte_bpe_50k.json"))


@F.pandas_udf(T.LongType())
def combined_crc32(parts: pd.Series) -> pd.Series:
    """Checksum of pieces (bytes long, checksum) laid after each other."""

    def one(pieces) -> int:
        total = 0
        for piece in pieces:
            # A checksum runs on over zeros; those of the piece itself are taken off again.
            gap = bytes(piece["size"])
            total = zlib.crc32(gap, total) ^ zlib.crc32(gap) ^ piece["crc"]
        return total

    return parts.map(one)


@query
def op1_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "huffman")
    huffman.write_ids(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    pieces = huffman.read_ids(spark, folder).select(
        "doc_id", "start", "n", F.struct("first", (F.col("n") * 4).alias("size"), F.crc32("ids").alias("crc")).alias("p")
    )
    whole = pieces.groupBy("start", "doc_id").agg(F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list("p")).alias("p"))
    return whole.select(
        "doc_id", "start", "n_tokens",
        F.when(F.size("p") == 1, F.col("p")[0]["crc"]).otherwise(combined_crc32("p")).alias("ids_crc32"),
    )


def packed_rows(docs: DataFrame) -> DataFrame:
    """Pieces with a checksum of their ids and their places in sequences."""
    made = stored(packing.pieces(docs, tokenizer_path(), end_id=2), "pieces")
    places = packing.pack(made)
    # The checksum first: the ids themselves are not shuffled.
    digests = made.select("uid", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return digests.join(places, "uid").select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        F.col("bin").alias("sequence_id"), F.col("offset").cast("long").alias("offset"),
    )


@query
def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows(table(spark, sf_dir, "documents"))


@query
def op2_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op10_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        F.col("row.doc_id").alias("doc_id"), toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op9_window_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = windows.dedup_substrings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op7_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.dedup_bytes(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


@query
def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lsh_forest.groups(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


@query
def op6_lattice_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lattice.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


@query
def op5_minimum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op4_skip_chain_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=False)
    counts = [F.col("counts")[i].alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts, "base_sha256", "spans")


@query
def op11_merkle_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = {c: F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.COLUMNS}
    found = merkle.manifest(table(spark, sf_dir, "documents"), carry={"tampered": F.when(tampered, merkle.leaf(changed))})
    start = F.coalesce("tampered", "leaf")
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256).alias("proof_sha256"),
        merkle.fold(start, F.col("sides"), F.col("siblings")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def ranks_path() -> str:
    """The byte-level vocabulary as ranks of its tokens."""
    import public_tokenizers

    return os.path.abspath(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op12_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find(table(spark, sf_dir, "documents"), ranks_path())
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def pieces_path() -> str:
    """The sentencepiece model."""
    import public_tokenizers

    return os.path.abspath(public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_fragment_monoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), pieces_path())
    return found
