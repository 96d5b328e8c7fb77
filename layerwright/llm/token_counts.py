"""Token counts of flat token files without an index.

A file is token identifiers of fixed width, documents ended by a separator. Blocks of a file are scanned side by
side: numpy finds the separators of a block at once. A prefix scan over the blocks' totals then gives each block
the number of documents before it and the place of the last separator before it, which stitches the documents
that reach over block borders.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.byte_pairs import token_ids
from layerwright.llm.common import small_batches
from layerwright.llm.files import file_system, new_file
from layerwright.session import scratch_path, stage

BLOCK_TOKENS = 1 << 20
BLOCKS_A_TASK = 8
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SEPARATOR = 50256
_encoders: dict[str, tiktoken.Encoding] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> tiktoken.Encoding:
    if path not in _encoders:
        import public_tokenizers

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _encoders[path] = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encoders[path]


def write_token_files(
    docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokenise all documents into flat files of uint16, each document ended by ``SEPARATOR``.

    Returns the order in which they were written: path, place (from 0), doc_id. A null or empty text is a
    document of no tokens. Each task writes one file below ``folder``.
    """
    store = folder or scratch_path(docs.sparkSession, "tokens")
    vocabulary = vocabulary or vocabulary_path()
    end = np.array([SEPARATOR], "<u2").tobytes()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = file_system(store)
        system.create_dir(base, recursive=True)
        coder, out, path, place = encoder(vocabulary), None, "", 0
        for batch in batches:
            if out is None:
                path = new_file(base, ".u16")
                out = system.open_output_stream(path, compression=None)
            for text in batch.body:
                # Unpaired surrogates cannot come out of UTF-8; control strings in a text are ordinary text.
                if text:
                    out.write(token_ids(coder, text).astype("<u2").tobytes())
                out.write(end)
            yield pd.DataFrame(
                {"path": f"{store}/{path.rsplit('/', 1)[1]}", "place": np.arange(place, place + len(batch)), "doc_id": batch.doc_id}
            )
            place += len(batch)
        if out is not None:
            out.close()

    small_batches(docs.sparkSession)
    body = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("body"))
    written = body.mapInPandas(write, "path string, place long, doc_id string")
    return stage(written.withColumn("doc_id", F.col("doc_id").cast("long")), "token-order")


def scan_separators(files: DataFrame, separator: int = SEPARATOR, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``files``: path. Returns path, place (of the document, from 0), first (token), n_tokens, ended.

    A last document without a separator is reported with ``ended`` false if it has tokens. Empty files have no
    documents; null paths are skipped. A file that is no whole number of tokens is an error.
    """
    width = np.dtype(dtype).itemsize

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch.path:
                system, name = file_system(path)
                size = system.get_file_info(name).size
                if size % width:
                    raise ValueError(f"{path}: {size} bytes are no whole number of tokens")
                starts = np.arange(0, size // width, block_tokens)
                yield pd.DataFrame({"path": path, "start": starts})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch.path, batch.start):
                system, name = file_system(path)
                with system.open_input_file(name) as file:
                    tokens = np.frombuffer(file.read_at(block_tokens * width, int(start) * width), dtype)
                ends = np.flatnonzero(tokens == separator) + int(start)
                yield pd.DataFrame({"path": [path], "start": [start], "stop": [start + len(tokens)], "ends": [ends]})

    paths = files.select("path").filter("path is not null").distinct()
    blocks = stage(paths.mapInPandas(cut, "path string, start long"), "token-cuts")
    # A fixed number of partitions, which is not coalesced: some blocks to a task, however few bytes their names take.
    blocks = blocks.repartition(max(1, -(-blocks.count() // BLOCKS_A_TASK)), "path", "start")
    scanned = stage(blocks.mapInPandas(scan, "path string, start long, stop long, ends array<long>"), "token-blocks")
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    totals = scanned.select(
        "path",
        "start",
        F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)).alias("places"),
        F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(earlier), F.lit(-1)).alias("last_end"),
        F.sum(F.size("ends")).over(whole).alias("all_places"),
        F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(whole), F.lit(-1)).alias("all_end"),
        F.max("stop").over(whole).alias("all_stop"),
    )
    stitched = scanned.join(totals, ["path", "start"])
    found = stitched.select("path", "places", "last_end", "ends", F.posexplode("ends").alias("i", "end")).select(
        "path",
        (F.col("places") + F.col("i")).alias("place"),
        (F.when(F.col("i") == 0, F.col("last_end")).otherwise(F.get("ends", F.col("i") - 1)) + 1).alias("first"),
        "end",
    )
    ended = found.select("path", "place", "first", (F.col("end") - F.col("first")).alias("n_tokens"), F.lit(True).alias("ended"))
    open_end = totals.filter((F.col("start") == 0) & (F.col("all_stop") > F.col("all_end") + 1)).select(
        "path",
        F.col("all_places").alias("place"),
        (F.col("all_end") + 1).alias("first"),
        (F.col("all_stop") - F.col("all_end") - 1).alias("n_tokens"),
        F.lit(False).alias("ended"),
    )
    return ended.unionByName(open_end)


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens of every document, counted by a scan of the token files its tokens are written to."""
    order = write_token_files(docs, vocabulary=vocabulary)
    counts = scan_separators(order)
    return order.join(counts, ["path", "place"]).select("doc_id", "n_tokens")
