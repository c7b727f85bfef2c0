"""Lengths of the documents in flat token files, found by scanning for separators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, slices
from .packing import byte_bpe


def write_token_blocks(
    df: DataFrame, path: str, tokenizer: str, id_column: str = "doc_id", text: str = "text", block_tokens: int = 1 << 18
) -> None:
    """Tokenizes documents into flat token files: each task's stream of 16-bit ids, a separator after
    every document, cut into blocks without regard to documents (``kind=0``: file, block, data).
    Beside them lies the order of the documents (``kind=1``: file, number, doc_id)."""

    def run(frames):
        tokens, file = byte_bpe(tokenizer), TaskContext.get().partitionId()
        end = tokens.n_vocab - 1
        stream, held, block, number = [], 0, 0, 0
        for f in slices(frames, "t"):
            order = pd.DataFrame({"file": file, "number": np.arange(number, number + len(f)), "doc_id": f["id"].astype("Int64"), "data": None, "kind": 1})
            number += len(f)
            yield order
            for t in f["t"]:
                ids = np.append(np.asarray(tokens.encode_ordinary(t or ""), dtype="<u2"), np.array([end], dtype="<u2"))
                stream.append(ids)
                held += len(ids)
                if held >= block_tokens:
                    flat = np.concatenate(stream)
                    whole = held // block_tokens
                    cut = [flat[k * block_tokens : (k + 1) * block_tokens].tobytes() for k in range(whole)]
                    yield pd.DataFrame({"file": file, "number": np.arange(block, block + whole), "doc_id": None, "data": cut, "kind": 0})
                    block += whole
                    stream, held = [flat[whole * block_tokens :]], held - whole * block_tokens
        if held:
            yield pd.DataFrame({"file": file, "number": [block], "doc_id": None, "data": [np.concatenate(stream).tobytes()], "kind": 0})

    source = df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("t"))
    rows = source.mapInPandas(run, "file long, number long, doc_id long, data binary, kind int")
    rows.write.partitionBy("kind").option("compression", "zstd").parquet(path)


def count_tokens(blocks: DataFrame, separator: int, dtype: str = "<u2", keep_separator: bool = False) -> DataFrame:
    """(file, number, n_tokens): the documents of flat token files in their order.

    ``blocks`` has the columns file, block and data, the files' bytes in blocks of any size that
    is a whole number of ids. Each block is searched on its own: how many separators it has, the
    tokens before its first and after its last, and the lengths between. A running sum over a file's
    blocks gives each block the number of its first document, and the tokens that the document
    brought along, also through blocks without any separator. Tokens after a file's last separator
    are a document if there are any. Null data counts as empty; other columns are ignored.
    """

    def scan(frames):
        for f in frames:
            out = []
            for data in f["data"]:
                ids = np.frombuffer(data if data is not None else b"", dtype=dtype)
                at = np.flatnonzero(ids == separator)
                out.append((len(ids), len(at), int(at[0]) if len(at) else len(ids), len(ids) - 1 - int(at[-1]) if len(at) else len(ids), np.diff(at) - 1 if len(at) else []))
            yield pd.concat([f[["file", "block"]].reset_index(drop=True), pd.DataFrame(out, columns=["n", "ends", "head", "tail", "inner"])], axis=1)

    found = saved(blocks.select("file", "block", "data").mapInPandas(scan, "file long, block long, n long, ends long, head long, tail long, inner array<long>"))
    # prefix scan: a file's blocks have a few numbers each; runs since the last separator add up
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    spans = found.withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    run = Window.partitionBy("file", "first").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # blocks with the same ``first`` share an open document: one that began in the block before
    # them, whose tail it holds, and goes on through blocks without separators
    spans = spans.withColumn("opened", F.when(F.lag("ends").over(order) > 0, F.lag("tail").over(order)).otherwise(F.lit(0)))
    spans = spans.withColumn("carried", F.coalesce(F.sum(F.col("opened") + F.when(F.col("ends") == 0, F.col("n")).otherwise(F.lit(0))).over(run), F.lit(0)) + F.col("opened"))
    extra = 1 if keep_separator else 0
    closed = spans.where("ends > 0").select(
        "file",
        F.posexplode(F.concat(F.array(F.col("carried") + F.col("head")), "inner")).alias("k", "n_tokens"),
        "first",
    ).select("file", (F.col("first") + F.col("k")).alias("number"), (F.col("n_tokens") + extra).alias("n_tokens"))
    final = Window.partitionBy("file").orderBy(F.desc("block"))
    rest = spans.withColumn("k", F.row_number().over(final)).where("k = 1").select(
        "file", (F.col("first") + F.col("ends")).alias("number"), F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("n")).alias("n_tokens")
    )
    return closed.union(rest.where("n_tokens > 0"))
