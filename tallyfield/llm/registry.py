"""The training-data operators as queries over their tables, with production parameters."""

from __future__ import annotations

import os
import sys

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, jaccard_join, language, line_templates, lm, near_vectors, packing, pieces, private_spans, suffix_repeats, token_scan, top_products, whitening
from ..session import ship_package
from .common import shared_dir


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_templates.drop_recurring_lines(table(spark, sf_dir, "documents"), short_lines=True)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_vector_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.link_near_vectors(table(spark, sf_dir, "embeddings"))


def op3_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many pieces, the crc32 of their ids, and whether decoding gives the text back."""
    docs, model = table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")

    def digest(frames):
        import zlib

        import numpy as np

        held = pieces.piece_model(model)
        for f in frames:
            rows = [(len(x), zlib.crc32(np.asarray(x, dtype="<u4").tobytes())) for x in f["ids"]]
            out = pd.DataFrame(rows, columns=["n_pieces", "ids_crc32"])
            yield out.assign(doc_id=f["doc_id"].astype("Int64").to_numpy(), decoded=[held.decode(x).encode() for x in f["ids"]])

    encoded = pieces.encode_pieces(docs, model)
    return encoded.mapInPandas(digest, "doc_id long, n_pieces long, ids_crc32 long, decoded binary").select(
        "doc_id", "n_pieces", "ids_crc32", F.length("decoded").cast("long").alias("n_bytes"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))


def op5_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.top_inner_products(table(spark, sf_dir, "embeddings"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the documents as flat token files, scans these, and names each counted document."""
    import uuid

    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    tokenizer = tokenizer_path("byte_bpe_50k.json")
    token_scan.write_token_blocks(table(spark, sf_dir, "documents"), path, tokenizer)
    rows = spark.read.schema("file long, number long, doc_id long, data binary, kind int").parquet(path)
    counts = token_scan.count_tokens(rows.where("kind = 0").select("file", F.col("number").alias("block"), "data"), 50256)
    order = rows.where("kind = 1").select("file", "number", "doc_id")
    return order.join(counts, ["file", "number"]).select("doc_id", "n_tokens")


def op7_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of ``repeat_report``; its further columns follow the cuts of phrases."""
    report = suffix_repeats.repeat_report(table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op11_span_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the patterns' spans, and all spans, as kind:start:end."""
    found = private_spans.find_private(table(spark, sf_dir, "documents"))
    base = F.filter("private", lambda s: s["base"])
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, private_spans.KINDS), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("private")).alias("spans"))


def op12_range_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_event_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, names = table(spark, sf_dir, "documents"), ("byte_bpe_50k.json", "piece_bpe_32k.model")
    return alignment.align_tokens(docs, *map(tokenizer_path, names), keep_groups=False).withColumnRenamed("groups", "groups_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if top not in sys.path:
        sys.path.insert(0, top)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    out = [
        op1_line_templates, op2_vector_forest, op3_piece_viterbi, op4_jaccard_join, op5_pivot_top_k, op6_token_counts,
        op7_log_bilinear, op8_suffix_repeats, op9_complement_packing, op10_language_profiles, op11_span_field, op12_range_whitening, op13_event_alignment, pipeline,
    ]
    return {f.__name__: f for f in out}


def oracle_sql() -> dict[str, str]:
    from . import sql

    return dict(sql.ORACLE)
