"""A corpus pipeline of five stages, each calling one operator of ``tallyfield.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import functools
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm import jaccard_join, language, line_templates, packing, suffix_repeats
from tallyfield.llm.common import noting, release, saved, shared_dir, sieve, sifted
from tallyfield.session import ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with n_chars counted anew."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


#: The share of labelled training documents that may score below what the language stage asks for.
LEAST_LIKE = 0.001


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: those without any letter or text, and those
    whose cosine with the best profile is no more than chance. That is below three times the spread of random vectors
    (3 / sqrt(dimensions)), or below what all but ``LEAST_LIKE`` of all labelled training
    documents reach, if that is less. ``lang`` becomes the predicted one only where it was null.
    Rows are judged each: repeated rows and shared or null ids stay as they are, null, empty and letterless
    texts go, an empty table stays empty, and columns beyond those of documents are left out, whatever their names."""
    ship_package(spark)
    found = saved(language.identify(docs))
    trained = found.where(~F.col("held_out") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.col("lang_pred") != language.UNKNOWN))
    reached = trained.agg(F.percentile_approx("score", LEAST_LIKE, 100_000)).first()[0]
    chance = (1 + 3 / math.sqrt(language.DIMENSIONS)) / 2
    least = chance if reached is None else min(chance, reached)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least)
    return _documents(found.where(known).withColumn("lang", F.coalesce("lang", "lang_pred")))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines of recurring templates but the first; documents left with spaces alone go, with null and
    empty ones. Identical rows count as one document for what recurs and lose the same lines; of equal lines the
    first by id, then by place, stays. Null ids count as the least. Columns beyond those of documents are left out."""
    return _documents(line_templates.drop_recurring_lines(docs, short_lines=True).where(F.trim("text") != ""))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows linked by a Jaccard similarity of 0.8 of five-word shingles one stays, that with
    the smallest id (null ids come last), then the smallest hash of the text, then of the row.

    Every row is a node of its own: rows that share an id are linked only if their texts are, and
    rows without an id take part like others. Texts without a word link with nothing, but of
    rows with the same id and such a text one stays, too. Rows are told apart by 64-bit hashes of all columns, so
    no table of them is written, and the texts of rows that surely stay aren't shuffled."""
    rows = docs.select(*COLUMNS)
    rows = rows.withColumn("_row", F.xxhash64(*COLUMNS, *[F.col(c).isNull() for c in COLUMNS]))
    with noting() as tables:
        groups = jaccard_join.jaccard_groups(rows, id_column="_row", words=5, part=80, share=100)
    groups = groups.select(F.col("doc_id").alias("_row"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("_group")).distinct()
    keyed = rows.groupBy("_row", "doc_id", F.xxhash64("text", F.col("text").isNull()).alias("_th")).agg(F.count(F.lit(1)).alias("_copies"))
    keyed = saved(keyed.join(groups, "_row"))
    release(*tables)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th", "_row")).alias("first")
    linked = keyed.where("_group is not null").groupBy("_group").agg(first).select("first._row")
    lone = keyed.where("_group is null").groupBy("doc_id", "_th").agg(first).select("first._row")
    kept = saved(linked.union(lone))
    lost = keyed.join(kept, "_row", "left_anti").select("_row").union(keyed.where("_copies > 1").select("_row"))
    unsure, sure = sifted(rows, sieve(lost, "_row"), "_row")
    one = unsure.join(kept, "_row", "left_semi").dropDuplicates(["_row"])
    return sure.select(*COLUMNS).union(one.select(*COLUMNS))


#: Shorter than almost every passage of 50 words (of those that documents of the check tables share, 99.9 % have
#: 150 bytes or more, 99 % 248 or more), and longer than a sentence that two writers may share by chance.
REPEATED_BYTES = 200


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes bytes covered by repeated strings of ``REPEATED_BYTES``; documents left without text go, with
    null, empty and blank ones. Rows that share id and text are copies of each other and lose all of it."""
    return _documents(suffix_repeats.remove_repeats(docs, length=REPEATED_BYTES).where(F.trim("text") != ""))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences of 1024: a row for each piece. Repeated rows and shared or null ids are
    packed each, a null or empty text is its end token alone, an empty table has no pieces."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


#: The tables that the last stage's result still reads.
_held: list[DataFrame] = []


def _after_the_last(stage):
    """A stage's result reads tables that it wrote. When the next stage is called, its predecessor's result has been
    written, so those tables go first: stages of a session run one after the other."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(*[t for t in _held if t.sparkSession is spark])
        _held.clear()
        with noting() as tables:
            out = stage(spark, docs, sf_dir)
        _held.extend(tables)
        return out

    return run_stage


STAGES = [
    ("language_id", _after_the_last(keep_known_languages)),
    ("line_dedup", _after_the_last(drop_recurring_lines)),
    ("jaccard_join", _after_the_last(keep_one_of_each_group)),
    ("suffix_dedup", _after_the_last(drop_repeated_strings)),
    ("packing", _after_the_last(pack_sequences)),
]

#: Components, the byte-level suffix order, profiles and tokenization are beyond SQL. In ``tests/llm`` the operators are
#: tested against brute-force versions; of the stages, the Jaccard and packing ones against whole expectations, the
#: others on planted and odd rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each on what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
