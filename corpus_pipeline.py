"""From raw documents to token ids: each stage is written and read again by the next."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyloom.llm import byte_bpe, language_id, mixing, near_dedup, substring_dedup
from tallyloom.llm.tables import ship_package, table, unused
from tallyloom.sinks.scratch import materialize

#: Shares of a document's letters that must be of its language; und has none.
LEAST_LANGUAGE_SCORE = 0.4
#: Words of a shingle and percent of the union that near duplicates share.
SHINGLE_WORDS, NEAR_PERCENT = 5, 80
#: Documents that pass to a Python task at a time, unless the session says otherwise: whole texts of many would fill it.
BATCH_ROWS = 1_000
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are mostly of one learned language.

    Null and empty texts, and texts without a letter, go, as do all if no row has a label. Rows that
    repeat stay or go together. Columns of any name stay as they are; no rows give no rows.
    """
    _prepare(spark)
    network = language_id.train_network(docs)
    language, share = unused(docs.columns, "language_found"), unused(docs.columns, "language_share")
    found = language_id.identify(docs, network, keep=tuple(docs.columns), names=(language, share))
    sure = (F.col(language) != language_id.UNKNOWN) & (F.col(share) >= LEAST_LANGUAGE_SCORE)
    return found.where(sure).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id.

    Of rows that repeat an id and the words of its text, without regard to the case of A-Z, the one stays whose columns come
    first in order, text before the others; rows of one id with other words stay, being other versions. Null and empty
    texts are like no other text; rows without an id stay. Columns of any name stay as they are; no rows give no rows.
    """
    _prepare(spark)
    found = near_dedup.near_duplicates(docs, size=SHINGLE_WORDS, percent=NEAR_PERCENT)
    several, turn, said = (unused(docs.columns, name) for name in ("several", "turn", "said"))
    decided = materialize(
        found.groupBy("doc_id")
        .agg(F.bool_and("kept").alias("kept"), (F.count(F.lit(1)) > 1).alias(several))
        .where(~F.col("kept") | F.col(several)),
        "near_decided",
    )
    gone, repeated = (decided.where(test).select("doc_id") for test in (~F.col("kept"), F.col("kept")))
    if not repeated.take(1):  # no id that stays stands in several rows: the texts meet one list alone
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    alone = docs.join(decided.select("doc_id"), "doc_id", "left_anti")
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    lower = F.translate(words, string.ascii_uppercase, string.ascii_lowercase)
    rows = docs.join(repeated, "doc_id", "left_semi").withColumn(said, F.sha2(lower, 256))
    # The first row of each id and words is taken before and after the shuffle, so a hot id is cut down.
    first = Window.partitionBy("doc_id", said).orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    one_each = rows.withColumn(turn, F.row_number().over(first)).where(F.col(turn) == 1)
    return alone.select(*docs.columns).union(one_each.select(*docs.columns))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages, n_chars set anew; those of which nothing is left go.

    Null and empty texts stay, as nothing is cut from them. Rows that repeat an id count as one document. Columns of
    any name stay as they are; no rows give no rows.
    """
    _prepare(spark)
    aside = {c: unused(docs.columns, f"own_{c}") for c in docs.columns if c.lower() in ("n_sentences", "n_removed")}
    cut = substring_dedup.remove_repeats(docs.withColumnsRenamed(aside))
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"\S")
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    cut = cut.where(left).withColumn("n_chars", length)
    return cut.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target weights.

    Null categories are one of their own; null and empty texts are drawn at the rate of their cell, rows that repeat
    an id together. Columns of any name stay as they are; no rows give no rows.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, tokens, ids and the hashes of ids and of decoded bytes, a row per row.

    Null and empty texts have no ids. Other columns are left out; no rows give no rows.
    """
    _prepare(spark)
    return byte_bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True
    )


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs


#: Learned predictions cannot be told in SQL; the stages are tested against plain versions.
ORACLE_SQL = None
