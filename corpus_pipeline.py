"""A corpus pipeline: stages of training-data operators from raw documents to token ids.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last return the
columns of ``documents``.

Defined results: a null text has no words, bytes, shingles or tokens and passes all stages as null; a blank text is not toxic and no
duplicate; a null id takes no part in the search for duplicates and repeats, and its row stays; rows of one id are one document, which
stays or goes as a whole; a text that is all repeats goes; a null source is a source of its own; an empty table passes as
one; further columns pass through with their values, whatever their names are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.llm import bpe_lexicon, minhash, mixing, suffix_dedup, toxicity
from sessionflow.workdir import write_table

#: Bytes from which on a repeat is cut out of all documents but the first.
REPEAT_BYTES = 50
#: Near duplicates share 80 percent of their shingles of five words.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
VOCABULARY = "word_bpe_49k.json"


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_DOCUMENT = {"doc_id", "text", "lang", "source", "n_chars"}


def _keeping_columns(stage: Stage) -> Stage:
    """Further columns travel under names that no operator adds."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apart = docs.toDF(*[c if c in _DOCUMENT else f"further_{i}" for i, c in enumerate(docs.columns)])
        return stage(spark, apart, sf_dir).select(apart.columns).toDF(*docs.columns)

    return run


@_keeping_columns
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not likelier toxic than clean."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(~F.col("tox_rejected")).select(docs.columns)


@_keeping_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    found = minhash.near_duplicates(docs, width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    return docs.join(found.where(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


@_keeping_columns
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand in a document with a smaller id; a text that is all repeats goes."""
    marked = docs.withColumn("suffix_null", F.col("text").isNull())
    cut = suffix_dedup.remove_repeats(marked, length=REPEAT_BYTES, whole_characters=True)
    touched = F.col("suffix_removed") > 0
    text = F.when(~F.col("suffix_null"), F.decode("suffix_kept", "UTF-8"))
    left = cut.withColumn("text", text).where(~touched | (F.length(F.trim("text")) > 0))
    return left.withColumn("n_chars", F.when(touched, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(docs.columns)


@_keeping_columns
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, repeated as often as it takes them."""
    return mixing.repeated(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, token_ids``; ids are unsigned little-endian 32-bit integers."""
    path = public_tokenizers.path(VOCABULARY)
    lexicon = bpe_lexicon.build_lexicon(docs, path)
    encoded = bpe_lexicon.encode(docs.select("doc_id", "lang", "source", "text"), path, lexicon, keep_text=False)
    return encoded.select("doc_id", "lang", "source", F.col("bpe_tokens").alias("n_tokens"), F.col("bpe_ids").alias("token_ids"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: No stage but the mixing can be written in SQL; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
