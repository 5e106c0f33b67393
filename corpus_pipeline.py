"""Corpus pipeline over ``documents``: language ID, exact dedup, near-duplicate join,
mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``; all but the last return the
columns of ``documents``.  Empty tables pass through to an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from telemetra.llm.common import cut_lineage, pick
from telemetra.llm.queries import vocabulary
from telemetra.sources.tables import table


#: Columns that the stages read; the others are only carried.
READ = ("doc_id", "text", "lang", "source")


def _carrying(docs: DataFrame, operator) -> DataFrame:
    """``operator`` over ``docs`` and the columns of ``docs`` from its result: the
    carried ones go through under names that no operator gives."""
    names = {c: c if c.lower() in READ else f"__cp_{i}" for i, c in enumerate(docs.columns)}
    out = operator(docs.select(*[pick(c).alias(n) for c, n in names.items()]))
    return out.select(*[pick(n).alias(c) for c, n in names.items()])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without text or letters go."""
    model = language_id.train(docs.where(~language_id.held_out()))
    return _carrying(docs, lambda d: language_id.identify(d, model).where(F.col("lang_pred") != "und"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return _carrying(docs, lambda d: exact_dedup.exact_dedup(d).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked texts (five-word shingles, similarity 0.8 or more) the smallest id."""
    return _carrying(docs, lambda d: jaccard_join.near_distinct(d, words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies of documents in training order, sources at their target weights."""
    return _carrying(docs, mixing.mix_copies)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed training sequences with their token ids."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained model and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
