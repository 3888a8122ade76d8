"""A training corpus from raw documents: toxic ones go, one of each group of near copies stays, what
holds benchmark passages goes, sources are mixed to target weights, and the rest becomes token files.

Near copies share 80 % of their five-word shingles.  Each stage sees all rows that its predecessor
kept, written as Parquet and read again.  All stages but the last return the columns they were given,
other names among them too, and treat odd rows alike: null and empty texts are never toxic, have no
copies and hold no passages; rows that repeat an id are each judged by their own text; a null id stays
null; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayflux.llm.common import stored, table
from wayflux.llm.decontaminate import drop_contaminated
from wayflux.llm.mixing import mixed_sample
from wayflux.llm.near_dup import keep_one
from wayflux.llm.queries import tokenizer_path, training_rows
from wayflux.llm.token_files import token_table
from wayflux.llm.toxicity import drop_toxic, learn


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model is learnt from the labels of these documents.

    Without toxic or without clean labels nothing is predicted toxic.  Null and empty texts stay.
    """
    return drop_toxic(docs, learn(docs, table(spark, sf_dir, "labels"), usable=training_rows()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of each group of near copies.

    Texts without words form no group and stay.  Of rows that repeat id and text all stay or go; a null
    id counts as the least.
    """
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten consecutive words of a benchmark item occur.

    Texts without words and null texts stay; null items and an empty benchmark take nothing away.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the tokens, raked to flatter shares of sources, languages and topics.

    Null sources and languages are values of their own; texts without words cost no tokens and stay.
    """
    return mixed_sample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's place and checksum in the token files, in ascending doc_id.

    Null and empty texts are the end id alone; null ids come first, rows that repeat an id follow each other.
    """
    return token_table(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("tokens", tokens)]

#: Learnt scores, signatures and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
