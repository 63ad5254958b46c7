"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists the stages in order; each is called with the documents its
predecessor kept, is written as Parquet and read again.  All but the last
return the columns of documents.

1. toxicity      documents that the classifier rejects go
2. line_dedup    repeated and nearly repeated lines go
3. simhash       one document of each near-duplicate group stays
4. mixing        sources are mixed to their target weights: documents are
                 repeated, cut at the quota or left out
5. packing       token sequences of at most 1024 tokens
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gearbox.llm import line_dedup, mixing, packing, simhash, toxicity
from gearbox.llm.common import materialise, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a model learnt from the labels
    of these documents (held-out ids excepted)."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out("doc_id"))
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its token ids."""
    return packing.pack(docs)


STAGES = [("toxicity", remove_toxic), ("line_dedup", remove_lines), ("simhash", remove_near_duplicates),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Scores, fingerprints and token ids are not SQL; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
