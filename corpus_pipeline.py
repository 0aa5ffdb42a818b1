"""A training corpus from raw documents: quality rules, near-duplicates, benchmark passages, personal data, packing.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again
as the next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan.llm.common import materialise, table
from quillspan.llm.decontamination import remove_passages
from quillspan.llm.packing import pack
from quillspan.llm.pii import pseudonymise
from quillspan.llm.quality import filter_documents
from quillspan.llm.simhash import drop_near_duplicates
from quillspan.llm.token_counts import model_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no quality rule."""
    return filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by doc_id) of every group of texts with a similarity of 0.8 or more; rows without a doc_id are documents, too."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out of the texts; documents of which nothing but white space is left go."""
    return remove_passages(docs, table(spark, sf_dir, "benchmark")).filter(F.expr("text rlike '[^\\\\x20\\\\x09-\\\\x0D]'"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in place of personal data, under the session's key."""
    return pseudonymise(docs, counts=False)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    return pack(docs, model_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]
#: Hamming links, permuted digits and packing plans are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
