"""Corpus pipeline: training-data operators in order, each stage written as Parquet and reread.

documents → quality rules → near-duplicates → repeated byte passages → mix of sources → token ids.
Every stage works on all that its predecessor kept.  All but the last return the columns of ``documents``; in the mix
a document appears as often as its source's budget takes it.  The last returns for every row of the mix
``doc_id, lang, source, n_tokens, ids`` (little-endian unsigned 32-bit integers) and the SHA-256 of the ids and of the
decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmetrics.llm import bpe, minhash, mixing, quality, suffix_dedup
from starmetrics.llm.common import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: rejected documents go, failing lines are removed from the others."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near-duplicates the document with the smallest id stays."""
    return minhash.dedup(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: bytes of passages that an earlier document holds are removed."""
    return suffix_dedup.dedup(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents are left out or repeated so that each source meets its target."""
    return mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the token ids of every row."""
    out = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    return bpe.encode(docs.select("doc_id", "lang", "source", "text"), outputs=out)


STAGES = [("quality rules", quality_rules), ("MinHash near-dedup", near_duplicates), ("suffix-array dedup", repeated_passages),
          ("mixing sources", source_mix), ("BPE encoding", token_ids)]

#: SQL can't express the byte dedup and the tokens; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
