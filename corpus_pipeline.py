"""The corpus pipeline: rules, near copies, repeated passages, leaks, token ids.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, the docs of the next stage. ``run`` checkpoints it to the
shared folder in between (an RDD checkpoint, not Parquet). All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from playlens.llm import common as C
from playlens.llm import op4_byte_bpe as bpe
from playlens.llm import op6_substring_dedup as repeats
from playlens.llm import op8_simhash as simhash
from playlens.llm import op9_quality_rules as rules
from playlens.llm import op10_decontamination as leaks


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules, or the verdict on their host, reject go."""
    return rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the least id stays."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut from the text; every document stays."""
    return repeats.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return leaks.drop_contaminated(docs, C.read_documents(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and the text decoded from them."""
    return bpe.token_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_copies),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", token_ids),
]

#: Near copies, passages and token ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is checkpointed to the shared folder before the next."""
    docs = C.read_documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = C.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
